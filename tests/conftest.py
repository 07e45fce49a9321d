import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))
sys.path.append(str(ROOT / "tests" / "llm"))  # a package, so that its conftest is not taken for this one

from gaugemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """Rows and a schema text to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def house_row(**changes):
    """One complete house row."""
    row = {
        "id": 1, "date": "20141013T000000", "price": 500000.0, "bedrooms": 3.0, "bathrooms": 2.0, "sqft_living": 1500.0,
        "sqft_lot": 5000.0, "floors": 1.0, "waterfront": 0, "view": 0, "condition": 3, "grade": 7, "sqft_above": 1200.0,
        "sqft_basement": 300.0, "yr_built": 2000, "yr_renovated": 2010, "zipcode": "98178", "lat": 47.5, "long": -122.2,
        "sqft_living15": 1400.0, "sqft_lot15": 4800.0,
    }
    return {**row, **changes}


HOUSE_SCHEMA = (
    "id long, date string, price double, bedrooms double, bathrooms double, sqft_living double, sqft_lot double, floors double, "
    "waterfront int, view int, condition int, grade int, sqft_above double, sqft_basement double, yr_built int, yr_renovated int, "
    "zipcode string, lat double, long double, sqft_living15 double, sqft_lot15 double"
)


@pytest.fixture
def houses(spark):
    def build(*changes):
        names = [c.split()[0] for c in HOUSE_SCHEMA.split(", ")]
        return spark.createDataFrame([tuple(house_row(**c)[n] for n in names) for c in changes], HOUSE_SCHEMA)

    return build


@pytest.fixture
def zips(spark):
    from gaugemill.contracts import DEMOGRAPHIC_COLUMNS

    def build(*keys):
        rows = [(k, *(float(i + j) for i in range(len(DEMOGRAPHIC_COLUMNS)))) for j, k in enumerate(keys)]
        return spark.createDataFrame(rows, "zipcode string, " + ", ".join(f"{c} double" for c in DEMOGRAPHIC_COLUMNS))

    return build
