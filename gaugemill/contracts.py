"""Feature contracts: which column plays which part, in which order the model sees them."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column names and their order are part of the data format.
SALES_COLUMNS = (
    "id", "date", "price", "bedrooms", "bathrooms", "sqft_living", "sqft_lot", "floors", "waterfront",
    "view", "condition", "grade", "sqft_above", "sqft_basement", "yr_built", "yr_renovated", "zipcode",
    "lat", "long", "sqft_living15", "sqft_lot15",
)
DEMOGRAPHIC_COLUMNS = (
    "ppltn_qty", "urbn_ppltn_qty", "sbrbn_ppltn_qty", "farm_ppltn_qty", "non_farm_qty",
    "medn_hshld_incm_amt", "medn_incm_per_prsn_amt", "hous_val_amt", "edctn_less_than_9_qty",
    "edctn_9_12_qty", "edctn_high_schl_qty", "edctn_some_clg_qty", "edctn_assoc_dgre_qty",
    "edctn_bchlr_dgre_qty", "edctn_prfsnl_qty", "per_urbn", "per_sbrbn", "per_farm", "per_non_farm",
    "per_less_than_9", "per_9_to_12", "per_hsd", "per_some_clg", "per_assoc", "per_bchlr", "per_prfsnl",
)
MINIMAL_COLUMNS = (
    "bedrooms", "bathrooms", "sqft_living", "sqft_lot", "floors", "zipcode", "lat", "long", "yr_built",
    "grade", "condition",
)
HOUSE_NUMERIC = (
    "bedrooms", "bathrooms", "sqft_living", "sqft_lot", "floors", "sqft_above", "sqft_basement",
    "yr_built", "yr_renovated", "lat", "long", "sqft_living15", "sqft_lot15",
)
HOUSE_CATEGORICAL = ("waterfront", "view", "condition", "grade", "zipcode")
ENGINEERED_COLUMNS = (
    "house_age", "renovated_flag", "renovation_age", "total_sqft", "living_to_lot_ratio",
    "bath_bed_ratio", "basement_ratio",
)
GEO_COLUMNS = ("geo_zip_bucket", "geo_cluster_placeholder")
DEFAULT_REFERENCE_YEAR = 2015

# Names under which a labeled table may hold truth and prediction.
TRUTH_CANDIDATES = ("actual_price", "price", "y_true", "ground_truth")
PREDICTION_CANDIDATES = ("predicted_price", "y_pred", "prediction")


@dataclass(frozen=True)
class FeatureContract:
    """Column groups of one fact table and its dimension.

    ``roles`` names the columns the engineered features are computed from, so the same rules serve any
    table that has a "built year", an "inside area" and so on.
    """

    name: str
    key: str
    target: str
    row_id: str
    metadata: tuple[str, ...]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    attributes: tuple[str, ...]
    roles: Mapping[str, str]
    critical: tuple[str, ...]
    engineered: tuple[str, ...] = ENGINEERED_COLUMNS
    geo: tuple[str, ...] = GEO_COLUMNS
    reference_year: int = DEFAULT_REFERENCE_YEAR
    hashed: tuple[str, ...] = ()  # categorical columns whose values a model codes by hash bucket

    @property
    def inference_columns(self) -> tuple[str, ...]:
        """Fact columns a row to be scored has to bring along."""
        return (*self.numeric, *(c for c in self.categorical if c not in self.numeric))

    @property
    def sales_columns(self) -> tuple[str, ...]:
        return (*self.metadata, *self.inference_columns)

    @property
    def merged_columns(self) -> tuple[str, ...]:
        return (*self.inference_columns, *self.attributes)

    @property
    def final(self) -> tuple[str, ...]:
        """Model input order: numeric, categorical, attributes, engineered, geo."""
        return (*self.numeric, *self.categorical, *self.attributes, *self.engineered, *self.geo)

    @property
    def model_numeric(self) -> tuple[str, ...]:
        return (*self.numeric, *self.attributes, *self.engineered, *self.geo)

    @property
    def critical_inference(self) -> tuple[str, ...]:
        return tuple(c for c in self.critical if c != self.target)

    def to_json(self) -> str:
        return json.dumps({**asdict(self), "roles": dict(self.roles), "final": list(self.final)}, indent=2)

    @classmethod
    def from_json(cls, text: str) -> FeatureContract:
        raw = {k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()}
        raw.pop("final", None)
        return cls(**raw)


def house_contract(reference_year: int = DEFAULT_REFERENCE_YEAR) -> FeatureContract:
    """Contract of the house-sales tables."""
    return FeatureContract(
        name="house",
        key="zipcode",
        target="price",
        row_id="id",
        metadata=("id", "date", "price"),
        numeric=HOUSE_NUMERIC,
        categorical=HOUSE_CATEGORICAL,
        attributes=DEMOGRAPHIC_COLUMNS,
        roles={
            "built": "yr_built",
            "renovated": "yr_renovated",
            "above": "sqft_above",
            "basement": "sqft_basement",
            "living": "sqft_living",
            "lot": "sqft_lot",
            "bathrooms": "bathrooms",
            "bedrooms": "bedrooms",
        },
        critical=("price", "zipcode", "bedrooms", "sqft_living"),
        reference_year=reference_year,
    )


HOUSE = house_contract()


@dataclass(frozen=True)
class Rule:
    """Bounds of one column; every rule also requires a value to be present. NaN is a missing value."""

    column: str
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    min_length: int | None = None
    integral: bool = False

    def holds(self) -> Column:
        c = F.col(self.column)
        ok = c.isNotNull()
        if self.min_length is None:
            ok = ok & ~F.isnan(F.coalesce(c.try_cast("double"), F.lit(0.0)))
        if self.ge is not None:
            ok = ok & (c >= self.ge)
        if self.gt is not None:
            ok = ok & (c > self.gt)
        if self.le is not None:
            ok = ok & (c <= self.le)
        if self.min_length is not None:
            ok = ok & (F.length(c) >= self.min_length)
        if self.integral:
            ok = ok & (c == F.floor(c))
        return F.coalesce(ok, F.lit(False))


# Bounds of the prediction rows.
FULL_ROW_RULES = (
    Rule("bedrooms", ge=0),
    Rule("bathrooms", ge=0),
    Rule("sqft_living", gt=0),
    Rule("sqft_lot", ge=0),
    Rule("floors"),
    Rule("waterfront", ge=0, integral=True),
    Rule("view", ge=0, integral=True),
    Rule("condition", ge=1, le=5, integral=True),
    Rule("grade", ge=1, le=13, integral=True),
    Rule("sqft_above", ge=0),
    Rule("sqft_basement", ge=0),
    Rule("yr_built", ge=1800, le=2100, integral=True),
    Rule("yr_renovated", ge=0, integral=True),
    Rule("zipcode", min_length=3),
    Rule("lat"),
    Rule("long"),
    Rule("sqft_living15", ge=0),
    Rule("sqft_lot15", ge=0),
)
MINIMAL_ROW_RULES = tuple(r for r in FULL_ROW_RULES if r.column in MINIMAL_COLUMNS)
MAX_REQUEST_ROWS = 500

# How a minimal row is completed; text names another column, numbers are constants.
MINIMAL_DEFAULTS: Mapping[str, str | float] = {
    "waterfront": 0,
    "view": 0,
    "sqft_above": "sqft_living",
    "sqft_basement": 0.0,
    "yr_renovated": 0,
    "sqft_living15": "sqft_living",
    "sqft_lot15": "sqft_lot",
}


@dataclass(frozen=True)
class Candidate:
    """One model to train: estimator name and target mode (``plain`` or ``log1p``)."""

    name: str
    target_mode: str = "plain"
    params: Mapping[str, float | int | str | bool] = field(default_factory=dict)

    @property
    def key(self) -> str:
        return f"{self.name}_{self.target_mode}"


@dataclass(frozen=True)
class TrainingParams:
    """Parameters of a training job."""

    random_state: int = 42
    test_size: float = 0.2
    reference_year: int = DEFAULT_REFERENCE_YEAR
    experiment_name: str = "house_price"
    registered_model_name: str = "house_price_regressor"
    cv_folds: int = 0
    # The candidates of a job that names none.
    candidates: tuple[Candidate, ...] = (
        Candidate("baseline_knn", "plain"),
        Candidate("hist_gradient_boosting", "log1p"),
        Candidate("random_forest", "log1p"),
        Candidate("extra_trees", "log1p"),
    )

    def to_json(self) -> str:
        settings = {k: v for k, v in asdict(self).items() if k != "candidates"}
        models = [{"name": c.name, "target_mode": c.target_mode, "params": dict(c.params)} for c in self.candidates]
        return json.dumps({"training": {**settings, "models": models}}, indent=2)

    @classmethod
    def from_json(cls, text: str) -> TrainingParams:
        """Parameters from a JSON document; what it leaves out keeps its default.

        Settings stand at the top or below ``training``. A value that does not convert and a model entry without a
        name raise.
        """
        document = json.loads(text) or {}
        settings = document.get("training") or document
        values: dict = {}
        for name, default in asdict(cls()).items():
            if name != "candidates" and name in settings:
                values[name] = type(default)(settings[name])
        entries = settings.get("models")
        if entries:
            values["candidates"] = tuple(_candidate(i, entry) for i, entry in enumerate(entries))
        return cls(**values)


def _candidate(position: int, entry: object) -> Candidate:
    if not isinstance(entry, dict) or not entry.get("name"):
        raise ValueError(f"model {position} of the training parameters has no name: {entry!r}")
    unknown = set(entry) - {"name", "target_mode", "params"}
    if unknown:
        raise ValueError(f"model {entry['name']!r} has unknown settings: {sorted(unknown)}")
    return Candidate(**entry)
