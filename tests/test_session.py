"""The shared work folder: named by the session, by the caller, or made for a local master."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from gaugemill.session import WORK_DIR, work_dir


class Conf(dict):
    """Settings of a session; those fixed when it was built can't be set."""

    def set(self, key, value):
        if key == "spark.checkpoint.dir":
            raise RuntimeError("CANNOT_MODIFY_CONFIG")
        self[key] = value


def session(master="local[2]", **conf):
    return SimpleNamespace(conf=Conf({k.replace("__", "."): v for k, v in conf.items()}), sparkContext=SimpleNamespace(master=master))


def test_folder_of_the_session_comes_first():
    spark = session("spark://x:7077", spark__checkpoint__dir="hdfs://a/shared/", gaugemill__work__dir="hdfs://b")
    first, second = work_dir(spark, "rows"), work_dir(spark, "rows")
    assert first.startswith("hdfs://a/shared/rows-") and first != second


def test_local_master_gets_one_folder():
    spark = session()
    first, second = Path(work_dir(spark, "rows")), Path(work_dir(spark, "rows"))
    assert first.parent == second.parent == Path(spark.conf[WORK_DIR]) and first.parent.is_dir()


def test_cluster_must_name_a_folder():
    spark = session("yarn")
    with pytest.raises(ValueError, match="gaugemill.work.dir"):
        work_dir(spark, "rows")
    spark.conf.set(WORK_DIR, "hdfs://c")
    assert work_dir(spark, "rows").startswith("hdfs://c/rows-")


def test_own_setting_can_be_changed_in_a_running_session(spark, tmp_path):
    spark.conf.set(WORK_DIR, str(tmp_path))
    assert spark.conf.get(WORK_DIR) == str(tmp_path)
    spark.conf.unset(WORK_DIR)
