"""Tabular feature, scoring and drift engine on PySpark DataFrames."""

from gaugemill.contracts import HOUSE, FeatureContract, TrainingParams, house_contract
from gaugemill.session import build_session, work_dir

__all__ = [
    "HOUSE",
    "FeatureContract",
    "TrainingParams",
    "build_session",
    "house_contract",
    "work_dir",
]
