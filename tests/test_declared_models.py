"""The registered model queries fit the estimators as they are declared."""

import inspect

import pytest

from gaugemill.catalog import models
from gaugemill.plans.models import DEFAULT_PARAMS

FITTING = ["cv_rmse", "train_score_rf", "train_score_gbt", "train_score_extra", "model_importance", "feature_ablation", "train_compare"]


class Seen(Exception):
    pass


@pytest.mark.parametrize("name", FITTING)
def test_declared_settings(name, monkeypatch):
    def see(*given, **named):
        raise Seen([*given, *named.values()])

    for stand_in in ("fit_contract_model", "cross_validated_rmse", "ablate", "train"):
        monkeypatch.setattr(models, stand_in, see)
    for data in ("_split_features", "_facts", "nations", "work_dir"):
        monkeypatch.setattr(models, data, lambda *_: (None, None))
    with pytest.raises(Seen) as seen:
        models.QUERIES[name](None, "")
    given = seen.value.args[0]
    fitted = [c for x in given for c in getattr(x, "candidates", [x]) if isinstance(c, models.Candidate)]
    assert fitted and all({**DEFAULT_PARAMS[c.name], **c.params} == DEFAULT_PARAMS[c.name] for c in fitted)


def test_importance_repeats(monkeypatch):
    monkeypatch.setattr(models, "_split_features", lambda *_: (None, None))
    monkeypatch.setattr(models, "fit_contract_model", lambda *_: type("M", (), {"transform": None}))
    signature, seen = inspect.signature(models.importance_of), []
    monkeypatch.setattr(models, "importance_of", lambda *a, **k: seen.append(signature.bind(*a, **k)))
    models.QUERIES["model_importance"](None, "")
    seen[0].apply_defaults()
    assert seen[0].arguments["repeats"] == signature.parameters["repeats"].default == 5
