from unittest.mock import MagicMock

import pytest

from weftline.operators import models
from weftline.plans import catalog


@pytest.mark.parametrize("name", ["permutation_importance", "param_search", "gbt_forecast"])
def test_registered_queries_run_the_whole_operator(monkeypatch, name):
    for place, names in ((catalog, ("training_frame", "shown", "rollout", "panel", "w")), (models, ("poisson_glm", "boosted_trees", "permutation_importance", "param_search"))):
        for n in names:
            monkeypatch.setattr(place, n, MagicMock())
    models.param_search.return_value = [(0.1, {})]
    catalog.queries()[name](MagicMock(), "")
    if name == "permutation_importance":
        call = models.permutation_importance.call_args
        assert call.args[2] == catalog.MODEL_FEATURES and call.kwargs.get("repeats", 5) == 5
    elif name == "param_search":
        call = models.param_search.call_args
        assert call.kwargs["trials"] == 50 and call.kwargs.get("folds", 3) == 3
    else:
        call = models.boosted_trees.call_args
        assert call.args[1] == catalog.MODEL_FEATURES and "rounds" not in (call.kwargs.get("params") or {})
