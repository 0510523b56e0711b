import os

import pytest

from weftline.operators import graph, learn
from weftline.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_forecasts_reach_36_months(spark, monkeypatch):
    got = registry.QUERIES["j05_series_forecasts"](spark, FOLDER).groupBy("keyword", "model").count()
    assert {r["count"] for r in got.collect()} == {36}
    real, seen = learn.forecast_series, []
    monkeypatch.setattr(learn, "forecast_series", lambda *a, **k: seen.append((a[4:], k)) or real(*a, **k))
    registry.QUERIES["j06_forecast_run"](spark, FOLDER)
    assert seen == [((), {})]


def test_consensus_is_of_20_runs(spark, monkeypatch):
    real, seeds = graph.louvain, []
    monkeypatch.setattr(graph, "louvain", lambda links, seed: seeds.append(seed) or real(links, seed))
    registry.QUERIES["j08_consensus_communities"](spark, FOLDER)
    assert seeds == list(range(42, 62))


def test_forest_has_300_trees(spark, monkeypatch):
    class Fitted(Exception):
        pass

    def stop(features, target, trees=300, *_, **__):
        raise Fitted(trees)

    monkeypatch.setattr(learn, "forest", stop)
    with pytest.raises(Fitted, match="300"):
        registry.QUERIES["j01_forest_predictions"](spark, FOLDER)
