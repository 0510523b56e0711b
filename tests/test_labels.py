import pytest

from weftline.operators import graph
from weftline.plans import model_queries, registry


def test_labels_spread_until_they_settle(spark, monkeypatch):
    # Weights fall along the path, so node n00's label needs a round for each step.
    path = spark.createDataFrame([(f"n{i:02}", f"n{i + 1:02}", 100 - i) for i in range(14)] + [("m", "n00", 1000)], "a string, b string, weight long")
    monkeypatch.setattr(model_queries, "_triplets", lambda *_: None)
    monkeypatch.setattr(graph, "edges", lambda *_: path)
    got = {r.node: r.community for r in registry.QUERIES["j08_label_propagation"](spark, "").collect()}
    again = {r.node: r.community for r in graph.label_propagation(path).collect()}
    assert got == again and len(got) == 16


def test_swapping_labels_are_reported(spark):
    with pytest.warns(UserWarning, match="back and forth"):
        graph.label_propagation(spark.createDataFrame([("a", "b", 1)], "a string, b string, weight long"))
