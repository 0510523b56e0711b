"""Weighted graphs from triplets: edges, consensus communities, components."""

from __future__ import annotations

import random
import warnings
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import singular
from weftline.session import cut


def edges(triplets: DataFrame, subject: str, relation: str, object_: str) -> DataFrame:
    """(a, b, weight, relations): undirected, entities singular and lower case, no loops."""
    x = triplets.select(singular(F.col(subject)).alias("s"), singular(F.col(object_)).alias("o"), F.col(relation).alias("r")).where("s is not null and o is not null and s != o")
    return x.groupBy(F.least("s", "o").alias("a"), F.greatest("s", "o").alias("b")).agg(F.count(F.lit(1)).alias("weight"), F.countDistinct("r").alias("relations"))


def label_propagation(e: DataFrame, guard: int = 1000) -> DataFrame:
    """(node, community) for graphs of any size: each node takes the heaviest label around it, the smaller on ties, keeping its own unless another is heavier.
    Goes on until no label moves; labels that swap back and forth, or more rounds than the guard, end it with a warning."""
    both = cut(e.select("a", "b", "weight").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")))
    label = both.select(F.col("a").alias("node")).distinct().withColumn("community", F.col("node"))
    last = None
    for _ in range(guard):
        near = both.join(label.select(F.col("node").alias("b"), "community"), "b").groupBy("a", "community").agg(F.sum("weight").alias("w"))
        own = label.select(F.col("node").alias("a"), "community", F.lit(0.5).alias("w"))
        best = near.unionByName(own).groupBy("a", "community").agg(F.sum("w").alias("w")).groupBy("a").agg(F.min_by("community", F.struct(-F.col("w"), F.col("community"))).alias("community"))
        new = cut(best.select(F.col("a").alias("node"), "community"))
        moved = lambda old: new.join(old.withColumnRenamed("community", "old"), "node").where("community != old").limit(1).count()  # noqa: E731, B023
        if not moved(label):
            return new
        if last is not None and not moved(last):
            warnings.warn("label_propagation: labels swap back and forth; those of the last round are given", stacklevel=2)
            return new
        last, label = label, new
    warnings.warn(f"label_propagation: labels still move after {guard} rounds", stacklevel=2)
    return label


def components(e: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component): the least node each is connected with; an error if the rounds don't suffice,
    which halve the distance each."""
    both = cut(e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component"))
    for _ in range(rounds):
        near = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("low"))
        step = label.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "low").alias("c"))
        far = label.select(F.col("node").alias("c"), F.col("component").alias("far"))
        new = cut(step.join(far, "c", "left").select("node", "old", F.least("c", F.coalesce("far", "c")).alias("component")))
        label = new.select("node", "component")
        if not new.where("old != component").limit(1).count():
            return label
    raise RuntimeError(f"components are not settled after {rounds} rounds")


def louvain(links: list[tuple[str, str, float]], seed: int) -> dict[str, str]:
    """Communities of a small graph by local moves that raise modularity, then by moves of whole communities."""
    rnd = random.Random(seed)
    group = {n: n for a, b, _ in links for n in (a, b)}
    near: dict = defaultdict(lambda: defaultdict(float))
    for a, b, w in links:
        near[a][b] += w
        near[b][a] += w
    total = sum(w for *_, w in links) * 2 or 1.0
    while True:
        of, size = {n: n for n in near}, {n: sum(near[n].values()) for n in near}
        degree, moved_any = dict(size), False
        while True:
            order, moved = sorted(near), False
            rnd.shuffle(order)
            for n in order:
                c = of[n]
                size[c] -= degree[n]
                pull: dict = defaultdict(float)
                for m, w in near[n].items():
                    if m != n:
                        pull[of[m]] += w
                best = max([c, *sorted(pull)], key=lambda k: (pull[k] - size[k] * degree[n] / total, k == c))
                size[best] += degree[n]
                if best != c:
                    of[n], moved, moved_any = best, True, True
            if not moved:
                break
        group = {n: of.get(c, c) for n, c in group.items()}
        if not moved_any:
            return group
        merged: dict = defaultdict(lambda: defaultdict(float))
        for n, ws in near.items():
            for m, w in ws.items():
                merged[of[n]][of[m]] += w
        near = merged


def consensus(e: DataFrame, runs: int = 20, share: float = 0.5, seed: int = 42, most: int = 200_000) -> DataFrame:
    """(node, community): edges kept whose ends share a community in at least half of the
    runs, then connected. The graph of a topic is small; one of more than `most` edges is refused: use label_propagation."""
    rows = e.select("a", "b", F.col("weight").cast("double")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} edges: use label_propagation")
    links = sorted(tuple(r) for r in rows)
    votes = [louvain(links, seed + i) for i in range(runs)]
    kept = [(a, b) for a, b, _ in links if sum(v[a] == v[b] for v in votes) >= share * runs]
    parent = {n: n for a, b, _ in links for n in (a, b)}

    def root(n: str) -> str:
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in kept:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return e.sparkSession.createDataFrame([(n, root(n)) for n in sorted(parent)], "node string, community string")
