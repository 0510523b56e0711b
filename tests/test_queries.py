"""Every core query against its SQL on the smallest tables."""

import os
import re

import pytest

from compare import plain
from weftline.plans import registry

FOLDER = "/root/testdata/sf0.001"
SLOW = {"j01_forest_predictions", "j02_frozen_model", "j03_walk_forward", "j04_contest", "growth_score_model"}  # a smaller sample has too few months
TABLES = "region nation customer supplier part orders lineitem events documents embeddings validate_at_scale_nvidia export_llm_data pmc_timeseries pmc_keywords trends brand_list brand_aliases reading_labels mix_targets".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n in registry.SQL])
def test_equals_sql(spark, con, name):
    from collections import Counter

    df = registry.QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    cur = con.execute(registry.SQL[name])
    have = [c[0] for c in cur.description]
    assert sorted(have) == cols
    want = Counter(tuple(plain(r[have.index(c)]) for c in cols) for r in cur.fetchall())
    assert Counter(tuple(plain(v) for v in r) for r in df.select(*cols).collect()) == want


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in registry.SQL and n not in SLOW])
def test_runs(spark, name):
    df = registry.QUERIES[name](spark, FOLDER)
    assert len(set(df.columns)) == len(df.columns)
    df.write.format("noop").mode("overwrite").save()


def test_llm_is_not_needed():
    root = os.path.dirname(os.path.dirname(os.path.abspath(registry.__file__)))
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f), encoding="utf-8") as h:
                    assert not re.search(r"weftline\.llm|from weftline import llm", h.read()), f
