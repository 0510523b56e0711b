from datetime import datetime

from weftline.plans import registry

TYPES = ("click", "view", "view")


def _events(spark, folder, n):
    rows = [(i, datetime(2024, 1, 1 + i % 28), i, TYPES[i % 3], 1.0, "{}") for i in range(n)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").toPandas().to_parquet(folder / "events.parquet", coerce_timestamps="us")


def test_events_of_a_stream_stay_out_of_the_driver(spark, tmp_path):
    _events(spark, tmp_path, 300)
    found = registry.QUERIES["s03_once_only_stream"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "LocalTableScan" not in plan and "Memory" not in plan
    assert {r.event_type: r.n for r in found.collect()} == {"click": 100, "view": 200}
    assert found.dtypes == [("event_type", "string"), ("n", "bigint")]


def test_a_stream_without_events_has_no_rows(spark, tmp_path):
    _events(spark, tmp_path, 0)
    assert registry.QUERIES["s03_once_only_stream"](spark, str(tmp_path)).count() == 0
