from weftline.plans import model_queries, registry


def test_page_text_is_whole(spark, monkeypatch):
    text = "long line " * 20_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    monkeypatch.setattr(model_queries, "table", lambda *_: docs)
    (row,) = registry.QUERIES["a24_page_text"](spark, "").collect()
    assert row.text == f"Home Beauty Trends\n{text.strip()}" or row.text == text.strip()
