"""What Python workers are given and what they leave behind."""

from meterline.llm import quality, storage


def test_a_text_goes_to_python_once(spark, monkeypatch):
    seen = []
    mapped = quality.mapped
    monkeypatch.setattr(quality, "mapped", lambda df, function, schema: seen.append(df) or mapped(df, function, schema))
    words = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame(
        [(1, words, "en"), (2, None, "en"), (3, "", None), (4, words + " é", None)], "doc_id long, text string, lang string"
    )
    kept = quality.good_documents(docs)
    assert "body" not in seen[-1].columns
    want = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want == {1, 4}
    assert kept.columns == docs.columns


def test_free_memory_goes_back_when_batches_end(monkeypatch):
    freed = []
    monkeypatch.setattr(storage, "_released", lambda: freed.append(1))
    run = storage.releasing(lambda batches: (x + 1 for x in batches))
    assert list(run(iter([1, 2]))) == [2, 3] and freed == [1]
