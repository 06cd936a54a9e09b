"""The pipeline against a plain version of what its stages promise."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm.storage import stored
from tests.llm.samples import documents, rows
from tests.llm.test_pairs import groups


def test_stages_in_turn(spark):
    docs = documents(spark).withColumn("kept", F.lit(True)).withColumn("row", F.lit("x"))
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stored(stage(spark, kept[-1], ""), "stage"))
        assert kept[-1].columns == docs.columns
    texts = [[(r.doc_id, r.text) for r in d.collect()] for d in kept]
    assert set(texts[1]) <= set(texts[0]) and 400 not in dict(texts[1]) and 29 in dict(texts[1])
    assert Counter(i for i, _ in texts[2]) == Counter(i for i, _ in texts[1])
    stay = {i for i, _, _, k in groups(texts[2]) if k}
    assert {i for i, _ in texts[3]} == stay
    assert set(texts[4]) <= set(texts[3])
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept[-1], "").collect()
    total = defaultdict(int)
    for p in pieces:
        total[p.doc_id] += p.length
    times = Counter(i for i, _ in texts[4])
    assert {i: n for i, n in total.items()} == {p.doc_id: p.doc_tokens * times[p.doc_id] for p in pieces}


def test_run_on_tables(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    documents(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    assert len(rows()) > 40


def test_near_duplicates_from_80_percent_on(spark):
    def changed(name, n):  # each change costs five runs of 196
        return " ".join(f"x{i}" if i % 20 == 10 and i < 20 * n else f"{name}{i}" for i in range(200))

    data = [(10 * k + j, changed(f"d{k}w", n), "en", "s", 1) for k in range(8) for j, n in ((0, 0), (1, 4))]  # 0.815
    data += [(100, changed("e", 0), "en", "s", 1), (101, changed("e", 5), "en", "s", 1)]  # 0.774
    got = corpus_pipeline.one_of_each_group(spark, documents(spark, data), "").collect()
    assert sorted(r.doc_id for r in got) == [*(10 * k for k in range(8)), 100, 101]
