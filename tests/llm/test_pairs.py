"""Near duplicates, repeated windows and nearest neighbours against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import minhash, neighbours, substrings
from tests.llm.samples import documents, rows, words


def sets_of(text):
    w = [x.lower() for x in words(text)]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def groups(data):
    sets = [(i, sets_of(t)) for i, t, *_ in data]
    label = {i: i for i, _ in sets}

    def top(x):
        return x if label[x] == x else top(label[x])

    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and x and 100 * len(x & y) >= 85 * len(x | y):
                label[max(top(a), top(b))] = min(top(a), top(b))
    return Counter((i, len(s), None if i is None else top(i), i is None or top(i) == i) for i, s in sets)


def test_near_duplicates_as_all_pairs(spark):
    got = minhash.near_duplicates(documents(spark)).collect()
    assert Counter(map(tuple, got)) == groups(rows())


def test_chain_of_near_copies_is_one_group(spark):
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(40):  # each differs from the next in one word, the ends in forty
        base = [*base[: 5 * i], f"new{i}", *base[5 * i + 1 :]]
        texts.append((1000 - i, " ".join(base), "en", "s", 1))
    got = minhash.near_duplicates(documents(spark, texts)).collect()
    assert Counter(map(tuple, got)) == groups(texts)
    assert len({r.component_id for r in got}) == 1


def test_many_unlinked_members_of_one_bucket(spark):
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(300):  # near each other, most below the limit
        r = np.random.default_rng(i)
        own = list(base)
        for k in r.integers(0, 120, 2):
            own[k] = f"x{i}_{k}"
        texts.append((i, " ".join(own), "en", "s", 1))
    got = minhash.near_duplicates(documents(spark, texts)).collect()
    assert Counter(map(tuple, got)) == groups(texts)


def test_sketch_fills_every_bin_and_estimates():
    r = np.random.default_rng(3)
    for n in (1, 2, 7, 100, 5000):
        x = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        assert (minhash.sketch(x) != np.iinfo(np.uint64).max).all()
    x = np.unique(r.integers(0, 2**64, 2000, dtype=np.uint64))
    y = np.concatenate([x[:1700], r.integers(0, 2**64, 300, dtype=np.uint64)])
    agree = (minhash.sketch(x) == minhash.sketch(np.unique(y))).mean()
    assert abs(agree - 1700 / 2300) < 0.15


def test_one_document_of_each_group_stays_with_all_columns(spark):
    docs = documents(spark).withColumn("kept", F.lit("mine")).withColumn("component_id", F.lit(1))
    got = minhash.without_near_duplicates(docs)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert 3 in ids and not set(range(100, 112)) & set(ids) and ids.count(None) == 2


def removed(data, n=35):
    times = Counter(tuple(w[i : i + n]) for _, t, *_ in data for w in [words(t)] for i in range(len(w) - n + 1))
    out = Counter()
    for doc, text, *_ in data:
        w, gone = words(text), set()
        for i in range(len(w) - n + 1):
            if times[tuple(w[i : i + n])] > 1:
                gone.update(range(i, i + n))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_repeated_windows_as_brute_force(spark):
    got = substrings.without_repeats(documents(spark)).drop("kept_text").collect()
    assert Counter(map(tuple, got)) == removed(rows())


def test_windows_repeated_in_one_document_and_at_its_edges(spark):
    run = [f"a{i}" for i in range(80)]
    data = [
        (1, " ".join([*run[:40], "x", *run[:40], "y", *run[5:39]]), "en", "s", 1),
        (2, " ".join(run[30:]), "en", "s", 1),
        (3, " ".join(run[31:66]), "en", "s", 1),
        (4, "b " * 90, "en", "s", 1),
        (5, " ".join(run[:34]), "en", "s", 1),
    ]
    got = substrings.without_repeats(documents(spark, data)).drop("kept_text").collect()
    assert Counter(map(tuple, got)) == removed(data)


@pytest.mark.parametrize("function", [minhash.near_duplicates, substrings.without_repeats])
def test_empty_table(spark, function):
    assert function(documents(spark, [])).count() == 0


def vectors(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")


def test_neighbours_rank_ties_and_leave_out_unusable_rows(spark):
    r = np.random.default_rng(5)
    data = [(i, [float(np.float32(x)) for x in r.normal(size=16)], 0) for i in range(300)]
    data += [(1000 + i, data[7][1], 0) for i in range(40)]  # a very common vector; 1000 asks for it
    data += [
        (2000, None, 0), (2100, [], 0), (2200, [0.0] * 16, 0), (2300, [float("nan")] * 16, 0),
        (2400, [None] * 16, 0), (2500, [float("inf")] * 16, 0), (2600, [1.0] * 3, 0), (None, data[1][1], 0), data[5],
    ]
    got = defaultdict(list)
    for row in neighbours.nearest(vectors(spark, data)).orderBy("query_id", "rank").collect():
        got[row.query_id].append((row.score, row.vec_id, row["rank"]))
    good = {i: np.array(v) for i, v, _ in data if i is not None and i < 2000}
    assert set(got) == {i for i in good if i % 100 == 0}
    hits = 0
    for q, found in got.items():
        true = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q)[:10]
        assert [k for *_, k in found] == list(range(1, 11))
        assert all(abs(s - np.sqrt(((good[q] - good[i]) ** 2).sum())) < 1e-9 for s, i, _ in found)
        hits += len({i for _, i, _ in found} & {i for _, i in true})
    assert [i for _, i, _ in got[1000]] == [7, *range(1001, 1010)]
    assert hits >= 0.9 * 10 * len(got)


def test_fewer_candidates_than_asked_for(spark):
    data = [(i, [1.0 + i, -2.0], 0) for i in (100, 1, 2)]
    got = neighbours.nearest(vectors(spark, data)).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(100, 2), (100, 1)]
    assert neighbours.nearest(vectors(spark, [])).count() == 0
