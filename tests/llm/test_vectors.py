"""Vector codes and hard negatives against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import codebooks, negatives

SCHEMA = "vec_id long, embedding array<float>, label int, v string, tie int, part int"


def vectors(spark, data):
    return spark.createDataFrame([(*row, "x", 1, 2) for row in data], SCHEMA).repartition(3)


def some(n: int, dim: int = 8, seed: int = 3, spread: float = 0.4) -> list[tuple]:
    r = random.Random(seed)
    middles = [[r.gauss(0, 0.3) for _ in range(dim)] for _ in range(6)]
    out = []
    for i in range(n):
        middle = middles[i % 6]
        v = [float(np.float32(m + r.gauss(0, spread * 0.3))) for m in middle]
        out.append((i, v, i % 5 if i % 4 else r.randrange(5)))
    return out


AWKWARD = [
    (5000, None, 1), (5001, [], 1), (5100, [None] * 8, 1), (5200, [math.nan] * 8, 1), (5300, [math.inf] + [0.0] * 7, 2),
    (5400, [0.1] * 3, 1), (5500, [0.0] * 8, 1), (5501, [-0.0] * 8, None),
]


def kept(data, scale):
    out = []
    for i, v, label in data:
        if v and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, [math.floor(scale * x) for x in v], label))
    return out


def plain_codes(data):
    rows = sorted(kept(data, 1024), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    v = np.array([r[1] for r in rows]).reshape(len(rows), 4, 2)
    books = v[:256].copy()
    for turn in range(5):
        far = ((v[:, None] - books[None]) ** 2).sum(3)
        near = far.argmin(1)
        if turn < 4:
            for p in range(4):
                for e in range(len(books)):
                    own = v[near[:, p] == e, p]
                    if len(own):
                        books[e, p] = [int(s) // len(own) for s in own.sum(0)]
    errors = [int(far[i, near[i], range(4)].sum()) for i in range(len(rows))]
    by_label = {}
    for (_, _, label), error in zip(rows, errors):
        by_label[label] = by_label.get(label, 0) + error
    codes = ["".join(f"{e:02x}" for e in row) for row in near]
    return sorted((str(r[0]), c, e, by_label[r[2]]) for r, c, e in zip(rows, codes, errors)), books.swapaxes(0, 1)


def test_codes_as_plain_version(spark):
    data = [*some(700), *AWKWARD, (None, [0.5] * 8, None), (3, [0.25] * 8, 2), some(10)[4], some(10)[4]]
    coded, books = codebooks.compressed(vectors(spark, data))
    rows = codebooks.with_label_errors(coded)
    assert rows.columns == ["vec_id", "label", "code", "error", "label_error"]
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in rows.collect())
    want, want_books = plain_codes(data)
    assert got == want
    assert (books == want_books).all()


def test_ties_go_to_the_lower_entry_and_few_rows_make_short_codebooks(spark):
    data = [(2, [1.0] * 8, 0), (1, [0.0] * 8, 0), (3, [0.0] * 8, 1)]
    coded, books = codebooks.compressed(vectors(spark, data))
    assert books.shape == (4, 3, 2)
    assert {r.vec_id: (r.code, r.error) for r in coded.collect()} == {1: ("00000000", 0), 2: ("01010101", 0), 3: ("00000000", 0)}


def test_tables_of_any_range_give_exact_distances():
    r = np.random.default_rng(1)
    for top in (3, 5000, 1 << 27):
        part, book = r.integers(-top, top, (1500, 5)), r.integers(-top, top, (40, 5))
        index, far = codebooks.nearest_entries(part, book)
        true = ((part[:, None] - book[None]) ** 2).sum(2)
        assert (index == true.argmin(1)).all() and (far == true.min(1)).all()


def test_vectors_that_cannot_be_cut_or_are_too_large_are_an_error(spark):
    with pytest.raises(ValueError, match="equal parts"):
        codebooks.compressed(vectors(spark, [(1, [1.0, 2.0, 3.0], 0)]))
    with pytest.raises(Exception, match="is 134217728 or more"):
        codebooks.compressed(vectors(spark, [(1, [1e30] * 4, 0)]))


def plain_negatives(data):
    rows = kept([r for r in dict.fromkeys((i, v if v is None else tuple(v), x) for i, v, x in data) if None not in (r[0], r[2])], 256)
    out = []
    for a, (i, v, label) in enumerate(rows):
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, other) for b, (j, w, other) in enumerate(rows) if b != a]
        for p, j, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fits = sorted(x for x in scored if x[2] != label and 80 * -p <= 100 * -x[0] <= 100 * -p)
            out += [(i, j, k, n, -p, -s) for k, (s, n, _) in enumerate(fits[:5], 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_negatives_as_full_comparison(spark, spread):
    data = [*some(900, spread=spread), *AWKWARD, (None, [0.5] * 8, 1), (7, None, 1), (200, some(900, spread=spread)[200][1], 3)]
    data += [some(900, spread=spread)[11]] * 3 + [(2000 + i, some(900, spread=spread)[17][1], 2) for i in range(300)]
    got = sorted(tuple(r) for r in negatives.hard_negatives(vectors(spark, data)).collect())
    assert got == plain_negatives(data) and len(got) > 100


def test_bounds_hold_at_every_level():
    r = np.random.default_rng(2)
    v = r.integers(-300, 300, (200, 37))
    means, deviations = negatives.summaries(v)
    table = negatives.pa.table(
        {"vec_id": range(200), "tie": [0] * 200, "label": [0] * 200, "v": v.tolist(), "means": means.tolist(), "deviations": deviations.tolist()}
    )
    rows, every, width = negatives.Rows(table), np.arange(200), None
    for level in range(3):
        lower, upper = rows.bounds(level, every, rows, 7)
        true = v @ v[7]
        assert (lower <= true).all() and (true <= upper).all()
        assert width is None or (upper - lower).sum() < width
        width = (upper - lower).sum()


def test_empty_tables(spark):
    empty = vectors(spark, [])
    coded, _ = codebooks.compressed(empty)
    assert codebooks.with_label_errors(coded).count() == 0
    assert negatives.hard_negatives(empty).count() == 0
    lonely = vectors(spark, [(0, [1.0] * 8, 0), (1, [1.0] * 8, 1)])
    assert negatives.hard_negatives(lonely, F.col("label")).count() == 0
