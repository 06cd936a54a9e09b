"""Spans of personal data: base rules against Python's, models against held-out and planted cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from meterline.llm import private
from tests.llm.samples import documents, rows

# The kinds' plain patterns, in the order of the kinds.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c))))
    return total % 10 == 0


def passes(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), n, k, m.end()) for n, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if passes(k, m[0])]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def card(seed: int, n: int = 16) -> str:
    r = random.Random(seed)
    digits = "4" + "".join(r.choice("0123456789") for _ in range(n - 2))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def phone(seed: int) -> str:
    r = random.Random(seed)
    return f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(10000):04d}"


def address(seed: int) -> str:
    r = random.Random(seed)
    return ".".join(str(r.randrange(256)) for _ in range(4))


def examples(n: int = 400) -> list[tuple]:
    out = []
    for i in range(n):
        r = random.Random(i)
        wrong = str(int(card(i)) + 1)  # fails the check
        said = r.choice([card(i), f"{card(i)[:4]} {card(i)[4:8]} {card(i)[8:12]} {card(i)[12:]}", wrong, f"a{wrong[:14]}f", "12 34"])
        text = f"on the {said} day {phone(i)} of it\n{address(i)} or {r.choice(['999.1.2.3', 'x.7@mail.example.com', 'joe@home', '3.14'])} ended"
        out.append((i, text, "en", "s", 1))
    return out


GLUED = [
    (9000, f"é🙂 {phone(1)} {card(2)} end", [("phone", 3, 20), ("card", 21, 37)]),
    (9001, f"{card(3)} 27.65.93.188", [("card", 0, 16), ("ip", 17, 29)]),
    (9002, f"call {phone(4)} {address(5)} now", [("phone", 5, 22), ("ip", 23, 23 + len(address(5)))]),
]


def collected(docs):
    return {r.row.doc_id: r for r in private.find(docs).collect()}


def test_base_spans_as_plain_patterns(spark):
    r = random.Random(1)
    parts = ["1", "4444", "255", "256", "0007", ".", "..", "-", " ", "  ", "+", "+1", "(", ")", "@", "a", "Zq", "_", "%", "é", "\n", "🙂", "12345678901234"]
    texts = ["".join(r.choices(parts, k=r.randrange(1, 60))) for _ in range(3000)]
    texts += [f"{card(i)}{r.choice(['', '-', ' ', '  '])}{r.choice(['', '1', card(i + 1, 14)])} a@b.c_d@e.f+{phone(i)}" for i in range(200)]
    data = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + rows()
    data = [(i, *d[1:]) for i, d in enumerate(data)]
    found = private.find(documents(spark, data))
    got = {x.row.doc_id: x for x in found.collect()}
    assert len(got) == len(data)
    for i, text, *_ in data:
        assert [(s.kind, s.start, s.end) for s in got[i].spans if s.base] == base_spans(text), text
    digests = private.digests(found).collect()
    for row in digests:
        base = base_spans(data[row.row.doc_id][1])
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in private.KINDS] == [sum(x[0] == k for x in base) for k in private.KINDS]
        assert set(f"{k}:{a}:{b}" for k, a, b in base) <= set(row.spans.split(","))


def test_glued_numbers_are_found_and_clean_texts_left_alone(spark):
    clean = [(9500 + i, t, "en", "s", 1) for i, t in enumerate(
        ["version 1.2.3.4.5.6 of 2024-01-02 03:04", "id 1234567890123456789012", "555 1234 5678 9", "tel at noon 12 34 56 78 90", "sum 999 999 9999 x"]
    )]
    docs = documents(spark, [*examples(), *((i, t, "en", "s", 1) for i, t, _ in GLUED), *clean])
    got = collected(docs)
    for i, text, spans in GLUED:
        assert [(s.kind, s.start, s.end) for s in got[i].spans] == spans, text
        assert any(not s.base and s.score is not None for s in got[i].spans)
    for i, text, *_ in clean:
        assert not [s for s in got[i].spans if not s.base], text
    added = [i for i in range(400) if any(not s.base for s in got[i].spans)]
    assert added == []


def test_models_hold_out_and_score_as_the_sql(spark):
    docs = documents(spark, examples())
    _, models = private.spans_and_models(docs, F.col("doc_id"))
    assert all(models[k].trees for k in ("card", "phone", "ip"))
    names = list(private.FEATURES)
    r = random.Random(4)
    points = [tuple(r.randrange(n) for n in private.FEATURES.values()) for _ in range(200)]
    frame = spark.createDataFrame(points, ", ".join(f"{n} int" for n in names))
    for kind in ("card", "phone"):
        got = [x.s for x in frame.select(*names, F.expr(models[kind].sql()).alias("s")).collect()]
        assert got == pytest.approx([models[kind].score(p) for p in points])


def test_boosting_learns_and_the_threshold_keeps_its_precision():
    r = random.Random(5)
    parts = private.Cells(), private.Cells()
    sizes = list(private.FEATURES.values())
    for cells in parts:
        for _ in range(400):
            x = tuple(r.randrange(n) for n in sizes)
            odds = 0.99 if x[0] >= 5 and x[1] == 1 else 0.3 if x[4] == 2 else 0.02
            cells.values.append(x)
            cells.n.append(20)
            cells.good.append(sum(r.random() < odds for _ in range(20)))
    model = private.fit(*parts)
    taken = [i for i, x in enumerate(parts[1].values) if model.score(x) >= model.threshold]
    assert sum(parts[1].good[i] for i in taken) >= 0.95 * sum(parts[1].n[i] for i in taken)
    wanted = [i for i, x in enumerate(parts[1].values) if x[0] >= 5 and x[1] == 1]
    assert len(set(taken) & set(wanted)) >= 0.9 * len(wanted)
    assert private.fit(parts[0], private.Cells()).threshold == float("inf")
    assert private.fit(private.Cells([(0,) * 7], [5], [5]), parts[1]).threshold == float("inf")


def test_redacted_texts_and_clashing_columns(spark):
    data = [(1, f"é {phone(1)}, x.1@a.b\n{address(2)}.", "en", "s", 1), (2, None, "en", "s", 1), (3, "clean 🙂 text", "en", "s", 1)]
    docs = documents(spark, data).selectExpr("*", "'mine' AS spans", "1 AS uid", "2 AS fold", "3 AS kind", "4 AS `first`", "'r' AS row")
    got = {r.row.doc_id: r for r in private.redacted(docs).collect()}
    assert {i: r.redacted for i, r in got.items()} == {1: "é [PHONE], [EMAIL]\n[IP].", 2: None, 3: "clean 🙂 text"}
    assert got[1].row.asDict().keys() == set(docs.columns) and got[1].row.spans == "mine"


def test_long_texts_and_empty_tables(spark):
    long = " ".join(["9" * 200_000, "a" * 200_000, "1 " * 100_000, "1.2." * 50_000, "+1-" * 50_000, "a@" * 50_000, address(1), phone(2)])
    got = collected(documents(spark, [(1, long, "en", "s", 1)]))
    assert [(s.kind, s.start, s.end) for s in got[1].spans if s.base] == base_spans_fast(long)
    empty = documents(spark, [])
    assert private.find(empty).count() == 0 and private.redacted(empty).count() == 0


def base_spans_fast(text):
    """Base spans of the long text, whose last two parts alone hold any but the dotted run."""
    out = [("ip", m.start(), m.end()) for m in re.finditer(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", text) if passes("ip", m[0])]
    out += [("phone", m.start(), m.end()) for m in re.finditer(PLAIN["phone"], text) if passes("phone", m[0])]
    return [(k, a, b) for a, _, k, b in sorted((a, {"ip": 1, "phone": 3}[k], k, b) for k, a, b in out)]
