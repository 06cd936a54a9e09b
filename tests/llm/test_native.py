"""Line dedup, mixing, sharding, licences and quality rules on small tables."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import licences, lines, minhash, mixing, quality, queries, sharding, substrings
from meterline.session import scratch_path
from tests.llm.samples import documents, prose, rows, words


def by_lang():
    return {"lang": F.col("lang"), "source": F.col("source")}



def test_lines_as_sql(spark):
    data = [r for r in rows()[:-2] if r[0] is not None and r[1] is not None]
    got = lines.without_repeated_chunks(documents(spark, data))
    got = got.select("row.doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256)).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in data])
    assert sorted(map(tuple, got)) == sorted(con.sql(lines.ORACLE_SQL).fetchall())
    assert sum(r.n_removed for r in got) > 50


def test_chunks_join_to_the_text_and_do_not_depend_on_what_is_above(spark):
    body = "\n".join(f"line {i}" for i in range(60))
    made = lines.with_chunks(spark.createDataFrame([(1, body), (2, "top\n\n" + body)], "doc_id long, text string"))
    a, b = (r.chunks for r in made.orderBy("doc_id").collect())
    assert "\n".join(c.text for c in a) == body
    assert len({c.text for c in a} & {c.text for c in b}) >= len(a) - 2


def test_lines_with_nulls_repeats_and_clashing_names(spark):
    docs = documents(spark).withColumn("gone", F.lit(1)).withColumn("chunks", F.lit("x")).withColumn("row", F.lit(2))
    got = lines.without_repeated_chunks(docs)
    assert got.count() == len(rows())
    assert got.select("row.*").columns == docs.columns
    by_id = {r.row.doc_id: r for r in got.collect()}
    assert by_id[400].kept_text is None and by_id[400].n_lines == 0 and by_id[401].kept_text == ""
    assert by_id[0].n_removed == 0  # rows that repeat a document are one
    assert lines.without_repeated_chunks(documents(spark, [])).count() == 0


def test_seeds_take_along_the_lines_that_agree(spark):
    shared = [f"shared line {i}" for i in range(40)]
    data = [
        (i, "\n".join([*(f"top {i} {k}" for k in range(5 + i)), *shared, *(f"end {i} {k}" for k in range(7))]), "en", "s", 1)
        for i in range(6)
    ]
    data += [(10 + i, "\n".join(f"copy {k}" for k in range(30)), "en", "s", 1) for i in range(3)]
    data.append((20, "\n".join(["own", *shared, "mid", *shared]), "en", "s", 1))
    docs = documents(spark, data)
    got = {r.row.doc_id: r for r in lines.without_repeated_chunks(docs, extend=True).collect()}
    text = {i: t for i, t, *_ in data}
    for i in (0, 10):
        assert got[i].n_removed == 0 and got[i].kept_text == text[i]
    for i in range(1, 6):
        assert got[i].kept_text.split("\n") == [x for x in text[i].split("\n") if not x.startswith("shared")]
    assert got[11].kept_text == got[12].kept_text == "" and got[11].n_removed == 30
    assert got[20].kept_text == "own\nmid" and got[20].n_removed == 80


def test_every_line_that_goes_still_stands_somewhere(spark):
    r = np.random.default_rng(3)
    pool = [f"w{i}" if i % 4 else "" for i in range(12)]
    data = [(int(i) if i % 9 else None, "\n".join(r.choice(pool, r.integers(1, 60))), "en", "s", 1) for i in range(150)]
    some = documents(spark, data + data[:3])
    plain = {(x.row.doc_id, x.row.text): x.n_removed for x in lines.without_repeated_chunks(some).collect()}
    got = lines.without_repeated_chunks(some, extend=True).collect()
    assert len(got) == 153
    for x in got:
        assert x.n_lines - x.n_removed == (len(x.kept_text.split("\n")) if x.n_removed < x.n_lines else 0)
        assert x.n_removed >= plain[x.row.doc_id, x.row.text]
    assert {v for x in got for v in x.kept_text.split("\n")} >= {v for _, t, *_ in data for v in t.split("\n")}
    assert lines.without_repeated_chunks(documents(spark, []), extend=True).count() == 0


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = [("a", "x", 10), ("a", "y", 1000), ("b", "x", 100), ("b", "y", 50), ("c", "x", 0)]
    frame = spark.createDataFrame(leaves, "level0 string, level1 string, supply long")
    got = mixing.budgets(frame, ["level0", "level1"], {"a": 1, "b": 2, "c": 0}, 50, 1).collect()
    budget = {(r.level0, r.level1): r.budget for r in got}
    # The root has 580: b can take 150 of its 386, a takes the rest; in a, x is full and y takes its share.
    assert budget == {("a", "x"): 10, ("a", "y"): 420, ("b", "x"): 100, ("b", "y"): 50}


def test_words_below_weight_zero_leave_their_budget_to_others(spark):
    leaves = [("f", "es", "x", 900), ("f", "en", "x", 100), ("w", "en", "x", 2000), ("w", "en", "y", 2000), ("b", "en", "x", 1000)]
    frame = spark.createDataFrame(leaves, "level0 string, level1 string, level2 string, supply long")
    got = mixing.budgets(frame, ["level0", "level1", "level2"], {"f/es": 0, "w/en/y": 0}, 50, 1).collect()
    # Of 3000, a third each: f can give 100 only, b 1000, and w takes the rest from its x alone.
    assert {(r.level0, r.level1, r.level2): r.budget for r in got} == {
        ("f", "en", "x"): 100, ("b", "en", "x"): 1000, ("w", "en", "x"): 1900
    }


def test_mixing_takes_prefixes_of_epochs(spark):
    data = [(i, "w " * (1 + i % 5), "en", "big" if i % 3 else "small", 1) for i in range(300)]
    taken = mixing.mixed(documents(spark, data), by_lang(), {"en/big": 1, "en/small": 3}, 100, 2)
    got = taken.select("row.doc_id", "row.source", "row.text", "epoch").collect()
    assert max(Counter((r.doc_id, r.epoch) for r in got).values()) == 1
    whole = {r.doc_id for r in got if r.epoch == 1 and r.source == "small"}
    assert whole == {i for i in range(0, 300, 3)}
    supply = Counter()
    for _, text, _, source, _ in data:
        supply[source] += len(words(text))
    used = Counter()
    for r in got:
        used[r.source] += len(words(r.text))
    assert 0 <= used["small"] - 2 * supply["small"] * 1 <= 5 or used["small"] <= 2 * supply["small"]
    assert abs(sum(used.values()) - sum(supply.values())) <= 10
    assert {r.doc_id for r in got if r.epoch == 2} <= whole


def test_mixing_with_nulls_repeats_and_clashing_names(spark):
    docs = documents(spark).withColumn("epoch", F.lit("mine")).withColumn("unit", F.lit(3)).withColumn("level0", F.lit(4))
    got = mixing.mixed(docs, by_lang(), {}, 100, 1)
    assert got.select("row.*").columns == docs.columns
    assert got.count() == len(rows())  # all of it, once
    assert mixing.mixed(documents(spark, []), by_lang(), {}, 100, 1).count() == 0


def test_shards_fit_and_are_the_shortest_prefixes(spark):
    got = sharding.assigned(documents(spark), 4000).collect()
    assert len(got) == len(rows())
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.bytes
    assert all(sizes[r.shard] == r.shard_bytes for r in got)
    assert all(r.shard_bytes <= 4000 or sizes[r.shard] == r.bytes for r in got)
    names = sorted(sizes)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for name in names:  # the bucket it was split from was too large
        assert not name or sum(n for s, n in sizes.items() if s.startswith(name[:-1])) > 4000


def test_one_id_over_many_shards_and_no_documents(spark):
    data = [(1, "x" * 100, "en", "s", 1)] * 500
    got = sharding.assigned(documents(spark, data), 5000).collect()
    assert len(got) == 500 and max(r.shard_bytes for r in got) <= 5000
    assert sharding.assigned(documents(spark, []), 10).count() == 0
    path = scratch_path(spark, "shards")
    sharding.write_shards(documents(spark, data[:50] + [(None, None, None, None, None)]), path, 1000)
    assert spark.read.parquet(path).count() == 51


def test_licences_of_headers_files_and_ancestors(spark):
    mit = "Released under the MIT License."
    gpl = "This work is licensed under the GNU General Public License, version 3."
    files = [
        ("a/LICENSE", gpl), ("a/b/COPYING.txt", mit), ("a/b/c/x.py", "code"), ("a/y.py", "more code"),
        ("a/b/z.py", f"# SPDX-License-Identifier: Apache-2.0\n{'word ' * 500}"), ("d/e.txt", "the of and licence"),
        ("d/f.txt", None), (None, "nothing"), (None, mit), ("d/f.txt", None), ("e/LICENSE", "no idea"), ("e/g", ""),
        ("LICENSED/h.txt", "x " * 3000 + "\n" + gpl),
    ]
    frame = spark.createDataFrame(files, "path string, text string").withColumn("score", F.lit(9))
    got = Counter((r.row.path, r.licence, r.found) for r in licences.scan(frame).collect())
    assert got == Counter(
        [
            ("a/LICENSE", "GPL-3.0", "file"), ("a/b/COPYING.txt", "MIT", "file"), ("a/b/c/x.py", "MIT", "inherited"),
            ("a/y.py", "GPL-3.0", "inherited"), ("a/b/z.py", "Apache-2.0", "header"), ("d/e.txt", None, "none"),
            ("d/f.txt", None, "none"), ("d/f.txt", None, "none"), (None, None, "none"), (None, "MIT", "header"),
            ("e/LICENSE", None, "none"), ("e/g", None, "none"), ("LICENSED/h.txt", "GPL-3.0", "header"),
        ]
    )
    assert licences.scan(frame.limit(0)).count() == 0


def test_standard_headers_and_texts_get_their_own_name(spark):
    gnu = "This {} is free software{} you can redistribute it and/or modify\nit under the terms of the GNU {} as published by\n" \
        "the Free Software Foundation{} either version {} of the License, or\n(at your option) any later version.\n\n" \
        "This {} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\n" \
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU {} for more details."  # fmt: skip
    full = {"": "General Public License", "A": "Affero General Public License", "L": "Lesser General Public License"}
    want = {
        f"{k}GPL-{v}": gnu.format(work, a, full[k], b, v.removesuffix(".0"), work, full[k])
        for k, v, work, a, b in (
            ("", "2.0", "program", ";", ";"), ("", "3.0", "program", ":", ","), ("A", "3.0", "program", ":", ","),
            ("L", "2.1", "library", ";", ";"), ("L", "3.0", "program", ":", ","),
        )
    }
    one, two = licences._BSD_1_2.split(" 2. ")
    bsd = [f"Copyright (c) 2020, Some One\n\n{licences._BSD}:", one, f"2. {two}"]
    want["BSD-2-Clause"] = "\n\n".join([*bsd, licences._BSD_END])
    want["BSD-3-Clause"] = "\n\n".join([*bsd, licences._BSD_3, licences._BSD_END])
    want |= {"MIT": licences._MIT, "ISC": licences._ISC, "Apache-2.0": licences._APACHE}
    files = [(f"{n}{end}", n, text) for n, text in want.items() for end in ("/LICENSE", "/header/x.c")]
    files += [(f"{n}/y.c", n, "code") for n in want]
    frame = spark.createDataFrame(files, "path string, want string, text string")
    got = [(r.row.path, r.licence) for r in licences.scan(frame).collect() if r.licence != r.row.want]
    assert got == []


def test_passing_over_segments_loses_none(spark):
    texts = [f"{a} {b}" for a in ("licensed under", "the of", "gpl") for _, b in licences.NOTICES]
    frame = spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(texts)], "path string, text string")
    low = {r.row.path: r for r in licences.scan(frame, 0.01).collect()}
    for r in licences.scan(frame, 0.6).collect():
        other = low[r.row.path]
        assert (other.score >= 0.6) == (r.licence is not None)
        assert r.licence is None or (r.licence, r.score) == (other.licence, other.score)


def base(text):
    w = words(text)
    seen = [i for i in range(len(w) - 2) if sum(w[j : j + 3] == w[i : i + 3] for j in range(len(w) - 2)) > 1]
    repeat = len({i + k for i in seen for k in range(3)})
    full = [x for x in (text or "").split("\n") if x.encode().split()]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(len(x.decode()) for x in w), symbols, len(full) - len(set(full)), repeat


def test_quality_base_counts_as_plain_python(spark):
    data = [r for r in rows() if r[0] != 406]
    data += [(500, "a b c\n" * 40, "en", "s", 1), (501, "#* x\n\nx\n x", "xx", "s", 1)]
    got = quality.quality(documents(spark, data)).collect()
    want = Counter((i, *base(t)) for i, t, *_ in data)
    assert Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality.quality(documents(spark, [])).count() == 0


def test_quality_rejects_strange_and_keeps_ordinary_documents(spark):
    r = np.random.default_rng(2)
    common = [f"w{i}" for i in range(200)]
    share = 1 / np.arange(1, 201)
    data = [(i, " ".join(r.choice(common, 200, p=share / share.sum())), "en", "s", 1) for i in range(200)]
    strange = [(1000 + i, " ".join(f"{w}%%%&&" for w in r.choice(common, 200)), "en", "s", 1) for i in range(5)]
    docs = documents(spark, data + strange).withColumn("kept", F.lit("mine")).withColumn("body", F.lit(1))
    got = quality.good_documents(docs)
    assert got.columns == docs.columns
    assert {x.doc_id for x in got.collect()} == set(range(200))


@pytest.mark.parametrize("p, q, want", [([1, 0], [1, 0], 0), ([1, 0], [0, 1], 1), ([0.5, 0.5], [1, 0], 0.5579)])
def test_divergence(p, q, want):
    assert abs(quality.divergence(np.array([p], float), np.array([q], float))[0] - want) < 1e-4


def test_domain_of_any_source(spark):
    frame = spark.createDataFrame([("src0",), ("src4",), ("x",), (None,)], "source string")
    assert [r[0] for r in frame.select(queries.domain()).collect()] == ["web", "books", "forums", "forums"]


def test_every_language_is_judged_by_its_own_reference(spark):
    data = [(i, prose(i, 120), f"l{i % 400}", "s", 1) for i in range(1200)]
    # Junk in a small language: as far from its reference as in a large one.
    junk = "%%% $$$ ### " * 60
    data += [(5000, junk + prose(1, 5), "l7", "s", 1), (5001, prose(3, 200), "alone", "s", 1), (5002, prose(4, 200), None, "s", 1)]
    got = {r.doc_id: r for r in quality.quality(documents(spark, data)).collect()}
    assert len(got) == len(data)
    assert got[5000].char_distance > 0.24 and not got[5000].kept
    assert got[5001].kept and got[5001].word_distance == 0 and got[5002].kept
    assert all(got[i].kept for i in range(1200) if i % 400 != 7)  # the junk is a third of that language


def test_written_shards_hold_what_was_assigned(spark, tmp_path):
    data = [(i % 40, "x" * (37 * i % 900), "en", "s", 1) for i in range(400)] + [(None, "y" * 50, "en", "s", 1), (None, None, None, None, None)]
    docs = documents(spark, data).selectExpr("*", "'mine' AS shard", "1 AS n", "2 AS number", "'u' AS unit", "3 AS bytes", "'r' AS row")
    path = f"{tmp_path}/shards"
    name = sharding.write_shards(docs, path, 1000)
    back = spark.read.parquet(path)
    assert name == "shard_" and set(back.columns) == {*docs.columns, name}
    sizes = back.groupBy(name).agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("rows")).collect()
    assert all((r.size or 0) <= 1000 or r.rows == 1 for r in sizes)
    assert Counter(map(tuple, back.drop(name).collect())) == Counter(map(tuple, docs.collect()))


def splits(spark, action) -> int:
    """Joins that adaptive execution has split while the action ran."""
    store = spark._jsparkSession.sharedState().statusStore()
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before, former = store.executionsCount(), {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        action()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        for k, v in former.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    plans = store.executionsList(before, 10_000)
    return sum(plans.apply(i).physicalPlanDescription().count("skew=true") for i in range(plans.size()))


def common_passages():
    shared = prose(900, 90)
    data = [(i, f"{prose(i, 30)}\n{shared}\n{prose(1000 + i, 30)}", "en", "s", 1) for i in range(400)]
    return data + [(1000 + i, prose(2000 + i, 60), "en", "s", 1) for i in range(200)]


@pytest.mark.parametrize("operator", [lines.without_repeated_chunks, substrings.without_repeats])
def test_joins_of_common_passages_can_be_split(spark, operator):
    docs = documents(spark, common_passages()).repartition(8)
    assert splits(spark, lambda: operator(docs).write.format("noop").mode("overwrite").save()) > 0


@pytest.mark.parametrize("operator", [minhash.without_near_duplicates, quality.good_documents])
def test_columns_with_clashing_names_pass(spark, operator):
    extra = "'x' AS __gone, 1 AS gone, 2 AS id, 'r' AS row, 'b' AS body, 3 AS kept, 'w' AS words, 'c' AS chars, 's' AS shares, 'l' AS ref_lang"
    docs = documents(spark).selectExpr("*", *extra.split(", "))
    got = operator(docs)
    assert got.columns == docs.columns and 0 < got.count() <= docs.count()


def plain_class(c: str) -> int:
    if c in " \t\n\v\f\r":
        return 3
    kinds = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", None, ".,;:!?'\"()-", "#*$%&|<>")
    found = [i for i, k in enumerate(kinds) if k and c in k]
    return found[0] if found else 6 if ord(c) > 127 else 7


def plain_distance(p: Counter, q: Counter) -> float:
    a, b = (np.array([x[k] / max(x.total(), 1) for k in sorted({*p, *q})]) for x in (p, q))
    m = (a + b) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        return float(np.sqrt(max(0, sum(np.where(x > 0, x * np.log2(x / m), 0).sum() for x in (a, b)) / 2)))


def test_quality_verdicts_as_plain_python(spark):
    # Fewer distinct words than common ones are kept, so that no tie decides.
    data = [(i, prose(i, 60 + 9 * i), ("en", "de", None)[i % 3], "s", 1) for i in range(40)]
    data += [(100, "%%% $$$ " * 80 + prose(5, 30), "en", "s", 1), (101, "ÉÀ né " * 100, "de", "s", 1), (102, "kan " * 70, "en", "s", 1)]
    chars, common = {}, {}
    for _, text, lang, *_ in data:
        chars.setdefault(lang, Counter()).update(map(plain_class, text))
        common.setdefault(lang, Counter()).update(text.split())
    assert all(len(c) <= quality.COMMON for c in common.values())
    got = {r.doc_id: r for r in quality.quality(documents(spark, data)).collect()}
    verdicts = Counter()
    for i, text, lang, *_ in data:
        n = len(text.split())
        want = plain_distance(Counter(map(plain_class, text)), chars[lang]), plain_distance(Counter(text.split()), common[lang])
        assert (got[i].char_distance, got[i].word_distance) == pytest.approx(want, abs=1e-6)
        slack = n**-0.5
        near = want[0] <= quality.CHAR_LIMIT + quality.CHAR_SLACK * slack and want[1] <= quality.WORD_LIMIT + quality.WORD_SLACK * slack
        assert got[i].kept == (near and not got[i].base_failed)
        verdicts[got[i].kept] += 1
    assert verdicts[True] > 30 and verdicts[False] >= 2


def plain_licences(files: list[tuple[str, str]], threshold: float) -> list[tuple]:
    """Own licence of each file by the cosine of every segment with every template, then the nearest folder's."""
    import re
    from math import log

    def segments(path, text):
        out = [*text.split("\n"), *re.split(r"\n[\x20\t\r]*\n", text)]
        return [re.findall("[a-z0-9]+", s.lower()) for s in out + ([text] if re.search(licences._LICENCE_FILE, path) else [])]

    every = [w for path, text in files for w in segments(path, text) if w]
    wordings = [(name, re.findall("[a-z0-9]+", t.lower()), licences.SHARED.get(t, 1)) for name, t in licences.templates()]
    n = len(every) + len(wordings)
    vocabulary = {w for _, words, _ in wordings for w in words}
    df = Counter(w for words in every for w in set(words) if w in vocabulary) + Counter(w for _, ws, _ in wordings for w in set(ws))

    def vector(words):
        return {w: (1 + log(c)) * (log((1 + n) / (1 + df[w])) + 1) for w, c in Counter(words).items()}

    vectors = [(name, vector(words), factor) for name, words, factor in wordings]
    size = lambda v: sum(x * x for x in v.values()) ** 0.5
    own = {}
    for path, text in files:
        found = []
        for words in segments(path, text):
            if words:
                v = vector(words)
                found += [(-round(sum(x * t.get(w, 0) for w, x in v.items()) * f / size(v) / size(t), 6), name) for name, t, f in vectors]
        best = min((x for x in found if -x[0] >= threshold), default=None)
        if best:
            own[path] = (best[1], -best[0])
    out = []
    for path, _ in files:
        folder, kind = path.rpartition("/")[0], "file" if re.search(licences._LICENCE_FILE, path) else "header"
        if path in own:
            out.append((path, *own[path], kind))
            continue
        while True:
            held = [(-s, name) for p, (name, s) in own.items() if p.rpartition("/")[0] == folder and re.search(licences._LICENCE_FILE, p)]
            if held or not folder:
                break
            folder = folder.rpartition("/")[0]
        out.append((path, min(held)[1], -min(held)[0], "inherited") if held else (path, None, None, "none"))
    return out


def test_licences_as_plain_python(spark):
    import random

    r = random.Random(8)
    notices = [text for _, text in licences.templates()]
    files = []
    for i in range(120):
        folder = "/".join(r.choices("abc", k=r.randrange(0, 4)))
        parts = [prose(i * 7 + k, r.randrange(3, 30)) for k in range(r.randrange(1, 4))]
        if r.random() < 0.5:
            words = r.choice(notices).split()
            cut = words[: max(3, int(len(words) * r.random() * 1.3))]
            parts.insert(r.randrange(len(parts) + 1), " ".join(cut))
        name = r.choice([f"LICENSE.{i}", f"COPYING-{i}", f"{i}.py", f"{i}.txt", f"{i}.c"])
        files.append((f"{folder}/{name}".lstrip("/"), r.choice(["\n", "\n\n"]).join(parts)))
    frame = spark.createDataFrame(files, "path string, text string")
    got = sorted((x.row.path, x.licence or "", round(x.score or 0, 5), x.found) for x in licences.scan(frame).collect())
    want = sorted((p, name or "", round(s or 0, 5), found) for p, name, s, found in plain_licences(files, licences.THRESHOLD))
    assert [(a[0], a[1], a[3]) for a in got] == [(b[0], b[1], b[3]) for b in want]
    assert all(abs(a[2] - b[2]) < 2e-5 for a, b in zip(got, want))
    assert {"file", "header", "inherited"} <= {a[3] for a in got}
