"""Personal data in texts: spans of mail addresses, IP addresses, card numbers and phone numbers.

Base rules find plain spans: a pattern for each kind, whose matches must pass the kind's check. Each number is judged as
far as it reaches, so a card number that stands one space behind a phone number spoils both. For such cases
generators propose more candidates, high in recall and overlapping: numbers of the usual forms, whatever stands beside
them, and also parts of longer ones. Boosted trees, one model for each kind, score a candidate by its format
(digits, groups, the kind's check, a leading plus) and its context (the characters beside it, words before it). Candidates with a score from the kind's threshold on are added, if they overlap no base span; of
candidates that overlap each other the best is.

The models learn from the corpus itself, over all documents. A base span is an example of its kind. Candidates that cut
into a base span of their kind, or that base rules have looked at alone and refused, are counterexamples. All other
candidates are undecided: these are the ones to be scored. Features are small whole numbers, so examples are summed by
their values: the table that goes to the driver, where trees are fitted, has at most one row for each combination
(``CELLS`` for each kind), whatever the size of the corpus. A fifth of the documents, by a hash of the text, is held out; the
threshold of a kind is the lowest score whose held-out share of examples, made to rise with the score (isotonic
calibration), is ``PRECISION``. A kind without held-out examples, or without counterexamples to learn from, gets no additions.

Only DataFrame functions are used. Texts are read once and not shuffled; what follows works on the finds, of which
only those of one document meet in one task. Places are code points, ends exclusive.

Defined cases: null and empty texts hold nothing. Very long texts are searched whole: patterns do not backtrack over
what they have passed, and places come from running sums. Rows that repeat a document, or share an id, are rows of
their own. Other columns, whatever their names, pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.storage import stored

KINDS = ("email", "ip", "card", "phone")
FOLDS, PRECISION = 5, 0.95
TREES, DEPTH, RATE, PENALTY = 16, 3, 0.4, 1.0
CONTEXT = 24

_LOCAL = "A-Za-z0-9._%+-"
# The base rules. As the plain patterns of the kinds, but no place inside a run is tried once its start has failed.
_BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Digits with at most one space or hyphen between; only runs of 14 to 19 digits can pass.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_GENERATORS = (
    ("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"),  # no domain needed
    ("email", r"(?<![A-Za-z0-9])[A-Za-z0-9]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]++"),  # the innermost part
    ("ip", r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    ("ip", r"(?<=[0-9])[0-9]{1,2}(?:\.[0-9]{1,3}){3}(?![0-9])"),  # behind further digits
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", r"(?<![0-9])(?:[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{2}([\x20-])[0-9]{6}\2[0-9]{5})(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{15}(?=[0-9])"),  # before further digits
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"),
    ("phone", r"(?<![0-9])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),  # without country
)
PATTERNS = (*_BASE.items(), *_GENERATORS)
# A text without this holds no match of the kind.
_HINTS = {
    "email": "@",
    "ip": r"\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?+[0-9]){12}",
    "phone": r"\+[0-9]|[0-9][\x20.-][0-9]{4}",
}
_OVER_255 = r"(?:^|\.)0*+(?:[1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(?:\.|$)"

# Features and how many values each has.
FEATURES = {"digits": 8, "passes": 2, "plus": 2, "groups": 7, "left": 5, "right": 5, "cue": 3}
CELLS = math.prod(FEATURES.values())
_CUE = r"(?i)(?:card|visa|tel|phone|call|fax|mail|contact|host|ip)[^A-Za-z0-9]{0,3}$"
_NO_CUE = r"(?i)(?:token|password|secret|key|hash|version|id|isbn|order)[^A-Za-z0-9]{0,5}$"


def _find(pattern: int):
    return lambda x, i: F.struct(
        F.lit(pattern).alias("pattern"), i.alias("at"), x["value"].alias("value"), F.length(x["gap"]).alias("gap"),
        F.substring(x["gap"], -CONTEXT, CONTEXT).alias("before"), F.substring(x["next"], 1, CONTEXT).alias("after"),
    )


def _finds(text: Column) -> tuple[dict[str, Column], Column]:
    """Columns of matches and of what stands between them, and the array of all finds made of them."""
    columns, finds = {}, []
    for n, (kind, pattern) in enumerate(PATTERNS):
        hint = text.contains(_HINTS[kind]) if kind == "email" else text.rlike(_HINTS[kind])
        columns[f"m{n}"] = F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        columns[f"s{n}"] = F.when(hint, F.split(text, pattern, -1))
        found = F.arrays_zip(
            F.col(f"m{n}").alias("value"), F.slice(f"s{n}", F.lit(1), F.size(f"m{n}")).alias("gap"),
            F.slice(f"s{n}", F.lit(2), F.size(f"m{n}")).alias("next"),
        )
        finds.append(F.transform(found, _find(n)))
    kind = "array<struct<pattern:int,at:int,value:string,gap:int,before:string,after:string>>"
    return columns, F.concat(*(F.coalesce(x, F.array()).cast(kind) for x in finds))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass the check of card numbers."""

    def part(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), part)
    return F.when(F.length(digits).between(1, 19), total % 10 == 0).otherwise(False)


def _passes(kind: Column, value: Column) -> Column:
    """The check of a kind."""
    digits = _digits(value)
    return (
        F.when(kind == "email", F.substring_index(value, "@", -1).contains("."))
        .when(kind == "ip", ~value.rlike(_OVER_255))
        .when(kind == "card", F.length(digits).between(14, 19) & _luhn(digits))
        .otherwise(value.startswith("+") & F.length(digits).between(10, 15))
    )


def _beside(char: Column) -> Column:
    """0 nothing, 1 white space, 2 digit, 3 letter, 4 anything else."""
    out = F.when(char == "", 0).when(char.rlike(r"^[\x20\x09-\x0D]"), 1).when(char.rlike("^[0-9]"), 2)
    return out.when(char.rlike(r"^\p{L}"), 3).otherwise(4)


def _features() -> dict[str, Column]:
    n = F.length(_digits(F.col("value")))
    bins = F.when(n < 10, 0).when(n == 10, 1).when(n == 11, 2).when(n < 14, 3).when(n == 14, 4).when(n == 15, 5)
    groups = F.size(F.split(F.col("value"), "[^0-9]++", -1))
    return {
        "digits": bins.when(n == 16, 6).otherwise(7),
        "passes": _passes(F.col("kind"), F.col("value")).cast("int"),
        "plus": F.col("value").startswith("+").cast("int"),
        "groups": F.least(groups, F.lit(6)),
        "left": _beside(F.substring("before", -1, 1)),
        "right": _beside(F.substring("after", 1, 1)),
        "cue": F.when(F.col("before").rlike(_CUE), 1).when(F.col("before").rlike(_NO_CUE), 2).otherwise(0),
    }


def _alone() -> Column:
    """Whether the kind's base rule has looked at just this span."""
    before, after, value = F.col("before"), F.col("after"), F.col("value")
    return (
        F.when(F.col("kind") == "email", ~before.rlike(f"[{_LOCAL}]$") & ~after.rlike(r"^(?:\.?[A-Za-z0-9-])"))
        .when(F.col("kind") == "ip", ~before.rlike(r"[0-9]\.?$") & ~after.rlike(r"^\.?[0-9]"))
        .when(F.col("kind") == "card", ~before.rlike(r"[0-9][\x20-]?$") & ~after.rlike(r"^[\x20-]?[0-9]"))
        .otherwise(value.startswith("+") & ~after.rlike(r"^[\x20().-]*[0-9]"))
    )


def _spans(found: DataFrame) -> DataFrame:
    """uid, fold, kind, first, last, base, features and label (null where undecided) of all spans and candidates."""
    rows = found.where(F.size("finds") > 0).select("uid", "fold", F.inline("finds"))
    ends = F.sum(F.col("gap") + F.length("value")).over(
        Window.partitionBy("uid", "pattern").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    )
    kind = F.element_at(F.array(*(F.lit(k) for k, _ in PATTERNS)), F.col("pattern") + 1)
    rows = rows.select("*", ends.cast("int").alias("last"), kind.alias("kind"))
    rows = rows.withColumn("first", F.col("last") - F.length("value"))
    base = F.col("pattern") < len(_BASE)
    rows = rows.withColumn("base", base & _passes(F.col("kind"), F.col("value"))).where(~base | F.col("base"))
    # A span that several patterns find is one; the widest view of what stands beside it counts.
    widest = lambda c: F.max(F.struct(F.length(c).alias("n"), F.col(c).alias("c"))).getField("c").alias(c)
    rows = rows.groupBy("uid", "fold", "kind", "first", "last").agg(
        F.max("base").alias("base"), F.min("value").alias("value"), widest("before"), widest("after")
    )

    def cut(*keys: str) -> Column:
        """Whether a base span among those of the same keys overlaps."""
        order = Window.partitionBy("uid", *keys).orderBy("first", "last")
        before = F.max(F.when(F.col("base"), F.col("last"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
        after = F.min(F.when(F.col("base"), F.col("first"))).over(order.rowsBetween(1, Window.unboundedFollowing))
        return F.coalesce(before > F.col("first"), F.lit(False)) | F.coalesce(after < F.col("last"), F.lit(False))

    rows = rows.select("*", cut("kind").alias("cuts_kind"), cut().alias("cuts"))
    label = F.when(F.col("base"), 1).when(F.col("cuts_kind") | _alone(), 0)
    return rows.select(
        "uid", "fold", "kind", "first", "last", "base", "cuts", label.alias("label"), *(c.cast("int").alias(n) for n, c in _features().items())
    )


@dataclass
class Cells:
    """Examples of one kind: the feature values of each cell, its number of candidates and of examples among them."""

    values: list[tuple[int, ...]] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    good: list[int] = field(default_factory=list)


@dataclass
class Leaf:
    value: float

    def score(self, x: tuple[int, ...]) -> float:
        return self.value

    def sql(self) -> str:
        return f"{self.value!r}D"


@dataclass
class Split:
    feature: int
    most: int
    low: Leaf | Split
    high: Leaf | Split

    def score(self, x: tuple[int, ...]) -> float:
        return (self.low if x[self.feature] <= self.most else self.high).score(x)

    def sql(self) -> str:
        name = list(FEATURES)[self.feature]
        return f"CASE WHEN {name} <= {self.most} THEN {self.low.sql()} ELSE {self.high.sql()} END"


def _grown(cells: Cells, rows: list[int], slope: list[float], bend: list[float], depth: int) -> Leaf | Split:
    """A regression tree on the gradients of the logistic loss."""

    def gain(s: float, b: float) -> float:
        return s * s / (b + PENALTY)

    all_s, all_b = sum(slope[i] for i in rows), sum(bend[i] for i in rows)
    best = (1e-6, None)
    for f in range(len(FEATURES)) if depth else ():
        sums: dict[int, list[float]] = {}
        for i in rows:
            at = sums.setdefault(cells.values[i][f], [0.0, 0.0])
            at[0] += slope[i]
            at[1] += bend[i]
        s = b = 0.0
        for value in sorted(sums)[:-1]:
            s, b = s + sums[value][0], b + sums[value][1]
            better = gain(s, b) + gain(all_s - s, all_b - b) - gain(all_s, all_b)
            if better > best[0] + 1e-9:
                best = (better, (f, value))
    if best[1] is None:
        return Leaf(RATE * all_s / (all_b + PENALTY))
    f, value = best[1]
    sides = [[i for i in rows if (cells.values[i][f] <= value) == low] for low in (True, False)]
    return Split(f, value, *(_grown(cells, side, slope, bend, depth - 1) for side in sides))


@dataclass
class Model:
    """Boosted trees of one kind and the score from which on a candidate is taken."""

    start: float = 0.0
    trees: list[Leaf | Split] = field(default_factory=list)
    threshold: float = math.inf

    def score(self, x: tuple[int, ...]) -> float:
        return self.start + sum(t.score(x) for t in self.trees)

    def sql(self) -> str:
        return " + ".join([f"{self.start!r}D", *(f"({t.sql()})" for t in self.trees)])


def fit(cells: Cells, held_out: Cells) -> Model:
    """Trees from ``cells``, threshold from ``held_out``."""
    n, good = sum(cells.n), sum(cells.good)
    if not 0 < good < n:
        return Model()
    model = Model(math.log(good / (n - good)))
    scores = [model.start] * len(cells.n)
    for _ in range(TREES):
        p = [1 / (1 + math.exp(-s)) for s in scores]
        slope = [g - m * q for g, m, q in zip(cells.good, cells.n, p)]
        bend = [m * q * (1 - q) for m, q in zip(cells.n, p)]
        tree = _grown(cells, list(range(len(scores))), slope, bend, DEPTH)
        model.trees.append(tree)
        scores = [s + tree.score(x) for s, x in zip(scores, cells.values)]
    by_score: dict[float, list[int]] = {}
    for x, m, g in zip(held_out.values, held_out.n, held_out.good):
        at = by_score.setdefault(model.score(x), [0, 0])
        at[0] += m
        at[1] += g
    # Shares of examples that rise with the score: neighbours that do not are pooled.
    pools: list[tuple[float, int, int]] = []
    for score, (n, good) in sorted(by_score.items()):
        while pools and pools[-1][2] * n >= good * pools[-1][1]:
            score, n, good = pools[-1][0], n + pools[-1][1], good + pools.pop()[2]
        pools.append((score, n, good))
    # Scores that the executors' sums round otherwise must not fall below.
    model.threshold = min((score - 1e-9 for score, n, good in pools if good >= PRECISION * n), default=math.inf)
    return model


def _models(spans: DataFrame) -> dict[str, Model]:
    held = (F.col("fold") == 0).alias("held")
    counts = spans.where("label IS NOT NULL").groupBy("kind", held, *FEATURES).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")
    )
    parts = {(k, h): Cells() for k in KINDS for h in (False, True)}
    for r in sorted(counts.collect(), key=lambda r: tuple(map(str, r))):
        cells = parts[r.kind, r.held]
        cells.values.append(tuple(r[f] for f in FEATURES))
        cells.n.append(r.n)
        cells.good.append(r.good)
    return {k: fit(parts[k, False], parts[k, True]) for k in KINDS}


def _added(spans: DataFrame, models: dict[str, Model]) -> DataFrame:
    """The undecided candidates that the models take: uid, kind, first, last, score."""
    score = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {m.sql()}" for k, m in models.items()) + " END")
    least = F.expr(
        "CASE kind " + " ".join(f"WHEN '{k}' THEN {m.threshold!r}D" for k, m in models.items() if m.threshold < math.inf) + " END"
    ) if any(m.threshold < math.inf for m in models.values()) else F.lit(None).cast("double")
    rows = spans.where("label IS NULL AND NOT cuts").withColumn("score", score).where(F.col("score") >= least)
    # Candidates that overlap in a chain have one number.
    order = Window.partitionBy("uid").orderBy("first", "last", "kind")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("starts", F.when(F.col("first") < before, 0).otherwise(1))
    rows = rows.withColumn("chain", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = Window.partitionBy("uid", "chain").orderBy(F.desc("score"), F.desc(F.col("last") - F.col("first")), "first", "kind")
    rows = rows.withColumn("place", F.row_number().over(best)).where("place = 1")
    return rows.select("uid", "kind", "first", "last", F.lit(False).alias("base"), "score")


def spans_and_models(docs: DataFrame, *keep: Column) -> tuple[DataFrame, dict[str, Model]]:
    """The columns ``keep`` and ``spans`` of each row, and the models.

    ``spans`` is an array of (start, kind, end, base, score) in order of start, then of kind as listed.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    columns, finds = _finds(F.col("text"))
    rows = docs.select(F.struct(*keep).alias("row"), text.alias("text"))
    rows = rows.select("row", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).alias("fold"), *(c.alias(n) for n, c in columns.items()))
    # Stored, the number of a row is the same for every later step.
    rows = stored(rows.select("row", "fold", F.monotonically_increasing_id().alias("uid"), finds.alias("finds")), "finds")
    spans = stored(_spans(rows), "spans")
    models = _models(spans)
    base = spans.where("base").select("uid", "kind", "first", "last", "base", F.lit(None).cast("double").alias("score"))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    span = F.struct(F.col("first").alias("start"), number.alias("number"), F.col("last").alias("end"), "kind", "base", "score")
    each = base.unionByName(_added(spans, models)).groupBy("uid").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    listed = F.transform("spans", lambda s: F.struct(*(s[c].alias(c) for c in ("start", "kind", "end", "base", "score"))))
    each = each.select(F.col("uid").alias("of"), listed.alias("spans"))
    none = F.array().cast("array<struct<start:int,kind:string,end:int,base:boolean,score:double>>")
    out = rows.select("row", "uid").join(each, F.col("uid") == F.col("of"), "left")
    return out.select("row", F.coalesce("spans", none).alias("spans")), models


def find(docs: DataFrame) -> DataFrame:
    """row (all columns as they came) and spans: array of (start, kind, end, base, score), see ``spans_and_models``."""
    return spans_and_models(docs, F.col("*"))[0]


def redacted(docs: DataFrame) -> DataFrame:
    """row (all columns as they came) and redacted: the text with each span replaced by its kind in brackets.

    Spans that overlap are replaced as one, by the kind of the first.
    """
    rows = find(docs)
    # The furthest end so far beside each span; four bytes a character make any place quick to reach.
    far = F.aggregate(
        "spans", F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.greatest(F.element_at(a, -1), s["end"])))
    )
    rows = rows.select("row", "spans", far.alias("far"), F.encode(F.col("row.text").cast("string"), "UTF-32").alias("code"))
    cut = lambda code, a, n: F.decode(F.substring(code, a * 4 + 1, n * 4), "UTF-32")
    piece = F.transform(
        F.arrays_zip("spans", F.slice("far", F.lit(1), F.size("spans")).alias("done")),
        lambda x: F.when(x["spans"]["start"] < x["done"], "").otherwise(
            F.concat(
                cut(F.col("code"), x["done"], x["spans"]["start"] - x["done"]), F.lit("["), F.upper(x["spans"]["kind"]), F.lit("]")
            )
        ),
    )
    rest = cut(F.col("code"), F.element_at("far", -1), F.octet_length("code"))
    return rows.select(
        "row", F.when(F.size("spans") == 0, F.col("row.text").cast("string")).otherwise(F.concat(F.array_join(piece, ""), rest)).alias("redacted")
    )


def digests(rows: DataFrame) -> DataFrame:
    """``rows`` with n_email, n_ip, n_card, n_phone, base_sha256 and spans as text: kind:start:end, comma-joined."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda a: F.array_join(F.transform(a, text), ",")
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    counts = {f"n_{k}": count(k) for k in KINDS}
    return rows.select(
        "row", *(c.alias(n) for n, c in counts.items()), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
