"""Personal data by candidate gradient boosting: DataFrame expressions and Spark ML only.

High-recall generators (regular expressions, two or more per kind) propose
spans that may overlap. Boosted trees score each candidate from its format and
its context, and a threshold per kind decides which become redactions. Spans of
the base rules always stay; the trees add candidates that the base rules lose,
such as a card number that runs into the next number.

The trees are fitted with Spark ML on the candidates of all documents, labelled
by the validity rules of their kind. Candidates of equal features are one row
with their number as its weight, so the fit's table grows with the different
forms, not with the corpus. Splits lie at the fixed ``STEPS``, one yes-or-no
feature each, since Spark ML would place splits of numbers by a sample of the
rows. Thresholds are calibrated on all candidates too: each is scored by trees
fitted on the other folds of documents.

The trees are then written out as SQL expressions. So scoring is one narrow
pass over whole texts: no shuffle, no join, nothing but column expressions.

No pattern crosses a repeat of its own class, so scanning is linear: runs are
possessive and may only start where a run starts or the last match ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkflow.llm.components import discard, materialise

KINDS = ("email", "ip", "card", "phone")

#: (kind, pattern); the first of each kind is the base rule.
GENERATORS = (
    (0, r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    (1, r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    (2, r"[0-9](?:[\x20-]?[0-9])++"),
    (3, r"\+[0-9][\x20().0-9-]+[0-9]"),
    (0, r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{2,24}){1,4}"),
    (1, r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    (2, r"(?<![0-9])[0-9]{14,19}(?![0-9])"),
    (2, r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])"),
    (3, r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])"),
    (3, r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"),
)
BASE = len(KINDS)
#: Parts of the documents, by a hash of the id; each part's candidates are scored by trees of the others.
FOLDS = 3
#: Where a feature that is a number may be split.
STEPS = (*range(25), 28, 32, 40, 48, 64, 128, 256)
#: Rows of the fit in one partition, about.
PART = 20_000
TREES = 12
DEPTH = 4
#: Share of valid candidates that a threshold must reach among those above it.
PRECISION = 0.98
SEED = 31
CHUNK = 128

_WORDS = r"(?i)(?:phone|tel|call|fax|mobile|mail|contact|card|visa|account|address|host|server|ip)\b"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lens: Column) -> Column:
    """Running totals of an array, in two levels, so that long arrays stay cheap."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, v: s + v)
    n = F.size(lens)
    sums = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int")), lambda c: total(F.slice(lens, c * CHUNK + 1, F.lit(CHUNK))))

    def bases(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda c: total(F.slice(s, F.lit(1), c)))

    def totals(base: Column) -> Column:
        def at(i: Column) -> Column:
            chunk = F.floor(i / CHUNK).cast("int")
            return F.element_at(base, chunk + 1) + total(F.slice(lens, chunk * CHUNK + 1, i - chunk * CHUNK + 1))

        return F.transform(F.sequence(F.lit(0), n - 1), at)

    return let(sums, lambda s: let(bases(s), totals))


def matches(text: Column, generator: int) -> Column:
    """Array of the generator's leftmost non-overlapping matches, with places in code points and context.

    Gaps and matches alternate in a text, so the lengths of both give places.
    """
    kind, pattern = GENERATORS[generator]

    def located(parts: Column, found: Column, ends: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            end = F.element_at(ends, i + 1)
            return F.struct(
                F.lit(kind).alias("kind"), F.lit(generator).alias("generator"), (end - F.char_length(m)).alias("start"),
                end.alias("end"), m.alias("text"), F.right(F.element_at(parts, i + 1), F.lit(24)).alias("before"),
                F.left(F.element_at(parts, i + 2), F.lit(12)).alias("after"),
            )

        return F.transform(found, one)

    def with_gaps(found: Column) -> Column:
        def places(parts: Column) -> Column:
            lens = F.transform(found, lambda m, i: (F.char_length(F.element_at(parts, i + 1)) + F.char_length(m)).cast("long"))
            return let(lens, lambda ls: let(_running(ls), lambda ends: located(parts, found, ends)))

        return let(F.split(text, pattern, -1), places)

    nothing = F.filter(F.array(located_type(kind, generator)), lambda _: F.lit(False))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, with_gaps(found)).otherwise(nothing))


def located_type(kind: int, generator: int) -> Column:
    """A span of the type that ``matches`` makes."""
    return F.struct(
        F.lit(kind).alias("kind"), F.lit(generator).alias("generator"), F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("end"), F.lit("").alias("text"), F.lit("").alias("before"), F.lit("").alias("after"),
    )


def candidates(text: Column) -> Column:
    """All generators' spans of a text; a text without digits and @ signs is not searched."""
    every = F.concat(*[matches(text, g) for g in range(len(GENERATORS))])
    nothing = F.filter(F.array(located_type(0, 0)), lambda _: F.lit(False))
    return F.when(text.rlike(r"[0-9@]|[\[(]at[\])]"), every).otherwise(nothing)


def digits(span: Column) -> Column:
    return F.regexp_replace(span["text"], "[^0-9]", "")


def valid(span: Column) -> Column:
    """The validity rule of the span's kind."""
    n = F.length(digits(span))
    ip = span["text"].rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$")
    card = n.between(14, 19) & F.call_function("luhn_check", digits(span))
    return F.when(span["kind"] == 0, F.lit(True)).when(span["kind"] == 1, ip).when(span["kind"] == 2, card).otherwise(n.between(10, 15))


def features(span: Column) -> list[Column]:
    """Format and context of a candidate, as numbers."""
    text, before, after = span["text"], span["before"], span["after"]
    n = F.length(digits(span))
    is_ = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return [
        span["kind"].cast("double"), is_(span["generator"] < BASE), n.cast("double"), F.char_length(text).cast("double"),
        F.length(F.regexp_replace(text, "[A-Za-z0-9]", "")).cast("double"), F.length(F.regexp_replace(text, "[^A-Za-z]", "")).cast("double"),
        is_(F.call_function("luhn_check", digits(span))), is_(text.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$")),
        is_(text.startswith("+")), is_(text.contains("(")), is_(before.rlike(r"[A-Za-z0-9]$")), is_(after.rlike(r"^[A-Za-z0-9]")),
        is_(before.rlike("[\"'=]$")), F.length(F.regexp_replace(F.concat(before, after), "[^0-9]", "")).cast("double"),
        is_(before.rlike(_WORDS)), F.coalesce(F.left(digits(span), F.lit(1)).try_cast("double"), F.lit(-1.0)),
    ]


FEATURES = 16
#: A feature's splits: all features but the numbers are 0 or 1.
_NUMBERS = {0: range(BASE - 1), 2: STEPS, 3: STEPS, 4: STEPS, 5: STEPS, 13: STEPS, 15: range(-1, 9)}
SPLITS = [(i, step) for i in range(FEATURES) for step in _NUMBERS.get(i, (0,))]


def stepped(feature: Column, at: int) -> Column:
    """The least step from the feature on: on the same side of every split as the feature itself."""
    steps = _NUMBERS.get(at, (0,))
    if len(steps) == 1:
        return feature

    def least(value: Column) -> Column:
        out = F.lit(2.0 * STEPS[-1])
        for step in reversed(steps):
            out = F.when(value <= step, F.lit(float(step))).otherwise(out)
        return out

    return let(feature, least)


def _tree(lines: list[str], at: int, f: Column) -> tuple[Column, int]:
    """A printed tree over ``SPLITS``, from line ``at``, as an expression over the feature array; the line after it."""
    line = lines[at].strip()
    if line.startswith("Predict:"):
        return F.lit(float(line.split(":")[1])), at + 1
    split, op, value = line[line.index("feature ") + 8 : -1].split(" ")
    if op != "in" or value not in ("{0.0}", "{1.0}"):
        raise ValueError(f"a tree with an unknown split: {line}")
    yes, at = _tree(lines, at + 1, f)
    no, at = _tree(lines, at + 1, f)
    if value == "{1.0}":
        yes, no = no, yes
    name, step = SPLITS[int(split)]
    return F.when(F.element_at(f, name + 1) <= float(step), yes).otherwise(no), at


class Boosted:
    """Fitted trees (printed form and weights) and the threshold of each kind."""

    def __init__(self, trees: list[tuple[list[str], float]], thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    def score(self, span: Column) -> Column:
        """Probability that a candidate is personal data."""
        return let(F.array(*features(span)), self.score_of)

    def score_of(self, f: Column) -> Column:
        """The score by an array of features."""
        if not self.trees:
            return F.lit(0.0)
        parts = [_tree(lines, 0, f)[0] * weight for lines, weight in self.trees]
        return 1 / (1 + F.exp(-2 * sum(parts[1:], parts[0])))

    def accepts(self, span: Column) -> Column:
        limit = F.lit(2.0)
        for kind, t in self.thresholds.items():
            limit = F.when(span["kind"] == kind, F.lit(t)).otherwise(limit)
        return self.score(span) >= limit


def _boost(rows: DataFrame) -> Boosted:
    """Boosted trees of (f0, ..., label, n) rows, n: the row's weight; no trees with one class only."""
    sizes = [r["count"] for r in rows.groupBy("label").count().collect()]
    if len(sizes) < 2:
        return Boosted([], {})
    sides = array_to_vector(F.array(*[(F.col(f"f{i}") > step).cast("double") for i, step in SPLITS]))
    yes_or_no = {"ml_attr": {"attrs": {"binary": [{"idx": j} for j in range(len(SPLITS))]}, "num_attrs": len(SPLITS)}}
    training = rows.select(sides.alias("features", metadata=yes_or_no), "label", F.col("n").cast("double").alias("n"))
    training = training.coalesce(-(-sum(sizes) // PART))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=2, stepSize=0.3, seed=SEED, weightCol="n").fit(training)
    trees = [
        ([x for x in t.toDebugString.split("\n")[1:] if x.strip()], w) for t, w in zip(model.trees, model.treeWeights, strict=True)
    ]
    return Boosted(trees, {})


def training_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(kind, fold, label, f0, ..., n): the candidates of all documents, equal ones counted in n.

    Label: the validity rule of the kind. Candidates of the national phone form
    have no rule and are left out.
    """
    fold = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit(SEED)), F.lit(FOLDS)).cast("int")
    spans = docs.select(fold.alias("fold"), F.explode(candidates(F.col(text))).alias("s")).where(F.col("s.generator") != len(GENERATORS) - 1)
    numbers = [stepped(f, i).alias(f"f{i}") for i, f in enumerate(features(F.col("s")))]
    rows = spans.select(F.col("s.kind").alias("kind"), "fold", F.coalesce(valid(F.col("s")), F.lit(False)).cast("double").alias("label"), *numbers)
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def fit(docs: DataFrame, doc_id: str, text: str) -> Boosted:
    """Boosted trees of all documents' candidates, and thresholds from all scored by trees of the other folds.

    A fold whose other folds have one class only takes no part in calibration.
    No threshold is below a half, however few candidates of a kind are invalid.
    """
    rows = materialise(training_rows(docs, doc_id, text), "candidates")
    model = _boost(rows)
    if not model.trees:
        discard(rows)
        return model
    bins: dict[tuple, list] = {}
    for fold in range(FOLDS):
        others = _boost(rows.where(F.col("fold") != fold))
        if others.trees:
            p = F.round(others.score_of(F.array(*[f"f{i}" for i in range(FEATURES)])), 2)
            held = rows.where(F.col("fold") == fold).groupBy("kind", p.alias("p"))
            for r in held.agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect():  # at most 404 rows
                total = bins.setdefault((r["kind"], r["p"]), [0, 0])
                total[0] += r["good"]
                total[1] += r["n"]
    discard(rows)
    for kind in range(BASE):
        good = n = 0
        for p in sorted((p for k, p in bins if k == kind), reverse=True):
            good, n = good + bins[kind, p][0], n + bins[kind, p][1]
            if good >= PRECISION * n and p >= 0.5:
                model.thresholds[kind] = p - 0.005
    return model


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row of ``docs`` as ``row`` with ``base`` and ``added``: arrays of (start, kind, end), in that order.

    ``base``: matches of the base rules that are valid. ``added``: candidates
    that the trees accept, that overlap no base span and no accepted candidate
    before them (by start, longest first). Places are code points from 0, ends
    exclusive. Null texts have no spans; repeated rows get equal spans; rows of
    a null id are in one fold; an empty table gives an empty result.
    """
    model = fit(docs, doc_id, text)
    rows = docs.select(F.struct(*docs.columns).alias("row"), candidates(F.coalesce(F.col(text), F.lit(""))).alias("all"))

    place = lambda s: s["start"] * BASE + s["kind"]

    def choose(every: Column) -> Column:
        base = F.filter(every, lambda s: (s["generator"] < BASE) & valid(s))

        def add(b: Column) -> Column:
            # Most candidates start where a base span of their kind does; a hashed difference of places sets
            # them aside, so that only the others are compared with the base spans.
            places = F.array_except(F.transform(every, place), F.transform(b, place))
            return let(places, lambda left: pick(b, left))

        def pick(b: Column, left: Column) -> Column:
            more = F.filter(every, lambda s: F.array_contains(left, place(s)) & ~F.exists(b, lambda x: _overlap(x, s)) & model.accepts(s))
            ordered = F.array_sort(F.transform(more, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("far"), s["kind"].alias("kind"), s["end"].alias("end"))))
            nothing = F.filter(ordered, lambda _: F.lit(False))
            kept = F.aggregate(ordered, nothing, lambda done, s: F.when(F.exists(done, lambda x: _overlap(x, s)), done).otherwise(F.concat(done, F.array(s))))
            short = lambda a: F.array_sort(F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
            return F.struct(short(b).alias("base"), short(kept).alias("added"))

        return let(base, add)

    return rows.select("row", let(F.col("all"), choose).alias("spans")).select("row", "spans.base", "spans.added")


def span_text(spans: Column) -> Column:
    """kind:start:end of an ordered array of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets (overlaps merge under the first kind)."""
    found = find_spans(docs, doc_id, text)
    ordered = F.array_sort(F.concat("base", "added"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    body = F.coalesce(F.col("row")[text], F.lit(""))

    def step(a: Column, s: Column) -> Column:
        names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
        gap = F.substring(body, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        put = F.concat(a["out"], gap, F.element_at(names, s["kind"] + 1))
        return F.struct(F.when(s["start"] < a["at"], a["out"]).otherwise(put).alias("out"), F.greatest(a["at"], s["end"]).alias("at"))

    def end(a: Column) -> Column:
        return F.concat(a["out"], F.substring(body, (a["at"] + 1).cast("int"), F.char_length(body)))

    clean = F.when(F.size(ordered) > 0, F.aggregate(ordered, start, step, end)).otherwise(F.col("row")[text])
    return found.withColumn("clean", clean).select(*[F.col("clean").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
