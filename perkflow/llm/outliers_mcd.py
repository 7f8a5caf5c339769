"""Quality rules: robust multivariate outliers per language and source.

Each text gives a vector of transformed statistics. For every (language,
source) group a minimum-covariance-determinant estimate is found by
concentration steps over all rows that pass the base rules: from medians and
quartiles, take the ``CORE`` share of rows nearest by Mahalanobis distance,
estimate mean and covariance from them, repeat until nothing changes. Rows
farther than ``CUT`` from their group's estimate are rejected.

A step is a few aggregations: distances are Spark expressions, the share's
limit comes from counts of finely binned distances, the moments from sums.
Only one row per group (moments, inverse) is handled in Python. The estimate of
a group is blended with its language's by row counts, so small groups need no
switch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.llm.components import materialise
from perkflow.llm.decontamination_suffix import covered
from perkflow.llm.text import (
    NOT_SPACE, Words, by_piece, dense_rank, ngram_ranks, row_of, split_words, text_bytes, word_ranks,
)

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
#: Share of a group's rows that its estimate is made from.
CORE = 0.75
#: Largest squared distance kept. The floors below keep distances from being chi-square; 99.99 % of the
#: labelled-good rows of the 0.10 GB table that pass the base rules lie below 33.
CUT = 35.0
#: Rows of its language that count beside a group's own.
BLEND = 100
#: The smallest spread of each transformed statistic that counts as one unit of distance, set so that each
#: can pass ``CUT`` alone: the distance is never above the sum of (difference / spread) squared.
SPREAD = (0.03, 0.03, 0.1, 0.06, 0.03, 0.06)
#: Lines and words without repeats that every text is given, as shares of a few of them say little.
MORE_LINES = 8
MORE_WORDS = 400
MAX_STEPS = 8

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b'!?;:"()[]{}~^_=+\\/@')] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_NOT_BREAK = np.ones(256, bool)
_NOT_BREAK[0x0A] = False

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
D = len(SPREAD)


def _per_row(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(w: Words, window: int) -> np.ndarray:
    """Mask of the words in windows that occur twice or more in their row."""
    n = len(w.start)
    if n < window:
        return np.zeros(n, bool)
    stop = np.repeat(w.rows[1:], np.diff(w.rows))
    at = np.flatnonzero(stop - np.arange(n) >= window)
    grams = ngram_ranks(word_ranks(w).rank, stop, window)[0]
    rank, _, distinct = dense_rank(grams[at] * len(w.rows) + row_of(w)[at])
    twice = at[np.bincount(rank, minlength=distinct)[rank] > 1]
    return covered(n, twice, np.full(len(twice), window))


def text_counts(column: pa.Array, window: int = REPEAT_WINDOW) -> dict[str, np.ndarray]:
    """The base statistics of every text (null: empty), see ``COUNTS``."""
    w = split_words(column, NOT_SPACE)
    data, off = w.data, text_bytes(column)[1]
    word_byte = NOT_SPACE[data]
    lines = split_words(column, _NOT_BREAK)
    sums = np.concatenate([[0], np.cumsum(word_byte)])
    real = sums[lines.end] > sums[lines.start]
    row = row_of(lines)[real]
    rank, _, distinct = dense_rank(word_ranks(lines).rank[real] * len(lines.rows) + row)
    owner = np.zeros(distinct, np.int64)
    owner[rank] = row
    rows = len(off) - 1
    n_lines = np.bincount(row, minlength=rows)
    return {
        "n_words": np.diff(w.rows),
        "word_chars": _per_row(((data & 0xC0) != 0x80) & word_byte, off),
        "n_symbols": _per_row(_SYMBOLS[data], off),
        "n_dup_lines": n_lines - np.bincount(owner, minlength=rows),
        "n_repeat_words": _per_row(_repeated(w, window), w.rows),
        "n_lines": n_lines,
        "n_upper": _per_row(_UPPER[data], off),
        "n_marks": _per_row(_MARKS[data], off),
    }


def count_texts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns (as k0, k1, ...) and ``COUNTS`` for every row."""
    cols = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))
    schema = T.StructType([*cols.schema.fields[:-1], *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        got = text_counts(piece.column(piece.num_columns - 1))
        arrays = [*piece.columns[:-1], *[pa.array(got[c].astype(np.int64)) for c in COUNTS]]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return cols.mapInArrow(by_piece("t", one), schema)


def vector() -> list[Column]:
    """The transformed statistics, from the columns of ``COUNTS``."""
    share = lambda a, b, more=0: F.sqrt(F.col(a) / F.greatest(F.col(b) + more, F.lit(1)))
    return [
        F.log((F.col("word_chars") + 300) / (F.col("n_words") + 50)), share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines", MORE_LINES), share("n_repeat_words", "n_words", MORE_WORDS), share("n_upper", "word_chars"),
        share("n_marks", "word_chars"),
    ]


def _quantile(df: DataFrame, keys: list[str], bin_: Column, shares: dict[str, float]) -> DataFrame:
    """Per group the smallest bin that holds each share of its rows, from counts per bin."""
    counts = df.groupBy(*keys, bin_.alias("bin")).count()
    w = Window.partitionBy(*keys)
    counts = counts.withColumn("below", F.sum("count").over(w.orderBy("bin"))).withColumn("all", F.sum("count").over(w))
    picks = [F.min(F.when(F.col("below") >= F.col("all") * s, F.col("bin"))).alias(k) for k, s in shares.items()]
    return counts.groupBy(*keys).agg(*picks)


def _start(rows: DataFrame) -> DataFrame:
    """First estimate per group: medians, and quartile ranges as independent spreads."""
    steps = 512
    long = rows.select("g", "s", F.posexplode(F.array(*[f"x{i}" for i in range(D)])).alias("i", "x"))
    q = _quantile(long, ["g", "s", "i"], F.floor(F.col("x") * steps), {"a": 0.25, "m": 0.5, "b": 0.75})
    spread = F.pow((F.col("b") - F.col("a")) / steps / 1.349, 2)
    floor = F.element_at(F.array(*[F.lit(v * v) for v in SPREAD]), F.col("i") + 1)
    q = q.select("g", "s", "i", ((F.col("m") + 0.5) / steps).alias("mu"), (1 / (spread + floor)).alias("w"))
    one = q.groupBy("g", "s").agg(F.array_sort(F.collect_list(F.struct("i", "mu", "w"))).alias("e"))
    inv = F.flatten(F.transform("e", lambda e: F.transform(F.sequence(F.lit(0), F.lit(D - 1)), lambda j: F.when(j == e["i"], e["w"]).otherwise(0.0))))
    return one.select("g", "s", F.col("e.mu").alias("mu"), inv.alias("inv"), F.lit(0.0).alias("logdet"))


def distance2() -> Column:
    """Squared Mahalanobis distance from columns x0.., mu and inv."""
    diff = [F.col(f"x{i}") - F.col("mu")[i] for i in range(D)]
    terms = [diff[i] * diff[j] * F.col("inv")[i * D + j] * (1 if i == j else 2) for i in range(D) for j in range(i, D)]
    return sum(terms[1:], terms[0])


def _step(rows: DataFrame, now: DataFrame, core: float) -> DataFrame:
    """One concentration step: (g, s, mu, inv, logdet) from the nearest rows under the present estimate."""
    near = rows.join(now, ["g", "s"]).withColumn("bin", F.floor(32 * F.log2(distance2() + 1e-9)))
    near = near.select("g", "s", *[f"x{i}" for i in range(D)], "bin")
    limit = materialise(_quantile(near, ["g", "s"], F.col("bin"), {"limit": core}), "mcd")
    inside = near.join(limit, ["g", "s"]).where("bin <= limit")
    pairs = [(i, j) for i in range(D) for j in range(i, D)]
    names = ["n", *[f"s{i}" for i in range(D)], *[f"p{i}_{j}" for i, j in pairs]]
    sums = inside.groupBy("g", "s").agg(
        F.count("*").cast("double").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(D)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs],
    )
    lang = sums.groupBy("g").agg(*[F.sum(c).alias(f"l_{c}") for c in names])
    both = sums.join(lang, "g")

    def estimate(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = tuple(np.array(pairs).T)
        for p in parts:
            def moments(prefix, p=p):
                n = p[prefix + "n"].to_numpy()
                mean = p[[f"{prefix}s{i}" for i in range(D)]].to_numpy() / n[:, None]
                second = np.zeros((len(p), D, D))
                second[:, upper[0], upper[1]] = second[:, upper[1], upper[0]] = p[[f"{prefix}p{i}_{j}" for i, j in pairs]].to_numpy() / n[:, None]
                return n, mean, second - mean[:, :, None] * mean[:, None, :]

            n, mean, cov = moments("")
            _, mean_l, cov_l = moments("l_")
            a = n / (n + BLEND)
            mu = a[:, None] * mean + (1 - a)[:, None] * mean_l
            full = (a[:, None, None] * cov + (1 - a)[:, None, None] * cov_l) / core + np.diag(np.square(SPREAD))
            inv = np.linalg.inv(full)
            yield pd.DataFrame({
                "g": p["g"], "s": p["s"], "mu": list(mu), "inv": list(inv.reshape(len(p), -1)), "logdet": np.linalg.slogdet(full)[1],
            })

    return both.mapInPandas(estimate, "g string, s string, mu array<double>, inv array<double>, logdet double")


def fit_groups(rows: DataFrame, core: float = CORE, max_steps: int = MAX_STEPS) -> DataFrame:
    """MCD estimate (g, s, mu, inv, logdet) of every group of ``rows`` (g, s, x0..)."""
    now = materialise(_start(rows), "mcd")
    last = None
    for _ in range(max_steps):
        now = materialise(_step(rows, now, core), "mcd")
        total = now.agg(F.sum("logdet")).first()[0]
        if last is not None and abs(total - last) <= 1e-6 * max(1.0, abs(last)):
            break
        last = total
    return now


def judge(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``keep`` columns (named k0, k1, ...), ``COUNTS``, ``base_failed``, ``distance2`` and ``kept`` of every row.

    ``base_failed``: under 20 words, or over 30 percent of the words in 8-word
    windows found twice in the text. ``kept``: not failed and within ``CUT`` of
    the group's estimate. Null texts have no words and fail; null languages and
    sources are groups of their own; every row is judged by itself, repeated
    rows alike; an empty table gives an empty result.
    """
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    marked = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], name(lang).alias("g"), name(source).alias("s"), F.col(text).alias("t"))
    own = [f"k{i}" for i in range(len(keep))]
    counted = count_texts(marked, [*own, "g", "s"], "t")
    counted = counted.withColumnsRenamed({f"k{len(keep)}": "g", f"k{len(keep) + 1}": "s"})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    counted = counted.withColumn("base_failed", failed).withColumns({f"x{i}": c for i, c in enumerate(vector())})
    rows = materialise(counted, "statistics")
    groups = fit_groups(rows.where("NOT base_failed").select("g", "s", *[f"x{i}" for i in range(D)]))
    far = rows.join(groups, ["g", "s"], "left").withColumn("distance2", distance2())
    near = F.coalesce(F.col("distance2") <= CUT, F.lit(True))
    return far.select(*own, *COUNTS, "base_failed", "distance2", (~F.col("base_failed") & near).alias("kept"))
