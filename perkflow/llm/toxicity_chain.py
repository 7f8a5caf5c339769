"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models; each
later model also sees the probabilities of the earlier ones. Those inputs are
out-of-fold predictions while training, so a later model learns from
probabilities as unsure as the ones it will meet.

The labels hold one flag, ``toxic``. It is the last category. The categories
before it are finer and weakly labelled: a toxic row that uses one of the
category's seed words.

Features are rates per hundred words (capped, square roots) of hashed words
and word beginnings (four to eight bytes), so inflected and compound forms
count. The chain is
fitted on the driver with at most ``LABELLED`` labelled rows and ``FEATURES``
features; every document is scored, in whole, by the executors.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow.llm.carry import packed, with_text
from perkflow.llm.components import materialise
from perkflow.llm.text import (
    _BYTE_VALUE, _powers, LETTER_DIGIT, LOWER, Words, by_piece, mix, row_of, split_words,
)

BUCKETS = 1 << 18
PREFIXES = (4, 5, 6, 7, 8)
#: Labelled rows used for fitting.
LABELLED = 12_000
#: Features kept, by the strength of their difference between the classes.
FEATURES = 256
#: Toxic training rows that must show a feature.
MIN_ROWS = 8
#: Largest rate per hundred words that counts.
MOST = 2.0
FOLDS = 5
RIDGE = 3.0
SEED = 23

#: Fixed seed words of the finer categories.
CATEGORIES = {
    "insult": ("idiot", "moron", "loser", "clown", "stupid", "dumb", "fool"),
    "contempt": ("trash", "scum", "worthless", "pathetic", "disgusting", "garbage", "filth"),
}
NAMES = (*CATEGORIES, "toxic")


def split_lower(column: pa.Array) -> Words:
    """Words of letters and digits, ASCII and Latin-1 letters in lower case."""
    w = split_words(column, LETTER_DIGIT, lower=True)
    data = w.data.copy()
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    data[second] += 0x20
    return w._replace(data=data)


def feature_hits(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of every feature occurrence, and the number of words of each row."""
    w = split_lower(column)
    n = len(w.data)
    up, down = _powers(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUE[w.data] * up[:n])])
    row, size = row_of(w), w.end - w.start
    rows, hashes = [row], [mix((sums[w.end] - sums[w.start]) * down[w.start])]
    for k in PREFIXES:
        long = size > k
        at = w.start[long]
        rows.append(row[long])
        hashes.append(mix((sums[at + k] - sums[at]) * down[at] + np.uint64(k)))
    return np.concatenate(rows), (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64), np.diff(w.rows)


class Chain(NamedTuple):
    """Fitted chain: feature of each bucket (-1: none), scales, weights per category (bias last), limit."""

    slot: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    limit: float

    def rates(self, column: pa.Array) -> np.ndarray:
        """Scaled feature rates of every text; zeros for a text without words."""
        row, bucket, words = feature_hits(column)
        at = self.slot[bucket]
        known = at >= 0
        k = len(self.scale)
        counts = np.bincount(row[known] * k + at[known], minlength=len(words) * k).reshape(len(words), k)
        return np.sqrt(np.minimum(100 * counts / np.maximum(words, 1)[:, None], MOST) / self.scale)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of each category, earlier ones feeding later ones."""
        out = np.zeros((len(x), len(self.weights)))
        for c, weight in enumerate(self.weights):
            out[:, c] = _probability(np.hstack([x, out[:, :c]]), weight)
        return out


def _probability(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weight[:-1] + weight[-1], -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the bias (last) is not penalised."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    share = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(share / (1 - share))
    for _ in range(steps):
        p = _probability(x[:, :-1], w)
        v = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * v[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit_chain(x: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Weights of each category and its out-of-fold probabilities; ``labels``: one column per category."""
    out = np.zeros(labels.shape)
    weights = []
    for c in range(labels.shape[1]):
        inputs = np.hstack([x, out[:, :c]])
        for f in np.unique(fold):
            test = fold == f
            out[test, c] = _probability(inputs[test], fit_logistic(inputs[~test], labels[~test, c]))
        weights.append(fit_logistic(inputs, labels[:, c]))
    return weights, out


def best_limit(p: np.ndarray, y: np.ndarray) -> float:
    """The limit with the best F1 on out-of-fold probabilities (in the middle of its gap)."""
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + max(y.sum(), 1))
    i = int(np.argmax(f1))
    return float((p[order][i] + (p[order][i + 1] if i + 1 < len(p) else 0)) / 2) if hit[-1] else 1.0


def labelled_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, flag: str, most: int) -> DataFrame:
    """(id, t, y) of at most ``most`` labelled documents, chosen by a hash of the id.

    One row per id, however often ``docs`` repeats it: its smallest text (each
    map task sends one row per id).
    """
    order = F.xxhash64("id", F.lit(SEED))
    known = labels.where(F.col(flag).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.max(F.col(flag).cast("int")).alias("y"))
    known = materialise(known.orderBy(order, "id").limit(most), "labelled")  # at most ``most`` rows: small enough to broadcast
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).join(F.broadcast(known), "id")
    rows = rows.groupBy("id").agg(F.min("t").alias("t"), F.first("y").alias("y"))
    return materialise(rows, "training")


def _choose(training: DataFrame, features: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature of each bucket, scale of each feature): the buckets whose rates differ most between the classes."""

    def run(batches):
        sums = np.zeros((5, BUCKETS))

        def one(piece: pa.RecordBatch) -> None:
            row, bucket, words = feature_hits(piece.column("t"))
            toxic = piece.column("y").to_numpy() > 0
            key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
            rate = np.minimum(100 * count / np.maximum(words, 1)[key // BUCKETS], MOST)
            sums[4] += np.bincount(key[toxic[key // BUCKETS]] % BUCKETS, minlength=BUCKETS)
            for y in (0, 1):
                mine = toxic[key // BUCKETS] == y
                at = key[mine] % BUCKETS
                sums[2 * y] += np.bincount(at, rate[mine], BUCKETS)
                sums[2 * y + 1] += np.bincount(at, rate[mine] ** 2, BUCKETS)

        for _ in by_piece("t", one)(batches):
            pass
        used = np.flatnonzero(sums[[1, 3]].sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(s[used]) for s in sums]], names=["bucket", "a", "aa", "b", "bb", "n"])

    n = dict(training.groupBy("y").count().collect())
    n0, n1 = max(n.get(0, 0), 1), max(n.get(1, 0), 1)
    sums = training.mapInArrow(run, "bucket long, a double, aa double, b double, bb double, n double").groupBy("bucket")
    sums = sums.agg(*[F.sum(c).alias(c) for c in ("a", "aa", "b", "bb", "n")]).where(F.col("n") >= MIN_ROWS)
    var = lambda s, ss, k: F.greatest(F.col(ss) / k - F.pow(F.col(s) / k, 2), F.lit(0.0)) / k
    gap = F.col("b") / n1 - F.col("a") / n0
    strength = F.abs(gap) / F.sqrt(var("a", "aa", n0) + var("b", "bb", n1) + 1e-6)
    spread = F.sqrt((F.col("aa") + F.col("bb")) / (n0 + n1))
    best = sums.select("bucket", strength.alias("t"), spread.alias("scale")).orderBy(F.desc("t"), "bucket").limit(features).collect()
    slot = np.full(BUCKETS, -1, np.int64)
    slot[[r["bucket"] for r in best]] = np.arange(len(best))
    return slot, np.array([r["scale"] for r in best], np.float64)


def fit(training: DataFrame, features: int = FEATURES, folds: int = FOLDS) -> Chain:
    """The chain from rows (id, t, y); with one class only it predicts that class's rate everywhere."""
    slot, scale = _choose(training, features)
    blank = Chain(slot, scale, [], 1.0)
    seeds = [frozenset(s.encode() for s in words) for words in CATEGORIES.values()]

    def rates(piece: pa.RecordBatch) -> pa.RecordBatch:
        x = blank.rates(piece.column("t")).astype(np.float32)
        w = split_lower(piece.column("t"))
        raw = w.data.tobytes()
        spoken = [{raw[a:b] for a, b in zip(w.start[i:j].tolist(), w.end[i:j].tolist(), strict=True)} for i, j in zip(w.rows[:-1], w.rows[1:], strict=True)]
        has = [[bool(words & s) for words in spoken] for s in seeds]
        packed = pa.array([r.tobytes() for r in x], pa.binary())
        return pa.RecordBatch.from_arrays([piece.column("id"), piece.column("y"), packed, pa.array(list(map(list, zip(*has, strict=True))), pa.list_(pa.bool_()))], names=["id", "y", "x", "has"])

    found = training.mapInArrow(by_piece("t", rates), "id long, y int, x binary, has array<boolean>")
    rows = sorted(found.collect())  # one row per labelled id, a bounded sample
    if not rows:
        return Chain(slot, scale, [np.array([*np.zeros(len(scale) + c), -30.0]) for c in range(len(NAMES))], 1.0)
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]).astype(np.float64)
    toxic = np.array([r["y"] > 0 for r in rows], float)
    weak = np.array([r["has"] for r in rows], float) * toxic[:, None]
    weights, out = fit_chain(x, np.hstack([weak, toxic[:, None]]), np.arange(len(rows)) % folds)
    return Chain(slot, scale, weights, best_limit(out[:, -1], toxic))


def score(docs: DataFrame, chain: Chain, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` as ``row`` (struct of its kept columns; default: all) and ``t`` (its text, if kept)
    with a probability per category (``p_...``) and the verdict ``is_toxic``."""
    model = docs.sparkSession.sparkContext.broadcast(chain)
    cols = docs.select(*packed(docs, text, keep))
    names = [f"p_{c}" for c in NAMES]
    back = ["row", *(["t"] if with_text(keep, text) else [])]
    schema = cols.select(*back, *[F.lit(0.0).alias(c) for c in names]).schema

    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        p = model.value.predict(model.value.rates(piece.column("t")))
        own = [piece.column(c) for c in back]
        return pa.RecordBatch.from_arrays([*own, *[pa.array(p[:, c]) for c in range(len(names))]], names=schema.names)

    return cols.mapInArrow(by_piece("t", one), schema).withColumn("is_toxic", F.col("p_toxic") >= chain.limit)


def classify(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", flag: str = "toxic", labelled: int = LABELLED,
    keep: list[str] | None = None,
) -> DataFrame:
    """Fit the chain on labelled rows of ``docs`` and score all of them.

    Null and empty texts have no features and get the base rate; without
    labels nothing is toxic; labels of null id or flag are ignored, and an id
    labelled twice counts as toxic if either says so; repeated rows score
    alike; an empty table gives an empty result.
    """
    return score(docs, fit(labelled_rows(docs, labels, doc_id, text, flag, labelled)), text, keep)
