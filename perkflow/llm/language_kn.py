"""Language identification by interpolated Kneser-Ney character models.

Per language one character model of order 5 over letters in lower case; every
run of anything else is one space. The highest order holds counts, each lower
one the number of different characters that its n-gram was seen to follow
(Kneser-Ney). A discount per language and order, n1 / (n1 + 2 n2) from the
counts of counts, is given to the next lower order, down to all characters
alike. A text goes to the language with the lowest cross-entropy, in bits per
character.

Models live in sorted hash arrays: per order the sorted 64-bit hashes of the
n-grams of all languages, an index on their first bits, and beside each hash
its log probability in every language, so one look-up serves all of them.
N-grams that aren't stored back off with the weight of their context.

Rejection is calibrated on one training document in eight, which isn't counted
for the models. ``score`` is the share of right predictions at that evidence
(distance to the next language, times the root of the length; made monotone).
A text is ``rejected``, with its prediction kept, if its cross-entropy lies
further above its language's mean than that of 99.9 % of calibration texts of
about its length, or if its score is below a half.

Spark's work: n-grams of all training texts are counted per task, then per
(language, n-gram); lower orders, counts of counts and the histogram of counts
are aggregations of that table. Models of up to ``MOST_ENTRIES`` n-grams, fewer
if there are many languages (``MOST_CELLS``), go to the driver and the workers
whole, and texts are scored in one narrow pass.

Larger models stay tables, and no n-gram is left out. The most frequent n-grams
of the highest order, as many as that bound, go to the workers with their log
probabilities. All others of the texts, seen in training or not, are written
out with the text's number; each different one meets the counts and contexts of
its orders by joins, and its log probabilities meet the texts by one more join.
Every text gets the cross-entropies of the whole models, up to rounding.

Defined cases. Null texts and texts without a letter: ``und``, score 0, no
cross-entropy. With nothing learned every text is ``und``. Ties go to the
first language by code point. A null language or a null id teaches nothing; a
null id isn't held out. Repeated rows count and are predicted each. Texts are
read whole, however long: the model works through them in slices. Other
columns travel as one struct, so their names can't clash. Letters are what
Unicode calls so.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from perkflow.llm.carry import packed, with_text
from perkflow.llm.components import discard, materialise
from perkflow.llm.text import by_piece, expand, mix, pieces, text_bytes

ORDER = 5
#: N-grams of all orders and languages that a worker holds at most, and n-grams times languages; the rest are joined.
MOST_ENTRIES = 1_000_000
MOST_CELLS = 16_000_000
#: One training document in so many calibrates.
CALIBRATION = 8
ACCEPTED = 0.999
UNKNOWN = "und"
SPACE = 0x20
#: Positions scored at a time: small enough for the processor's cache.
SLICE = 1 << 16
COUNT_BYTES = 1 << 22
_U = np.uint64
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """The lower-case letter of every code point; a space for what is none."""
    if not _LETTERS:
        table = np.full(0x110000, SPACE, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LETTERS.append(table)
    return _LETTERS[0]


class Spelled(NamedTuple):
    """Texts as code points: each with ORDER - 1 spaces ahead and a space behind; ``rows``: first place of each text."""

    codes: np.ndarray
    rows: np.ndarray


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a string column and the first one of each row (one more than rows)."""
    data, off = text_bytes(column)
    try:
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:  # broken UTF-8 somewhere: row by row
        each = [data[a:b].tobytes().decode(errors="replace") for a, b in zip(off[:-1], off[1:], strict=True)]
        codes = np.frombuffer("".join(each).encode("utf-32-le"), np.uint32)
        return codes, np.concatenate([[0], np.cumsum([len(s) for s in each])]).astype(np.int64)
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return codes, first[off]


def spelled(column: pa.Array) -> Spelled:
    """The letters of each text, words apart by one space; a text without a letter has no places."""
    codes, off = code_points(column)
    codes = letters()[codes]
    gap = codes == SPACE
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    starts = off[:-1][np.diff(off) > 0]
    keep[starts] = ~gap[starts]
    kept = np.concatenate([[0], np.cumsum(keep)])[off]
    size = np.diff(kept)
    codes = codes[keep]
    open_end = np.zeros(len(size), bool)
    some = np.flatnonzero(size)
    open_end[some] = codes[kept[1:][some] - 1] != SPACE
    total = np.where(size > 0, ORDER - 1 + size + open_end, 0)
    rows = np.concatenate([[0], np.cumsum(total)])
    out = np.full(rows[-1], SPACE, _U)
    out[expand(rows[:-1] + ORDER - 1, size)] = codes
    return Spelled(out, rows)


def key(columns: Sequence[np.ndarray]) -> np.ndarray:
    """The hash of n-grams given as one array of code points per place, oldest first."""
    k = len(columns)
    last = columns[-3:]
    low = last[0] if k else np.zeros(1, _U)
    for c in last[1:]:
        low = (low << _U(21)) | c
    if k > 3:
        high = columns[0]
        for c in columns[1 : k - 3]:
            high = (high << _U(21)) | c
        low = low ^ mix(high + _U(0x9E3779B97F4A7C15))
    return mix(low + _U(k * 0x632BE59BD9B4E019 % 2**64))


class Hashed:
    """Values by sorted hash: a row of ``values`` (n-grams x languages) per hash."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        order = np.argsort(hashes)
        bits = max(1, min(22, int(len(hashes)).bit_length()))
        self.shift = _U(64 - bits)
        self.hashes = np.append(hashes[order], _U(2**64 - 1))
        self.values = np.concatenate([values[order], np.zeros((1, values.shape[1]))]).astype(np.float32)
        self.first = np.searchsorted(self.hashes[:-1], np.arange(1 << bits, dtype=_U) << self.shift).astype(np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each hash."""
        at = self.first[(hashes >> self.shift).astype(np.int64)]
        behind = np.flatnonzero(self.hashes[at] < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[self.hashes[at[behind]] < hashes[behind]]
        return at, (self.hashes[at] == hashes) & (at < len(self.hashes) - 1)


class Model:
    """Models of all ``languages``; built order by order with :meth:`add`."""

    def __init__(self, languages: Sequence[str], alphabet: int):
        self.languages = list(languages)
        self.flat = -np.log2(alphabet + 1.0)
        self.orders: list[Hashed] = []
        self.backoff: list[Hashed] = []

    def add(self, codes: np.ndarray, counts: np.ndarray, discount: np.ndarray) -> None:
        """The next order: its n-grams (n x order), their counts (n x languages) and a discount per language."""
        columns = list(codes.T)
        context = np.broadcast_to(key(columns[:-1]), len(codes))
        hashes, at = np.unique(context, return_inverse=True)
        total, kinds = np.zeros((len(hashes), counts.shape[1])), np.zeros((len(hashes), counts.shape[1]))
        np.add.at(total, at, counts)
        np.add.at(kinds, at, counts > 0)
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        lower = 2.0 ** self.log2(columns[1:], len(codes))
        own = np.maximum(counts - discount, 0) / np.maximum(total[at], 1)
        self.orders.append(Hashed(key(columns), np.log2(own + weight[at] * lower)))
        self.backoff.append(Hashed(hashes, np.log2(weight)))

    def log2(self, columns: Sequence[np.ndarray], n: int) -> np.ndarray:
        """Log probability (n x languages) of each n-gram's last character after those before it."""
        k = len(columns)
        if k == 0:
            return np.full((n, len(self.languages)), self.flat, np.float32)
        at, there = self.orders[k - 1].find(key(columns))
        out = self.orders[k - 1].values[at]
        lost = np.flatnonzero(~there)
        if len(lost):
            few = [c[lost] for c in columns]
            context = np.broadcast_to(key(few[:-1]), len(lost))
            at, there = self.backoff[k - 1].find(context)
            out[lost] = np.where(there[:, None], self.backoff[k - 1].values[at], 0) + self.log2(few[1:], len(lost))
        return out

    def entropies(self, texts: Spelled) -> tuple[np.ndarray, np.ndarray]:
        """(bits per character in each language, number of characters) of each text; NaN without characters."""
        sums = np.zeros((len(texts.rows) - 1, len(self.languages)))
        size = np.maximum(np.diff(texts.rows) - (ORDER - 1), 0)
        some = np.flatnonzero(size)
        place = expand(texts.rows[:-1][some] + ORDER - 1, size[some])
        row = np.repeat(some, size[some])
        for a in range(0, len(place), SLICE):
            at = place[a : a + SLICE]
            values = self.log2([texts.codes[at - (ORDER - 1 - j)] for j in range(ORDER)], len(at))
            of = row[a : a + SLICE]
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            sums[of[first]] -= np.add.reduceat(values, first, axis=0, dtype=np.float64)
        return sums / np.where(size > 0, size, np.nan)[:, None], size


class Calibration(NamedTuple):
    """``limits``: cross-entropy accepted per language and length band; ``evidence``, ``share``: the score's curve."""

    limits: np.ndarray
    evidence: np.ndarray
    share: np.ndarray


BANDS = 32
OPEN = Calibration(np.full((0, BANDS), np.inf), np.zeros(0), np.zeros(0))


def remainder(doc_id: str) -> Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string"))


def held_out(doc_id: str) -> Column:
    return F.coalesce(remainder(doc_id) % 4 == 2, F.lit(False))


def _training(docs: DataFrame, text: str, lang: str, doc_id: str) -> DataFrame:
    """(lang, t, calibrates) of the documents that may be learned from."""
    may = docs.where(_may_teach(lang, text, doc_id))
    return may.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("t"), _calibrates(doc_id).alias("calibrates"))


def _may_teach(lang: str, text: str, doc_id: str) -> Column:
    return F.col(lang).isNotNull() & F.col(text).isNotNull() & (remainder(doc_id) % 4 != 2)


def _calibrates(doc_id: str) -> Column:
    return F.floor(remainder(doc_id) / 4) % CALIBRATION == 0


def _counts(piece: pa.RecordBatch) -> pa.RecordBatch | None:
    """(lang, gram, n) of one piece of texts."""
    texts = spelled(piece.column("t"))
    langs = piece.column("lang").dictionary_encode()
    of = np.asarray(langs.indices)
    size = np.maximum(np.diff(texts.rows) - (ORDER - 1), 0)
    out_lang, out_gram, out_n = [], [], []
    for i, name in enumerate(langs.dictionary.to_pylist()):
        mine = np.flatnonzero((of == i) & (size > 0))
        at = expand(texts.rows[:-1][mine] + ORDER - 1, size[mine])
        if not len(at):
            continue
        hashes = key([texts.codes[at - (ORDER - 1 - j)] for j in range(ORDER)])
        _, first, n = np.unique(hashes, return_index=True, return_counts=True)
        grams = texts.codes[at[first][:, None] + np.arange(1 - ORDER, 1)].astype("<u4").tobytes().decode("utf-32-le")
        out_gram += [grams[j : j + ORDER] for j in range(0, len(grams), ORDER)]
        out_lang += [name] * len(n)
        out_n.append(n)
    if not out_n:
        return None
    return pa.RecordBatch.from_pydict({"lang": pa.array(out_lang, pa.string()), "gram": pa.array(out_gram, pa.string()), "n": pa.array(np.concatenate(out_n), pa.int64())})


def count_grams(training: DataFrame) -> DataFrame:
    """(lang, gram, n) of the highest order."""
    each = training.select("lang", "t").mapInArrow(by_piece("t", _counts, COUNT_BYTES), "lang string, gram string, n long")
    return each.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def all_orders(level: DataFrame) -> DataFrame:
    """(lang, k, gram, n) of every order: counts of the highest, numbers of different predecessors of the lower ones."""
    out = level.select("lang", F.lit(ORDER).alias("k"), "gram", "n")
    for k in range(ORDER - 1, 0, -1):
        level = level.groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n"))
        out = out.unionByName(level.select("lang", F.lit(k).alias("k"), "gram", "n"))
    return out


def least_count(grams: DataFrame, most: int) -> int:
    """The smallest count from which at most ``most`` n-grams are left, by a histogram of counts (doubling steps above 64)."""
    step = F.when(F.col("n") <= 64, F.col("n")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2(F.col("n").cast("double")))))
    bins = {int(r["b"]): r["c"] for r in grams.groupBy(step.cast("long").alias("b")).agg(F.count("*").alias("c")).collect()}
    least, kept = max(bins, default=1) * 2, 0
    for b in sorted(bins, reverse=True):
        kept += bins[b]
        if kept > most:
            break
        least = b
    return least


class Counts(NamedTuple):
    """Counts of all orders: ``grams`` (lang, k, gram, n), ``entries``: those of two characters and more; a discount per order and language."""

    grams: DataFrame
    languages: list[str]
    discount: np.ndarray
    entries: int


def count_all(training: DataFrame) -> Counts | None:
    """All n-grams of ``training`` (lang, t), written out; None if it has no letters."""
    highest = materialise(count_grams(training), "grams")
    grams = materialise(all_orders(highest), "orders")
    discard(highest)
    few = [F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in (1, 2)]
    stats = grams.groupBy("lang", "k").agg(*few, F.count("*").alias("n")).collect()  # a row per language and order
    languages = sorted({r["lang"] for r in stats})
    if not languages:
        discard(grams)
        return None
    discount = np.full((ORDER + 1, len(languages)), 0.5)
    for r in stats:
        if r["n1"]:
            discount[r["k"], languages.index(r["lang"])] = max(0.1, r["n1"] / (r["n1"] + 2 * r["n2"]))
    return Counts(grams, languages, discount, sum(r["n"] for r in stats if r["k"] > 1))


def fit(training: DataFrame, most: int = MOST_ENTRIES, cells: int = MOST_CELLS) -> Model | None:
    """Models of all languages in ``training`` (lang, t) for use on their own, within the bound; None if it has no letters.

    Beyond the bound rarer n-grams are left to the lower orders. ``identify``
    takes such models only if nothing is left out, and ``score_grams`` otherwise.
    """
    counts = count_all(training)
    if counts is None:
        return None
    model = build(counts, min(most, cells // len(counts.languages)))
    discard(counts.grams)
    return model


def build(counts: Counts, most: int) -> Model:
    """The models of at most ``most`` n-grams, the most frequent, and all single characters."""
    grams, languages, discount = counts.grams, counts.languages, counts.discount
    least = least_count(grams.where("k > 1"), most) if counts.entries > most else 1
    stored = grams.where((F.col("k") == 1) | (F.col("n") >= least)).toArrow().combine_chunks()
    of = np.searchsorted(np.array(languages, object), stored.column("lang").to_numpy())
    order, n = stored.column("k").to_numpy(), stored.column("n").to_numpy()
    model = None
    for k in range(1, ORDER + 1):
        at = np.flatnonzero(order == k)
        codes = code_points(stored.column("gram").take(pa.array(at)))[0].astype(_U).reshape(-1, k)
        hashes, first, where = np.unique(key(list(codes.T)), return_index=True, return_inverse=True)
        counts_k = np.zeros((len(hashes), len(languages)))
        np.add.at(counts_k, (where, of[at]), n[at])
        if model is None:
            model = Model(languages, len(hashes))
        model.add(codes[first], counts_k, discount[k])
    return model


class Tables(NamedTuple):
    """The whole models: ``own`` (k, gram, own) and ``weights`` (k, ctx, weight), an array over the languages each; ``flat`` log probability."""

    own: DataFrame
    weights: DataFrame
    flat: float


def _dense(place: Column, value: Column, n: int, missing: float) -> Column:
    """An aggregate: the values as an array over all ``n`` places."""
    found = F.map_from_entries(F.collect_list(F.struct(place, value)))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(found[i], F.lit(missing)))


def tables(counts: Counts) -> Tables:
    """Each n-gram's own share of its context and each context's weight for the lower order, per language."""
    n = len(counts.languages)
    place = F.create_map(*[F.lit(x) for i, name in enumerate(counts.languages) for x in (name, i)])[F.col("lang")]
    discounts = F.array(*[F.array(*[F.lit(float(d)) for d in row]) for row in counts.discount])
    discount = F.element_at(F.element_at(discounts, F.col("k") + 1), F.col("l") + 1)
    grams = counts.grams.select(place.alias("l"), "k", "gram", "n", F.expr("left(gram, k - 1)").alias("ctx"))
    contexts = grams.groupBy("l", "k", "ctx").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    share = (F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")).alias("v")
    own = grams.join(contexts, ["l", "k", "ctx"]).select("k", "gram", "l", share).groupBy("k", "gram").agg(_dense(F.col("l"), F.col("v"), n, 0.0).alias("own"))
    weight = contexts.select("k", "ctx", "l", (discount * F.col("kinds") / F.col("total")).alias("v"))
    weights = weight.groupBy("k", "ctx").agg(_dense(F.col("l"), F.col("v"), n, 1.0).alias("weight"))
    alphabet = counts.grams.where("k = 1").select("gram").distinct().count()
    return Tables(materialise(own, "own"), materialise(weights, "weights"), -np.log2(alphabet + 1.0))


def score_grams(wanted: DataFrame, whole: Tables, languages: int) -> DataFrame:
    """(gram, bits: an array over the languages) of different n-grams of the highest order.

    Order by order, each different ending of the n-grams meets its own share,
    its context's weight and the next lower order. No key has more rows than
    there are characters.
    """
    lower = None
    for k in range(1, ORDER + 1):
        ends = wanted.select(F.expr(f"right(gram, {k})").alias("gram")).distinct()
        rows = ends.select("gram", F.expr(f"left(gram, {k - 1})").alias("ctx"), F.expr(f"right(gram, {k - 1})").alias("low"))
        rows = rows.join(whole.own.where(F.col("k") == k).drop("k"), "gram", "left")
        rows = rows.join(whole.weights.where(F.col("k") == k).drop("k"), "ctx", "left")
        if lower is None:
            rows = rows.withColumn("q", F.array_repeat(F.lit(float(2.0**whole.flat)), languages))
        else:
            rows = rows.join(lower, "low")
        at = F.sequence(F.lit(0), F.lit(languages - 1))
        p = F.transform(at, lambda i: F.coalesce(F.col("own")[i], F.lit(0.0)) + F.coalesce(F.col("weight")[i], F.lit(1.0)) * F.col("q")[i])
        lower = rows.select(F.col("gram").alias("low"), p.alias("q"))
    return lower.select(F.col("low").alias("gram"), F.transform("q", lambda p: -F.log2(p)).alias("bits"))


class Frequent(NamedTuple):
    """Log probabilities of the most frequent n-grams of the highest order."""

    found: Hashed
    languages: int


def frequent(counts: Counts, whole: Tables, most: int) -> Frequent:
    """At most ``most`` of them, by their counts over all languages."""
    n = len(counts.languages)
    sums = counts.grams.where(F.col("k") == ORDER).groupBy("gram").agg(F.sum("n").alias("n"))
    wanted = materialise(sums.where(F.col("n") >= least_count(sums, most)).select("gram"), "frequent")
    rows = score_grams(wanted, whole, n).toArrow().combine_chunks()
    discard(wanted)
    codes = code_points(rows.column("gram").combine_chunks() if rows.num_rows else pa.array([], pa.string()))[0].astype(_U).reshape(-1, ORDER)
    bits = rows.column("bits").combine_chunks().flatten().to_numpy() if rows.num_rows else np.zeros(0)
    return Frequent(Hashed(key(list(codes.T)), -bits.reshape(-1, n)), n)


def _first_scores(sent, carried: list[str], kind: pa.Schema) -> Callable:
    """A row per text with the bits of its frequent n-grams, and rows (id, gram, n) of the others, the carried columns null."""

    def others(ids: pa.Array, of: np.ndarray, codes: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((hashes, of))
        new = np.flatnonzero(np.concatenate([[True], (np.diff(of[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])]))
        n = np.diff(np.append(new, len(order)))
        first = order[new]
        spelt = codes[at[first][:, None] + np.arange(1 - ORDER, 1)].astype("<u4").tobytes().decode("utf-32-le")
        grams = pa.array([spelt[j : j + ORDER] for j in range(0, len(spelt), ORDER)], pa.string())
        own = {"id": ids.take(pa.array(of[first])), "gram": grams, "n": pa.array(n, pa.int64())}
        return pa.RecordBatch.from_arrays([own[f.name] if f.name in own else pa.nulls(len(n), f.type) for f in kind], schema=kind)

    def run(batches):
        hot = sent.value
        for piece in pieces(batches, "t"):
            texts = spelled(piece.column("t"))
            ids = piece.column("id")
            sums = np.zeros((piece.num_rows, hot.languages))
            size = np.maximum(np.diff(texts.rows) - (ORDER - 1), 0)
            some = np.flatnonzero(size)
            place = expand(texts.rows[:-1][some] + ORDER - 1, size[some])
            row = np.repeat(some, size[some])
            for a in range(0, len(place), SLICE):
                at, of = place[a : a + SLICE], row[a : a + SLICE]
                hashes = key([texts.codes[at - (ORDER - 1 - j)] for j in range(ORDER)])
                where, there = hot.found.find(hashes)
                values = np.where(there[:, None], hot.found.values[where], 0)
                first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                sums[of[first]] -= np.add.reduceat(values, first, axis=0, dtype=np.float64)
                lost = np.flatnonzero(~there)
                if len(lost):
                    yield others(ids, of[lost], texts.codes, at[lost], hashes[lost])
            ends = pa.array(np.arange(piece.num_rows + 1) * hot.languages, pa.int32())
            own = {c: piece.column(c) for c in ["id", *carried]}
            own |= {"sums": pa.ListArray.from_arrays(ends, pa.array(sums.ravel())), "size": pa.array(size), "gram": pa.nulls(piece.num_rows, pa.string()), "n": pa.nulls(piece.num_rows, pa.int64())}
            yield pa.RecordBatch.from_arrays([own[f.name].cast(f.type) for f in kind], schema=kind)

    return run


def entropies(rows: DataFrame, carried: list[str], counts: Counts, most: int) -> tuple[DataFrame, float]:
    """The carried columns of ``rows`` (with a text ``t``), cross-entropies in the whole models (``bits``), numbers of characters (``size``), written out; ``flat``."""
    n = len(counts.languages)
    whole = tables(counts)
    sent = rows.sparkSession.sparkContext.broadcast(frequent(counts, whole, most))  # of bounded size: ``most``
    numbered = rows.withColumn("id", F.monotonically_increasing_id())  # fixed once written
    schema = T.StructType([T.StructField(c, numbered.schema[c].dataType) for c in ["id", *carried]])
    for name, kind in (("sums", T.ArrayType(T.DoubleType())), ("size", T.LongType()), ("gram", T.StringType()), ("n", T.LongType())):
        schema = schema.add(name, kind)
    found = materialise(numbered.mapInArrow(_first_scores(sent, carried, to_arrow_schema(schema)), schema), "first-scores")
    rare = found.where("gram IS NOT NULL").select("id", "gram", "n")
    wanted = materialise(rare.select("gram").distinct(), "wanted")
    each = [F.sum(F.col("n") * F.col("bits")[i]) for i in range(n)]
    rest = rare.join(score_grams(wanted, whole, n), "gram").groupBy("id").agg(F.array(*each).alias("rest"))
    sums = F.transform("sums", lambda x, i: (x + F.coalesce(F.col("rest")[i], F.lit(0.0))) / F.nullif(F.col("size"), F.lit(0)))
    out = found.where("gram IS NULL").join(rest, "id", "left").select(*carried, sums.alias("bits"), "size")
    out = materialise(out, "entropies")
    discard(found, wanted, whole.own, whole.weights)
    return out, whole.flat


def _judge(languages: Sequence[str], flat: float, calibration: Calibration, bits: np.ndarray, size: np.ndarray) -> dict[str, pa.Array]:
    """Prediction of each text: best language, its cross-entropy, evidence, length band, score and rejection."""
    n = len(size)
    letter = size > 0
    best = np.where(letter, np.nan_to_num(bits, nan=np.inf).argmin(1), 0)
    first = bits[np.arange(n), best]
    other = bits.copy()
    other[np.arange(n), best] = np.inf
    second = np.minimum(other.min(1, initial=np.inf), -flat)  # at the latest, all characters alike
    with np.errstate(invalid="ignore"):
        evidence = np.where(letter, np.maximum(second - first, 0) * np.sqrt(size), 0)
    band = np.log2(np.maximum(size, 1)).astype(np.int64)
    limit = calibration.limits[best, band] if len(calibration.limits) else np.full(n, np.inf)
    share = np.interp(evidence, calibration.evidence, calibration.share) if len(calibration.share) else 1 - 2.0**-evidence
    score = np.where(letter, np.clip(np.round(share, 6), 0, 1), 0.0)
    names = np.array([*languages, UNKNOWN], object)[np.where(letter, best, len(languages))]
    return {
        "lang_pred": pa.array(names, pa.string()), "score": pa.array(score),
        "cross_entropy": pa.array(np.round(first, 6), mask=~letter), "rejected": pa.array(~letter | (first > limit) | (score < 0.5)),
        "evidence": pa.array(evidence), "band": pa.array(band.astype(np.int32)),
    }


JUDGED = "lang_pred string, score double, cross_entropy double, rejected boolean, evidence double, band int"


def _judging(model, calibration: Calibration, carried: list[str]) -> Callable:
    def one(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = _judge(model.value.languages, model.value.flat, calibration, *model.value.entropies(spelled(piece.column("t"))))
        return pa.RecordBatch.from_pydict({**{c: piece.column(c) for c in carried}, **found})

    return by_piece("t", one)


def _judging_bits(languages: Sequence[str], flat: float, calibration: Calibration, carried: list[str]) -> Callable:
    """The same by cross-entropies that the rows hold."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                size = batch.column("size").to_numpy(zero_copy_only=False)
                bits = batch.column("bits").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(languages)).astype(np.float64)
                found = _judge(languages, flat, calibration, bits, size)
                yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in carried}, **found})

    return run


def monotone(right: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Shares made non-decreasing: neighbours that fall are pooled."""
    pools: list[list[float]] = []
    for r, t in zip(right, total, strict=True):
        pools.append([r, t, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.concatenate([np.zeros(0), *[np.full(int(c), r / t) for r, t, c in pools]])


def _limits(right: DataFrame, languages: Sequence[str]) -> np.ndarray:
    """Cross-entropy accepted per language and length band: the language's mean plus what texts of that length lie above theirs.

    A band's limit is its ACCEPTED quantile, or the one that an exponential
    tail through its median and 95 % quantile has, if that is higher (few
    texts show no far tail). Bands of under 20 texts take the nearest band's,
    widened for shorter texts by the root of the ratio of lengths.
    """
    means = {r["lang_pred"]: r["m"] for r in right.groupBy("lang_pred").agg(F.avg("cross_entropy").alias("m")).collect()}
    limits = np.full((len(languages), BANDS), np.inf)
    if not means:
        return limits
    mean = F.create_map(*[F.lit(x) for pair in means.items() for x in pair])
    above = right.select(F.least("band", F.lit(BANDS - 1)).alias("band"), (F.col("cross_entropy") - mean[F.col("lang_pred")]).alias("above"))
    quantiles = F.percentile_approx("above", [0.5, 0.95, ACCEPTED], 10_000).alias("q")
    over = np.full(BANDS, np.nan)
    for r in above.groupBy("band").agg(quantiles, F.count("*").alias("n")).collect():
        if r["n"] >= 20:
            tail = np.log(0.5 / (1 - ACCEPTED)) / np.log(0.5 / 0.05)
            over[r["band"]] = max(r["q"][2], r["q"][0] + tail * (r["q"][1] - r["q"][0]))
    known = np.flatnonzero(~np.isnan(over))
    if len(known):
        near = known[np.abs(known - np.arange(BANDS)[:, None]).argmin(1)]
        over = over[near] * 2.0 ** (np.maximum(near - np.arange(BANDS), 0) / 2)
        for i, name in enumerate(languages):
            limits[i] = means.get(name, np.inf) + over
    return limits


def calibrate(judged: DataFrame, languages: Sequence[str], bins: int = 32) -> Calibration:
    """Limits and score curve from texts that the model hasn't seen: their ``lang`` and how they were judged."""
    found = materialise(judged.where(F.col("lang_pred") != UNKNOWN), "calibration")
    right = F.col("lang") == F.col("lang_pred")
    limits = _limits(found.where(right), languages)
    steps = [i / bins for i in range(1, bins)]
    edges = found.agg(F.percentile_approx("evidence", steps, 10_000)).first()[0] or []
    edges = sorted(set(edges))
    bin_of = F.lit(0)
    for e in edges:
        bin_of = bin_of + (F.col("evidence") > e).cast("int")
    share = found.groupBy(bin_of.alias("b")).agg(F.avg("evidence").alias("e"), F.count("*").alias("n"), F.sum(right.cast("long")).alias("r"))
    rows = share.orderBy("b").collect()  # at most ``bins`` rows
    discard(found)
    if not rows:
        return OPEN._replace(limits=limits)
    total = np.array([r["n"] for r in rows], float)
    return Calibration(limits, np.array([r["e"] for r in rows]), monotone(np.array([r["r"] for r in rows]) + 0.5, total + 1))


def identify(
    docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", keep: Sequence[str] | None = None,
    most: int = MOST_ENTRIES, cells: int = MOST_CELLS,
) -> DataFrame:
    """row (the kept columns), held_out, lang_pred, score, cross_entropy, rejected of every document; t if the text is kept.

    ``lang`` is read of training documents alone: those whose id's crc32
    doesn't leave 2 when divided by 4.
    """
    spark = docs.sparkSession
    carried = ["row", "held_out", *(["t"] if with_text(keep, text) else [])]
    rows = docs.select(*packed(docs, text, keep), held_out(doc_id).alias("held_out"))
    training = _training(docs, text, lang, doc_id)
    counts = count_all(training.where("NOT calibrates"))
    if counts is None:
        nothing = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy")]
        return rows.select(*carried, *nothing, F.lit(True).alias("rejected"))
    most = min(most, cells // len(counts.languages))
    learned = "lang string, " + JUDGED
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carried) + ", " + JUDGED
    if counts.entries <= most:
        model = build(counts, most)
        discard(counts.grams)
        sent = spark.sparkContext.broadcast(model)  # of bounded size: MOST_ENTRIES, MOST_CELLS
        unseen = training.where("calibrates").select("lang", "t").mapInArrow(_judging(sent, OPEN, ["lang"]), learned)
        judging = _judging(sent, calibrate(unseen, model.languages), carried)
    else:
        lang_of = F.when(_may_teach(lang, text, doc_id) & _calibrates(doc_id), F.col(lang).cast("string"))
        named = docs.select(*packed(docs, text, keep), held_out(doc_id).alias("held_out"), lang_of.alias("lang"))
        rows, flat = entropies(named, [*carried, "lang"], counts, most)
        discard(counts.grams)
        unseen = rows.where("lang IS NOT NULL").select("lang", "bits", "size").mapInArrow(_judging_bits(counts.languages, flat, OPEN, ["lang"]), learned)
        judging = _judging_bits(counts.languages, flat, calibrate(unseen, counts.languages), carried)
    return rows.mapInArrow(judging, schema).drop("evidence", "band")
