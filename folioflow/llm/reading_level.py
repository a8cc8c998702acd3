"""Problem 10: reading level, by the surprisal of interpolated n-gram models.

A character model of orders 1 to 4 (Witten-Bell interpolation) is trained on the
labelled texts of the two plain bands.  Every sentence of a document's running
text gets its surprisal in bits a word under that model, times the logarithm of
its length in words, as rare words weigh more in long nested sentences; a
document's score is the QUANTILE of that distribution over its words, near the
median, so it tells how the text reads for most of it.  Isotonic regression, fitted to the raters' bands, maps the
score to a level from 1 to 4 that never falls as surprisal grows; plain texts are
scored for that by models that left their fold out.

The models and the map are fitted on all labelled documents, where these lie:
counts of contexts are added up, a sorted table of scores gives the bins that the
isotonic regression is fitted to.  All documents are scored, whole.

Defined cases: null and empty texts, and texts without English running text, have
a null level; raters' bands of one document are averaged, null bands left out;
without any label, every level is null.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frame, read, strings, written

#: labelled documents that are looked for in one pass over the documents; more are more passes
LABELS_A_PASS = 1_000_000
FOLDS = 5
MIN_WORDS = 50
EXPERT = 3.5
QUANTILE = 0.58
BIN = 5
SYMBOLS, ORDER = 28, 4
CONTEXTS = SYMBOLS**ORDER

#: Common function words of English that are no common words of other European languages.
FUNCTION_WORDS = frozenset("and any are been but by for from had has have his if is it its my nor not of or our she such than that the their them then there these they this those to under upon was we were what when whether which while who whose will with within would you your".split())

_ITEM = re.compile(r"^[ \t]*(?:[-*•·‣]|\d{1,3}[.)]|[a-z]\))[ \t]+(?![^\n]*\w[.!?]\s)[^\n]*$|^[^\n]*(?:\.{4,}|\t|[|;][^|;\n]*[|;]|(?:,[^,\s][^,\n]*){4,})[^\n]*$|^[ \t]{4,}[^\n]*[;{}=()\\][^\n]*$", re.M)
_SENTENCE = re.compile(r"(?<=[.!?])[\"'”’)\]]*\s+|\n\s*\n")
_WORD = re.compile(r"[A-Za-z]+(?:['’][a-z]+)?")
_ANY_WORD = re.compile(r"\w+")
_FOREIGN = re.compile(r"\w*[^\W\d_a-zA-Z]\w*")


def sentences(text: str) -> tuple[list[list[str]], int, int]:
    """English sentences of the running text as lower-case words; their number of words; that of all running text."""
    out, english, running = [], 0, 0
    if not text.isascii() and len(text.encode("ascii", "ignore")) < 0.3 * len(text):
        return out, english, len(text)  # hardly any letter or space of English
    for sentence in _SENTENCE.split(_ITEM.sub("", text)):
        every = len(_ANY_WORD.findall(sentence))
        if every < 3:
            continue
        running += every
        words = [w.lower() for w in _WORD.findall(sentence)]
        if len(words) < 0.7 * every or sum(map(len, words)) < 2.2 * len(words) or (not sentence.isascii() and len(_FOREIGN.findall(sentence)) > 0.2 * every):
            continue  # no words, single letters, or another language
        if len(words) < 8 or sum(map(FUNCTION_WORDS.__contains__, words)) >= 0.06 * len(words):
            out.append(words)
            english += len(words)
    return out, english, running


_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(1, 27)
_SYMBOL[ord("'")] = 27


def symbols(text: str) -> np.ndarray:
    """1 to 26 for letters, 27 for an apostrophe, 0 for what parts words."""
    return _SYMBOL[np.frombuffer(text.replace("’", "'").encode("ascii", "replace"), np.uint8)]


def context(codes: np.ndarray) -> np.ndarray:
    """The index of each symbol with the three before it (parting symbols before the start)."""
    padded = np.concatenate([np.zeros(ORDER - 1, np.int64), codes])
    n, index = len(codes), np.zeros(len(codes), np.int64)
    for k in range(ORDER):
        index = index * SYMBOLS + padded[k : k + n]
    return index


def train(texts: list[str]) -> np.ndarray:
    """Bits of each symbol after each context of three, interpolated over all shorter contexts."""
    counts = np.zeros(CONTEXTS, np.int64)
    for t in texts:
        if t:
            np.add.at(counts, context(symbols(t)), 1)
    return interpolated(counts)


def interpolated(counts: np.ndarray) -> np.ndarray:
    """The bits by the counts of each context of three with the symbol after it."""
    counts = counts.astype(float).reshape([SYMBOLS] * ORDER)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        of_order = counts.sum(axis=tuple(range(ORDER - order))) if order < ORDER else counts
        total = of_order.sum(axis=-1, keepdims=True)
        kinds = (of_order > 0).sum(axis=-1, keepdims=True)
        p = np.where(total > 0, (of_order + kinds * p) / np.maximum(total + kinds, 1), np.broadcast_to(p, of_order.shape))
    return -np.log2(p).reshape(-1).astype(np.float32)


def score(text: str | None, bits: np.ndarray) -> tuple[float | None, int, float | None]:
    """(QUANTILE of the sentences' surprisal over the words, or None where the running text isn't English; number of words; the same distribution's 90 % point)."""
    if not text or not text.strip():
        return None, 0, None
    found, english, running = sentences(text)
    total = len(_ANY_WORD.findall(text))
    if not english or english < 0.5 * running:
        return None, total, None
    flat = [w for s in found for w in s]
    if sum(map(FUNCTION_WORDS.__contains__, flat)) < 0.12 * english:
        return None, total, None
    joined = " ".join(flat) + " "
    values = bits[context(symbols(joined))]
    letters = np.fromiter(map(len, flat), np.int64, len(flat)) + 1
    per_word = np.add.reduceat(values, np.concatenate([[0], np.cumsum(letters)[:-1]]))
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    per_sentence = np.add.reduceat(per_word, np.concatenate([[0], np.cumsum(lengths)[:-1]])) / lengths * np.log2(1 + lengths)
    order = np.argsort(per_sentence, kind="stable")
    cumulative = np.cumsum(lengths[order])
    middle = per_sentence[order[np.searchsorted(cumulative, cumulative[-1] * QUANTILE)]]
    high = per_sentence[order[np.searchsorted(cumulative, cumulative[-1] * 0.9)]]
    return float(middle), total, float(high)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-decreasing step values nearest to y, as knots to interpolate between."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum, weight, first x, last x
    for a, b in zip(x[order].tolist(), y[order].tolist()):
        blocks.append([b, 1, a, a])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, w, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w
            blocks[-1][3] = last
    knots = [(p, s / w) for s, w, first, last in blocks for p in ((first, last) if last > first else (first,))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, band, fold) of every document with a band and a text, as a table."""
    bands = labels.where("band IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("band").alias("band"))
    texts = documents.where("text IS NOT NULL AND text <> ''").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"))
    passes = max(1, -(-bands.count() // LABELS_A_PASS))
    of_pass = F.pmod(F.xxhash64(F.lit("pass"), "doc_id"), F.lit(passes))
    tables = [written(texts.join(F.broadcast(bands.where(of_pass == k)), "doc_id").select("doc_id", "text", "band", "fold")) for k in range(passes)]
    return reduce(DataFrame.unionAll, tables)


def counted(rows: DataFrame) -> np.ndarray:
    """Counts of each context with its symbol in the plain labelled texts, by fold."""

    def run(it):
        counts = np.zeros((FOLDS, CONTEXTS), np.int64)
        for batch in it:
            for text, fold in zip(strings(batch, "text"), strings(batch, "fold")):
                found, english, running = sentences(text)
                if found and english >= 0.5 * running:
                    np.add.at(counts[fold], context(symbols(" ".join(w for s in found for w in s) + " ")), 1)
        at = np.flatnonzero(counts)
        yield frame(["place", "n"], [at, counts.ravel()[at]], [pa.int32(), pa.int64()])

    found = rows.where("band <= 2").select("text", "fold").mapInArrow(run, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # at most FOLDS * CONTEXTS rows
    counts = np.zeros(FOLDS * CONTEXTS, np.int64)
    counts[found["place"].to_numpy()] = found["n"].to_numpy()
    return counts.reshape(FOLDS, CONTEXTS)


def binned(scored: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Means of x and y over neighbours by x, so that one rater's slip moves no knot: about a hundred bins, or bins of BIN."""
    scored = written(scored)  # the ranges are sampled from it before it is sorted
    placed = written(scored.repartitionByRange("x", "doc_id").sortWithinPartitions("x", "doc_id").select("x", "y", F.monotonically_increasing_id().alias("place")))
    part = F.shiftright("place", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    n = sum(s["count"] for s in sizes)
    if not n:
        return np.zeros(0), np.zeros(0)
    before = np.concatenate([[0], np.cumsum([s["count"] for s in sizes])]).tolist()
    starts = placed.sparkSession.createDataFrame([(s["part"], b) for s, b in zip(sizes, before)], "part bigint, before bigint")
    bins = max(1, n // max(BIN, n // 100))
    least, larger = divmod(n, bins)  # so many bins hold one more
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    bin_of = F.when(rank < larger * (least + 1), F.floor(rank / (least + 1))).otherwise(larger + F.floor((rank - larger * (least + 1)) / least))
    # sums of decimals don't depend on the order
    total = lambda c: F.sum(F.col(c).cast("decimal(28,15)")).alias(c)
    means = placed.withColumn("part", part).join(F.broadcast(starts), "part").groupBy(bin_of.alias("bin")).agg(total("x"), total("y"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    return np.array([float(m.x) / m.n for m in means]), np.array([float(m.y) / m.n for m in means])


def fit(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(bits, knots) from all labelled documents, or None without plain ones."""
    rows = labelled(documents, labels)
    counts = counted(rows)
    every = counts.sum(axis=0)
    if not every.any():
        return None
    bits = interpolated(every)
    # a text the model was trained on would surprise it less than others of its kind: it is scored by one that left its fold out
    left_out = [interpolated(every - of_fold) if of_fold.any() and (every > of_fold).any() else bits for of_fold in counts]
    sent = rows.sparkSession.sparkContext.broadcast((bits, left_out))

    def run(it):
        for batch in it:
            bits, left_out = sent.value
            out = []
            for doc, text, band, fold in zip(*(strings(batch, c) for c in ("doc_id", "text", "band", "fold"))):
                middle = score(text, left_out[fold] if band <= 2 else bits)[0]
                if middle is not None:
                    out.append((doc, middle, band))
            yield frame(["doc_id", "x", "y"], list(zip(*out)) or [[], [], []], [pa.int64(), pa.float64(), pa.float64()])

    x, y = binned(rows.mapInArrow(run, "doc_id bigint, x double, y double"))
    return (bits, *isotonic(x, y)) if len(x) else None


def levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, surprisal, surprisal_p90, level) of every document."""
    model = fit(documents, labels)
    sent = documents.sparkSession.sparkContext.broadcast(model)  # 28**4 floats and at most two knots a bin
    names = ["doc_id", "n_words", "surprisal", "surprisal_p90", "level"]
    types = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]

    def run(it):
        for batch in it:
            out = []
            for doc, text in zip(strings(batch, "doc_id"), strings(batch, "text")):
                if sent.value is None:
                    out.append((doc, len(_ANY_WORD.findall(text or "")), None, None, None))
                    continue
                bits, x, y = sent.value
                middle, words, high = score(text, bits)
                out.append((doc, words, middle, high, None if middle is None else float(np.interp(middle, x, y))))
            yield frame(names, list(zip(*out)) or [[] for _ in names], types)

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_words int, surprisal double, surprisal_p90 double, level double")


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels(read(spark, sf_dir, "documents"), read(spark, sf_dir, "level_labels"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents of at least 50 words that only experts can read."""
    return _levels(spark, sf_dir).where((F.col("level") >= EXPERT) & (F.col("n_words") >= MIN_WORDS)).select("doc_id").distinct()


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source and level band."""
    sources = read(spark, sf_dir, "documents").select("doc_id", "source")
    band = F.greatest(F.lit(1), F.least(F.lit(4), F.round("level").cast("int")))
    return _levels(spark, sf_dir).join(sources, "doc_id").groupBy("source", F.when(F.col("level").isNotNull(), band).alias("band")).agg(F.count(F.lit(1)).alias("documents"), F.sum("n_words").alias("words"))
