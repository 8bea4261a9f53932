"""Toxicity: boosted trees over dense features, calibrated by isotonic regression.

The lexicon holds word stems (four to six letters, or a whole word, folded to
lower case) with the log-odds that labelled texts give them. Training texts
are split in two folds by a hash of the text. A fold's features come from the
lexicon that the other one teaches; a quarter of both calibrates what the rest
teaches the trees. So nothing is judged on what it has taught. The lexicon for
scoring is taught by both. Per text there are
densities of lexicon words (also with digits and signs read as the letters they
stand for), second-person words near them, and rates of capitals, punctuation
and obfuscation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import U, arrow_map, blocks, id_filter, owners, per_text, prefixes, record, runs, signed, spans_hash, split_by_filter
from stationflow.llm.labels import bounded, remainder, training
from stationflow.session import stored

LABEL, MODULUS, HELD = "toxic", 4, 2
CUT = 0.3
# Labelled rows for the lexicon, the trees and their calibration.
SAMPLE = 20_000
FIT_PARTITIONS = 4
LEXICON_SIZE = 2000
LEAST_TEXTS = 2
LEAST_ODDS = 2.3
# Texts of label 0 that a stem counts as seen in besides those it is in.
DOUBT = 2.0
STEMS = (4, 5, 6)
NEAR = 3

# Forms of address in the four languages of the tables.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre usted eres ti tus vosotros"
# A start for the lexicon, with the odds it has until labels say more.
SEEDS = (
    "idiot moron stupid loser trash scum clown pathetic worthless disgusting dumb fool imbecile jerk bastard bitch crap creep "
    "freak garbage vermin filth hate idiota estúpido imbécil asqueroso basura connard salaud débile ordure abruti arschloch "
    "dummkopf trottel abschaum widerlich"
)
SEED_ODDS = 4.0
# Signs and digits that stand for letters.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
PLAIN = FOLD.copy()
for sign, letter in STANDS_FOR.items():
    PLAIN[ord(sign)] = ord(letter)
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
SIGN = np.zeros(256, bool)
SIGN[[ord(c) for c in STANDS_FOR]] = True


def folded(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the two-byte Latin letters."""
    out = table[data]
    upper = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.zeros(0, np.int64)
    upper = upper[(data[upper] >= 0x80) & (data[upper] <= 0x9E) & (data[upper] != 0x97)]
    out[upper] += 32
    return out


def tokens(data: np.ndarray, offsets: np.ndarray, signs: bool):
    """(start, end, text) of runs of letters, or of letters and signs."""
    start, end = runs((LETTER | SIGN)[data] if signs else LETTER[data], offsets)
    return start, end, owners(offsets, start)


def forms(sums: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Hashes of each word's stems and of the whole, one row per form; 0 where it is too short."""
    out = np.zeros((len(STEMS) + 1, len(start)), U)
    for k, length in enumerate(STEMS):
        long = end - start > length
        out[k, long] = spans_hash(sums, start[long], start[long] + length)
    out[-1] = spans_hash(sums, start, end) ^ U(1)
    return out


def hashed(words: str) -> np.ndarray:
    raw = words.encode()
    data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    start, end, _ = tokens(data, offsets, False)
    return np.sort(spans_hash(prefixes(folded(data, FOLD)), start, end))


ADDRESS = hashed(SECOND_PERSON)


def among(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place in ``sorted_keys``, -1 where it is not there."""
    if not len(sorted_keys):
        return np.full(x.shape, -1)
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == x, at, -1)


def weights(lexicon: tuple[np.ndarray, np.ndarray], found: np.ndarray) -> np.ndarray:
    """The largest lexicon weight of a word's forms, 0 for none."""
    keys, values = lexicon
    at = among(keys, found)
    return np.where(at >= 0, values[np.maximum(at, 0)] if len(values) else 0.0, 0.0).max(axis=0, initial=0.0)


NAMES = (
    "words", "lexicon_sum", "lexicon_rate", "lexicon_max", "lexicon_count", "signs_sum", "signs_max", "address_rate", "address_near",
    "capital_rate", "capital_words", "bang_rate", "question_rate", "mark_rate", "digit_rate", "obfuscated_rate", "repeat_rate",
)


def features(data: np.ndarray, offsets: np.ndarray, lexicon) -> np.ndarray:
    """The columns of ``NAMES`` for a block of texts; empty texts have zeros."""
    n = len(offsets) - 1
    length = np.maximum(np.diff(offsets), 1)
    sums = prefixes(folded(data, FOLD))
    start, end, text = tokens(data, offsets, False)
    some = np.maximum(per_text(n, text), 1)
    weight = weights(lexicon, forms(sums, start, end))
    top = np.zeros(n)
    np.maximum.at(top, text, weight)
    hit = weight > 0
    # With signs read as letters: only words that hold some.
    wide, wide_end, wide_text = tokens(data, offsets, True)
    signs = np.concatenate([[0], np.cumsum(SIGN[data])])
    letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    mixed = (signs[wide_end] > signs[wide]) & (letters[wide_end] > letters[wide])
    wide, wide_end, wide_text = wide[mixed], wide_end[mixed], wide_text[mixed]
    read = weights(lexicon, forms(prefixes(folded(data, PLAIN)), wide, wide_end))
    read_top = np.zeros(n)
    np.maximum.at(read_top, wide_text, read)
    address = among(ADDRESS, spans_hash(sums, start, end)) >= 0
    close = np.zeros(len(start), bool)
    for k in range(1, NEAR + 1):
        same = text[k:] == text[:-k]
        close[k:] |= hit[k:] & address[:-k] & same
        close[:-k] |= hit[:-k] & address[k:] & same
    capital = (data >= 65) & (data <= 90)
    capitals = np.concatenate([[0], np.cumsum(capital)])
    shouted = (capitals[end] - capitals[start] == end - start) & (end - start > 1)
    repeat = np.flatnonzero(LETTER[data[2:]] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])) if len(data) > 2 else np.zeros(0, np.int64)

    def rate(flags):
        return per_text(n, owners(offsets, np.flatnonzero(flags))) / length

    marks = (data > 32) & (data < 127) & ~LETTER[data] & ~((data >= 48) & (data <= 57))
    return np.column_stack([
        np.log1p(per_text(n, text)), np.bincount(text, weight, minlength=n), np.bincount(text, weight, minlength=n) / some, top,
        per_text(n, text[hit]), np.bincount(wide_text, read, minlength=n), read_top, per_text(n, text[address]) / some, per_text(n, text[close]),
        rate(capital), per_text(n, text[shouted]) / some, rate(data == 33), rate(data == 63), rate(marks), rate((data >= 48) & (data <= 57)),
        per_text(n, wide_text) / some, per_text(n, owners(offsets, repeat)) / length,
    ]).astype(float)


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """y, text, fold and part of at most ``SAMPLE`` labelled rows; copies are one row."""
    chosen = stored(bounded(labels, SAMPLE).select("doc_id", "y"), "toxic-sample-ids")
    near, _ = split_by_filter(docs, "doc_id", id_filter(chosen, "doc_id"))
    rows = near.join(chosen, "doc_id").withColumn("h", F.xxhash64("text")).groupBy("h").agg(F.max("y").alias("y"), F.first("text").alias("text"))
    return rows.select("y", "text", F.pmod("h", F.lit(2)).alias("fold"), F.pmod(F.xxhash64("h"), F.lit(4)).alias("part"))


def stem_counts(sample: DataFrame) -> DataFrame:
    """stem, fold, and the texts of label 1 and 0 that have it."""

    def work(batch):
        y, fold = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("y", "fold"))
        for first, last, offsets, data in blocks(batch.column("text")):
            start, end, text = tokens(data, offsets, False)
            found = forms(prefixes(folded(data, FOLD)), start, end)
            key = np.unique(np.column_stack([np.tile(text, len(found)).astype(U), found.ravel()])[found.ravel() != 0], axis=0)
            stems, back = np.unique(key[:, 1], return_inverse=True)
            who = first + key[:, 0].astype(np.int64)
            for f in (0, 1):
                n1 = np.bincount(back, (y[who] == 1) & (fold[who] == f), minlength=len(stems)).astype(np.int64)
                n0 = np.bincount(back, (y[who] == 0) & (fold[who] == f), minlength=len(stems)).astype(np.int64)
                some = n1 + n0 > 0
                yield record(stem=signed(stems[some]), fold=np.full(some.sum(), f), n1=n1[some], n0=n0[some])

    counted = arrow_map(sample, ["y", "fold", "text"], work, "stem long, fold long, n1 long, n0 long")
    return counted.groupBy("stem", "fold").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def lexicon(stems: DataFrame, ones: float, zeros: float) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of stems and words, sorted, and their log-odds; at most ``LEXICON_SIZE`` learnt ones."""
    odds = F.log((F.col("n1") + 0.5) / (ones + 1)) - F.log((F.col("n0") + DOUBT) / (zeros + DOUBT))
    found = (
        stems.groupBy("stem").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        .filter(F.col("n1") >= LEAST_TEXTS).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc(F.col("odds") * F.sqrt("n1")), "stem").limit(LEXICON_SIZE).select("stem", "odds").toPandas()
    )
    seeds = hashed(SEEDS) ^ U(1)  # as whole words
    keys = np.concatenate([found["stem"].to_numpy(np.int64).view(U), seeds])
    odds = np.concatenate([found["odds"].to_numpy(float), np.full(len(seeds), SEED_ODDS)])
    keys, first = np.unique(keys, return_index=True)
    return keys, odds[first]


def featured(docs: DataFrame, words: tuple[np.ndarray, np.ndarray], carried: str) -> DataFrame:
    """The column ``carried`` (a long) and the features of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def work(batch):
        for first, last, offsets, data in blocks(batch.column("text")):
            x = features(data, offsets, shared.value)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield record(**{carried: batch.column(carried).slice(first, last - first)}, x=lists)

    return arrow_map(docs, [carried, "text"], work, f"{carried} long, x array<double>")


def taught(docs: DataFrame, labels: DataFrame) -> tuple[tuple, DataFrame]:
    """The lexicon of the whole sample, and (y, part, v) of its rows by the other fold's lexicon."""
    sample = stored(sampled(docs, labels), "toxic-sample")
    stems = stored(stem_counts(sample), "toxic-stems")
    sizes = {r["fold"]: (float(r["n1"]), float(r["n"] - r["n1"])) for r in sample.groupBy("fold").agg(F.sum("y").alias("n1"), F.count("*").alias("n")).collect()}
    one, two = (sizes.get(f, (0.0, 0.0)) for f in (0, 1))
    packed = sample.withColumn("own", F.col("y") * 4 + F.col("part"))
    rows = [
        featured(packed.filter(F.col("fold") == f), lexicon(stems.filter(F.col("fold") != f), *other), "own")
        for f, other in ((0, two), (1, one))
    ]
    fit = rows[0].union(rows[1]).select(F.floor(F.col("own") / 4).cast("int").alias("y"), (F.col("own") % 4).alias("part"), array_to_vector("x").alias("v"))
    return lexicon(stems, one[0] + two[0], one[1] + two[1]), stored(fit.repartition(FIT_PARTITIONS), "toxic-fit")


def probability(rows: DataFrame, model) -> DataFrame:
    return model.transform(rows).withColumn("p", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts are scored by their (zero) features, repeated rows
    each. If the usable labels lack one of the two values, every score is the
    smoothed share of label 1. An empty table gives no rows.
    """
    docs, known = texts(docs), stored(training(labels, LABEL, MODULUS, HELD), "toxic-labels")
    words, fit = taught(docs, known)
    rows = stored(featured(docs, words, "doc_id"), "toxic-features")
    trees_on, curve_on = fit.filter("part > 0"), fit.filter("part = 0")
    kinds = trees_on.agg(F.sum("y"), F.count("*")).first()
    ones, total = float(kinds[0] or 0), float(kinds[1] or 0)
    out = rows.select("doc_id", (remainder(MODULUS) == HELD).alias("held_out"), array_to_vector("x").alias("v"))
    if 0 < ones < total:
        trees = GBTClassifier(featuresCol="v", labelCol="y", maxIter=20, maxDepth=4, stepSize=0.3, maxBins=32, seed=7).fit(trees_on)
        out = probability(out, trees)
        if curve_on.head(1):
            curve = IsotonicRegression(featuresCol="p", labelCol="y", predictionCol="score").fit(probability(curve_on, trees))
            # Steps tell texts apart no more; a trace of the trees' own score does.
            out = curve.transform(out).withColumn("score", 0.99 * F.col("score") + 0.01 * F.col("p"))
        else:
            out = out.withColumnRenamed("p", "score")
    else:
        out = out.withColumn("score", F.lit((ones + 0.5) / (total + 1)))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
