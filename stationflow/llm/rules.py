"""Quality rules whose cutoffs come from mergeable quantile sketches.

Every text gets exact counts (words, symbols, repeated lines and words). Ratios
of them go into relative-error quantile sketches, one per language, source and
measure: a value falls into the bucket ``ceil(log(x) / log(gamma))``, so a
quantile is known to within ``ACCURACY``, and two sketches merge by adding
bucket counts, whatever the order. A sketch has at most a few hundred buckets.

No cutoff is a constant. A measure's cutoff is the farther of two places of its
sketch: ``FENCE`` quartile widths above the median, and halfway from the median to
the tail. Where the tail is no farther than the median, nearly all texts are
alike, and there is no cutoff. Sketches of few texts are merged into that of
their language, and those of few texts there into that of all texts. Cutoffs are
joined back to the rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import (
    SEPARATOR, U, arrow_map, blocks, mix, owners, per_text, prefixes, record, runs, spans_hash, windows, words,
)
from stationflow.session import stored

# The symbols of the contract.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
LEAST = 1e-4
FENCE = 4.0
TAIL = 0.99
# Texts below which a group takes the sketch of the group above it.
FEW = 400

MEASURES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "length": "word_chars / greatest(n_words, 1)",
}

COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def duplicates(hashes: np.ndarray, text: np.ndarray):
    """For each item, how many items of its text are equal to it; and which is the first."""
    key = hashes ^ mix(text.astype(U) + U(1))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    group = np.cumsum(fresh) - 1
    size = np.bincount(group) if len(group) else np.zeros(0, np.int64)
    count = np.empty(len(key), np.int64)
    count[order] = size[group]
    first = np.empty(len(key), bool)
    first[order] = fresh
    return count, first


def line_counts(data: np.ndarray, offsets: np.ndarray, sums: np.ndarray):
    """Lines with a word per text, and those equal to an earlier one."""
    n = len(offsets) - 1
    start, end = runs(data != 10, offsets)
    solid = np.concatenate([[0], np.cumsum(~SEPARATOR[data])])
    keep = solid[end] > solid[start]
    start, end = start[keep], end[keep]
    text = owners(offsets, start)
    _, first = duplicates(spans_hash(sums, start, end), text)
    return per_text(n, text), per_text(n, text[~first])


def counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The columns of ``COUNTS`` for a block of texts."""
    n = len(offsets) - 1
    sums = prefixes(data)
    start, end, text = words(data, offsets)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = owners(offsets, np.flatnonzero(SYMBOLS[data]))
    hashes = spans_hash(sums, start, end)
    triples, at = windows(hashes, text, 3)
    count, _ = duplicates(triples, text[at])
    hit = at[count >= 2]
    repeated = np.zeros(len(start), bool)
    for k in range(3):
        repeated[hit + k] = True
    lines, again = line_counts(data, offsets, sums)
    return [
        per_text(n, text),
        per_text(n, text, points[end] - points[start]),
        per_text(n, symbols),
        lines,
        again,
        per_text(n, text[repeated]),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the exact counts; null and empty texts count 0."""
    names = [x.split()[0] for x in COUNTS.split(", ")]

    def work(batch):
        for first, last, offsets, data in blocks(batch.column("text")):
            rest = {c: batch.column(c).slice(first, last - first) for c in ("doc_id", "lang", "source")}
            yield record(**rest, **dict(zip(names, counts(data, offsets), strict=True)))

    columns = [
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
    ]
    return arrow_map(docs, columns, work, f"doc_id long, lang string, source string, {COUNTS}")


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n: partial counts are combined before the exchange."""
    ratios = F.array(*[F.struct(F.lit(k).alias("measure"), F.expr(e).alias("x")) for k, e in MEASURES.items()])
    bucket = F.when(
        F.col("r.x") > LEAST, F.ceil(F.log(F.col("r.x") / LEAST) / math.log(GAMMA))
    ).otherwise(F.lit(0)).cast("int")
    return (
        rows.select("lang", "source", F.explode(ratios).alias("r"))
        .groupBy("lang", "source", F.col("r.measure").alias("measure"), bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def quantiles(sketch: DataFrame, at: dict[str, float]) -> DataFrame:
    """One row per language, source and measure with the named quantiles."""
    group = Window.partitionBy("lang", "source", "measure")
    below = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = sketch.withColumn("below", below).withColumn("total", F.sum("n").over(group))
    value = F.when(F.col("bucket") > 0, LEAST * F.pow(F.lit(GAMMA), F.col("bucket")) * 2 / (1 + GAMMA)).otherwise(0.0)
    return ranked.groupBy("lang", "source", "measure").agg(
        *[F.min(F.when(F.col("below") >= q * F.col("total"), value)).alias(name) for name, q in at.items()]
    )


def cutoffs(rows: DataFrame) -> DataFrame:
    """lang, source and one cutoff per measure, null where there is none."""
    own = stored(sketches(rows), "rule-sketches")

    def level(*names: str) -> DataFrame:
        """The sketches merged into groups of the named columns: their size and cutoffs."""
        keys = [F.col(c) if c in names else F.lit("").alias(c) for c in ("lang", "source")]
        merged = own.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
        values = quantiles(merged, {"q50": 0.5, "q75": 0.75, "tail": TAIL})
        size = merged.groupBy("lang", "source", "measure").agg(F.sum("n").alias("size"))
        fence = F.col("q50") + FENCE * (F.col("q75") - F.col("q50"))
        cutoff = F.when(F.col("tail") > F.col("q50"), F.greatest(fence, (F.col("q50") + F.col("tail")) / 2))
        return values.join(size, ["lang", "source", "measure"]).select(*names, "measure", "size", cutoff.alias("cutoff"))

    groups, langs, whole = level("lang", "source").alias("g"), level("lang").alias("l"), level().alias("w")
    both = groups.join(langs, ["lang", "measure"]).join(whole, "measure")
    chosen = F.when(F.col("g.size") >= FEW, F.col("g.cutoff")).when(F.col("l.size") >= FEW, F.col("l.cutoff")).otherwise(F.col("w.cutoff"))
    return both.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == k, chosen)).alias(f"max_{k}") for k in MEASURES])


def judged(docs: DataFrame) -> DataFrame:
    """Counts, cutoffs and the verdict of every document.

    ``base_failed`` holds for fewer than 50 words, or more than half the words
    in repeated three-word windows. ``kept`` is false for these and for texts
    above a cutoff of their language and source. Null and empty languages and
    sources are one group; repeated rows are judged each; an empty table gives none.
    """
    rows = stored(measured(docs), "rule-counts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    fits = F.lit(True)
    for k, e in MEASURES.items():
        fits = fits & F.coalesce(F.expr(e) <= F.col(f"max_{k}"), F.lit(True))
    # Spark broadcasts the table of cutoffs while it is small, and else splits a hot source's rows.
    limits = stored(cutoffs(rows), "rule-cutoffs")
    return (
        rows.join(limits, ["lang", "source"], "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & fits)
    )


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    rows = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *[f"max_{k}" for k in MEASURES],
    )
