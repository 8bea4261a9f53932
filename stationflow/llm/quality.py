"""Quality classifier: shape features of a text, scored by an additive model."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import additive
from stationflow.llm.common import arrow_map, blocks, owners, per_text, prefixes, record, spans_hash, words
from stationflow.llm.labels import bounded, remainder, training
from stationflow.llm.rules import counts, duplicates
from stationflow.session import stored

LABEL, MODULUS, HELD = "quality", 3, 1
# Labelled rows that the model is fitted on.
SAMPLE = 20_000
CUT = 0.5

KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "bang": b"!?", "stop": b".,;:", "pipe": b"|",
    "symbol": b"#*$%&<>@^~=+_\\/", "bracket": b"()[]{}\"'", "line": b"\n", "beyond": bytes(range(0xC2, 0xF5)),
}


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of numbers per text; empty texts have zeros throughout."""
    n = len(offsets) - 1
    n_words, word_chars, _, n_lines, dup_lines, repeats = counts(data, offsets)
    length = np.maximum(np.diff(offsets), 1)
    some = np.maximum(n_words, 1)
    out = [np.log1p(n_words), word_chars / some, dup_lines / np.maximum(n_lines, 1), repeats / some, some / np.maximum(n_lines, 1)]
    for letters in KINDS.values():
        wanted = np.zeros(256, bool)
        wanted[list(letters)] = True
        out.append(per_text(n, owners(offsets, np.flatnonzero(wanted[data]))) / length)
    start, end, text = words(data, offsets)
    size = end - start
    _, first = duplicates(spans_hash(prefixes(data), start, end), text)
    same = np.zeros(len(start), bool)
    if len(start) > 1:
        hashes = spans_hash(prefixes(data), start, end)
        same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    upper = (data[start] >= 65) & (data[start] <= 90) if len(start) else np.zeros(0, bool)
    out += [
        per_text(n, text[first]) / some, per_text(n, text[same]) / some, per_text(n, text[size <= 3]) / some,
        per_text(n, text[size > 14]) / some, per_text(n, text[upper]) / some,
        np.sqrt(np.maximum(np.bincount(text, size.astype(float) ** 2, minlength=n) / some - (np.bincount(text, size, minlength=n) / some) ** 2, 0)),
    ]
    return np.column_stack(out)


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and its features."""

    def work(batch):
        for first, last, offsets, data in blocks(batch.column("text")):
            x = features(data, offsets)
            yield record(doc_id=batch.column("doc_id").slice(first, last - first), x=pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, ["doc_id", "text"], work, "doc_id long, x array<double>")


def fitted(rows: DataFrame, labels: DataFrame) -> dict:
    """The model from at most ``SAMPLE`` labelled ids that are not held out, a row each."""
    known = stored(training(labels, LABEL, MODULUS, HELD).join(rows, "doc_id", "left_semi"), "quality-labels")
    ids = stored(bounded(known, SAMPLE).select("doc_id", "y"), "quality-sample-ids")
    chosen = rows.join(ids, "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.max("y").alias("y")).orderBy("doc_id").toPandas()
    x = np.vstack(chosen["x"].to_list()) if len(chosen) else np.zeros((0, 1))
    return additive.fit(x, chosen["y"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts are scored by their (zero) features, repeated rows
    each. Without usable labels every score is 0.5; an empty table gives none.
    """
    rows = stored(featured(docs), "quality-features")
    model = docs.sparkSession.sparkContext.broadcast(fitted(rows, labels))

    @F.pandas_udf("double")
    def score(x):
        return pd.Series(additive.scored(model.value, np.vstack(x.to_list())) if len(x) else [], dtype=float)

    return rows.select("doc_id", (remainder(MODULUS) == HELD).alias("held_out"), score("x").alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns as they are, whose text the classifier accepts."""
    rows = stored(featured(docs), "quality-features")
    model = docs.sparkSession.sparkContext.broadcast(fitted(rows, labels))

    @F.pandas_udf("boolean")
    def good(texts):
        out = []
        for _, _, offsets, data in blocks(pa.array(texts, pa.large_string(), from_pandas=True)):
            out.append(additive.scored(model.value, features(data, offsets)) >= CUT)
        return pd.Series(np.concatenate(out) if out else [], dtype=bool)

    return docs.filter(good(F.col("text").cast("string")))


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
