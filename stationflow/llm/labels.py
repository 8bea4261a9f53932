"""Labelled rows for training: held-out rows never enter, samples are bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(modulus: int):
    """crc32 of the doc_id as text, mod ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus, F.lit(-1))


def training(labels: DataFrame, label: str, modulus: int, held: int) -> DataFrame:
    """doc_id, y and mark (an even random number) of the rows that may be learnt from.

    Null ids and labels are left out; of repeated rows of one id the larger label counts.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    rows = rows.filter("doc_id IS NOT NULL AND y IN (0, 1)").filter(remainder(modulus) != held)
    return rows.groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("mark", F.xxhash64("doc_id", F.lit(label)))


def bounded(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, those of the least marks.

    Marks are even, so the least twice as many lie below a known mark: only
    those are sorted, however many rows there are.
    """
    share = 2 * most / max(rows.count(), 1)
    if share < 1:
        rows = rows.filter(F.col("mark") < int((share - 0.5) * 2.0**64))
    return rows.orderBy("mark", "doc_id").limit(most)
