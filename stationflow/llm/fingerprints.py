"""Document fingerprints: weighted sets of content-defined chunk digests.

A fingerprint is the set of a text's distinct chunk digests, each weighted by
its length in bytes. The likeness of two is their shared weight over the lesser
of their weights (containment): 1 for equal texts and for two empty ones, 0 if
just one is empty. A shift or an edit changes the chunks it touches only.

``neighbours`` brings every document together with the next by descending id:
ids are cut into ranges, each range is sorted in its own task, and the first
document of every range also goes to the range before it. The whole text is
shuffled once.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.chunks import Chunking, chunks, digests
from stationflow.llm.common import blocks, record

# Short chunks: from 300 characters on, the half that an edit leaves holds a whole one.
CHUNKING = Chunking(least=32, wanted=64, most=128)
RANGES_PER_PARTITION = 4
ROWS = 256
LAST = -(1 << 63)


def fingerprints(texts: list[str], how: Chunking = CHUNKING) -> list[dict[bytes, int]]:
    """Digest to length for every text."""
    found: list[dict[bytes, int]] = []
    for _, _, offsets, data in blocks(pa.array(texts, pa.large_string())):
        sets: list[dict[bytes, int]] = [{} for _ in range(len(offsets) - 1)]
        start, end, text = chunks(data, offsets, how)
        for d, n, k in zip(digests(data, start, end, 8), (end - start).tolist(), text.tolist(), strict=True):
            sets[k][d] = n
        found += sets
    return found


def written(fingerprint: dict[bytes, int]) -> str:
    return ",".join(f"{d.hex()}:{n}" for d, n in sorted(fingerprint.items()))


def likeness(a: dict[bytes, int], b: dict[bytes, int]) -> float:
    if not a or not b:
        return float(not a and not b)
    shared = sum(n for d, n in a.items() if d in b)
    return shared / min(sum(a.values()), sum(b.values()))


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, text, border, sorted within partitions so that the next row is the next document.

    Border rows only end a range: they are the first document of the next one.
    A null id comes last; rows of one id are ordered by text, descending.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    place = F.coalesce("doc_id", F.lit(LAST))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES_PER_PARTITION * partitions
    cuts = rows.select("doc_id").approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 1 / (4 * ranges))
    bounds = np.array(sorted(set(cuts)))

    @F.pandas_udf("int")
    def range_of(place):
        return pd.Series(np.searchsorted(bounds, place.to_numpy(), "right").astype(np.int32))

    heads = rows.select(place.alias("place")).groupBy(range_of("place").alias("range")).agg(F.max("place").alias("place"))
    first = sorted((r["range"], r["place"]) for r in heads.collect())  # one row per range
    # The first document of a range follows the last of the next higher range.
    before = {place: first[(k + 1) % len(first)][0] for k, (_, place) in enumerate(first)}

    @F.pandas_udf("array<int>")
    def ranges_of(place):
        own = np.searchsorted(bounds, place.to_numpy(), "right").tolist()
        return pd.Series([[r] + ([before[p]] if p in before else []) for r, p in zip(own, place.tolist(), strict=True)])

    return (
        rows.withColumn("place", place)
        .select("doc_id", "text", "place", F.posexplode(ranges_of("place")).alias("border", "range"))
        .repartition(partitions, "range")
        .sortWithinPartitions("range", "border", F.desc("place"), F.desc("text"))
        .select("doc_id", "text", (F.col("border") > 0).alias("border"), "range")
    )


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compared(docs: DataFrame) -> DataFrame:
    """Every document against its edited text and the next document.

    Null text is empty. One document alone is its own next. Repeated rows give
    a row each. An empty table gives none.
    """

    def emit(ids, texts, borders):
        prints = fingerprints(texts)
        at = [k for k in range(len(texts) - 1) if not borders[k]]
        changed = [edited(texts[k], texts[k + 1]) for k in at]
        other = fingerprints(changed)
        return record(
            doc_id=pa.array([ids[k] for k in at], pa.int64()),
            n_chars=pa.array([len(texts[k]) for k in at], pa.int64()),
            edited_sha256=pa.array([sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            fingerprint=pa.array([written(prints[k]) for k in at], pa.string()),
            edited_fingerprint=pa.array([written(x) for x in other], pa.string()),
            near_edited=pa.array([likeness(prints[k], x) for k, x in zip(at, other, strict=True)], pa.float64()),
            near_next=pa.array([likeness(prints[k], prints[k + 1]) for k in at], pa.float64()),
        )

    def run(batches):
        ids, texts, borders = [], [], []
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                ids += part.column("doc_id").to_pylist()
                texts += part.column("text").to_pylist()
                borders += part.column("border").to_pylist()
                yield emit(ids, texts, borders)
                ids, texts, borders = ids[-1:], texts[-1:], borders[-1:]

    return neighbours(docs).mapInArrow(run, SCHEMA)


def op10_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compared(spark.read.parquet(f"{sf_dir}/documents.parquet"))
