"""Substring deduplication by content-defined chunks.

Chunks are grouped by digest; one that an earlier document, or an earlier place
of its own document, also holds is a repeat. Runs of adjoining repeats of at
least ``LEAST_RUN`` bytes are cut out. Only digests found twice or more are
joined back to their places, and only texts that may lose something are shuffled.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.chunks import Chunking, chunks, digests
from stationflow.llm.common import arrow_map, blocks, id_filter, record, split_by_filter
from stationflow.session import stored

CHUNKING = Chunking(least=32, wanted=64, most=256)
LEAST_RUN = 80


def places(docs: DataFrame) -> DataFrame:
    """d1, d2 (digest), document (doc_id, twin), start, length, again: whether its own text has it before."""

    def work(batch):
        for first, last, offsets, data in blocks(batch.column("text")):
            start, end, text = chunks(data, offsets, CHUNKING)
            both = np.frombuffer(b"".join(digests(data, start, end, 16)), np.int64).reshape(-1, 2)
            order = np.lexsort((start, both[:, 1], both[:, 0], text))
            ranked = np.column_stack([text[order], both[order]])
            again = np.zeros(len(start), bool)
            again[order[1:]] = (ranked[1:] == ranked[:-1]).all(axis=1)
            ids, twins = (batch.column(c).slice(first, last - first).take(pa.array(text)) for c in ("doc_id", "twin"))
            yield record(
                d1=both[:, 0].copy(), d2=both[:, 1].copy(), doc_id=ids, twin=twins,
                start=(start - offsets[text]).astype(np.int32), length=(end - start).astype(np.int32), again=again,
            )

    return arrow_map(docs, ["doc_id", "twin", "text"], work, "d1 long, d2 long, doc_id long, twin long, start int, length int, again boolean")


def repeats(docs: DataFrame) -> DataFrame:
    """A document and the list of (start, length) of its repeated chunks.

    The first place is that of the smallest doc_id, a null id last, and among
    texts of one id of the smallest twin. A text's list is no longer than the text.
    """
    found, own = places(docs), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "twin")
    common = (
        found.groupBy("d1", "d2").agg(F.min(own).alias("first"), F.count("*").alias("n")).filter("n >= 2").drop("n")
    )
    return (
        found.join(common, ["d1", "d2"])
        .filter(F.col("again") | (own > F.col("first")))
        .select("doc_id", "twin", F.struct("start", "length").alias("chunk"))
        .groupBy("doc_id", "twin")
        .agg(F.collect_set("chunk").alias("chunks"))
    )


def cut(text: bytes, repeated: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without its runs of repeated chunks, and these runs."""
    spans: list[list[int]] = []
    for start, length in sorted(repeated):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], start + length)
        else:
            spans.append([start, start + length])
    gone = [(a, b) for a, b in spans if b - a >= LEAST_RUN]
    kept, at = [], 0
    for a, b in gone:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), gone


OUTPUT = "doc_id long, text string, n_bytes long, n_removed long, n_spans long, spans string, kept_sha256 string"


def removed(docs: DataFrame) -> DataFrame:
    """Every document with its remaining text and what was cut from it.

    Null texts are empty, a null id is the last. Texts of one id, or of none, are
    documents each; rows equal in both are one document and are cut alike. An
    empty table gives none.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("twin"), text.alias("text"))
    found = stored(repeats(rows), "repeated-chunks")
    touched, clean = split_by_filter(rows, "doc_id", id_filter(found, "doc_id"))
    found = found.withColumnsRenamed({"doc_id": "_of", "twin": "_twin"})
    joined = touched.join(found, F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("twin") == F.col("_twin")), "left")
    both = clean.withColumn("chunks", F.lit(None).cast(found.schema["chunks"].dataType)).unionByName(joined.drop("_of", "_twin"))

    def work(batch):
        out = []
        for text, places in zip(batch.column("text").to_pylist(), batch.column("chunks").to_pylist(), strict=True):
            raw = text.encode()
            kept, gone = cut(raw, [(p["start"], p["length"]) for p in places or ()])
            out.append((kept.decode(), len(raw), len(raw) - len(kept), len(gone), ",".join(f"{a}:{b}" for a, b in gone), sha256(kept).hexdigest()))
        cols = list(zip(*out, strict=True)) if out else [()] * 6
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        names = ("text", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256")
        yield record(doc_id=batch.column("doc_id"), **{n: pa.array(c, k) for n, c, k in zip(names, cols, kinds, strict=True)})

    return arrow_map(both, ["doc_id", "text", "chunks"], work, OUTPUT)


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return removed(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text")
