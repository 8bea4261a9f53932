"""Helpers of the text operators: blocks of whole texts, hashes, words, sketches.

Tasks work on Arrow batches, a block of whole texts at a time, as one byte array
with the offsets of its texts. A block holds about ``BLOCK`` bytes, or one text
if that is longer, so a task's memory is bounded by its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 20
# For work that holds many numbers a byte: they fit the processor's cache, and an idle worker keeps little.
SMALL_BLOCK = 1 << 18
# Bytes of an Arrow batch, in a task and in the worker that it feeds.
BATCH = 4 << 20
U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
INVERSE = U(pow(int(BASE), -1, 1 << 64))

# White space of the contracts: blank and 9 to 13.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def binary(column) -> pa.LargeBinaryArray:
    """Texts as UTF-8 bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).fill_null(b"")


def blocks(column, limit: int = BLOCK):
    """Yield (first row, end row, offsets from 0, bytes) over a text column."""
    column = binary(column)
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(first + 1, last), n)
        yield first, last, offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]]
        first = last


def mix(x):
    """Finaliser of splitmix64, elementwise."""
    x = np.asarray(x, U)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Powers:
    """Powers of BASE and of its inverse, grown to the longest block seen.

    They stay where they are: a function that uses them travels without the numbers.
    """

    def __init__(self):
        self.up = self.down = np.ones(1, U)

    def __reduce__(self):
        return Powers, ()

    def to(self, n: int):
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up), SMALL_BLOCK + 1)
            self.up = np.concatenate([np.ones(1, U), np.cumprod(np.full(size, BASE, U))])
            self.down = np.concatenate([np.ones(1, U), np.cumprod(np.full(size, INVERSE, U))])
        return self.up, self.down


POWERS = Powers()


def prefixes(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`spans_hash` gets the hash of any span."""
    up, _ = POWERS.to(len(data))
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=sums[1:])
    return sums


def spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal bytes give equal hashes wherever they lie."""
    _, down = POWERS.to(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def owners(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text of each byte position."""
    return np.searchsorted(offsets, at, "right") - 1


def runs(flags: np.ndarray, offsets: np.ndarray):
    """(start, end) of maximal runs of true bytes; runs end with their text."""
    n = len(flags)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = flags[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = flags[1:]
    after[edges - 1] = False
    return np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after) + 1


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], ..., start[0] + length[0] - 1, start[1], ..."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def words(data: np.ndarray, offsets: np.ndarray):
    """(start, end, text) of every word."""
    start, end = runs(~SEPARATOR[data], offsets)
    return start, end, owners(offsets, start)


def per_text(n: int, text: np.ndarray, weights=None) -> np.ndarray:
    if weights is None:
        return np.bincount(text, minlength=n).astype(np.int64)
    return np.rint(np.bincount(text, weights=weights, minlength=n)).astype(np.int64)


def windows(hashes: np.ndarray, text: np.ndarray, width: int):
    """Hashes of ``width`` words in a row within a text, and their first words."""
    if len(hashes) < width:
        return np.zeros(0, U), np.zeros(0, np.int64)
    n = len(hashes) - width + 1
    total = np.zeros(n, U)
    for k in range(width):
        total = mix(total + hashes[k : k + n])
    inside = np.flatnonzero(text[:n] == text[width - 1 :])
    return total[inside], inside


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, U).view(np.int64)


def arrow_map(df: DataFrame, columns: list, function, schema: str) -> DataFrame:
    """``function(batch) -> RecordBatches`` over the named columns only."""

    def run(batches):
        for batch in batches:
            yield from function(batch)

    return df.select(*columns).mapInArrow(run, schema)


def small_batches(spark) -> None:
    """Batches that end by their bytes: by number alone, one of long texts holds tens of megabytes on either side."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns)
    )


# Counters of a slice at least, slices of a sketch at most, and those that travel in one batch.
SLICE = 1 << 13
SLICES = 1 << 11
SENT = 128


def counters(df: DataFrame, columns: list, keys, width: int) -> np.ndarray:
    """Count ``keys(batch)`` (uint64) by hash into ``width`` counters: a count-min row.

    The sketch has the size the caller names, a power of two up to 2^27. A task
    counts to 255 and sends slices (the counters in use with their places, if
    they are few), slices are summed on the executors, and the driver gets
    half a byte for each counter, see :func:`level_of`.
    """
    size = min(width, max(SLICE, width // SLICES))
    slices = width // size

    def count(batches):
        total = np.zeros(width, np.uint8)
        for batch in batches:
            for found in keys(batch):
                at, n = np.unique(found & U(width - 1), return_counts=True)
                at = at.astype(np.int64)
                total[at] = np.minimum(total[at] + n, 255)
        parts = total.reshape(slices, size)
        used = np.flatnonzero(parts.any(axis=1))
        for first in range(0, len(used), SENT):
            some = used[first : first + SENT]
            places, counts = [], []
            for k in some:
                at = np.flatnonzero(parts[k])
                few = 3 * len(at) < size
                here = parts[k][at] if few else parts[k]
                places.append(at.astype(np.uint16).tobytes() if few else b"")
                counts.append(here.tobytes())
            yield record(slice=some.astype(np.int32), places=pa.array(places, pa.binary()), counts=pa.array(counts, pa.binary()))

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for places, counts in zip(batch.column("places"), batch.column("counts"), strict=True):
                at = np.frombuffer(places.as_py(), np.uint16)
                total[at if len(at) else slice(None)] += np.frombuffer(counts.as_py(), np.uint8)
        level = np.zeros(size, np.uint8)
        some = total > 0
        level[some] = np.minimum(15, 1 + np.floor(np.log2(total[some])))
        yield record(slice=pa.array([key[0].as_py()], pa.int32()), levels=pa.array([(level[::2] | level[1::2] << 4).tobytes()], pa.binary()))

    sent = df.select(*columns).mapInArrow(count, "slice int, places binary, counts binary")
    parts = sent.groupBy("slice").applyInArrow(merge, "slice int, levels binary")
    levels = np.zeros(width // 2, np.uint8)
    # At most SLICES rows, together half a byte for each counter.
    for row in parts.collect():
        levels[row["slice"] * size // 2 : (row["slice"] + 1) * size // 2] = np.frombuffer(row["levels"], np.uint8)
    return levels


def level_of(levels: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The counters' levels: 1 + floor(log2(count)), 15 at most, 0 for none."""
    at = (hashes & U(2 * len(levels) - 1)).astype(np.int64)
    return (levels[at >> 1] >> ((at & 1) << 2).astype(np.uint8)) & 15


ID_BITS = 1 << 20


def id_filter(ids: DataFrame, name: str) -> np.ndarray:
    """A Bloom filter (one hash, fixed size) of long ids, as counters.

    Ids outside it are surely absent. Beyond its capacity it lets more rows
    through to the join behind it and costs speed, never rows.
    """

    def keys(batch):
        yield id_hash(batch.column(0))

    return counters(ids, [name], keys, ID_BITS)


def id_hash(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return mix(column.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(U))


def split_by_filter(docs: DataFrame, column, bits: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be in the filter, rows whose id surely is not)."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def maybe(ids):
        import pandas as pd

        return pd.Series(level_of(shared.value, mix(ids.fillna(-1).to_numpy().astype(np.int64).view(U))) > 0)

    inside = maybe((F.col(column) if isinstance(column, str) else column).cast("long"))
    return docs.filter(inside), docs.filter(~inside)
