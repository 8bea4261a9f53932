"""Hierarchical packing of documents into windows of several context sizes.

A document fills whole windows of the longest size; what is left is routed to
the smallest tier that holds it. Each tier is packed from its longest pieces,
and the gap of a window is filled from shorter tiers: the longest piece that
fits, again and again, then a cut of the shortest. So windows end up full, and
full windows of any tier need no padding. Windows of one tier are dealt to step
groups in turns of their attention cost, so that a step's members cost alike.

Every task packs the documents of its own partition, in pools of bounded size;
what does not fill a window moves on to the next pool. No row is shuffled, and a
task that runs again packs the same rows the same way.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.bpe import Encoder, Vocabulary
from stationflow.llm.common import record

LONGEST = 2048
TIERS = (256, 512, 1024, 2048)
POOL = 512
STEP = 8
END_ID = 1
# A task's share of ids: its number above, a running number below.
TASK_BITS = 40

Piece = tuple[int, int, int]  # document, start, length


class Packer:
    """Packs the documents of one task; ``add`` and ``close`` return full windows."""

    def __init__(self):
        self.left: list[Piece] = []

    def add(self, documents: list[tuple[int, int]]) -> list[list[Piece]]:
        """Windows from (document, length) and what earlier pools left."""
        out, items = [], self.left
        for document, length in documents:
            whole = length - length % LONGEST
            out += [[(document, at, LONGEST)] for at in range(0, whole, LONGEST)]
            if whole < length:
                items.append((document, whole, length - whole))
        items.sort(key=lambda p: (p[2], p[0], p[1]))
        sizes = [p[2] for p in items]
        while items:
            piece = items.pop()
            window, gap = [piece], TIERS[bisect_left(TIERS, sizes.pop())] - piece[2]
            while gap and items:
                k = bisect_right(sizes, gap) - 1
                if k >= 0:
                    filler = items.pop(k)
                    sizes.pop(k)
                else:
                    document, start, length = items.pop(0)
                    sizes.pop(0)
                    filler = (document, start, gap)
                    rest = (document, start + gap, length - gap)
                    k = bisect_left(sizes, rest[2])
                    items.insert(k, rest)
                    sizes.insert(k, rest[2])
                window.append(filler)
                gap -= filler[2]
            if gap:  # nothing is left to fill it with
                self.left = window
                return out
            out.append(window)
        self.left = []
        return out

    def close(self) -> list[list[Piece]]:
        """The rest: full windows of the largest tiers that it fills, then one that needs padding."""
        pieces, out = self.left, []
        self.left = []
        total = sum(p[2] for p in pieces)
        for tier in reversed(TIERS):
            while total >= tier:
                window, gap = [], tier
                while gap:
                    document, start, length = pieces.pop()
                    take = min(gap, length)
                    window.append((document, start, take))
                    if take < length:
                        pieces.append((document, start + take, length - take))
                    gap -= take
                out.append(window)
                total -= tier
        return out + ([pieces] if pieces else [])


def context(window: list[Piece]) -> int:
    """The padded size: its own at a power of two, else the longest."""
    size = sum(p[2] for p in window)
    return size if size & (size - 1) == 0 else LONGEST


class Steps:
    """Deals windows of a context size to step groups of ``STEP``, by attention cost in turns."""

    def __init__(self):
        self.next = 0

    def deal(self, windows: list[list[Piece]]) -> list[int]:
        groups = [0] * len(windows)
        by: dict[int, list[int]] = {}
        for k, w in enumerate(windows):
            by.setdefault(context(w), []).append(k)
        for _, members in sorted(by.items()):
            members.sort(key=lambda k: (-sum(p[2] ** 2 for p in windows[k]), k))
            n = -(-len(members) // STEP)
            for turn, k in enumerate(members):
                lap, at = divmod(turn, n)
                groups[k] = self.next + (at if lap % 2 == 0 else n - 1 - at)
            self.next += n
        return groups


SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, context long, step_group long"
)


def packed(docs: DataFrame, path: str) -> DataFrame:
    """A row per piece of a document, with its place in a sequence and its ids.

    ``context`` is the padded size of the sequence. Null and empty texts are
    documents of the end id alone. Repeated rows are packed each. An empty table
    gives no rows.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path).state())

    def run(batches):
        encoder, packer, steps = Encoder(Vocabulary.of(vocabulary.value)), Packer(), Steps()
        base = TaskContext.get().partitionId() << TASK_BITS
        held: dict[int, tuple[int | None, np.ndarray]] = {}
        sequence = document = 0

        def rows(windows):
            nonlocal sequence
            groups = steps.deal(windows)
            out = []
            for window, group in zip(windows, groups, strict=True):
                size, offset = context(window), 0
                for k, start, length in window:
                    doc_id, ids = held[k]
                    out.append((doc_id, start, length, ids[start : start + length].tobytes(), len(ids), base + sequence, offset, size, base + group))
                    offset += length
                sequence += 1
            kept = {p[0] for p in packer.left}
            for k in [k for k in held if k not in kept]:
                del held[k]
            columns = list(zip(*out, strict=True)) if out else [()] * 9
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            return record(**{n: pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, columns, strict=True)})

        for batch in batches:
            for first in range(0, batch.num_rows, POOL):
                part = batch.slice(first, POOL)
                new = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text").to_pylist()), strict=True):
                    held[document] = (doc_id, np.append(ids, np.uint32(END_ID)).astype("<u4"))
                    new.append((document, len(ids) + 1))
                    document += 1
                yield rows(packer.add(new))
        yield rows(packer.close())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def digested(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "context", "step_group"
    )


def op6_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digested(packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json")))
