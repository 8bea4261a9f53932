"""Deduplication of repeated byte strings by suffix arrays.

Every byte inside a string of ``LENGTH`` bytes that also starts earlier goes.

Distribution: each window of ``LENGTH`` bytes belongs to the least hash of its
``GRAM``-byte substrings, so equal windows meet under one key. A run of windows
of one key is a piece. Keys that only one piece has, and once, hold no repeat and go before
any text is sent. A piece that the same task has sent already is known to repeat
and is not sent again. Keys with many different pieces are cut further, into
single windows keyed by their whole content.

Sorting, within a task, block by block of whole keys: a two-stage suffix sort.
Suffixes smaller than their successors are sorted directly; the others are
induced by scanning the buckets of first bytes in ascending order, since each is
its first byte before a successor that an earlier scan has placed. Windows whose hash
comes once in their block repeat nothing there and are not sorted. Then adjacent
suffixes are compared; a row of suffixes that share ``LENGTH`` bytes or more are the
occurrences of one string, and all but the earliest are marked.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import (
    SMALL_BLOCK, U, arrow_map, blocks, id_filter, prefixes, ranges, record, runs, signed, small_batches, spans_hash, split_by_filter,
)
from stationflow.session import stored

LENGTH = 100
GRAM = 24
# Half of the grams of a window, at most.
NEAR = 32
# A key's windows are keyed one by one if it has more pieces than ``HOT_SHARE`` times a task's mean
# (and than ``HOT_LEAST``), or than a sort block should hold.
HOT_SHARE, HOT_LEAST, HOT_MOST = 3, 1000, 20_000
# Distinct pieces that a task remembers; a full memory starts anew.
MEMORY = 500_000
SORT_BLOCK = 1 << 20
NO_ID = (1 << 63) - 1
SHIFT = 31


def window_keys(data: np.ndarray, offsets: np.ndarray):
    """(key, first window, windows, again) of every run of windows of one key; runs end with their text.

    ``again``: the substring of the key occurs more than once in the run.
    """
    n = len(data)
    none = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    if n < LENGTH:
        return none
    sums = prefixes(data)
    at = np.arange(n - GRAM + 1)
    grams = least = spans_hash(sums, at, at + GRAM)
    width, have = LENGTH - GRAM + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
        if have == NEAR:  # a window around a gram holds the NEAR grams from it on, or those up to it
            peak = np.zeros(n - GRAM + 1, bool)
            peak[: len(least)] = grams[: len(least)] == least
            peak[NEAR - 1 :] |= grams[NEAR - 1 :] == least
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    # Only there can a gram be the least of a window.
    peaks = np.flatnonzero(peak)
    # least[i] is the key of the window at i; windows that cross texts are no windows.
    inside = np.zeros(len(least) + 1, bool)
    for a, b in zip(offsets[:-1].tolist(), (offsets[1:] - LENGTH + 1).tolist(), strict=True):
        inside[a : max(a, b)] = True
    first = inside[:-1].copy()
    first[1:] &= (least[1:] != least[:-1]) | ~inside[:-2]
    start = np.flatnonzero(first)
    if not len(start):
        return none
    # A run ends where the next one starts, or where windows do.
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    count = np.minimum(np.append(start[1:], len(least)), ends[np.searchsorted(ends, start, "right")]) - start
    key = least[start]
    low, high = np.searchsorted(peaks, start), np.searchsorted(peaks, start + count + width - 1)
    hits = grams[peaks[ranges(low, high - low)]] == np.repeat(key, high - low)
    return key, start, count, np.add.reduceat(hits.astype(np.int64), np.cumsum(high - low) - (high - low)) > 1


def identity(docs: DataFrame) -> list:
    """doc_id, null as the largest, and ``twin``, which tells texts of one id apart: the two order documents."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(text).alias("twin"), text.alias("text")]


def normal(docs: DataFrame) -> DataFrame:
    return docs.select(*identity(docs))


def shared_pieces(docs: DataFrame) -> DataFrame:
    """A document and its (key, place) of keys that two pieces have; a place packs first window and windows."""

    def work(batch):
        for first, last, offsets, data in blocks(batch.column("text"), SMALL_BLOCK):
            key, start, count, _ = window_keys(data, offsets)
            who = np.searchsorted(offsets, start, "right") - 1
            ids, twins = (batch.column(c).slice(first, last - first).take(pa.array(who)) for c in ("doc_id", "twin"))
            yield record(key=signed(key), doc_id=ids, twin=twins, place=((start - offsets[who]) << SHIFT) | count)

    def keys(batch):
        for _, _, offsets, data in blocks(batch.column("text"), SMALL_BLOCK):
            key, _, _, again = window_keys(data, offsets)
            yield record(key=signed(key), again=again)

    found = arrow_map(docs, ["doc_id", "twin", "text"], work, "key long, doc_id long, twin long, place long")
    counted = arrow_map(docs, ["text"], keys, "key long, again boolean")
    common = counted.groupBy("key").agg(F.sum(F.when(F.col("again"), 2).otherwise(1)).alias("n")).filter("n >= 2").select("key")
    # A text has no more pieces than bytes.
    return (
        found.join(common, "key")
        .select("doc_id", "twin", F.struct("key", "place").alias("piece"))
        .groupBy("doc_id", "twin").agg(F.collect_set("piece").alias("pieces"))
    )


PIECE = "key long, doc_id long, twin long, start int, count int, bytes binary"


class Seen:
    """Pieces sent before by this task, with their earliest place."""

    def __init__(self):
        self.places: dict[bytes, tuple[int, int, int]] = {}

    def copy(self, content: bytes, place: tuple[int, int, int]) -> bool:
        """Whether a piece at an earlier or the same place had this content."""
        digest = blake2b(content, digest_size=16).digest()
        known = self.places.get(digest)
        if known is not None and known <= place:
            return True
        if len(self.places) >= MEMORY:
            self.places.clear()
        self.places[digest] = place
        return False


def piece_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    names = [x.split()[0] for x in PIECE.split(", ")]
    return record(**{n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


def pieces(docs: DataFrame) -> DataFrame:
    """Pieces with their bytes; null bytes: the task has sent the same from an earlier place."""
    found = stored(shared_pieces(docs), "pieces-of-text")
    near, _ = split_by_filter(docs, "doc_id", id_filter(found, "doc_id"))
    near = near.join(found, ["doc_id", "twin"])

    def run(batches):
        seen = Seen()
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part, out = batch.slice(first, 64), []
                own = part.column("pieces")
                keys, places = (own.values.field(c).to_numpy() for c in ("key", "place"))
                ends = own.offsets.to_numpy()
                for k, (doc_id, twin, text) in enumerate(zip(*(part.column(c).to_pylist() for c in ("doc_id", "twin", "text")), strict=True)):
                    raw = text.encode()
                    place = places[ends[k] : ends[k + 1]]
                    order = np.argsort(place, kind="stable")
                    place, key = place[order], keys[ends[k] : ends[k + 1]][order]
                    for key_, start, count in zip(key.tolist(), (place >> SHIFT).tolist(), (place & ((1 << SHIFT) - 1)).tolist(), strict=True):
                        content = raw[start : start + count + LENGTH - 1]
                        sent = seen.copy(content, (doc_id, twin, start))
                        out.append((key_, doc_id, twin, start, count, None if sent else content))
                yield piece_rows(out)

    return near.select("doc_id", "twin", "text", "pieces").mapInArrow(run, PIECE)


def singles(rows: DataFrame) -> DataFrame:
    """Each window of the pieces as a piece of its own, keyed by its content."""

    def run(batches):
        seen = Seen()
        for batch in batches:
            for first, last, offsets, data in blocks(batch.column("bytes"), SMALL_BLOCK):
                out = []
                part = batch.slice(first, last - first)
                ids, twins, starts = (part.column(c).to_pylist() for c in ("doc_id", "twin", "start"))
                raw, sums = data.tobytes(), prefixes(data)
                for k, (doc_id, twin, start) in enumerate(zip(ids, twins, starts, strict=True)):
                    at = np.arange(offsets[k], offsets[k + 1] - LENGTH + 1)
                    for a, key in zip(at.tolist(), signed(spans_hash(sums, at, at + LENGTH)).tolist(), strict=True):
                        content, place = raw[a : a + LENGTH], start + a - int(offsets[k])
                        sent = seen.copy(content, (doc_id, twin, place))
                        out.append((key, doc_id, twin, place, 1, None if sent else content))
                yield piece_rows(out)

    return rows.select("doc_id", "twin", "start", "bytes").mapInArrow(run, PIECE)


def eights(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number; zeros follow the end."""
    out = text.astype(U)
    for k in (1, 2, 4):
        wider = out << U(8 * k)
        wider[:-k] |= out[k:]
        out = wider
    return out


def sorted_directly(at: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Suffixes in order of their first ``LENGTH`` bytes and a few more; further ties stay as they are."""
    at = at[np.argsort(keys[at])]
    n = len(keys) - 1
    group = np.cumsum(np.concatenate([[0], (keys[at[1:]] != keys[at[:-1]]).astype(np.int64)])) if len(at) else at
    live = np.arange(len(at))
    for depth in range(8, LENGTH + 8, 8):
        size = np.bincount(group[live]) if len(live) else np.zeros(0, np.int64)
        live = live[size[group[live]] > 1] if len(live) else live
        if not len(live):
            break
        own = group[live]
        key = keys[np.minimum(at[live] + depth, n)]
        head = np.concatenate([[True], own[1:] != own[:-1]])
        first = key[np.maximum.accumulate(np.where(head, np.arange(len(live)), 0))]
        apart = np.bincount(own, weights=key != first, minlength=own[-1] + 1)[own] > 0
        if apart.any():
            some, k, g = live[apart], key[apart], own[apart]
            order = np.lexsort((k, g))
            at[some] = at[some[order]]
            k, g = k[order], g[order]
            fresh = np.concatenate([[True], (k[1:] != k[:-1]) | (g[1:] != g[:-1])])
            # Group numbers only tell neighbours apart: the first member's place.
            group[some] = some[np.maximum.accumulate(np.where(fresh, np.arange(len(some)), 0))] + len(at)
        # Numbers grow with the place again, as the next round needs.
        group = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]).astype(np.int64)]))
    return at


def suffix_array(text: np.ndarray, keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The ``wanted`` suffixes of ``text`` (bytes from 1, 0 between pieces and at the end) by their first ``LENGTH`` bytes.

    Two stages: direct sorting of suffixes smaller than their successors, as far
    as wanted ones are or lead to them, then induction of the rest, bucket by bucket.
    """
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    turn = np.minimum.accumulate(np.where(step != 0, np.arange(n), n - 1)[::-1])[::-1]
    smaller = step[turn] > 0
    smaller[text == 0] = False
    # A larger suffix is induced from the next smaller one to its right.
    to_right = np.minimum.accumulate(np.where(smaller, np.arange(n), n)[::-1])[::-1]
    needed = np.zeros(n + 1, bool)
    needed[to_right[wanted]] = True
    direct = sorted_directly(np.flatnonzero(smaller & needed[:n]), keys)
    edges = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[0] = [np.flatnonzero(text == 0)]
    whole = []
    for c in range(256):
        rows = induced[c]
        if c:  # runs of this byte: a suffix places the one that starts a byte earlier
            last = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            while len(last):
                before = last[last > 0] - 1
                last = before[text[before] == c]
                rows.append(last)
        rows = np.concatenate([*rows, direct[edges[c] : edges[c + 1]]])
        whole.append(rows)
        before = rows[rows > 0] - 1
        before = before[text[before] > c]
        byte = text[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        cuts = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]])) if len(byte) else []
        for k, a in enumerate(cuts):
            b = cuts[k + 1] if k + 1 < len(cuts) else len(byte)
            induced[byte[a]].append(before[a:b])
    rows = np.concatenate(whole)
    return rows[wanted[rows]]


def linked_neighbours(suffixes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each suffix has a common prefix of ``LENGTH`` bytes or more with the one before it; none ends sooner."""
    out = np.zeros(len(suffixes), bool)
    live = np.arange(1, len(suffixes))
    for depth in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        live = live[keys[suffixes[live - 1] + depth] == keys[suffixes[live] + depth]]
    out[live] = True
    return out


def twice(text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether a window starts at a place of ``text`` whose hash another window has; equal windows have one hash.

    ``sizes``: of the pieces, each with the byte behind it.
    """
    begin = np.cumsum(sizes) - sizes
    out = np.zeros(len(text), bool)
    # Part by part, so that the numbers stay small; a long piece is a part of its own.
    hashes, cuts = [], np.append(np.flatnonzero(np.diff(begin // SMALL_BLOCK, prepend=-1)), len(sizes))
    places = ranges(begin, np.maximum(sizes - LENGTH, 0))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        first = begin[a]
        part = text[first : begin[b - 1] + sizes[b - 1]]
        sums = prefixes(part)
        at = places[np.searchsorted(places, first) : np.searchsorted(places, first + len(part))] - first
        hashes.append(spans_hash(sums, at, at + LENGTH))
    hashes = np.concatenate(hashes)
    ordered = np.sort(hashes)
    # By their first bits, so a few more windows are sorted than need be.
    bits = np.zeros(1 << 21, bool)
    bits[(ordered[1:][ordered[1:] == ordered[:-1]] >> U(43)).astype(np.int64)] = True
    out[places[bits[(hashes >> U(43)).astype(np.int64)]]] = True
    return out


def repeated(contents: list[bytes], doc_ids: np.ndarray, twins: np.ndarray, starts: np.ndarray):
    """(piece, first, last window) of all windows that start earlier elsewhere."""
    sizes = np.array([len(c) + 1 for c in contents])
    text = np.frombuffer(b"\xff".join(contents) + b"\xff", np.uint8) + np.uint8(1)  # no UTF-8 byte is 255
    wanted = twice(text, sizes)
    some = np.flatnonzero(np.logical_or.reduceat(wanted, np.cumsum(sizes) - sizes))
    if not len(some):
        return np.zeros((3, 0), np.int64)
    kept = ranges((np.cumsum(sizes) - sizes)[some], sizes[some])
    owner, first, last = sorted_repeats(text[kept], wanted[kept], sizes[some], doc_ids[some], twins[some], starts[some])
    return some[owner], first, last


def sorted_repeats(text: np.ndarray, wanted: np.ndarray, sizes: np.ndarray, doc_ids: np.ndarray, twins: np.ndarray, starts: np.ndarray):
    """:func:`repeated` among the ``wanted`` windows of pieces joined to one text."""
    keys = eights(text)
    suffixes = suffix_array(text, keys, wanted)
    linked = linked_neighbours(suffixes, keys)
    member = linked.copy()
    member[:-1] |= linked[1:]
    at, head = suffixes[member], np.flatnonzero(~linked[member])
    if not len(at):
        return np.zeros((3, 0), np.int64)
    begin = np.cumsum(sizes) - sizes
    # The order of documents within the block, then places below 2^31, as one number.
    order = np.lexsort((twins, doc_ids))
    fresh = (np.diff(doc_ids[order], prepend=doc_ids[order[0]]) != 0) | (np.diff(twins[order], prepend=twins[order[0]]) != 0)
    rank = np.empty(len(sizes), np.int64)
    rank[order] = np.cumsum(fresh)
    where = np.repeat((rank << SHIFT) + starts - begin, sizes)[at] + at
    later = where != np.repeat(np.minimum.reduceat(where, head), np.diff(head, append=len(at)))
    gone = np.zeros(len(text), bool)
    gone[at[later]] = True
    a, b = runs(gone, np.append(begin, len(text)))
    owner = np.searchsorted(begin, a, "right") - 1
    return owner, a - begin[owner], b - 1 - begin[owner]


SPAN = "doc_id long, twin long, start int, end int"


def spans_of(rows: DataFrame) -> DataFrame:
    """Spans that repeat: pieces are brought together by key and sorted block by block."""

    def run(batches):
        keys, ids, twins, starts, contents, size = [], [], [], [], [], 0

        def flush(upto):
            doc_ids, twin, begin = (np.array(x[:upto], np.int64) for x in (ids, twins, starts))
            owner, first, last = repeated(contents[:upto], doc_ids, twin, begin)
            del keys[:upto], ids[:upto], twins[:upto], starts[:upto], contents[:upto]
            return record(
                doc_id=doc_ids[owner], twin=twin[owner], start=(begin[owner] + first).astype(np.int32), end=(begin[owner] + last + LENGTH).astype(np.int32)
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "doc_id", "twin", "start", "bytes"))
            for key, doc_id, twin, start, content in zip(*columns, strict=True):
                if size >= SORT_BLOCK and key != keys[-1]:
                    yield flush(len(keys))
                    size = 0
                keys.append(key)
                ids.append(doc_id)
                twins.append(twin)
                starts.append(start)
                contents.append(content)
                size += len(content)
        if keys:
            yield flush(len(keys))

    sent = rows.filter("bytes IS NOT NULL").select("key", "doc_id", "twin", "start", "bytes")
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = sent.repartition(partitions, "key").sortWithinPartitions("key").mapInArrow(run, SPAN)
    known = rows.filter("bytes IS NULL").select("doc_id", "twin", "start", (F.col("start") + F.col("count") + (LENGTH - 1)).alias("end"))
    return near.union(known)


def repeats(docs: DataFrame) -> DataFrame:
    """A document (doc_id, twin) and its spans (start, end) in bytes, overlapping or not."""
    rows = stored(pieces(docs), "pieces")
    sent = rows.filter("bytes IS NOT NULL")
    share = sent.count() // int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bound = min(HOT_MOST, max(HOT_LEAST, HOT_SHARE * share))
    hot = stored(sent.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > bound).select("key"), "hot-keys")
    plain = rows.join(hot, "key", "left_anti")
    cut = stored(singles(sent.join(hot, "key", "left_semi")), "single-windows")
    copies = rows.filter("bytes IS NULL").join(hot, "key", "left_semi").select(plain.columns)
    spans = spans_of(plain.unionByName(copies).unionByName(cut))
    return spans.groupBy("doc_id", "twin").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


OUTPUT = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>"


def removed(docs: DataFrame) -> DataFrame:
    """Every document with its remaining bytes and the maximal spans removed.

    Null texts are empty. A null doc_id counts as the largest. Texts of one id, or
    of none, are documents each, in an order fixed by their content; rows that are
    equal in both are one document: they do not repeat each other, and lose the
    same bytes. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = normal(docs)
    found = stored(repeats(docs), "repeated-spans")
    touched, clean = split_by_filter(docs, "doc_id", id_filter(found, "doc_id"))
    both = touched.join(found, ["doc_id", "twin"], "left").unionByName(clean.withColumn("spans", F.lit(None).cast(found.schema["spans"].dataType)))

    def work(batch):
        kept, n, gone, spans = [], [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            raw, parts, at = text.encode(), [], 0
            own = merged((s["start"], s["end"]) for s in found or ())
            for a, b in own:
                parts.append(raw[at:a])
                at = b
            kept.append(b"".join([*parts, raw[at:]]))
            n.append(len(raw))
            gone.append(len(raw) - len(kept[-1]))
            spans.append([{"start": a, "end": b} for a, b in own])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield record(
            doc_id=batch.column("doc_id"), kept=pa.array(kept, pa.binary()), n_bytes=pa.array(n, pa.int64()),
            n_removed=pa.array(gone, pa.int64()), spans=pa.array(spans, kind),
        )

    out = arrow_map(both, ["doc_id", "text", "spans"], work, OUTPUT)
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def cut_texts(docs: DataFrame) -> DataFrame:
    """``docs``, all their columns, without the repeated strings in ``text``.

    A character that would be cut in two goes whole. Null texts stay null. Null
    and repeated ids, equal rows and empty tables are as in :func:`removed`.
    """
    small_batches(docs.sparkSession)
    found = stored(repeats(normal(docs)), "repeated-spans").toDF("__cut_id", "__cut_twin", "__cut_spans")
    own, twin, _ = identity(docs)
    touched, clean = split_by_filter(docs, own, id_filter(found, "__cut_id"))

    @F.pandas_udf("string")
    def rest(texts, spans):
        out = []
        for text, found in zip(texts, spans, strict=True):
            if text is None or found is None:
                out.append(text)
                continue
            raw, parts, at = text.encode(), [], 0
            for a, b in merged((s["start"], s["end"]) for s in found):
                parts.append(raw[at:a].decode("utf-8", "ignore"))
                at = b
            out.append("".join([*parts, raw[at:].decode("utf-8", "ignore")]))
        return pd.Series(out, dtype=object)

    touched = touched.join(found, (own == F.col("__cut_id")) & (twin == F.col("__cut_twin")), "left")
    touched = touched.withColumn("text", rest(F.col("text").cast("string"), "__cut_spans"))
    return touched.select(docs.columns).unionByName(clean)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return removed(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
