"""Phrase collocations by dynamic itemset counting.

Texts are dealt into ``SHARDS`` shards, which are scanned in a cycle. A phrase is
counted from the scan after both its subphrases (all words but the last, all but
the first) have been seen ``least`` times, for exactly one full cycle, whatever
the shard at which it starts. So long phrases are counted in the same scans as
short ones, and their counts are exact.

Tasks know which phrases have been seen often enough, and since when, from a
table of fixed size: a byte per slot, the scan after which the first phrase of
that slot got there. A slot never changes again, so phrases that share one are
merely counted sooner, for a full cycle too, and no count depends on its size.

Scans count hashes of phrases, a few bytes each. A last cycle, of all shards at
once, counts the longest phrases, and by their words those that were counted
often enough, so that no two phrases can pass for one.

Scores are ratios of whole numbers in 38 digits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import LOWER, SMALL_BLOCK, U, blocks, mix, owners, prefixes, ranges, record, runs, signed, small_batches, spans_hash
from stationflow.session import scratch_path, stored

SHARDS = 4
LONGEST = 5
LEAST_COUNT = 100
BEST = 2000
# Slots for phrases seen often enough: between these, for the words at hand.
FEW_SLOTS, MANY_SLOTS = 1 << 16, 1 << 27
# Slots whose bits travel in one row, as Spark's bitmaps have them.
BITMAP = 32768
NEVER = 255
# Numbers of the three factors of a score reach 38 digits together.
WIDE = "decimal(38,0)"

# The separators of the contract: of words in a piece, and of pieces.
GAP = np.zeros(256, bool)
GAP[[9, 32]] = True
STOP = np.zeros(256, bool)
STOP[[*b".,;:!?", 10, 11, 12, 13]] = True

# Hashes that a task gathers before it counts them, and phrases that it holds before it sends them.
GATHERED = 1 << 19

# The last bits of ``h`` hold a phrase's start (8) and its number of words (3).
SPARE = 11
COUNTED = "h long, n long"
TEXTS = "lang string, phrase string, words int, n long"
TEXT_NAMES = ["lang", "phrase", "words", "n"]
BUNDLES = "share int, lang array<string>, phrase array<string>, words array<int>, n array<long>"


def dealt(docs: DataFrame) -> str:
    """Lower-case texts by language, in a folder per shard; its path."""
    path = scratch_path(docs.sparkSession, "phrase-texts")
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SHARDS)).cast("int").alias("shard"),
    )
    rows.filter("text <> ''").write.partitionBy("shard").parquet(path)
    return path


def pieced(data: np.ndarray, offsets: np.ndarray):
    """(start, end, text, piece) of every word."""
    stop = STOP[data]
    start, end = runs(~(stop | GAP[data]), offsets)
    text = owners(offsets, start)
    return start, end, text, np.cumsum(stop)[start] + text


def written(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """A function that gives the words from one to another joined by blanks, for many phrases at once."""
    size = end - start + 1
    at = ranges(start, size)
    joined = np.append(data, np.uint8(32))[at]
    ends = np.cumsum(size)
    joined[ends - 1] = 32

    def phrases(first: np.ndarray, words: int) -> pa.Array:
        a, b = ends[first] - size[first], ends[first + words - 1] - 1
        offsets = np.concatenate([[0], np.cumsum(b - a)]).astype(np.int32)
        content = joined[ranges(a, b - a)]
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(content)))

    return phrases


def hash_of(text: str) -> int:
    raw = np.frombuffer(text.encode(), np.uint8)
    return int(spans_hash(prefixes(raw), np.array([0]), np.array([len(raw)]))[0])


def hashed(batch: pa.RecordBatch):
    """For every block of a batch: lower-case bytes, word spans, pieces, row and hash of each word. Hashes differ by language."""
    langs = batch.column("lang").dictionary_encode()
    salts = mix(np.array([hash_of(x) for x in langs.dictionary.to_pylist()], U))
    own = langs.indices.to_numpy()
    for first, last, offsets, raw in blocks(batch.column("text"), SMALL_BLOCK):
        data = LOWER[raw]
        start, end, text, piece = pieced(data, offsets)
        if len(start):
            yield data, start, end, piece, first + text, mix(spans_hash(prefixes(data), start, end) ^ salts[own[first:last][text]])


def slot(h: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((h >> U(SPARE)) & U(len(slots) - 1)).astype(np.int64)


def longer(word: np.ndarray, piece: np.ndarray, slots: np.ndarray, most: int):
    """For two to ``most`` words: (words, places, hashes, starts) of the phrases whose two subphrases have been seen often enough.

    A start is the scan from which a phrase counts. Only these phrases can have
    longer ones of the kind, so each length looks at what the one before found,
    and starts no sooner.
    """
    at, h = np.arange(len(word)), mix(word + U(1))  # order matters in the sums below
    start = np.zeros(len(word), U)
    for words in range(2, most + 1):
        since = slots[slot(h, slots)]
        pair = np.flatnonzero((since[:-1] != NEVER) & (since[1:] != NEVER) & (at[1:] - at[:-1] == 1))
        pair = pair[piece[at[pair]] == piece[at[pair] + words - 1]]
        if not len(pair):
            return
        start = np.maximum(start, since.astype(U) + U(1))
        start = np.maximum(start[pair], start[pair + 1])
        at, h = at[pair], mix(h[pair] + word[at[pair] + words - 1])
        yield words, at, h, start


def packed(h: np.ndarray, start, words: int) -> np.ndarray:
    """A hash that also holds the phrase's start and number of words."""
    return (h & ~U((1 << SPARE) - 1)) | (start << U(3)) | U(words)


def counted(batches, scan: int, slots: np.ndarray | None):
    """The phrases that this scan counts, as rows of ``COUNTED``: words in the first cycle, longer ones for a cycle from their start."""
    found, size = [], 0

    def flush():
        h, n = np.unique(np.concatenate(found), return_counts=True)
        return record(h=signed(h), n=n.astype(np.int64))

    for batch in batches:
        for _, _, _, piece, _, word in hashed(batch):
            if scan < SHARDS:
                found.append(packed(mix(word + U(1)), U(0), 1))
                size += len(word)
            for words, _, h, start in longer(word, piece, slots, LONGEST - 1) if slots is not None else ():
                now = (start <= scan) & (start + U(SHARDS) > scan)
                found.append(packed(h[now], start[now], words))
                size += len(found[-1])
            if size >= GATHERED:
                yield flush()
                found, size = [], 0
    if size:
        yield flush()


def combined(rows: list[pa.RecordBatch]) -> pa.Table:
    """One row per phrase, counts added up."""
    both = pa.Table.from_batches(rows).group_by(["share", "lang", "phrase", "words"]).aggregate([("n", "sum")])
    return both.rename_columns({"n_sum": "n"}).select(["share", *TEXT_NAMES])


def bundles(found: pa.Table, parts: int):
    """The phrases of a task, as a row for each of ``parts`` shares."""
    # In order, neighbours share their first bytes, and compress.
    found = found.sort_by([("share", "ascending"), ("phrase", "ascending")]).combine_chunks()
    ends = np.concatenate([[0], np.cumsum(np.bincount(found.column("share").to_numpy(), minlength=parts))]).astype(np.int32)
    lists = {c: pa.ListArray.from_arrays(pa.array(ends), found.column(c).combine_chunks()) for c in TEXT_NAMES}
    yield record(share=np.arange(parts, dtype=np.int32), **lists).filter(pa.array(np.diff(ends) > 0))


def texts_of(batches, wanted: np.ndarray, parts: int):
    """Phrases whose slot is wanted, and all words as a phrase of none, with their counts, in bundles."""
    rows, size, since = [], 0, np.where(wanted, np.uint8(0), np.uint8(NEVER))
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        names, own = langs.dictionary.cast(pa.string()), langs.indices.to_numpy()
        for data, start, end, piece, row, word in hashed(batch):
            phrases, lang = written(data, start, end), own[row]
            each, first = np.flatnonzero(np.bincount(lang)), mix(word + U(1))
            rows.append(record(
                share=np.zeros(len(each), np.int32), lang=names.take(pa.array(each)), phrase=pa.array([""] * len(each)),
                words=np.zeros(len(each), np.int32), n=np.bincount(lang)[each].astype(np.int64),
            ))
            for words, at, h, _ in [(1, np.arange(len(word)), first, None), *longer(word, piece, since, LONGEST)]:
                if words < LONGEST:  # the longest are counted here only, in this last cycle
                    keep = wanted[slot(h, wanted)]
                    at, h = at[keep], h[keep]
                h, some, n = np.unique(h, return_index=True, return_counts=True)
                at = at[some]
                rows.append(record(
                    share=(h % U(parts)).astype(np.int32), lang=names.take(pa.array(lang[at])), phrase=phrases(at, words), words=np.full(len(at), words, np.int32),
                    n=n.astype(np.int64),
                ))
                size += len(at)
            if size >= GATHERED // 2:
                found = combined(rows)
                rows, size = found.to_batches(), 0
                if len(found) >= GATHERED:
                    yield from bundles(found, parts)
                    rows = []
    if rows:
        yield from bundles(combined(rows), parts)


def slots_of(words: int) -> int:
    """A power of two with room for all phrases of one length that are often among so many words, and for others."""
    wanted = words * (LONGEST - 1) // LEAST_COUNT * 2
    return 1 << max(FEW_SLOTS, min(MANY_SLOTS, wanted)).bit_length() - 1


def often(rows: DataFrame, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each slot has a phrase of these rows, and whether it has one short enough to lead to another scan."""
    at = F.shiftrightunsigned("h", SPARE).bitwiseAND(F.lit(slots - 1))
    leads = (F.col("h").bitwiseAND(F.lit(7)) < LONGEST - 1).alias("leads")
    # Bitmaps are merged on the executors. Spark numbers buckets from 1 for the positions 1 to 32768.
    maps = rows.groupBy(leads, F.bitmap_bucket_number(at + 1).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at + 1)).alias("bits"))
    out = np.zeros((2, slots), bool)
    for row in maps.collect():  # slots / 4 bytes at most
        here = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little").astype(bool)
        out[int(row["leads"]), (row["k"] - 1) * BITMAP : row["k"] * BITMAP] = here
    return out[0] | out[1], out[1]


def sent(spark, table: np.ndarray):
    """A function that gives the table to tasks, which hold it compressed: most slots are free."""
    kind, shared = table.dtype, spark.sparkContext.broadcast(zlib.compress(table.tobytes(), 1))
    return lambda: np.frombuffer(zlib.decompress(shared.value), kind)


def scanned(texts: DataFrame, scan: int, slots: np.ndarray | None) -> DataFrame:
    """The counts of one scan, of one shard; partial counts are combined by Spark before the exchange."""
    table = sent(texts.sparkSession, slots) if slots is not None else lambda: None

    def run(batches):
        yield from counted(batches, scan, table())

    return texts.filter(F.col("shard") == scan % SHARDS).select("lang", "text").mapInArrow(run, COUNTED)


def frequent(docs: DataFrame, least: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n of all phrases seen ``least`` times; lang and n of all words).

    The number of scans does not depend on the input: a cycle for each length but
    the last at most, less what longer phrases overlap with shorter ones.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = spark.read.schema("lang string, text string, shard int").parquet(dealt(docs))
    open_rows, slots, done, last, scan = None, None, [], -1, 0
    # The scans end a cycle after the last one that found a phrase in a free slot that longer ones but the longest build on.
    while scan < SHARDS or scan <= last + SHARDS:
        fresh = scanned(texts, scan, slots)
        rows = fresh if open_rows is None else fresh.unionByName(open_rows)
        rows = stored(rows.groupBy("h").agg(F.sum("n").alias("n")), "phrase-counts")
        if scan == 0:
            slots = np.full(slots_of(SHARDS * (rows.agg(F.sum("n")).first()[0] or 0)), NEVER, np.uint8)
        enough = rows.filter(F.col("n") >= least)
        now, leads = often(enough, len(slots))
        if (leads & (slots == NEVER)).any():
            last = scan
        slots = np.where(now & (slots == NEVER), np.uint8(scan), slots)
        whole = F.shiftright("h", 3).bitwiseAND(F.lit(255)) + (SHARDS - 1) == scan
        done.append(enough.filter(whole).select("h"))
        open_rows = rows.filter(~whole)
        scan += 1
    table = sent(spark, often(reduce(DataFrame.union, done), len(slots))[0])
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        yield from texts_of(batches, table(), parts)

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                lists = {c: batch.column(c)[k].values for c in TEXT_NAMES}
                rows.append(record(share=np.zeros(len(lists["n"]), np.int32), **lists))
                size += rows[-1].num_rows
                if size >= GATHERED // 2:
                    rows, size = combined(rows).to_batches(), 0
        both = combined(rows)
        enough = pc.or_(pc.greater_equal(both.column("n"), least), pc.equal(both.column("words"), 0))
        yield from both.filter(enough).select(TEXT_NAMES).to_batches()

    found = texts.select("lang", "text").mapInArrow(run, BUNDLES).groupBy("share").applyInArrow(meet, TEXTS)
    found = stored(found, "frequent-phrases")
    return found.filter("words > 0"), found.filter("words = 0").select("lang", "n")


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, n and score of every phrase of several words, by its lowest cut."""
    own = found.filter("words > 1").join(totals.withColumnRenamed("n", "n_lang"), "lang")
    k = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cut = own.select("lang", "phrase", "words", F.col("n").alias("a"), F.col("n_lang").alias("n"), k)
    cut = cut.withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cut = cut.withColumn("rest", F.expr("substring(phrase, char_length(first) + 2)"))
    side = found.select("lang", "phrase", "n")
    both = cut.join(side.toDF("lang", "first", "l"), ["lang", "first"]).join(side.toDF("lang", "rest", "r"), ["lang", "rest"])
    a, n, l, r = (F.col(c).cast(WIDE) for c in "anlr")
    both = both.withColumn("over", (F.lit(1000).cast(WIDE) * a * n)).withColumn("under", l * r)
    best = both.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct(F.expr("over div under").alias("score"), "k", "l", "r")).alias("c"))
    return best.select("lang", "phrase", "words", "a", "c.l", "c.r", "n", "c.score")


def closed(rows: DataFrame) -> DataFrame:
    """The phrases that no longer one holds as often.

    The two phrases a word shorter are enough to look at: if a much longer phrase
    is as often as one within it, so is every phrase between them.
    """
    longer = rows.filter("words > 2")
    without_first = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    without_last = F.expr("substring_index(phrase, ' ', words - 1)")
    inner = longer.select("lang", "a", F.explode(F.array(without_first, without_last)).alias("phrase"))
    held = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    return rows.join(held, ["lang", "phrase"], "left").filter("most IS NULL OR most < a").drop("most")


def best(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each language with their rank.

    Each task ranks its share first, so a language is never one task's.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    shares = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    own = own.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("rank") <= most)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return own.withColumn("rank", rank).filter(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, most: int = BEST) -> DataFrame:
    """The ``most`` best phrases of two to five words of each language, with rank and counts.

    A: Z are lower-cased; words end at blanks and tabs, phrases at the marks
    ``.,;:!?`` and line ends. ``a`` counts a phrase, ``l`` and ``r`` the two parts of
    its cut of least ``score = floor(1000 a n / (l r))``, ``n`` all words of the
    language. Phrases that a longer one holds as often are left out. A null
    language is ``und``; null and empty texts have no words; repeated rows count
    each; an empty table gives no rows. Ids are not read.
    """
    return best(closed(scored(*frequent(docs, least))), most)


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
word AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM piece),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM word GROUP BY lang),
phrase AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM word, unnest(range(1, 6)) AS t(k), unnest(range(1, len(ws) - k + 2)) AS u(i)
  GROUP BY ALL HAVING count(*) >= 100),
cut AS (
  SELECT p.lang, p.k, p.phrase, p.f AS a, c, string_split(p.phrase, ' ') AS ws
  FROM phrase p, unnest(range(1, p.k)) AS t(c)),
scored AS (
  SELECT cut.*, x.f AS l, y.f AS r, n, CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cut JOIN total USING (lang)
  JOIN phrase x ON x.lang = cut.lang AND x.phrase = array_to_string(ws[1:c], ' ')
  JOIN phrase y ON y.lang = cut.lang AND y.phrase = array_to_string(ws[c + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
held AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase, max(f) AS most
  FROM phrase, unnest(range(2, k)) AS t(m), unnest(range(1, k - m + 2)) AS u(i) GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN held USING (lang, phrase) WHERE most IS NULL OR most < a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
