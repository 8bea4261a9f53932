"""Near-duplicate join on word shingles with adaptive multi-match prefixes.

Two texts of similarity t share at least ``need(n) = ceil(t n)`` shingles, n the
larger set. So if both list their shingles in one global order, rarest first,
the first ``n - need(n) + l`` of each have at least l in common, for any l up to
``need(n)``. Every document chooses its own l by the estimated cost of the
candidates it meets: a longer prefix reads a little more and asks for more
shared shingles before verification. A pair must share the lesser of its two l.

- Copies (equal sets) are one class, found by a 128-bit digest.
- The order comes from counts of all shingles in a sketch sized by their number.
- Large groups of near copies are not paired off: their members are first
  verified against a few hubs and merged into components; only pairs of
  different components remain to be joined and verified.
- A pair goes on to verification if its sets' parity signatures differ in no more
  bits than similar sets may differ in shingles, which no similar pair fails.
- Verification compares whole shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import (
    LOWER, SMALL_BLOCK, U, arrow_map, blocks, counters, id_filter, level_of, mix, prefixes, record, signed, small_batches, spans_hash,
    split_by_filter, windows, words,
)
from stationflow.llm.components import components
from stationflow.session import stored

# Counters of the sketch that orders shingles: one for each shingle of the table, within these bounds.
SKETCH = 1 << 16, 1 << 26
# Bits of a set's parity signature, and of its fold that prefix entries carry to the last join.
PARITY = 1024
FOLD = 256
SIGNS = [f"p{k}" for k in range(FOLD // 64)]
# Classes whose prefixes a task remembers to have sent; a full memory starts anew.
MEMORY = 500_000
LEVELS = 8
# The cost of verifying a pair, in prefix entries read.
VERIFY = 16.0
# Shingle groups above this go through hubs first.
SMALL_GROUP = 2
# Hub rounds end when the pairs left are no more than this per prefix entry, or hardly fewer than before.
# A round takes dozens of jobs, a pair about as long as an entry.
PAIRS_PER_ENTRY = 4
LEAST_PROGRESS = 0.7
NO_ID = (1 << 63) - 1
# Numbers from here up stand for texts of a null id.
UNKNOWN = 1 << 62


def need(n, percent: int):
    """Shingles that a partner must share with a set of n."""
    return -(-percent * n // 100)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """Distinct shingle hashes of all texts, sorted within a text, and where each text's begin."""
    data = LOWER[data]
    sums = prefixes(data)
    start, end, text = words(data, offsets)
    hashes = spans_hash(sums, start, end)
    found, at = windows(hashes, text, width)
    owner = text[at]
    n = len(offsets) - 1
    count = np.bincount(text, minlength=n)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):  # the whole sequence is the one shingle
        first = np.searchsorted(text, short)
        total = np.zeros(len(short), U)
        for k in range(width - 1):
            more = k < count[short]
            total[more] = mix(total[more] + hashes[first[more] + k])
        found = np.concatenate([found, mix(total + count[short].astype(U) * U(0xA0761D6478BD642F))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[fresh], owner[fresh]
    return found, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int64), owner


def normal(docs: DataFrame) -> DataFrame:
    """doc_id, or for a null one a number of the text's own from ``UNKNOWN`` up, and text."""
    text = F.col("text").cast("string")
    own = F.xxhash64(text).bitwiseAND(F.lit(UNKNOWN - 1)) + F.lit(UNKNOWN)
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), own).alias("doc_id"), text.alias("text"))


def one_of_unknown(rows: DataFrame, keys: list) -> DataFrame:
    """``rows`` with one of the copies that share a number because their ids are null."""
    known = F.col("doc_id") < UNKNOWN
    return rows.filter(known).unionByName(rows.filter(~known).dropDuplicates(["doc_id", *keys]))


def digests(found: np.ndarray, begin: np.ndarray):
    """Two 64-bit digests of each text's set."""
    out = []
    for salt in (0x9FB21C651E98DF25, 0xD1B54A32D192ED03):
        sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(found ^ U(salt)), dtype=U)])
        out.append(signed(mix(sums[begin[1:]] - sums[begin[:-1]] + U(salt))))
    return out


def parities(found: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each text a bit per class of hashes: whether its set has an odd number of them."""
    bit = (found >> U(40)).astype(np.int64) % PARITY
    odd = np.bincount(owner * PARITY + bit, minlength=n * PARITY).reshape(n, PARITY) & 1
    return np.packbits(odd.astype(np.uint8), axis=1)


def sized(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, s1, s2 (digest of the set), n (its size), parity (its signature) and the signature's fold."""

    def work(batch):
        for first, last, offsets, data in blocks(batch.column("text"), SMALL_BLOCK):
            found, begin, owner = shingle_sets(data, offsets, width)
            s1, s2 = digests(found, begin)
            signs = parities(found, owner, last - first)
            # A class of the fold is the union of PARITY / FOLD classes, so its parity is their sum's.
            fold = np.bitwise_xor.reduce(signs.reshape(last - first, PARITY // FOLD, FOLD // 8), axis=1)
            yield record(
                doc_id=batch.column("doc_id").slice(first, last - first), s1=s1, s2=s2, n=np.diff(begin),
                parity=pa.array([x.tobytes() for x in signs], pa.binary()),
                **{p: np.ascontiguousarray(x) for p, x in zip(SIGNS, np.ascontiguousarray(fold).view(np.int64).T, strict=True)},
            )

    more = "".join(f", {p} long" for p in SIGNS)
    return arrow_map(docs, ["doc_id", "text"], work, f"doc_id long, s1 long, s2 long, n long, parity binary{more}")


def sketch_size(shingles: int) -> int:
    return min(max(1 << max(shingles - 1, 1).bit_length(), SKETCH[0]), SKETCH[1])


def entries(docs: DataFrame, counts: int, width: int, percent: int) -> DataFrame:
    """token, rep, n, level: the longest prefixes of every class, tokens that two classes share only.

    ``level`` is the least l whose prefix has the token; ``counts`` is the size of
    the order's sketch. Returned as a written table, so that it can be released.
    """

    def keys(batch):
        for _, _, offsets, data in blocks(batch.column("text"), SMALL_BLOCK):
            yield shingle_sets(data, offsets, width)[0]

    shared = docs.sparkSession.sparkContext.broadcast(counters(docs, ["text"], keys, counts))
    sent: dict[int, int] = {}

    def fresh(s1: int, doc_id: int) -> bool:
        """Whether this task has not sent the class yet, or only for a larger id."""
        if sent.get(s1, NO_ID + 1) <= doc_id:
            return False
        if len(sent) >= MEMORY:
            sent.clear()
        sent[s1] = doc_id
        return True

    def work(batch):
        for first, last, offsets, data in blocks(batch.column("text"), SMALL_BLOCK):
            found, begin, owner = shingle_sets(data, offsets, width)
            size = np.diff(begin)
            rarity = level_of(shared.value, found)
            order = np.lexsort((found, rarity, owner))
            place = np.arange(len(found)) - begin[owner]
            least = need(size, percent)
            level = np.maximum(1, place - (size - least)[owner] + 1)
            ids, s1 = batch.column("doc_id").slice(first, last - first), digests(found, begin)[0]
            new = np.array([fresh(s, d) for s, d in zip(s1.tolist(), ids.to_pylist(), strict=True)], bool)
            keep = (level <= np.minimum(LEVELS, least)[owner]) & new[owner]
            who = owner[keep]
            yield record(
                token=signed(found[order][keep]), s1=s1[who], doc_id=ids.take(pa.array(who)),
                n=size[who].astype(np.int32), level=level[keep].astype(np.int32),
            )

    rows = arrow_map(docs, ["doc_id", "text"], work, "token long, s1 long, doc_id long, n int, level int")
    # Copies were combined in their tasks, so one exchange by token serves the classes and their number.
    one = rows.repartition("token").groupBy("token", "s1", "n", "level").agg(F.min("doc_id").alias("rep")).drop("s1")
    out = stored(one.withColumn("df", F.count("*").over(Window.partitionBy("token"))).filter("df >= 2"), "prefixes")
    shared.destroy()
    return out


def adapted(rows: DataFrame) -> DataFrame:
    """The entries within the level that each class chooses: token, rep, n, l."""
    per = rows.groupBy("rep").agg(
        *[F.sum(F.when(F.col("level") <= k, F.col("df") - 1).otherwise(0)).alias(f"c{k}") for k in range(1, LEVELS + 1)],
        F.max("level").alias("most"),
    )
    # Least of (cost, l): entries read, and pairs that reach l, each to be verified.
    best = F.least(
        *[
            F.struct((F.when(F.col("most") >= k, F.col(f"c{k}") * (1 + VERIFY / k)).otherwise(1e300)).alias("cost"), F.lit(k).alias("l"))
            for k in range(1, LEVELS + 1)
        ]
    )
    chosen = per.select("rep", best["l"].alias("l"))
    return rows.join(chosen, "rep").filter("level <= l").select("token", "rep", "n", "l")


def plausible(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures leave room for similarity.

    Sets of similarity t differ in at most (1 - t) / (1 + t) of their summed
    sizes, and their signatures in no more bits than that.
    """

    def compare(batch):
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, PARITY // 8) for c in ("x", "y"))
        apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        yield batch.select(["a", "b"]).filter(pa.array(apart * (100 + percent) <= both * (100 - percent)))

    a = sizes.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("parity").alias("x"))
    b = sizes.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("parity").alias("y"))
    return arrow_map(pairs.join(a, "a").join(b, "b"), ["a", "b", "n_a", "n_b", "x", "y"], compare, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, sizes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Texts travel rather than sets of hashes, which are larger and do not compress.
    """
    pairs = stored(plausible(pairs, sizes, percent), "pairs")

    def side(name: str, text: str) -> DataFrame:
        near, _ = split_by_filter(docs, "doc_id", id_filter(pairs.select(name), name))
        return near.select(F.col("doc_id").alias(name), F.col("text").alias(text))

    def sets(column):
        for _, _, offsets, data in blocks(column, SMALL_BLOCK):
            found, begin, _ = shingle_sets(data, offsets, width)
            yield from (found[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True))

    def compare(batch):
        for first in range(0, batch.num_rows, 256):
            part, good = batch.slice(first, 256), []
            for x, y in zip(sets(part.column("x")), sets(part.column("y")), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return arrow_map(both, ["a", "b", "x", "y"], compare, "a long, b long")


def labelled(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """Entries with the component of their class so far; a class is labelled once, not at each of its entries."""
    if found is None:
        return rows.withColumn("component", F.col("rep"))
    classes = rows.groupBy("rep", "n", "l").agg(F.collect_list("token").alias("tokens"))
    known = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    return known.select(F.explode("tokens").alias("token"), "rep", "n", "l", F.coalesce("component", "rep").alias("component"))


def mixed(rows: DataFrame) -> DataFrame:
    """The entries of shingles that several components hold, with the number of a shingle's entries.

    A window over the shingle's entries, no join of the table with its own groups.
    """
    own = Window.partitionBy("token")
    some = rows.withColumns({"lo": F.min("component").over(own), "hi": F.max("component").over(own), "size": F.count("*").over(own)})
    return some.filter("lo < hi").drop("lo", "hi")


def pairs_left(rows: DataFrame) -> int:
    """At most so many pairs of different components share a shingle."""
    per = rows.groupBy("token", "component").agg(F.count("*").alias("k"))
    per = per.groupBy("token").agg(((F.pow(F.sum("k"), 2) - F.sum(F.col("k") * F.col("k"))) / 2).alias("pairs"))
    return int(per.agg(F.sum("pairs")).first()[0] or 0)


def similar_sizes(percent: int):
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def hub_pairs(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each member of a large group with the hub of most of its groups; other hubs each turn."""
    big = rows.filter(F.col("size") > SMALL_GROUP)
    order = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
    hubs = big.groupBy("token").agg(F.min(F.struct(order.alias("o"), "rep", "n", "component")).alias("h"))
    return (
        big.join(hubs, "token")
        .filter("component <> h.component")
        .select(F.col("rep").alias("a"), F.col("h.rep").alias("b"), F.col("n").alias("n_a"), F.col("h.n").alias("n_b"))
        .filter(similar_sizes(percent))
        .groupBy("a", "b").agg(F.count("*").alias("shared"))
        .groupBy("a").agg(F.max_by("b", F.struct("shared", -F.col("b"))).alias("b"))
    )


def candidate_pairs(rows: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share as many prefix shingles as the lesser l.

    The folds of the signatures are compared within the join, so that a large
    group whose members share prefixes but little else makes few rows.
    """
    # Texts of one id that differ have a signature each.
    signs = sizes.select(F.col("doc_id").alias("rep"), F.col("n").cast("int").alias("n"), *SIGNS).distinct()
    signed_rows = rows.join(signs, ["rep", "n"])

    def side(x: str) -> DataFrame:
        names = {"rep": x, "n": f"n_{x}", "l": f"l_{x}", "component": f"c_{x}"} | {p: f"{p}_{x}" for p in SIGNS}
        return signed_rows.select("token", *[F.col(c).alias(to) for c, to in names.items()])

    apart = sum(F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in SIGNS)
    alike = apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)
    return (
        side("a").join(side("b"), "token")
        .filter((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & similar_sizes(percent) & alike)
        .groupBy("a", "b", F.least("l_a", "l_b").alias("l"))
        .agg(F.count("*").alias("shared"))
        .filter("shared >= l")
        .select("a", "b")
    )


def merged_once(links: DataFrame, found: DataFrame | None) -> DataFrame:
    """(id, component): the components so far, merged along fresh links (a, b).

    A component takes the least one within two links, then that one's least one,
    twice. Equal components are surely linked, linked ones need not be equal yet:
    between hub rounds that is enough to leave pairs out, and it takes one job
    where whole components take many.
    """
    ids = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    if found is None:
        known, edges = ids.withColumn("component", F.col("id")), links.toDF("x", "y")
    else:
        known = ids.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        known = known.union(found.join(ids, "id", "left_anti"))
        a, b = (found.toDF(end, side) for end, side in (("a", "x"), ("b", "y")))
        edges = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y"))
    edges = edges.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
    both = edges.union(edges.select("y", "x")).toDF("x", "y")
    near = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
    to = stored(both.join(near.toDF("y", "m"), "y").groupBy("x").agg(F.least(F.col("x"), F.min("m")).alias("to")), "nearest")
    for _ in range(2):
        to = to.join(to.toDF("to", "next"), "to", "left").select("x", F.coalesce("next", "to").alias("to"))
    return known.join(to, known["component"] == to["x"], "left").select("id", F.coalesce("to", "component").alias("component"))


def class_components(docs: DataFrame, sizes: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, component) of the classes that are linked with another class."""
    if sizes.filter(F.col("doc_id") >= UNKNOWN).head(1):
        sizes = stored(one_of_unknown(sizes, ["s1", "s2"]), "sizes-once")
        docs = stored(one_of_unknown(docs, ["text"]), "texts-once")
    shingles = sizes.filter("n > 0").dropDuplicates(["s1", "s2"]).agg(F.sum("n")).first()[0] or 0
    rows = stored(adapted(entries(docs, sketch_size(shingles), width, percent)), "prefixes-chosen")
    bound = PAIRS_PER_ENTRY * rows.count()
    links, found, turn, before = None, None, 0, float("inf")
    left = rows
    while True:
        # A shingle whose classes are all in one component stays so: only the others are labelled again.
        left = stored(mixed(labelled(left.select(rows.columns), found)), "prefixes-left")
        now = pairs_left(left)
        if now <= bound or now > LEAST_PROGRESS * before:
            break
        fresh = stored(verified(hub_pairs(left, turn, percent), docs, sizes, width, percent), "links")
        links = fresh if links is None else links.union(fresh)
        found = stored(merged_once(fresh, found), "components-so-far")
        turn, before = turn + 1, now
    fresh = verified(candidate_pairs(left, sizes, percent), docs, sizes, width, percent)
    return stored(components(fresh if links is None else links.union(fresh)), "components")


def joined(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Links hold between texts whose shingle sets have a Jaccard similarity of
    ``percent`` / 100 or more; a component's id is its smallest doc_id. Texts
    without words, and null texts, have no shingles and no links. Every text of
    a null doc_id is a document of its own, linked by its own text; its component
    is null if no linked row has an id. Rows of one id are one document, linked
    if one of its texts is. Repeated rows give a row each, an empty table none.
    Ids are below 2^62.
    """
    small_batches(docs.sparkSession)
    docs = normal(docs)
    rows = stored(sized(docs, width), "shingle-sizes")
    classes = rows.filter("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    found = class_components(docs, rows, width, percent).withColumnRenamed("id", "rep")
    classes = classes.join(found, "rep", "left").select("s1", "s2", F.coalesce("component", "rep").alias("component"))
    some = rows.filter("n > 0").join(classes, ["s1", "s2"]).select("doc_id", "n", "component")
    none = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component"))
    return some.union(none).select(
        F.when(F.col("doc_id") < UNKNOWN, F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("component") < UNKNOWN, F.col("component")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all their columns: of each component the document of the smallest id.

    Of several rows of one id one stays. Texts without words stay, and so do rows
    of a null id: no id tells a copy among them from other texts.
    """
    found = joined(docs, width, percent).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.coalesce("component_id", F.lit(NO_ID)).alias("__of"))
    found = stored(found, "near-duplicates")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    gone = found.filter(f"__id <> __of AND __id <> {NO_ID}").select("__id").distinct()
    touched, clean = split_by_filter(docs, own, id_filter(gone, "__id"))
    kept = clean.unionByName(touched.join(gone, own == F.col("__id"), "left_anti"))
    several = found.filter(f"__id = __of AND __id <> {NO_ID}").groupBy("__id").agg(F.count("*").alias("__n")).filter("__n > 1")
    if not several.head(1):
        return kept
    touched, clean = split_by_filter(kept, own, id_filter(several, "__id"))
    touched = touched.join(several, own == F.col("__id"), "left")
    repeated = touched.filter("__n IS NOT NULL").dropDuplicates(["__id"])
    return clean.unionByName(touched.filter("__n IS NULL").unionByName(repeated).select(docs.columns))


def op4_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet"))
