"""Mixing sources to target weights by thresholds on hashes.

Each source gets a budget of words. A document is taken as often as the budget
holds its whole source, and once more if its hash lies below the source's
threshold. Thresholds come from histograms: sizes are summed by source and
hash bucket, the bucket in which the budget ends is found, and only the rows of
that bucket are summed again, by finer buckets, until it holds one row. Nothing
is sorted, a larger budget takes all that a smaller one takes, and the hash of
id and text gives the same mix on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.session import stored

# Sources in order of code points weigh these, repeating.
WEIGHTS = (1, 2, 3)
MOST = 3
# Bits by which a level refines the hash; and of each of the two numbers that make a row's place.
STEP = 12
BITS = 60
WORD = r"[^\x20\x09-\x0D]+"
# Exact products of two longs.
WIDE = "decimal(38,0)"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and place (h, r) of every row.

    ``h`` is a hash of id and text, the same on every run. ``r`` numbers the rows
    and tells only repeated rows apart, of which it does not matter which is taken.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.conv(F.substring(own, 1, BITS // 4), 16, 10).cast("long").alias("h"),
        F.monotonically_increasing_id().alias("r"),
    )


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with the number of each in order of code points, null last.

    Ranges of sources are numbered by themselves and then moved by the counts of
    the ranges before; the driver sees one count per range.
    """
    order = [F.col("source").isNull(), F.col("source")]
    dealt = stored(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    before, total = {}, 0
    for row in sorted(dealt.groupBy("part").count().collect()):
        before[row["part"]], total = total, total + row["count"]
    if not before:
        return dealt.withColumn("rank", F.lit(0).cast("long")).drop("part")
    moved = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("part")]
    own = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return dealt.withColumn("rank", (own - 1 + moved).cast("long")).drop("part")


def targets(sources: DataFrame) -> DataFrame:
    """source, source_size and target of every source.

    Sources share the sum of all sizes by weight. One that would get more than
    ``MOST`` times its size stops there, and the others share the rest, until
    none is above. Each round is one aggregate over the sources, and compares
    products of whole numbers.
    """
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    rows = stored(ranked(sources).withColumn("weight", weight.cast(WIDE)).withColumn("most", (MOST * F.col("source_size")).cast(WIDE)), "weights")
    first = rows.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    share, weights = first["s"] or 0, first["w"] or 1
    above = F.lit(False)
    known = 0
    while True:
        above = above | (F.col("weight") * F.lit(int(share)).cast(WIDE) > F.col("most") * F.lit(int(weights)).cast(WIDE))
        row = rows.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, F.col("most"))).alias("gone"),
            F.sum(F.when(~above, F.col("weight"))).alias("w"),
        ).first()
        if row["n"] == known or not row["w"]:
            break
        known, share, weights = row["n"], (first["s"] or 0) - int(row["gone"]), int(row["w"])
    rest = F.col("weight") * F.lit(int(share)).cast(WIDE)
    target = F.when(above, F.col("most").cast("double")).otherwise(rest.cast("double") / F.lit(float(weights)))
    return rows.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def same_source(x: str, y: str):
    return F.col(f"{x}.source").eqNullSafe(F.col(f"{y}.source"))


def shifted(rows: DataFrame, level: int):
    """The bucket of a row's place at a level, and the buckets above it."""
    levels = BITS // STEP
    name, own = ("h", level) if level < levels else ("r", level - levels)
    return F.shiftright(name, BITS - STEP * (own + 1)).bitwiseAND(F.lit((1 << STEP) - 1))


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """source, h, r and closed: the place where each source's ``rest`` of words ends.

    Rows before the place are in, a row at the place is in if ``closed``. Sources
    whose rest ends nowhere within their rows are absent.
    """
    state = wanted.filter("rest > 0").select("source", F.col("rest").alias("left"))
    found = None
    for level in range(2 * BITS // STEP):
        bucket = shifted(rows, level)
        sums = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        sums = stored(sums, "mix-histogram")  # at most 2 ** STEP rows per source
        upto = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
        at = sums.withColumn("upto", upto).alias("s").join(state.alias("t"), same_source("s", "t")).filter("upto >= left AND upto - s.size < left")
        at = stored(at.select("s.source", "bucket", "n", (F.col("left") - F.col("upto") + F.col("s.size")).alias("left")), "mix-boundary")
        near = rows.withColumn("bucket", bucket).alias("x").join(
            at.alias("y"), same_source("x", "y") & (F.col("x.bucket") == F.col("y.bucket")), "left_semi"
        )
        rows = stored(near.select("x.source", "x.size", "x.h", "x.r"), "mix-boundary-rows")
        single = at.filter("n = 1").alias("y").join(rows.alias("x"), same_source("x", "y"))
        single = single.select("x.source", "x.h", "x.r", (2 * F.col("left") >= F.col("x.size")).alias("closed"))
        found = single if found is None else found.unionByName(single)
        state = at.filter("n > 1").select("source", "left")
        if not state.head(1):
            break
        rows = rows.alias("x").join(state.alias("y"), same_source("x", "y"), "left_semi")
    return found


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row.

    ``size`` counts the words of the text, 0 for null and empty ones. ``taken`` is
    a multiple of it, at most ``MOST`` times: the words that the mix takes of the
    row. The taken words of a source differ from its target by half a document
    at most, the one at which the budget ends. A null source is a source of its
    own, the last. Repeated rows are rows each; it does not matter which of them
    is taken once more. An empty table gives no rows.
    """
    rows = stored(sizes(docs), "mix-sizes")
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("whole", F.least(whole, F.lit(MOST).cast("long")))
    rest = F.when(F.col("whole") < MOST, F.col("target") - F.col("whole") * F.col("source_size")).otherwise(0.0)
    goals = stored(goals.withColumn("rest", rest), "mix-targets")
    ends = thresholds(rows, goals)
    plan = goals.alias("g").join(ends.alias("e"), same_source("g", "e"), "left")
    plan = stored(plan.select("g.source", "source_size", "target", "whole", "h", "r", "closed"), "mix-plan")
    more = (F.col("x.h") < F.col("p.h")) | (
        (F.col("x.h") == F.col("p.h")) & ((F.col("x.r") < F.col("p.r")) | ((F.col("x.r") == F.col("p.r")) & F.col("closed")))
    )
    # Spark broadcasts the plan if its table is under the session's limit, and else splits a hot source's rows.
    return rows.alias("x").join(plan.alias("p"), same_source("x", "p")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * (F.col("whole") + F.coalesce(more, F.lit(False)).cast("long"))).alias("taken")
    )


def op13_source_mix(spark, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH word AS (
  SELECT doc_id, source, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM word GROUP BY source),
weight AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM source),
-- Those that reach three times their size first come first; the first that does not sets the level.
cumulated AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS share,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS weights, row_number() OVER (ORDER BY 3 * source_size / w, source) AS place
  FROM weight WINDOW before AS (ORDER BY 3 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT place, share, weights FROM cumulated WHERE w * share <= 3 * source_size * weights ORDER BY place LIMIT 1),
target AS (
  SELECT c.source, c.source_size,
         CASE WHEN c.place < l.place THEN CAST(3 * c.source_size AS DOUBLE) ELSE CAST(c.w * l.share AS DOUBLE) / CAST(l.weights AS DOUBLE) END AS target
  FROM cumulated c, level l),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3, CAST(floor(target / source_size) AS BIGINT)) ELSE 0 END AS whole,
         CASE WHEN source_size > 0 AND target < 3 * source_size THEN target - floor(target / source_size) * source_size ELSE 0 END AS rest
  FROM target),
cut AS (
  SELECT doc_id, size, source_size, target, whole, rest, sum(size) OVER (PARTITION BY word.source ORDER BY h ROWS UNBOUNDED PRECEDING) AS upto
  FROM word JOIN budget ON word.source IS NOT DISTINCT FROM budget.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (whole + CASE WHEN rest > 0 AND (upto < rest OR (upto - size < rest AND 2 * (rest - (upto - size)) >= size)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM cut
"""
