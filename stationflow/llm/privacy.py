"""Information-theoretic sanitisation, with DataFrame functions only.

Personal data of four kinds are found by patterns. They are the entities to
protect. A term that stands near an entity reveals it as far as knowing the term
settles the entity: with document counts over the corpus, pointwise mutual
information log(N n(e,t) / (n(e) n(t))) as a share of the entity's own
information log(N / n(e)). At ``REMOVE`` of it and above the term is removed from
the documents that hold the entity, at ``GENERALISE`` and above it is
generalised. Terms met with an entity in fewer than ``SUPPORT`` documents are no
evidence.

Places come from splitting: the text between matches and the matches themselves
alternate, so adding lengths gives positions in code points. Patterns are linear:
what may repeat is possessive, and a match starts where its letters start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.session import stored

KINDS = ("email", "ip", "card", "phone", "term", "class")
LOCAL = "[A-Za-z0-9._%+-]"
LABEL = "[A-Za-z0-9-]++"
# The same matches as the contract's patterns, without their backtracking.
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}(?:\.{LABEL})++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A chain of digits with single separators, if it has 14 to 19 digits.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Cheap tests that a text must pass to be searched.
HINTS = {"email": "text LIKE '%@%.%'", "ip": r"text RLIKE r'[0-9]\.[0-9]+\.[0-9]+\.[0-9]'", "card": r"text RLIKE r'[0-9](?:[ -]?[0-9]){13}'", "phone": "text LIKE '%+%'"}
BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"

NEAR = 64
WORDS = 5
SUPPORT = 2
REMOVE = 0.95
GENERALISE = 0.7
NOT_TERM = r"[^\p{L}\p{N}]+"
TERM_LETTERS = 4


def places(text: Column, pattern: Column | str, kind: int) -> Column:
    """Array of (start, kind, end, value) of a pattern's matches, leftmost first, not overlapping."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))
    # The last gap has no match.
    pairs = F.filter(pairs, lambda p: p["match"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def add(sofar, pair):
        begin = sofar["at"] + F.char_length(pair["gap"])
        end = begin + F.char_length(pair["match"])
        own = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["match"].alias("value"))
        return F.struct(end.alias("at"), F.concat(sofar["found"], F.array(own)).alias("found"))

    return F.aggregate(pairs, start, add, lambda x: x["found"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    d = digits(value)

    def add(total, k):
        x = F.substr(d, F.length(d) - k + 1, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(k % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.rlike(v, F.lit(rf"^{BYTE}(?:\.{BYTE}){{3}}$")),
    "card": luhn,
    "phone": lambda v: F.length(digits(v)).between(10, 15),
}


def holds(test):
    return lambda span: test(span["value"])


def is_kind(k: int):
    return lambda span: span["kind"] == k


def base_spans(text: Column) -> Column:
    """All valid matches by start, then kind."""
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        valid = F.filter(places(text, pattern, k), holds(VALID[kind]))
        found.append(F.when(F.expr(HINTS[kind]), valid).otherwise(F.array().cast(SPAN)))
    return F.sort_array(F.concat(*found))


def nearby(text: Column, span: Column) -> Column:
    """Terms among the ``WORDS`` words on either side of a span, within ``NEAR`` characters."""
    before = F.substr(text, F.greatest(span["start"] - NEAR, F.lit(0)) + 1, F.least(span["start"], F.lit(NEAR)))
    after = F.substr(text, span["end"] + 1, F.lit(NEAR))
    # A word cut by the window's edge is no word.
    left = F.slice(F.reverse(F.split(F.concat(before, F.lit(" ")), NOT_TERM)), 1, WORDS + 1)
    left = F.when(span["start"] > NEAR, F.filter(left, lambda w, k: k < F.size(F.split(before, NOT_TERM)) - 1)).otherwise(left)
    right = F.slice(F.split(F.concat(F.lit(" "), after), NOT_TERM), 1, WORDS + 1)
    words = F.transform(F.concat(left, right), lambda w: F.lower(w))
    return F.array_distinct(F.filter(words, lambda w: F.char_length(w) >= TERM_LETTERS))


def entity(span: Column) -> Column:
    """What a span protects: its kind and its value, without spacing."""
    plain = F.when(span["kind"] >= 2, digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"].cast("string"), F.lit(":"), plain)


def with_base(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__pii_key`` and ``__pii_base``; needs a column ``text``, without nulls."""
    return docs.withColumn("__pii_base", base_spans(F.col("text"))).withColumn("__pii_key", F.monotonically_increasing_id())


def revealing(found: DataFrame, texts: DataFrame) -> DataFrame:
    """__pii_key and its terms to remove and to generalise (lists no longer than the text).

    ``found`` has __pii_key, __pii_base and the texts that hold entities; ``texts`` all texts.
    """
    pair = F.explode(
        F.array_distinct(
            F.flatten(
                F.transform(
                    F.col("__pii_base"),
                    lambda s: F.transform(nearby(F.col("text"), s), lambda w: F.struct(entity(s).alias("e"), w.alias("t"))),
                )
            )
        )
    )
    pairs = stored(found.filter(F.size("__pii_base") > 0).select("__pii_key", pair.alias("p")).select("__pii_key", "p.e", "p.t"), "private-pairs")
    entities = found.filter(F.size("__pii_base") > 0).select(F.explode(F.array_distinct(F.transform("__pii_base", entity))).alias("e"))
    holders = entities.groupBy("e").agg(F.count("*").alias("n_e")).filter(F.col("n_e") >= SUPPORT)
    together = pairs.groupBy("e", "t").agg(F.count("*").alias("n_et")).filter(F.col("n_et") >= SUPPORT)
    words = F.explode(F.array_distinct(F.split(F.lower(F.col("text")), NOT_TERM)))
    frequency = texts.select(words.alias("t")).filter(F.char_length("t") >= TERM_LETTERS).groupBy("t").agg(F.count("*").alias("n_t"))
    total = texts.count()
    own = F.log(F.lit(float(max(total, 1))) / F.col("n_e"))
    shared = F.log(F.lit(float(max(total, 1))) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    # An entity of every document has nothing to reveal.
    share = F.when(own > 0, shared / own).otherwise(0.0)
    kind = F.when(share >= REMOVE, F.lit(4)).when(share >= GENERALISE, F.lit(5))
    judged = (
        together.join(holders, "e").join(frequency, "t")
        .select("e", "t", kind.alias("kind")).filter("kind IS NOT NULL")
    )
    return (
        pairs.join(judged, ["e", "t"])
        .groupBy("__pii_key", "t").agg(F.min("kind").alias("kind"))
        .groupBy("__pii_key").agg(
            F.collect_set(F.when(F.col("kind") == 4, F.col("t"))).alias("__pii_remove"),
            F.collect_set(F.when(F.col("kind") == 5, F.col("t"))).alias("__pii_generalise"),
        )
    )


def term_spans(text: Column, terms: Column, kind: int) -> Column:
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.sort_array(terms), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    return F.when(F.size(terms) > 0, places(text, pattern, kind)).otherwise(F.array().cast(SPAN))


def with_spans(found: DataFrame, texts: DataFrame) -> DataFrame:
    """``found`` with ``__pii_spans``: base spans and those of revealing terms, by start, then kind."""
    terms = stored(revealing(found, texts), "private-terms")
    extra = F.concat(term_spans(F.col("text"), F.col("__pii_remove"), 4), term_spans(F.col("text"), F.col("__pii_generalise"), 5))
    both = F.when(F.col("__pii_remove").isNotNull(), F.sort_array(F.concat("__pii_base", extra))).otherwise(F.col("__pii_base"))
    return found.join(terms, "__pii_key", "left").withColumn("__pii_spans", both).drop("__pii_remove", "__pii_generalise")


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, spans per kind, the digest of the base spans and all spans, of every row.

    Null and empty texts hold nothing; repeated rows give a row each; an empty
    table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Only texts that hold something are kept for the second look.
    kept = with_base(rows).withColumn("text", F.when(F.size("__pii_base") > 0, F.col("text")))
    found = with_spans(stored(kept, "private-spans"), rows.select("text"))
    return found.select(
        "doc_id",
        *[F.size(F.filter("__pii_base", is_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS[:4])],
        F.sha2(written(F.col("__pii_base")).cast("binary"), 256).alias("base_sha256"),
        written(F.col("__pii_spans")).alias("spans"),
    )


def replaced(text: Column, spans: Column) -> Column:
    """The text with each span replaced by a mark of its kind, removed terms by nothing."""
    marks = F.array(*[F.lit(f"<{k.upper()}>" if k != "term" else "") for k in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(sofar, s):
        fresh = s["start"] >= sofar["at"]
        more = F.concat(sofar["out"], F.substr(text, sofar["at"] + 1, s["start"] - sofar["at"]), F.element_at(marks, s["kind"] + 1))
        return F.struct(F.greatest(sofar["at"], s["end"]).alias("at"), F.when(fresh, more).otherwise(sofar["out"]).alias("out"))

    done = F.aggregate(spans, begin, add)
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(done["out"], F.substr(text, done["at"] + 1, F.char_length(text))))


def sanitised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, with personal data and revealing terms taken out of ``text``.

    Null texts stay null.
    """
    marked = stored(with_base(docs.withColumn("__pii_text", F.col("text")).withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))), "private-documents")
    out = with_spans(marked, marked.select("text")).withColumn("text", F.when(F.col("__pii_text").isNotNull(), replaced(F.col("text"), F.col("__pii_spans"))))
    return out.select(docs.columns)


def op3_pii(spark, sf_dir: str) -> DataFrame:
    return counted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
