"""The mix of sources against a plain one, by sorting."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import md5

import pytest
from compare import difference, duck, type_difference

from stationflow.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string"


def brute_targets(sizes):
    """Targets of sources (in order), exactly."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        share = Fraction(total - sum(3 * sizes[s] for s in capped), sum(weight[s] for s in free) or 1)
        above = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not above:
            return {s: Fraction(3 * sizes[s]) if s in capped else weight[s] * share for s in order}
        capped |= above


def brute(rows):
    sizes, own = Counter(), defaultdict(list)
    for doc_id, text, _, source in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += size
        own[source].append((md5(f"{'' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()[:15], doc_id, size))
    out = []
    for source, target in brute_targets(sizes).items():
        whole = min(3, target // sizes[source]) if sizes[source] else 0
        left = target - whole * sizes[source] if whole < 3 else 0
        for _, doc_id, size in sorted(own[source], key=lambda x: x[0]):
            more = left > 0 and 2 * left >= size
            left = left - size if left > size else 0
            out.append((doc_id, size, sizes[source], float(target), size * (int(whole) + more)))
    return out


def canonical(rows):
    return sorted(tuple((x is None, x or 0) for x in r) for r in rows)


def made(seed, n=300):
    rng = random.Random(seed)
    sources = ["big"] * 12 + ["a", "é", "日", "z", None, "tiny"]
    text = lambda: " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 30)))
    rows = [(i, text(), "en", rng.choice(sources)) for i in range(n)]
    return rows + [(n, None, None, "a"), (n + 1, "", None, "nothing"), (None, "x y", None, None), (n + 2, "long " * 5000, None, "z")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_a_sorted_mix(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    extra = df.selectExpr("*", "lang AS size", "lang AS h", "lang AS r", "lang AS target", "lang AS bucket")
    assert canonical(tuple(r) for r in mixing.mixed(extra).collect()) == canonical(brute(rows))


def test_repeated_rows_are_taken_one_by_one(spark):
    rows = [(7, "one two three", None, "a")] * 200 + [(8, "one two", None, "b")] * 100 + [(None, "one", None, "c")] * 100
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    first, again = (sorted(tuple(r) for r in mixing.mixed(d).drop("doc_id").collect()) for d in (df, df.repartition(3)))
    assert first == again
    taken, target = Counter(), {}
    for size, source_size, goal, words in first:
        taken[source_size] += words
        target[source_size] = goal
        assert words % size == 0 and words <= 3 * size
    assert all(abs(taken[s] - target[s]) <= 1.5 for s in target)


def test_sources_of_equal_hashes(spark, monkeypatch):
    """A hash that tells no rows apart leaves the order to the rows' numbers."""
    monkeypatch.setattr(mixing.F, "md5", lambda c: mixing.F.lit("0" * 32))
    rows = [(i, "one two", None, s) for i in range(60) for s in ("a", "b", "c")]
    got = mixing.mixed(spark.createDataFrame(rows, SCHEMA).repartition(4)).toPandas()
    assert (got.groupby("target").taken.sum().to_numpy() == got.groupby("target").taken.sum().index).all()


def test_empty_table(spark):
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mixed(spark.createDataFrame([(1, "", "en", "a"), (2, None, "en", None)], SCHEMA)).count() == 2


def test_equals_duckdb(spark):
    con, df = duck("/root/testdata/sf0.01"), mixing.op13_source_mix(spark, "/root/testdata/sf0.01")
    assert type_difference(df, con, mixing.OP13_SQL) is None
    assert difference(df, con, mixing.OP13_SQL) is None
