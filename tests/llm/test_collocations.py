"""Phrases against a plain count of every phrase."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import difference, duck, type_difference

from stationflow.llm import collocations
from stationflow.llm.common import BATCH

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, most):
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        own = count[lang or "und"]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, 6):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        often = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        found = []
        for p, a in often.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def prose(rng, n):
    """Words of skewed frequency, a fixed phrase, marks and odd spaces."""
    words = [rng.choice("ab cd EF gh é 日本 x. y; z\t".split()) if rng.random() < 0.7 else f"w{rng.randint(0, 40)}" for _ in range(n)]
    for _ in range(n // 12):
        words[rng.randrange(n)] = rng.choice(["Alpha  beta\tgamma delta epsilon zeta", "one two three\nfour", "no no no no no no"])
    return " ".join(words)


@pytest.mark.parametrize(("least", "most"), [(5, 2000), (12, 7)])
def test_equals_a_plain_count(spark, least, most):
    rng = random.Random(9)
    rows = [(prose(rng, rng.randint(1, 150)), rng.choice(["en", "fr", None, "und"])) for _ in range(90)]
    rows += [("", "en"), (None, "fr"), (None, None), ("...", "de"), rows[0], rows[0], (prose(rng, 6000), "en")]
    df = spark.createDataFrame([(i // 3, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string").repartition(6)
    got = collocations.collocations(df.selectExpr("*", "lang AS phrase", "lang AS n", "lang AS shard", "lang AS a"), least, most)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, most)


def test_phrases_that_share_slots_are_counted_the_same(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(prose(rng, 60), "en") for _ in range(60)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    plain = collocations.slot
    monkeypatch.setattr(collocations, "slots_of", lambda _: collocations.BITMAP)
    monkeypatch.setattr(collocations, "slot", lambda h, slots: plain(h, slots) & 31)
    monkeypatch.setattr(collocations, "often", lambda rows, slots, f=collocations.often: f(rows.selectExpr("(h >>> 11 & 31) << 11 | h & 7 AS h"), slots))
    assert sorted(tuple(r) for r in collocations.collocations(df, 5).collect()) == brute(rows, 5, 2000)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_equals_duckdb(spark):
    con, df = duck("/root/testdata/sf0.01"), collocations.op12_collocations(spark, "/root/testdata/sf0.01")
    assert type_difference(df, con, collocations.OP12_SQL) is None
    assert difference(df, con, collocations.OP12_SQL) is None


def test_tasks_hold_small_blocks():
    """What a task's worker holds, in bytes, for texts of 6 MB whose phrases are all counted."""
    rng = random.Random(6)
    words = [f"w{k}" for k in range(30000)]
    texts = [" ".join(rng.choices(words, k=1000)) for _ in range(1000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(["en"] * 50), pa.array(texts[k : k + 50])], ["lang", "text"]) for k in range(0, 1000, 50)]
    seen = np.ones(1 << 24, bool)

    def peak(rows):
        tracemalloc.start()
        n = sum(r.num_rows for r in rows)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return n, most

    n, most = peak(collocations.counted(batches, 1, np.zeros(1 << 16, np.uint8)))
    assert n > 2_000_000
    assert most < 50e6
    n, most = peak(collocations.texts_of(batches[:4], seen, 16))
    assert n > 0
    assert most < 90e6


def test_batches_end_by_their_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(1 << 26))
        collocations.collocations(spark.createDataFrame([("a b a b", "en")], "text string, lang string"), 2).collect()
        assert spark.conf.get(key) == str(BATCH)
    finally:
        spark.conf.set(key, before)
