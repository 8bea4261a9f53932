import random

import pytest

WORDS = [a + b + c for a in ("an", "er", "th", "on") for b in ("re", "in", "", "st") for c in ("", "ed", "ing", "ou", "é")]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Copies, near copies, shared passages, periodic and empty texts, by id; None is a null text."""
    rng = random.Random(11)
    found = {k: prose(rng, rng.randint(5, 120)) for k in range(40)}
    passage = prose(rng, 60)
    for k in range(40, 46):
        found[k] = prose(rng, 20) + " " + passage + " " + prose(rng, 20)
    for k in range(46, 50):
        words = found[7].split()
        words[k % len(words)] = "changed"
        found[k] = " ".join(words)
    found |= {50: found[3], 51: found[3], 52: "", 53: None, 54: "ab" * 400, 55: "x" * 700, 56: "one two", 57: "one two"}
    found |= {58: "é" * 150 + "日本" * 80, 59: "\n".join(["same line here"] * 30), 60: " \t\n ", 61: prose(rng, 3000)}
    return found


def rows_of(texts):
    return [(k, t, "en" if k % 3 else None, "s" if k % 2 else None, len(t or "")) for k, t in texts.items()]


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def odd_docs(spark, texts):
    """Null ids, repeated rows and columns whose names operators use inside."""
    rows = [(1, texts[1], "a"), (1, texts[1], "a"), (None, texts[1], "b"), (None, None, None), (2, "", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    extra = ("score", "key", "start", "spans", "ids", "n", "a", "b", "token", "source", "kind", "x", "y", "n_chars")
    return df.selectExpr("*", *[f"lang AS {c}" for c in extra])
