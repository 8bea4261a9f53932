"""Nulls, repeated rows, clashing names and empty tables."""

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from stationflow.llm import bpe, fingerprints, jaccard, packing, passages, privacy, quality, rules, suffixes, toxicity  # noqa: E402

BYTES, LETTERS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")


ROWS = {
    "rules": lambda d, _: rules.judged(d),
    "bpe": lambda d, _: bpe.coded(d, BYTES),
    "fingerprints": lambda d, _: fingerprints.compared(d),
    "jaccard": lambda d, _: jaccard.joined(d),
    "passages": lambda d, _: passages.removed(d),
    "privacy": lambda d, _: privacy.counted(d),
    "quality": quality.scored,
    "suffixes": lambda d, _: suffixes.removed(d),
    "toxicity": toxicity.scored,
    "sanitised": lambda d, _: privacy.sanitised(d),
    "cut": lambda d, _: suffixes.cut_texts(d),
    "accepted": quality.accepted,
}


@pytest.mark.parametrize("name", sorted(ROWS))
def test_odd_rows(odd_docs, labels, name):
    assert ROWS[name](odd_docs, labels).count() == 5


@pytest.mark.parametrize("name", sorted(ROWS))
def test_empty_table(no_docs, labels, name):
    assert ROWS[name](no_docs, labels).count() == 0


def test_packing_of_odd_and_no_rows(odd_docs, no_docs):
    pieces = packing.packed(odd_docs, LETTERS).collect()
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)
    assert sum(r.start == 0 for r in pieces) == 5
    assert packing.packed(no_docs, LETTERS).count() == 0


def test_one_of_each_keeps_columns_and_one_row(odd_docs):
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    found = sorted((r.doc_id is None, bool(r.text)) for r in kept.collect())
    assert found == [(False, False), (False, True), (True, False), (True, True)]
