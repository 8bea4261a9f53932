"""Operators whose results are fixed: each against a brute-force version."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from stationflow.llm import bpe, fingerprints, jaccard, packing, passages, rules, suffixes  # noqa: E402
from stationflow.llm.common import BATCH, counters, level_of, prefixes, spans_hash  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTES, LETTERS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_rule_counts(docs, texts):
    got = by_id(rules.judged(docs))
    assert set(got) == set(texts)
    for k, text in texts.items():
        words = WORD.findall(text or "")
        seen = Counter(zip(words, words[1:], words[2:], strict=False))
        repeated = {j for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if seen[w] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (r.kept and r.base_failed)


def test_quantile_sketch_is_within_its_accuracy(spark):
    rows = spark.range(1, 5001).selectExpr(
        "'' AS lang", "'' AS source", "1000L AS n_words", "id AS word_chars", "0L AS n_symbols", "1L AS n_lines", "0L AS n_dup_lines", "0L AS n_repeat_words"
    )
    got = {r.measure: r for r in rules.quantiles(rules.sketches(rows), {"q50": 0.5}).collect()}
    assert got["length"].q50 == pytest.approx(2.5, rel=2 * rules.ACCURACY)
    assert got["symbols"].q50 == 0


def brute_cutoff(values):
    """Halfway from the median to the tail, or four quartile widths, from the sorted values."""
    values = sorted(values)
    q50, q75, tail = (values[int(np.ceil(q * len(values))) - 1] for q in (0.5, 0.75, 0.99))
    return max(q50 + 4 * (q75 - q50), (q50 + tail) / 2) if tail > q50 else np.inf


def test_cutoffs_follow_their_group(spark):
    """The same text passes in a source full of symbols and fails in a plain one; few texts take the cutoff of their language."""
    rng = np.random.default_rng(6)
    share = {"code": 0.2, "plain": 0.002, "rare": 0.002}
    rows = []
    for source, n in (("code", 600), ("plain", 600), ("rare", 40)):
        for _ in range(n):
            marks = rng.poisson(500 * share[source] * (1 if rng.random() > 0.02 else 12))
            rows.append((len(rows), " ".join([f"{len(rows)}x{i}abc" for i in range(100)]) + " " + "#" * marks, "en", source))
    rows += [(-1, rows[0][1] + "#" * 60, "en", "code"), (-2, rows[0][1] + "#" * 60, "en", "plain")]
    got = rules.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).toPandas()
    ratio = got.n_symbols / got.word_chars
    by = {s: brute_cutoff(ratio[got.source == s]) for s in ("code", "plain")} | {"rare": brute_cutoff(ratio)}
    kept = got.set_index("doc_id").kept
    for source, cutoff in by.items():
        mine = got[got.source == source]
        assert mine.max_symbols.iloc[0] == pytest.approx(cutoff, rel=0.03)
        sure = (ratio[mine.index] / cutoff - 1).abs() > 0.05
        lengths = mine.word_chars / mine.n_words
        fits = (ratio[mine.index] <= cutoff) & (mine.max_length.isna() | (lengths <= mine.max_length))
        assert (mine.kept == fits)[sure].all() and not mine.base_failed.any()
    assert kept[-1] and not kept[-2]


@pytest.mark.parametrize("path", [BYTES, LETTERS])
def test_ids_equal_the_tokenizers(docs, texts, path):
    reference = Tokenizer.from_file(path)
    reference.no_truncation()
    reference.no_padding()
    for k, r in by_id(bpe.coded(docs, path)).items():
        want = reference.encode(texts[k] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        if path == BYTES:
            assert r.decoded == reference.decode(want, skip_special_tokens=False) == (texts[k] or "")


def test_special_strings_and_odd_spaces():
    reference = Tokenizer.from_file(BYTES)
    encoder = bpe.Encoder(bpe.Vocabulary(BYTES))
    odd = ["a\x1cb  c", "don't<|endoftext|>we'LL", "   \n\n x", "​日本語 😀", "1234 ½²"]
    for text, ids in zip(odd, encoder.encode(odd), strict=True):
        assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids


def test_compatible_pairs_are_those_that_merging_leaves():
    v = bpe.Vocabulary(BYTES)
    rng = np.random.default_rng(3)
    own = np.flatnonzero(v.stands)
    a, b = rng.choice(own, 3000), rng.choice(own, 3000)
    for x, y, good in zip(a, b, v.compatible(a, b), strict=True):
        raw = v.decoded(np.array([x, y]))
        ids, _ = v.merged(np.frombuffer(raw, np.uint8).astype(np.int64), np.array([len(raw)]))
        assert good == (ids.tolist() == [x, y])


def test_packing_loses_nothing(docs, texts):
    reference = Tokenizer.from_file(LETTERS)
    pieces = packing.digested(packing.packed(docs, LETTERS)).toPandas()
    for k, own in pieces.sort_values(["doc_id", "start"]).groupby("doc_id"):
        ids = np.array([*reference.encode(texts[k] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in own.itertuples():
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert set(pieces.doc_id) == set(texts)
    short = 0
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        ends = own.length.cumsum()
        assert own.offset.tolist() == [0, *ends[:-1]] and ends.iloc[-1] <= 2048
        short += ends.iloc[-1] not in packing.TIERS
    assert short <= 3  # one per task


def test_fingerprints(docs, texts):
    got = by_id(fingerprints.compared(docs))
    order = sorted(texts, reverse=True)
    for i, k in enumerate(order):
        text, following = texts[k] or "", texts[order[(i + 1) % len(order)]] or ""
        edited = fingerprints.edited(text, following)
        own, other, after = fingerprints.fingerprints([text, edited, following])
        r = got[k]
        assert r.edited_sha256 == sha256(edited.encode()).hexdigest() and r.n_chars == len(text)
        assert r.fingerprint == fingerprints.written(own) and r.edited_fingerprint == fingerprints.written(other)
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(own, other), fingerprints.likeness(own, after))
    assert got[50].fingerprint == got[3].fingerprint


def test_fingerprints_of_short_texts_keep_what_an_edit_keeps(docs, texts):
    """Half of every text stays; from 300 characters on some chunk of it is found again."""
    got = by_id(fingerprints.compared(docs))
    long_enough = [k for k, t in texts.items() if len(t or "") >= 300 and len(set(t)) > 2]
    assert len(long_enough) > 20
    assert all(got[k].near_edited > 0 for k in long_enough)


def brute_components(texts, width, percent):
    sets = {}
    for k, text in texts.items():
        words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[k] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    component = {k: k for k in texts}
    for a in texts:
        for b in texts:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]) and component[a] != component[b]:
                old, new = max(component[a], component[b]), min(component[a], component[b])
                component = {k: new if c == old else c for k, c in component.items()}
    return {k: (len(sets[k]), component[k]) for k in texts}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_components(docs, texts, width, percent):
    got = {k: (r.n_shingles, r.component_id) for k, r in by_id(jaccard.joined(docs, width, percent)).items()}
    assert got == brute_components(texts, width, percent)


def test_components_of_null_ids(spark, texts):
    """Every text of a null id is by itself: near copies of others join them, unlike ones do not."""
    nulls = [texts[46], texts[61], texts[61], texts[61] + " more", texts[9], "", None]
    rows = [(k, texts[k]) for k in (7, 46, 47, 9, 52)] + [(None, t) for t in nulls]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.n_shingles, r.component_id or 0, r.doc_id or 0) for r in jaccard.joined(docs, 3, 80).collect()))
    want = brute_components({k if k is not None else 1000 + n: t for n, (k, t) in enumerate(rows)}, 3, 80)
    assert got == sorted((n, c if c < 1000 else 0, k if k < 1000 else 0) for k, (n, c) in want.items())


@pytest.mark.parametrize("known", [None, {1: 1, 2: 1}])
def test_entries_are_labelled_by_class(spark, known):
    rows = [(t, rep, 9, 1) for rep in (1, 2, 3) for t in (10 * rep, 5)]
    found = known and spark.createDataFrame(list(known.items()), "id long, component long")
    got = jaccard.labelled(spark.createDataFrame(rows, "token long, rep long, n int, l int"), found)
    assert sorted((r.token, r.rep, r.component) for r in got.collect()) == sorted((t, rep, (known or {}).get(rep, rep)) for t, rep, _, _ in rows)


def test_shared_shingles_are_found_without_a_join(spark):
    """The entries of shingles with several components, from one window: no rows are joined to their own groups."""
    rows = [(1, 1, 1), (1, 2, 1), (2, 1, 1), (2, 3, 3), (2, 3, 3), (3, 4, 4)]
    got = jaccard.mixed(spark.createDataFrame(rows, "token long, rep long, component long"))
    assert sorted(tuple(r) for r in got.collect()) == [(2, 1, 1, 3), (2, 3, 3, 3), (2, 3, 3, 3)]
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def brute_repeats(texts):
    seen, out = set(), {}
    for k in sorted(texts):
        raw = (texts[k] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\x01" * 100
            seen.add(raw[i : i + 100])
        out[k] = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
    return out


@pytest.mark.parametrize("hot", [20_000, 2])
def test_repeated_strings(docs, texts, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_MOST", hot)
    got = by_id(suffixes.removed(docs))
    want = brute_repeats(texts)
    for k, r in got.items():
        assert bytes(r.kept) == want[k]
        assert r.n_removed == r.n_bytes - len(want[k]) == sum(s.end - s.start for s in r.spans)
    assert set(got) == set(texts)


def test_suffix_array_orders_wanted_suffixes():
    rng = np.random.default_rng(5)
    text = np.concatenate([rng.integers(1, 4, 900), [0]]).astype(np.uint8)
    wanted = np.arange(901) <= 800
    got = suffixes.suffix_array(text, suffixes.eights(text), wanted)
    assert got.tolist() == sorted(range(801), key=lambda i: text[i:].tobytes())


def test_only_windows_that_come_twice_are_sorted(monkeypatch):
    """Pieces without a repeat are left out before the sort, the rest gives the repeats of all."""
    rng, asked, sort = np.random.default_rng(7), [], suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda text, keys, wanted: asked.append((len(text), wanted.sum())) or sort(text, keys, wanted))
    same = bytes(rng.integers(97, 123, 150, dtype=np.uint8))
    alone = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in (100, 260, 3000)]
    # Documents 9, null (largest) and 9's other text; a piece of its own that repeats itself.
    contents = [alone[0], same, alone[1], b"q" * 130, same + b"z", alone[2]]
    ids, twins = np.array([5, suffixes.NO_ID, 1, 4, 9, 9]), np.array([0, 0, 0, 0, 3, -3])
    owner, first, last = suffixes.repeated(contents, ids, twins, np.array([0, 40, 0, 7, 10, 0]))
    assert sorted(zip(owner.tolist(), first.tolist(), last.tolist(), strict=True)) == [(1, 0, 50), (3, 1, 30)]
    (size, wanted), = asked
    assert size == 151 + 131 + 152 and wanted == 51 + 31 + 51
    assert len(suffixes.repeated(alone, ids[:3], twins[:3], np.zeros(3, np.int64))[0]) == 0


def test_batches_end_by_their_bytes(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 26))
        suffixes.removed(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(BATCH)
        # 100 texts of 1 MB: one batch by number.
        sizes = spark.range(0, 100, 1, 1).selectExpr("repeat('x', 1000000) AS text").mapInArrow(
            lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect()
        assert max(r.n for r in sizes) <= 8
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)


def test_chunk_repeats(docs, texts):
    got = by_id(passages.removed(docs))
    assert set(got) == set(texts)
    for k, r in got.items():
        raw = (texts[k] or "").encode()
        spans = [tuple(map(int, s.split(":"))) for s in r.spans.split(",") if s]
        kept = b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(raw)], strict=True))
        assert kept.decode() == r.text and r.kept_sha256 == sha256(kept).hexdigest()
    assert got[51].text == "" and got[3].n_removed == 0
    assert all(got[k].n_removed > 150 for k in range(41, 46)) and got[40].n_removed == 0


@pytest.fixture(scope="module")
def shared_ids(spark, texts):
    """Several texts of one id and of none, some alike, some not, and equal rows."""
    alone = ["日本é " * 60 + str(k) + " unlike any other " * 3 + "ü" * k for k in range(3)]
    rows = [(7, texts[41]), (7, texts[42]), (7, "é" + texts[5]), (None, texts[43]), (None, alone[0]), (None, texts[41]), (None, texts[41])]
    rows += [(3, alone[1]), (3, alone[1]), (3, None), (None, None), (None, alone[2] + texts[61])]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def documents_in_order(df):
    """(id, text) of every document, those of one id by the hash of their text."""
    rows = df.selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS twin").distinct().collect()
    return [(r.doc_id, r.text) for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.twin))]


def test_repeated_strings_of_shared_ids(shared_ids):
    order = documents_in_order(shared_ids)
    want = brute_repeats({k: text for k, (_, text) in enumerate(order)})
    kept = {(i, t): want[k] for k, (i, t) in enumerate(order)}
    rows = [(r.doc_id, r.text or "") for r in shared_ids.collect()]
    got = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.kept)) for r in suffixes.removed(shared_ids).collect())
    assert got == sorted((i is None, i or 0, kept[i, t]) for i, t in rows)
    cut = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in suffixes.cut_texts(shared_ids).collect())
    assert [(a, b) for a, b, _ in cut] == [(a, b) for a, b, _ in got]
    assert sum("unlike any other" in t for _, _, t in cut) == sum("unlike any other" in t for _, t in rows)


def test_chunk_repeats_of_shared_ids(shared_ids):
    """No chunk is lost: every chunk of the input is left in some document, or lies in a run of repeats."""
    got = passages.removed(shared_ids).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r.doc_id is None, r.doc_id or 0) for r in shared_ids.collect())
    assert sum("unlike any other" in r.text for r in got) == sum("unlike any other" in (r.text or "") for r in shared_ids.collect())


def brute_chunks(order):
    """Texts without runs of 80 bytes or more of chunks that were seen before, chunked one by one."""
    seen, out = set(), []
    for text in order:
        raw = np.frombuffer(text.encode(), np.uint8)
        start, end, _ = passages.chunks(raw, np.array([0, len(raw)]), passages.CHUNKING) if len(raw) else ([], [], [])
        gone = []
        for a, b in zip(start, end, strict=True):
            piece = raw[a:b].tobytes()
            gone.append((a, b, piece in seen))
            seen.add(piece)
        runs, kept = [], b""
        for a, b, again in gone:
            if again and runs and runs[-1][2] and runs[-1][1] == a:
                runs[-1][1] = b
            else:
                runs.append([a, b, again])
        for a, b, again in runs:
            if not again or b - a < 80:
                kept += raw[a:b].tobytes()
        out.append(kept)
    return out


def test_chunk_repeats_equal_a_plain_scan(docs, texts, shared_ids):
    got = by_id(passages.removed(docs))
    for k, kept in zip(sorted(texts), brute_chunks([texts[k] or "" for k in sorted(texts)]), strict=True):
        assert got[k].text.encode() == kept
    order = documents_in_order(shared_ids)
    kept = dict(zip(order, brute_chunks([t for _, t in order]), strict=True))
    rows = sorted((r.doc_id is None, r.doc_id or 0, kept[r.doc_id, r.text or ""]) for r in shared_ids.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text.encode()) for r in passages.removed(shared_ids).collect()) == rows


def test_window_keys_are_least_substrings():
    """Runs of windows by their least substring's hash, counted from every window of every text."""
    rng = np.random.default_rng(4)
    width = suffixes.LENGTH - suffixes.GRAM + 1
    for letters, period in ((2, 0), (3, 7), (4, 45), (26, 0), (1, 1)):
        sizes = np.array([0, 99, 100, 101, 400, 30, 177])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = rng.integers(97, 97 + letters, offsets[-1]).astype(np.uint8)
        data = np.resize(data[:period], len(data)) if period else data
        sums = prefixes(data)
        at = np.arange(len(data) - suffixes.GRAM + 1)
        grams = spans_hash(sums, at, at + suffixes.GRAM)
        want = []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            keys = [grams[i : i + width].min() for i in range(a, b - suffixes.LENGTH + 1)]
            edges = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]] + [len(keys)]
            for k, end in zip(edges[:-1], edges[1:], strict=True):
                hits = (grams[a + k : a + end + width - 1] == keys[k]).sum()
                want.append((keys[k], a + k, end - k, hits > 1))
        assert list(zip(*suffixes.window_keys(data, offsets), strict=True)) == want


def test_sketch_levels(spark):
    """Levels of counts by place, whether tasks send all counters of a slice or few."""
    for width, each in ((1 << 14, 40_000), (1 << 14, 50), (1 << 16, 3_000)):
        rows = spark.range(each, numPartitions=3)
        levels = counters(rows, ["id"], lambda batch: iter([batch.column(0).to_numpy().astype(np.uint64)]), width)
        seen = np.bincount(np.arange(each) % width, minlength=width)
        want = np.where(seen > 0, 1 + np.floor(np.log2(np.maximum(seen, 1))), 0)
        assert (level_of(levels, np.arange(width, dtype=np.uint64)) == want).all()
    assert jaccard.sketch_size(0) == jaccard.SKETCH[0] and jaccard.sketch_size(10**12) == jaccard.SKETCH[1]
    assert jaccard.sketch_size(1 << 20) == 1 << 20 and jaccard.sketch_size((1 << 20) + 1) == 1 << 21
