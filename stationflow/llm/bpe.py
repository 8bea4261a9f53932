"""Byte-pair encoding and decoding by speculation and verification.

Distinct words are encoded once per task. Greedy longest match proposes tokens
for all words at once; a vectorised check then tests every adjacent pair. Two
neighbours are compatible if merging their bytes afresh would leave the boundary
between them: undo the merges beside the boundary, latest first, and see that at
no time a merge across it would have come before the next merge beside it. A
word of tokens that each stand for themselves, all of whose neighbours are
compatible, is encoded right; only the other words are merged exactly.

The vocabulary is a ``tokenizers`` file named by path. The driver reads it and
broadcasts its tables, whose size is that of the vocabulary.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import U, mix, ranges, record

NONE = np.int64(1 << 40)
MAX_WORDS = 400_000
LONG_WORD = 64
ROWS = 512
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d|"
# The word patterns of the two tokenizers files.
BYTE_PATTERN = CONTRACTIONS + r" ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
WORD_PATTERN = CONTRACTIONS + r"\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
WORD_END = "</w>"


class Table:
    """From uint64 keys to integers, looked up by whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.mask = (1 << max(4, int(len(keys) * 4).bit_length())) - 1
        self.keys = np.zeros(self.mask + 1, U)
        self.values = np.full(self.mask + 1, NONE, np.int64)
        self.probes = 0
        at = (mix(keys) & U(self.mask)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            self.probes += 1
            free = self.values[at[left]] == NONE
            _, first = np.unique(at[left[free]], return_index=True)
            put = left[free][first]
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & self.mask

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        """Values, NONE where there is none."""
        at = (mix(keys) & U(self.mask)).astype(np.int64)
        found = np.where(self.keys[at] == keys, self.values[at], NONE)
        for _ in range(self.probes - 1):
            miss = np.flatnonzero((found == NONE) & (self.values[at] != NONE))
            if not len(miss):
                break
            at[miss] = (at[miss] + 1) & self.mask
            found[miss] = np.where(self.keys[at[miss]] == keys[miss], self.values[at[miss]], NONE)
        return found


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable Latin-1 is itself, the rest follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Tables of a BPE vocabulary. A symbol is a byte, or 256 + byte if it ends a word with an end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        ids = model["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.word_ends = bool(model["model"]["end_of_word_suffix"])
        letters = byte_letters()
        n = max([*ids.values(), *self.specials.values()]) + 1
        spelled: dict[int, list[int]] = {}
        for token, k in ids.items():
            ends = self.word_ends and token.endswith(WORD_END)
            body = token.removesuffix(WORD_END) if ends else token
            if token in self.specials or not body or any(c not in letters for c in body):
                continue
            spelled[k] = [letters[c] for c in body]
            spelled[k][-1] += 256 * ends
        self.single = np.full(512, -1, np.int64)
        for k, s in spelled.items():
            if len(s) == 1:
                self.single[s[0]] = k
        self.rank = np.full(n, -1, np.int64)
        self.left = np.full(n, -1, np.int64)
        self.right = np.full(n, -1, np.int64)
        pairs = np.array([[ids[a], ids[b], ids[a + b]] for a, b in merges], np.int64)
        order = np.arange(len(pairs))
        self.rank[pairs[:, 2]], self.left[pairs[:, 2]], self.right[pairs[:, 2]] = order, pairs[:, 0], pairs[:, 1]
        self.made = pairs[:, 2].copy()
        self.pairs = Table(self.pair_keys(pairs[:, 0], pairs[:, 1]), order)
        # Tokens by the hash of their symbols, for the greedy match.
        self.lengths = sorted({len(s) for s in spelled.values()})
        keys, values = [], []
        for k, s in spelled.items():
            total = 0
            for x in s:
                total = (total * 0x9E3779B97F4A7C15 + x + 1) & 0xFFFFFFFFFFFFFFFF
            keys.append(total)
            values.append(k)
        self.tokens = Table(np.array(keys, U), np.array(values, np.int64))
        raw = {k: bytes(x & 255 for x in s) for k, s in spelled.items()} | {k: t.encode() for t, k in self.specials.items()}
        sizes = np.array([len(raw.get(k, b"")) for k in range(n)], np.int64)
        self.byte_start, self.byte_length = np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes
        self.bytes = np.frombuffer(b"".join(raw.get(k, b"") for k in range(n)), np.uint8)
        # Tokens that encoding their own bytes gives back.
        self.stands = np.zeros(n, bool)
        own = [k for k, s in spelled.items() if len(s) <= LONG_WORD]
        flat = np.concatenate([np.array(spelled[k], np.int64) for k in own])
        size = np.array([len(spelled[k]) for k in own])
        got, count = self.merged(flat, size)
        first = got[np.concatenate([[0], np.cumsum(count)[:-1]])]
        self.stands[np.array(own)[(count == 1) & (first == own)]] = True

    def state(self) -> dict:
        """Plain arrays and numbers, to broadcast."""
        return {k: vars(v) if isinstance(v, Table) else v for k, v in vars(self).items()}

    @classmethod
    def of(cls, state: dict) -> Vocabulary:
        made = cls.__new__(cls)
        vars(made).update(state)
        for name in ("pairs", "tokens"):
            table = Table.__new__(Table)
            vars(table).update(state[name])
            setattr(made, name, table)
        return made

    @staticmethod
    def pair_keys(a, b):
        return a.astype(U) * U(1 << 32) + b.astype(U) + U(1)

    def pair_rank(self, a, b):
        return self.pairs[self.pair_keys(a, b)]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens would stay apart."""
        good = np.ones(len(a), bool)
        left, right = a.copy(), b.copy()
        until_left, until_right = np.full(len(a), NONE), np.full(len(a), NONE)
        live = np.arange(len(a))
        while len(live):
            x, y = left[live], right[live]
            rank = self.pair_rank(x, y)
            # Of equal ranks the leftmost merge comes first.
            crossed = (rank < until_left[live]) & (rank <= until_right[live]) & (rank < NONE)
            good[live[crossed]] = False
            rank_x, rank_y = self.rank[x], self.rank[y]
            go = ~crossed & ((rank_x >= 0) | (rank_y >= 0))
            undo_left = go & (rank_x > rank_y)
            undo_right = go & ~undo_left
            k = live[undo_left]
            until_left[k], left[k] = rank_x[undo_left], self.right[x[undo_left]]
            k = live[undo_right]
            until_right[k], right[k] = rank_y[undo_right], self.left[y[undo_right]]
            live = live[go]
        return good

    def proposed(self, symbols: np.ndarray, size: np.ndarray):
        """Greedy longest match: flat ids and the number of ids per word (-1 where none matches)."""
        ends = np.cumsum(size)
        n = len(symbols)
        room = np.repeat(ends, size) - np.arange(n)
        longest, token = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        total = np.zeros(n, U)
        at = np.arange(n)
        for length in range(1, self.lengths[-1] + 1):
            at = at[room[at] >= length]
            if not len(at):
                break
            total[at] = total[at] * U(0x9E3779B97F4A7C15) + symbols[at + length - 1].astype(U) + U(1)
            found = self.tokens[total[at]]
            hit = found < NONE
            longest[at[hit]], token[at[hit]] = length, found[hit]
        place = ends - size
        live = np.flatnonzero(size > 0)
        words, ids = [], []
        while len(live):
            here = place[live]
            words.append(live)
            ids.append(token[here])
            place[live] = here + np.maximum(longest[here], 1)
            live = live[place[live] < ends[live]]
        if not words:
            return np.zeros(0, np.int64), np.zeros(len(size), np.int64)
        word = np.concatenate(words)
        order = np.argsort(word, kind="stable")
        return np.concatenate(ids)[order], np.bincount(word, minlength=len(size))

    def encoded(self, symbols: np.ndarray, size: np.ndarray):
        """Flat ids and ids per word: proposals where they hold, exact merging for the rest."""
        ids, count = self.proposed(symbols, size)
        word = np.repeat(np.arange(len(size)), count)
        bad = np.zeros(len(size), bool)
        known = (ids >= 0) & self.stands[ids]
        bad[word[~known]] = True
        inner = np.flatnonzero((word[1:] == word[:-1]) & known[1:] & known[:-1]) if len(word) else np.zeros(0, np.int64)
        keys, back = np.unique(self.pair_keys(ids[inner], ids[inner + 1]), return_inverse=True)
        a, b = ((keys - U(1)) >> U(32)).astype(np.int64), ((keys - U(1)) & U(0xFFFFFFFF)).astype(np.int64)
        bad[word[inner[~self.compatible(a, b)[back]]]] = True
        if not bad.any():
            return ids, count
        again = np.flatnonzero(bad)
        start = np.cumsum(size) - size
        exact, exact_count = self.merged(symbols[ranges(start[again], size[again])], size[again])
        both_count = count.copy()
        both_count[again] = exact_count
        out = np.empty(both_count.sum(), np.int64)
        at = np.cumsum(both_count) - both_count
        fine = ~bad
        out[ranges(at[fine], both_count[fine])] = ids[~bad[word]]
        out[ranges(at[again], exact_count)] = exact
        return out, both_count

    def merged(self, symbols: np.ndarray, size: np.ndarray):
        """Exact merging of all words at once, a merge per word and round; long words by a heap."""
        if (size > LONG_WORD).any():
            start = np.cumsum(size) - size
            long = np.flatnonzero(size > LONG_WORD)
            short = np.flatnonzero(size <= LONG_WORD)
            ids, count = self.merged(symbols[ranges(start[short], size[short])], size[short])
            lists = [self.merged_long(symbols[start[k] : start[k] + size[k]]) for k in long]
            both = np.empty(len(size), np.int64)
            both[short], both[long] = count, [len(x) for x in lists]
            at = np.cumsum(both) - both
            out = np.empty(both.sum(), np.int64)
            out[ranges(at[short], count)] = ids
            for k, x in zip(long, lists, strict=True):
                out[at[k] : at[k] + len(x)] = x
            return out, both
        ids = self.single[symbols]
        word = np.repeat(np.arange(len(size)), size)
        done_ids, done_words = [], []
        while len(ids):
            rank = np.full(len(ids), NONE)
            inner = np.flatnonzero(word[1:] == word[:-1])
            rank[inner] = self.pair_rank(ids[inner], ids[inner + 1])
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, first)
            lengths = np.diff(np.concatenate([first, [len(ids)]]))
            per = np.repeat(least, lengths)
            over = per == NONE
            done_ids.append(ids[over])
            done_words.append(word[over])
            hits = np.flatnonzero((rank == per) & ~over)
            _, leftmost = np.unique(word[hits], return_index=True)
            at = hits[leftmost]
            ids[at] = self.made[rank[at]]
            stay = ~over
            stay[at + 1] = False
            ids, word = ids[stay], word[stay]
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(len(size), np.int64)
        word = np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_ids)[order], np.bincount(word, minlength=len(size))

    def merged_long(self, symbols: np.ndarray) -> list[int]:
        """Exact merging of one long word in n log n."""
        ids = self.single[symbols].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.pair_rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, k, ids[k], ids[k + 1]) for k, r in enumerate(ranks) if r < NONE]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}
        while heap:
            r, k, a, b = heapq.heappop(heap)
            j = after[k]
            if j >= n or ids[k] != a or ids[j] != b:
                continue
            ids[k], ids[j] = int(self.made[r]), -1
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < n:
                    pair = (ids[x], ids[y])
                    if pair not in known:
                        known[pair] = int(self.pair_rank(np.array([pair[0]]), np.array([pair[1]]))[0])
                    if known[pair] < NONE:
                        heapq.heappush(heap, (known[pair], x, *pair))
        return [x for x in ids if x >= 0]

    def decoded(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        return self.bytes[ranges(self.byte_start[ids], self.byte_length[ids])].tobytes()


class Index(dict):
    """Numbers new words as they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Encoder:
    """Encodes texts, remembering the words of its task; a full memory starts anew."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.find = regex.compile(WORD_PATTERN if vocabulary.word_ends else BYTE_PATTERN).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, vocabulary.specials)) + ")").split if vocabulary.specials else None
        self.forget()

    def forget(self):
        self.index = Index()
        self.known = 0
        self.ids, self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def words(self, text: str) -> list[str]:
        if self.v.word_ends:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.find(text)

    def numbered(self, text: str) -> list[int]:
        """Words as numbers; a special token is -1 - id."""
        if self.split is None or not any(s in text for s in self.v.specials):
            return list(map(self.index.__getitem__, self.words(text)))
        out: list[int] = []
        for part in self.split(text):
            special = self.v.specials.get(part)
            out += [-1 - special] if special is not None else map(self.index.__getitem__, self.words(part))
        return out

    def learn(self):
        fresh = list(self.index)[self.known :]
        if not fresh:
            return
        raw = [w.encode() for w in fresh]
        size = np.array([len(x) for x in raw], np.int64)
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        if self.v.word_ends:
            symbols[np.cumsum(size) - 1] += 256
        ids, count = self.v.encoded(symbols, size)
        start = len(self.ids) + np.cumsum(count) - count
        self.ids, self.start, self.count = (np.concatenate(x) for x in ((self.ids, ids), (self.start, start), (self.count, count)))
        self.known = len(self.index)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.index) > MAX_WORDS:
            self.forget()
        numbered = [np.array(self.numbered(t), np.int64) for t in texts]
        self.learn()
        out = []
        for x in numbered:
            if len(x) and x.min() < 0:
                parts = [np.array([-1 - k]) if k < 0 else self.ids[self.start[k] : self.start[k] + self.count[k]] for k in x.tolist()]
                ids = np.concatenate(parts)
            else:
                ids = self.ids[ranges(self.start[x], self.count[x])]
            out.append(ids.astype("<u4"))
        return out


def coded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and the text decoded from them.

    Null texts are empty and have no ids. Repeated rows give a row each.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path).state())

    def run(batches):
        encoder = Encoder(Vocabulary.of(vocabulary.value))
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                ids = encoder.encode(part.column("text").to_pylist())
                yield record(
                    doc_id=part.column("doc_id"),
                    n_tokens=pa.array([len(x) for x in ids], pa.int64()),
                    ids=pa.array([x.tobytes() for x in ids], pa.binary()),
                    decoded=pa.array([encoder.v.decoded(x).decode("utf-8", "replace") for x in ids], pa.string()),
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = coded(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
