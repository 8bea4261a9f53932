"""Gradient boosting by mergeable histograms.

Features are worked out once: rows are written in blocks, each feature as its distinct
values and their numbers, and summaries of its quantiles are gathered on the way. The
numbers then become those of bins, a byte each. A pass so hands tasks whole columns
instead of values one by one. Each
tree then grows level by level, and a level is one pass over the table, for the trial that chooses
the number of trees and for the final fit at once: tasks route their rows through the trees so far, add up gradients by open leaf, feature and bin, and executors
add up the tasks' histograms, one task per leaf, and pick its best split. The driver
gets a few numbers per leaf and holds the trees. Bins are never written again, so a
lost executor costs a re-read of its share.

Over a large table only the smaller leaf of a split is added up; the driver holds the
histograms of the open leaves, whose number is that of the settings, and takes the other
leaf as the difference to the split one.

Within a level leaves are split in order of their gain until the tree has all
its leaves. Squared loss; leaf values and gains are shrunk by L1 and L2.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stationflow.operators.quantiles import Learner, Summary
from stationflow.session import stored

# Tasks get these functions by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a block at most.
ROWS = 16384
# Blocks are large rows, so a file's groups are ended by their bytes and not by the number of rows.
BLOCK_FILES = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 8, "parquet.page.size.row.check.min": 1}
# Blocks of a batch at most.
BATCH = 4
LEVELS = 12
# Tables of more rows are large.
LARGE = 1 << 20
# Neighbouring rows are added up in as many places, so that an addition need not wait for the one before.
LANES = 4
# Distinct values that are told apart one by one.
FEW = 32


@dataclass(frozen=True)
class BoostSettings:
    """Boosting parameters; fewer rounds with a larger step than a native library."""

    rounds: int = 8
    patience: int = 3
    step: float = 0.35
    depth: int = 5
    leaves: int = 31
    l1: float = 1.0
    l2: float = 2.0
    row_share: float = 0.7
    feature_share: float = 0.7
    bins: int = 32
    seed: int = 0


@dataclass
class Tree:
    """Nodes in heap order: the children of ``k`` are ``2 k + 1`` and ``2 k + 2``. A leaf has feature -1."""

    feature: np.ndarray
    split: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (1 << depth + 1) - 1
        return cls(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n))

    @cached_property
    def ends(self) -> np.ndarray:
        """The node reached by each path: a bit per depth, 1 to the right, 0 after a leaf. For trees that grow no more."""
        depth = len(self.feature).bit_length() - 1
        path, at = np.arange(1 << depth), np.zeros(1 << depth, np.int64)
        for d in range(depth):
            at = np.where(self.feature[at] >= 0, 2 * at + 1 + (path >> (depth - 1 - d) & 1), at)
        return at

    def paths(self, x: np.ndarray, seen: dict) -> np.ndarray:
        """The path of each row, a place in ``ends``; ``x`` has a row per feature.

        Rows are looked at as bits, a comparison of a column for all of them at
        once; ``seen`` keeps those for other trees on the same ``x``.
        """
        depth = len(self.feature).bit_length() - 1
        path, level = np.zeros(x.shape[1], np.uint16), {0: None}
        for d in range(depth):
            below, right = {}, None
            for node, rows in level.items():
                f, split = int(self.feature[node]), int(self.split[node])
                if f < 0:
                    continue
                if (f, split) not in seen:
                    seen[f, split] = np.packbits(x[f] > np.uint8(split))
                more = seen[f, split]
                go = more if rows is None else rows & more
                below[2 * node + 1], below[2 * node + 2] = ~more if rows is None else rows ^ go, go
                right = go if right is None else right | go
            if right is None:
                break
            path |= np.unpackbits(right, count=x.shape[1]).astype(np.uint16) << np.uint16(depth - 1 - d)
            level = below
        return path

    def nodes(self, x: np.ndarray, seen: dict) -> np.ndarray:
        """The node of each row."""
        return self.ends.take(self.paths(x, seen))


@dataclass(frozen=True)
class Model:
    """The trees of one flow, and the errors of the trial that chose their number."""

    flow: str
    base: float
    trees: tuple[Tree, ...]
    step: float
    validation_mae: tuple[float, ...] = ()

    @property
    def best_rounds(self) -> int:
        return len(self.trees)

    def predict(self, x: np.ndarray, seen: dict | None = None) -> np.ndarray:
        out, seen = np.full(x.shape[1], self.base), {} if seen is None else seen
        for tree in self.trees:
            out += (self.step * tree.value)[tree.ends].take(tree.paths(x, seen))
        return out


@dataclass(frozen=True)
class Binned:
    """A written table of blocks of rows of one ``split``.

    ``kept`` has the columns to keep and ``fit`` the flows and a row number ``i``, as
    Arrow streams; ``x`` the bin numbers, feature by feature. ``s_`` and ``n_`` with
    the place of a flow are its sum and the number of its values.
    """

    blocks: DataFrame
    features: tuple[str, ...]
    flows: tuple[str, ...]
    bins: int
    kinds: Mapping[str, str]


def quantile_edges(coded: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Up to ``bins - 1`` cut points per feature, from the summaries of all parts."""
    at = [k / bins for k in range(1, bins)]

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted((part, raw) for b in batches for part, raw in zip(b.column("part").to_pylist(), b.column("summary").to_pylist(), strict=True))
        total = Summary.empty()
        for _, raw in parts:
            total = total.merge(Summary.read(raw))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.quantiles(at)], pa.list_(pa.float64()))], ["feature", "at"])

    rows = coded.filter("feature IS NOT NULL").select("feature", "part", "summary")
    found = {r.feature: r["at"] for r in rows.groupBy("feature").applyInArrow(meet, "feature int, at array<double>").collect()}
    return {c: sorted(set(found.get(k, ()))) for k, c in enumerate(features)}


def binned(
    df: DataFrame, features: Sequence[str], flows: Sequence[str], keep: Sequence[str], bins: int, edges: Mapping[str, Sequence[float]] | None = None
) -> Binned:
    """Bin numbers of all features, nulls as 0: the number of cut points below a value.

    ``df`` has a column ``split``. Cut points are quantiles of the rows that are
    not "test", unless given. At most 127 bins. ``df`` is worked out once.
    """
    source = df.fillna(0, subset=list(features))
    values = [f"__x{k}" for k in range(len(features))]
    keep, flows = tuple(keep), tuple(flows)
    rows = source.select(
        *[F.col(c).alias(f"__k{k}") for k, c in enumerate(keep)], *[F.col(f).cast("double").alias(f) for f in flows], "split",
        F.monotonically_increasing_id().alias("i"), *[F.col(c).cast("double").alias(v) for c, v in zip(features, values, strict=True)],
    )
    kinds = {c: rows.schema[f"__k{k}"].dataType.simpleString() for k, c in enumerate(keep)}
    sums = "".join(f", s_{k} double, n_{k} long" for k in range(len(flows)))
    schema = f"split string, n int, kept binary, fit binary, distinct binary, sizes binary, x binary{sums}, feature int, part int, summary binary"
    names, learns = [c.split()[0] for c in schema.split(", ")], edges is None
    arrow = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "long": pa.int64()}
    types = [arrow[c.split()[1]] for c in schema.split(", ")]

    def row(**values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([values.get(c)], t) for c, t in zip(names, types, strict=True)], names)

    def block(part: pa.RecordBatch) -> pa.RecordBatch:
        coded = [distinct(part.column(v).to_numpy(zero_copy_only=False)) for v in values]
        own = pa.RecordBatch.from_arrays([part.column(f"__k{k}") for k in range(len(keep))], list(keep))
        totals = {}
        for k, f in enumerate(flows):
            flow = part.column(f)
            totals |= {f"s_{k}": pc.sum(flow).as_py(), f"n_{k}": len(flow) - flow.null_count}
        return row(
            split=part.column("split")[0].as_py(), n=part.num_rows, kept=streamed(own), fit=streamed(part.select([*flows, "i"])),
            distinct=b"".join(d.tobytes() for d, _ in coded), sizes=np.array([len(d) for d, _ in coded], np.int32).tobytes(), x=b"".join(c.tobytes() for _, c in coded), **totals,
        )

    def code(batches):
        learner = Learner(len(values))
        # Rows of a split wait until they fill a block.
        waiting: dict = {}
        for batch in gathered(batches):
            split = batch.column("split")
            if learns and (known := batch.filter(pc.not_equal(split, "test"))).num_rows:
                learner.add([known.column(v).to_numpy(zero_copy_only=False) for v in values])
            for value in split.unique():
                same = batch.filter(pc.equal(split, value) if value.is_valid else pc.is_null(split))
                if value.as_py() in waiting:
                    same = pa.concat_batches([waiting[value.as_py()], same])
                full = same.num_rows - same.num_rows % ROWS
                for first in range(0, full, ROWS):
                    yield block(same.slice(first, ROWS))
                waiting[value.as_py()] = pa.concat_batches([same.slice(full)])
        for rest in waiting.values():
            if rest.num_rows:
                yield block(rest)
        if learns:
            for k, summary in enumerate(learner.close()):
                yield row(feature=k, part=TaskContext.get().partitionId(), summary=summary.written())

    coded = stored(rows.mapInArrow(code, schema), "coded", BLOCK_FILES)
    edges = edges or quantile_edges(coded, features, bins)

    # No number exceeds one that is not a number.
    cuts = [np.array([e for e in edges[c] if e == e], float) for c in features]

    def number(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                n, raw = one.column("n")[0].as_py(), memoryview(one.column("x")[0].as_buffer())
                known, first, start = np.frombuffer(one.column("distinct")[0].as_buffer()), 0, 0
                x = np.empty((len(cuts), n), np.uint8)
                for own, cut, size in zip(x, cuts, np.frombuffer(one.column("sizes")[0].as_buffer(), np.int32).tolist(), strict=True):
                    codes = np.frombuffer(raw, width(size), n, start)
                    np.searchsorted(cut, known[first : first + size], "left").astype(np.uint8).take(codes, out=own)
                    first, start = first + size, start + codes.nbytes
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) if c == "x" else one.column(c) for c in last], last)

    last = ["split", "n", "kept", "fit", "x", *(f"{c}_{k}" for k in range(len(flows)) for c in "sn")]
    # A task per file, so what is written has the files, and the order, of what was read.
    with conf(df.sparkSession, "spark.sql.files.openCostInBytes", df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")):
        part = coded.filter("feature IS NULL").select(*last[:-2 * len(flows)], "distinct", "sizes", *last[-2 * len(flows):])
        blocks = stored(part.mapInArrow(number, f"split string, n int, kept binary, fit binary, x binary{sums}"), "binned", BLOCK_FILES)
    most = max(len(e) for e in edges.values()) + 1
    return Binned(blocks, tuple(features), flows, most, kinds)


@contextmanager
def conf(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the queries that are run inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def width(size: int) -> type:
    """The type of numbers below ``size``, which is no more than ``ROWS``."""
    return np.uint8 if size <= 256 else np.uint16


def distinct(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and each value's number among them."""
    known = np.sort(v)
    known = known[np.concatenate([[True], known[1:] != known[:-1]])] if len(v) else known
    if len(known) > FEW:
        known, codes = np.unique(v, return_inverse=True)
        return known, codes.astype(width(len(known)))
    codes = np.zeros(len(v), np.uint8)
    for low in known[:-1]:
        codes += v > low
    return known, codes


def streamed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read(batch: pa.RecordBatch, column: str, k: int) -> pa.RecordBatch:
    return pa.ipc.open_stream(batch.column(column)[k].as_buffer()).read_next_batch()


def matrix(batch: pa.RecordBatch, k: int) -> np.ndarray:
    """The bin numbers of a block, a row per feature."""
    return np.frombuffer(batch.column("x")[k].as_buffer(), np.uint8).reshape(-1, batch.column("n")[k].as_py())


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``ROWS`` at least, but for the last."""
    some, size = [], 0
    for batch in batches:
        some.append(batch)
        size += batch.num_rows
        if size >= ROWS:
            yield pa.concat_batches(some)
            some, size = [], 0
    if size:
        yield pa.concat_batches(some)


def chance(i: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) for each row, the same in every pass of a round."""
    x = i.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt * 2654435761 % (1 << 63))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))).astype(np.float64) / 2.0**64


def shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def best_split(sums: np.ndarray, counts: np.ndarray, s: BoostSettings, allowed: np.ndarray):
    """(gain, feature, split, left sum, left count, sum, count) of a leaf's histogram; the first of equal gains."""
    g, n = sums[0].sum(), counts[0].sum()
    left, left_n = sums.cumsum(axis=1), counts.cumsum(axis=1)

    def score(a, b):
        return shrunk(a, s.l1) ** 2 / (b + s.l2 + 1e-300)

    gain = score(left, left_n) + score(g - left, n - left_n) - score(g, n)
    gain[(left_n <= 0) | (left_n >= n) | ~allowed[:, None]] = -np.inf
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    return float(gain[f, b]), f, b, float(left[f, b]), float(left_n[f, b]), float(g), float(n)


SPLITS = "flow int, node int, gain double, feature int, split int, l double, ln double, g double, n double"


class Fit:
    """Trees of all flows, grown side by side in the same passes.

    Each group of parts has a model of every flow, the first group's come first:
    the model ``m`` is of the flow ``m % len(flows)`` and learns from the parts of
    the group ``m // len(flows)``.
    """

    def __init__(self, data: Binned, groups: Sequence[Sequence[str]], settings: BoostSettings):
        self.data, self.groups, self.s = data, [list(parts) for parts in groups], settings
        self.large = (data.blocks.agg(F.sum("n")).first()[0] or 0) > LARGE
        mean = [F.try_divide(F.sum(f"s_{k}"), F.sum(f"n_{k}")) for k in range(len(data.flows))]
        rows = [data.blocks.filter(F.col("split").isin(parts)).agg(*mean).first() for parts in self.groups]
        self.models = [Model(f, row[k] or 0.0, (), settings.step) for row in rows for k, f in enumerate(data.flows)]

    def allowed(self, k: int, turn: int) -> np.ndarray:
        """The features that a flow's tree may use."""
        n = len(self.data.features)
        rng = np.random.default_rng([self.s.seed, k, turn])
        out = np.zeros(n, bool)
        out[rng.permutation(n)[: max(1, round(self.s.feature_share * n))]] = True
        return out

    def level(self, turn: int, trees: list[Tree | None], open_nodes: list[list[int]]) -> list:
        """The best split of every open node of every flow, or of a large table the nodes' histograms; a pass over the rows."""
        bins, s, large = self.data.bins, self.s, self.large
        models, groups = self.models, self.groups
        n = len(self.data.flows)
        flows = [m.flow for m in models]
        allowed = [self.allowed(k % n, turn) for k in range(len(models))]
        added = self.added(turn)
        # The place of each feature among those, -1 for others.
        slot = [[int(np.searchsorted(a, f)) if f in a else -1 for f in range(len(self.data.features))] for a in added]
        # The place of each counted node's histogram; other nodes come last.
        places = [np.full(1 << LEVELS + 1, len(own), np.int64) for own in open_nodes]
        for own, place in zip(open_nodes, places, strict=True):
            place[own] = np.arange(len(own))

        def add(total, wide, x, rows, split):
            used = chance(rows.column("i").to_numpy(), s.seed * 7919 + turn) < s.row_share
            x = x.compress(used, axis=1)
            # All models' trees, those of earlier rounds too, look at the same rows, so they share comparisons.
            seen: dict = {}
            counted = []
            for k, own in enumerate(open_nodes):
                if not own or split not in groups[k // n]:
                    continue
                g = rows.column(flows[k]).to_numpy(zero_copy_only=False)[used]
                place = places[k][trees[k].ends].take(trees[k].paths(x, seen))
                mine = None if (inside := place < len(own)).all() else np.flatnonzero(inside)
                if mine is not None:
                    place, g = place[mine], g[mine]
                if 2 * len(g) < x.shape[1]:  # few are left to look at
                    out = models[k].predict(x.compress(inside, axis=1))
                else:
                    out = models[k].predict(x, seen)
                    out = out if mine is None else out[mine]
                counted.append((k, mine, place, g - out))
            if large:
                by_lanes(total, wide, x, counted)
                return
            counted = [(k, mine, place * bins, g) for k, mine, place, g in counted]
            for f in range(len(x)):
                column = None
                for k, mine, first, g in counted:
                    if (at := slot[k][f]) >= 0:
                        column = x[f].astype(np.int64) if column is None else column
                        code = first + (column if mine is None else column[mine])
                        total[k][0, at] += np.bincount(code, g, total[k].shape[2])
                        total[k][1, at] += np.bincount(code, minlength=total[k].shape[2])

        def by_lanes(total, wide, x, counted):
            """The same sums with neighbouring rows apart and, where it pays, two features at once."""
            for q in range(n):
                both = []
                for k, mine, place, g in counted:
                    if k % n == q and len(g):
                        two = len(open_nodes[k]) * bins * bins <= len(g)
                        size = len(open_nodes[k]) * bins * (bins if two else 1)
                        lanes = LANES if LANES * size <= len(g) else 1
                        first = place * (bins * bins if two else bins) + np.arange(len(g)) % lanes * size
                        both.append((k, mine, first, g, two, size, lanes))
                        if two and k not in wide:
                            wide[k] = np.zeros((2, -(-len(added[k]) // 2), size))
                # Models of a flow may split by the same features, and at their roots count the same rows.
                for at in range(0, len(added[q]), 2) if both else ():
                    pair, count = added[q][at : at + 2], None
                    columns = {}
                    for k, mine, first, g, two, size, lanes in both:
                        if two and "pair" not in columns:
                            columns["pair"] = (x[pair[0]] * np.uint16(bins) + x[pair[-1]]).astype(np.int64)
                        for j, f in enumerate(pair[:1] if two else pair):
                            name = "pair" if two else j
                            if name not in columns:
                                columns[name] = x[f].astype(np.int64)
                            code = first + (columns[name] if mine is None else columns[name][mine])
                            to = wide[k][:, at // 2] if two else total[k][:, at + j]
                            to[0] += np.bincount(code, g, lanes * size).reshape(lanes, size).sum(0)
                            own = count if two and open_nodes[k] == [0] else None
                            if own is None:
                                own = np.bincount(code, minlength=lanes * size).reshape(lanes, size).sum(0)
                            if two and open_nodes[k] == [0]:
                                count = own
                            to[1] += own

        def unfolded(total, wide):
            """Sums of pairs, added to those of each feature."""
            for k, sums in wide.items():
                sums = sums.reshape(2, -1, len(open_nodes[k]), bins, bins)
                m = len(added[k])
                total[k][:, 0::2] += sums.sum(4).reshape(2, -1, total[k].shape[2])
                total[k][:, 1::2] += sums.sum(3).reshape(2, -1, total[k].shape[2])[:, : m // 2]

        def partial(batches):
            total, wide = [np.zeros((2, len(added[k]), len(own) * bins)) for k, own in enumerate(open_nodes)], {}
            for batch in batches:
                for at in range(batch.num_rows):
                    add(total, wide, matrix(batch, at), read(batch, "fit", at), batch.column("split")[at].as_py())
            unfolded(total, wide)
            found = {(k, j): total[k].reshape(2, -1, len(own), bins)[:, :, at] for k, own in enumerate(open_nodes) for at, j in enumerate(own)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.int32()), pa.array([j for _, j in found], pa.int32()),
                 pa.array([h.tobytes() for h in found.values()], pa.binary())], ["flow", "node", "h"],
            )

        def summed(key: tuple, batches: Iterator[pa.RecordBatch]) -> tuple[int, int, np.ndarray]:
            k, j = (x.as_py() for x in key)
            total = np.zeros((2, len(added[k]), bins))
            for batch in batches:
                for raw in batch.column("h"):
                    total += np.frombuffer(raw.as_py()).reshape(total.shape)
            return k, j, total

        def together(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k, j, total = summed(key, batches)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([j], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["flow", "node", "h"])

        def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k, j, total = summed(key, batches)
            gain, f, *sums = best_split(total[0], total[1], s, allowed[k][added[k]])
            kinds = [f.split()[1] for f in SPLITS.split(", ")]
            types = [pa.int32() if t == "int" else pa.float64() for t in kinds]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((k, j, gain, int(added[k][f]), *sums), types, strict=True)], [f.split()[0] for f in SPLITS.split(", ")]
            )

        parts = {part for k, own in enumerate(open_nodes) if own for part in groups[k // n]}
        rows = self.data.blocks.filter(F.col("split").isin(sorted(parts))).select("split", "n", "x", "fit")
        tasks = rows.mapInArrow(partial, "flow int, node int, h binary").groupBy("flow", "node")
        # A few blocks make a batch, so that some are read while others are added up.
        with conf(self.data.blocks.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH)):
            return (tasks.applyInArrow(together, "flow int, node int, h binary") if large else tasks.applyInArrow(meet, SPLITS)).collect()

    def added(self, turn: int) -> list[np.ndarray]:
        """The features that each model adds up: only those that may split, and the first, which gives a leaf's sum."""
        allowed = [self.allowed(k % len(self.data.flows), turn) for k in range(len(self.models))]
        return [np.flatnonzero(a | (np.arange(len(a)) == 0)) for a in allowed]

    def splits(self, turn: int, trees: list[Tree | None], open_nodes: list[list[int]], smaller: list[list[int]], held: dict) -> list:
        """The best split of every open node; of a large table from ``held``, which has the histograms of the level above."""
        if not self.large:
            return self.level(turn, trees, open_nodes)
        added = self.added(turn)
        found = {(r.flow, r.node): np.frombuffer(r.h).reshape(2, len(added[r.flow]), -1) for r in self.level(turn, trees, smaller)}
        out = []
        for k, own in enumerate(open_nodes):
            for node in own:
                if (k, node) not in found and node:
                    rest = held[k, (node - 1) // 2] - found[k, (node - 1 ^ 1) + 1]
                    rest[0][rest[1] <= 0] = 0.0
                    found[k, node] = rest
        held.clear()
        held.update(found)
        for (k, node), (sums, counts) in found.items():
            gain, f, *rest = best_split(sums, counts, self.s, self.allowed(k % len(self.data.flows), turn)[added[k]])
            out.append(Row(**dict(zip([c.split()[0] for c in SPLITS.split(", ")], (k, node, gain, int(added[k][f]), *rest), strict=True))))
        return out

    def grow(self, turn: int, flows: Sequence[int]) -> None:
        """One more tree for each of the models."""
        s, n = self.s, len(self.models)
        depth = min(s.depth, LEVELS)
        trees: list[Tree | None] = [Tree.empty(depth) if k in flows else None for k in range(n)]
        open_nodes, leaves = [[0] if k in flows else [] for k in range(n)], [1] * n
        smaller, held = open_nodes, {}

        def value(g, count):
            return float(shrunk(g, s.l1) / (count + s.l2)) if count else 0.0

        for level in range(depth):
            found = self.splits(turn, trees, open_nodes, smaller, held)
            open_nodes, smaller = [[] for _ in range(n)], [[] for _ in range(n)]
            # Leaves of the largest gain first, while there is room.
            for r in sorted(found, key=lambda r: (r.flow, -r.gain, r.node)):
                tree = trees[r.flow]
                if level == 0:
                    tree.value[0] = value(r.g, r.n)
                if r.gain <= 0 or not np.isfinite(r.gain) or leaves[r.flow] >= s.leaves:
                    continue
                a = 2 * r.node + 1
                tree.feature[r.node], tree.split[r.node] = r.feature, r.split
                tree.value[a], tree.value[a + 1] = value(r.l, r.ln), value(r.g - r.l, r.n - r.ln)
                leaves[r.flow] += 1
                open_nodes[r.flow] += [a, a + 1]
                smaller[r.flow].append(a if 2 * r.ln <= r.n else a + 1)
            if not any(open_nodes):
                break
        for k in flows:
            self.models[k] = replace(self.models[k], trees=(*self.models[k].trees, trees[k]))

    def errors(self, part: str) -> list[float]:
        """The mean absolute error of the first group's model of every flow on a part."""
        df = predicted(self.data, self.models[: len(self.data.flows)], part, [])
        row = df.agg(*[F.avg(F.abs(F.col(f) - F.col(f"{f}_predicted"))) for f in self.data.flows]).first()
        return [x if x is not None else 0.0 for x in row]


def predicted(data: Binned, models: Sequence[Model], part: str, keys: Sequence[str]) -> DataFrame:
    """The rows of a part with their keys, flows and ``<flow>_predicted``."""
    rows = data.blocks.filter(F.col("split") == part).select("n", *(["kept"] if keys else []), "fit", "x")
    names = [m.flow for m in models]
    keys, flows, models = list(keys), list(data.flows), tuple(models)
    schema = ", ".join([*(f"`{c}` {data.kinds[c]}" for c in keys), *(f"`{f}` double" for f in flows), *(f"`{f}_predicted` double" for f in names)])

    def score(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                x, own = matrix(batch, at), read(batch, "fit", at).select(flows).columns
                if keys:
                    own = [*read(batch, "kept", at).select(keys).columns, *own]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(m.predict(x)) for m in models)], [*keys, *flows, *(f"{f}_predicted" for f in names)])

    return rows.mapInArrow(score, schema)


def best_round(errors: Sequence[float], patience: int) -> int:
    """The round with the least error before ``patience`` rounds bring nothing better."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def boosted(data: Binned, parts: Sequence[str], settings: BoostSettings, rounds: Sequence[int] | None = None) -> list[Model]:
    """Models of all flows after a given number of rounds each (default: all)."""
    fit = Fit(data, [parts], settings)
    rounds = list(rounds or [settings.rounds] * len(data.flows))
    for turn in range(max(rounds)):
        fit.grow(turn, [k for k, n in enumerate(rounds) if turn < n])
    return fit.models


def fitted(data: Binned, settings: BoostSettings) -> list[Model]:
    """Fit on "train", take the best round on "valid", fit on both with that many rounds.

    A round's trees of both fits grow in the same passes, so rows are read once for
    the two of them. A flow stops when its patience runs out; the final fit's trees
    past the best round are left out.
    """
    n = len(data.flows)
    fit, errors = Fit(data, [["train"], ["train", "valid"]], settings), [[] for _ in data.flows]
    for turn in range(settings.rounds):
        going = [k for k, e in enumerate(errors) if len(e) - best_round(e, settings.patience) < settings.patience] if turn else list(range(n))
        if not going:
            break
        fit.grow(turn, [*going, *(n + k for k in going)])
        for k, error in enumerate(fit.errors("valid")):
            if k in going:
                errors[k].append(error)
    rounds = [best_round(e, settings.patience) for e in errors]
    return [replace(m, trees=m.trees[:r], validation_mae=tuple(e)) for m, r, e in zip(fit.models[n:], rounds, errors, strict=True)]
