"""Cut points gathered while rows pass by, against Spark's own aggregate."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.operators import boosting as bo
from stationflow.operators import quantiles as qt

AT = [k / 32 for k in range(1, 32)]
KINDS = {
    "few": lambda rng, n: rng.poisson(0.3, n).astype(float),
    "many": lambda rng, n: rng.normal(size=n),
    "rising": lambda rng, n: np.arange(n) / 7,
    "falling": lambda rng, n: -np.arange(n) / 7,
    "mixed": lambda rng, n: np.where(rng.random(n) < 0.8, 0.0, rng.exponential(size=n)),
    "one": lambda rng, n: np.full(n, 3.0),
}


@pytest.mark.parametrize(("rows", "parts"), [(0, 1), (1, 1), (7, 3), (3000, 1), (9000, 4), (50000, 1), (170000, 1), (260000, 3)])
def test_equal_to_percentile_approx(spark, rows, parts):
    rng = np.random.default_rng(rows)
    columns = {k: make(rng, rows) for k, make in KINDS.items()}
    df = spark.range(0, rows, 1, parts)
    for name, values in columns.items():
        path = spark.createDataFrame([(values.tolist(),)], "v array<double>")
        df = df.crossJoin(F.broadcast(path)).selectExpr("*", f"v[int(id)] AS {name}").drop("v")
    row = df.agg(*[F.percentile_approx(c, AT, 1000).alias(c) for c in columns]).first()
    # Spark deals out a range as whole runs.
    ends = [rows * k // parts for k in range(parts + 1)]
    total = [qt.Summary.empty()] * len(columns)
    for a, b in zip(ends, ends[1:], strict=False):
        learner = qt.Learner(len(columns))
        for first in range(a, b, 7001):
            learner.add([v[first : min(b, first + 7001)] for v in columns.values()])
        total = [s.merge(qt.Summary.read(more.written())) for s, more in zip(total, learner.close(), strict=True)]
    for name, summary in zip(columns, total, strict=True):
        assert summary.quantiles(AT) == list(row[name] or []), name


def test_features_are_worked_out_once(spark):
    """Cut points come from the pass that writes the rows, in as many parts as it has, without those of "test"."""
    worked = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            worked.add(batch.num_rows)
            yield batch

    rows = [(i, "test" if i % 10 == 0 else None if i % 10 == 1 else "train", float(i * i % 977), None if i % 3 else 0.5, 1.0) for i in range(4000)]
    df = spark.createDataFrame(rows, "k int, split string, x double, y double, inNums double")
    data = bo.binned(df.mapInArrow(seen, df.schema), ["x", "y"], ["inNums"], ["k"], 32)
    assert worked.value == 4000
    row = df.fillna(0, ["y"]).filter("split <> 'test'").agg(*[F.percentile_approx(c, AT, 1000).alias(c) for c in "xy"]).first()
    cuts = {c: np.array(sorted(set(row[c]))) for c in "xy"}
    found = {}
    for b in data.blocks.toArrow().to_batches():
        for at in range(b.num_rows):
            found |= zip(bo.read(b, "kept", at).column("k").to_pylist(), bo.matrix(b, at).T.tolist(), strict=True)
    assert found == {k: [np.searchsorted(cuts["x"], x), np.searchsorted(cuts["y"], y or 0.0)] for k, _, x, y, _ in rows}


def test_distinct_values_of_a_block():
    rng = np.random.default_rng(3)
    for values in ([], [0.0, -0.0, 2.5], rng.integers(0, 9, 500) / 3, rng.integers(0, 200, 500), rng.normal(size=5000)):
        v = np.array(values, float)
        known, codes = bo.distinct(v)
        assert (known[codes] == v).all() and (np.diff(known) > 0).all() and codes.itemsize == (1 if len(known) <= 256 else 2)
