"""Boosted trees and station vectors: known functions, plain versions, errors against a naive forecast."""

import numpy as np
import pytest

from stationflow.operators import boosting as bo
from stationflow.operators import forecast as fc
from stationflow.operators import model as md
from stationflow.plans import fixture as fx
from stationflow.plans import models
from stationflow.plans.fixture import PLAN, Fixture

QUICK = md.BoostSettings(rounds=3, depth=3, patience=2)


def test_best_round_stops_when_patience_runs_out():
    errors = [5.0, 4.0, 4.5, 4.4, 4.3, 1.0]
    assert bo.best_round(errors, patience=2) == 2
    assert bo.best_round(errors, patience=10) == 6
    assert bo.best_round([1.0], patience=1) == 1


def test_minute_model(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    forecast, results = models.minute_model(
        f.slots(), f.stations(), f.template(), PLAN.workdays(),
        fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET, closed=(1,), settings=QUICK,
    )
    rows = forecast.toPandas()
    assert len(rows) == f.template().count()
    assert (rows[["inNums", "outNums"]] >= 0).all().all()
    assert rows[rows.stationID == 1][["inNums", "outNums"]].to_numpy().sum() == 0
    for r in results:
        assert 1 <= r.best_rounds <= QUICK.rounds
        assert r.validation_mae[r.best_rounds - 1] == min(r.validation_mae[: r.best_rounds])
    actual = f.same_as(fx.WEEKDAY_TARGET, fx.WEEKDAY_TARGET).fillna(0.0)
    for other in (forecast, f.weekday_rule(), f.same_as(fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET).fillna(0.0)):
        mae = fc.absolute_error(actual, other, fc.TEMPLATE_KEYS).first()
        assert 0 <= mae.inNums_mae < 1e6 and mae.n == len(rows)


def test_the_minute_model_beats_the_day_before(spark):
    """At production settings, on the given tables: nearer than yesterday's flows, and at their level."""
    f = Fixture(spark, "/root/testdata/sf0.01")
    forecast, results = models.minute_model(
        f.slots(), f.stations(), f.template(), PLAN.workdays(), fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET, closed=()
    )
    actual = f.same_as(fx.WEEKDAY_TARGET, fx.WEEKDAY_TARGET).fillna(0.0)
    naive = f.same_as(fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET).fillna(0.0)
    mine, other = (fc.absolute_error(actual, x, fc.TEMPLATE_KEYS).first() for x in (forecast, naive))
    assert mine.inNums_mae < other.inNums_mae and mine.outNums_mae < other.outNums_mae
    both = actual.join(forecast.withColumnsRenamed({"inNums": "x", "outNums": "y"}), list(fc.TEMPLATE_KEYS))
    # The given taps fall at random, so there is no more to learn than the level; zeros for all miss that.
    level = both.selectExpr("avg(x) / avg(inNums) AS x", "avg(y) / avg(outNums) AS y").first()
    assert 0.5 < level.x < 2 and 0.5 < level.y < 2
    for r in results:
        assert r.validation_mae[r.best_rounds - 1] == min(r.validation_mae)


def stepped(spark, n=600):
    rows = [(i, "valid" if i % 5 == 0 else "train", i % 7, i % 3, float((10 if i % 7 > 3 else 2) + (4 if i % 7 > 3 and i % 3 == 1 else 0))) for i in range(n)]
    return spark.createDataFrame(rows, "k int, split string, x int, z int, inNums double").repartition(3)


def test_boosting_learns_a_step(spark):
    """Levels told apart by two features together: the trees must find them."""
    data = bo.binned(stepped(spark), ["x", "z"], ["inNums"], ["k"], bins=16)
    settings = bo.BoostSettings(rounds=20, patience=20, step=0.5, depth=3, l1=0, l2=0, row_share=1, feature_share=1)
    (model,) = bo.fitted(data, settings)
    got = bo.predicted(data, [model], "valid", ["k"]).toPandas()
    assert np.abs(got.inNums_predicted - got.inNums).max() < 0.1
    assert list(model.validation_mae) == sorted(model.validation_mae, reverse=True)


def plain_tree(x, g, s):
    """A tree grown level by level, best leaves first, over all splits: (leaf of each row, value of each leaf)."""
    shrunk = lambda v: np.sign(v) * max(abs(v) - s.l1, 0)
    score = lambda rows: shrunk(g[rows].sum()) ** 2 / (len(rows) + s.l2)
    leaves = level = [np.arange(len(x))]
    for _ in range(s.depth):
        found = []
        for rows in level:
            best = (0, None)
            for f in range(x.shape[1]):
                for v in np.unique(x[rows, f])[:-1]:
                    a, b = rows[x[rows, f] <= v], rows[x[rows, f] > v]
                    gain = score(a) + score(b) - score(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, (a, b))
            found.append((best[0], rows, best[1]))
        level = []
        for _, rows, split in sorted(found, key=lambda t: -t[0]):
            if split is not None and len(leaves) < s.leaves:
                leaves = [leaf for leaf in leaves if leaf is not rows] + list(split)
                level += split
    out = np.zeros(len(x))
    for rows in leaves:
        out[rows] = shrunk(g[rows].sum()) / (len(rows) + s.l2)
    return out


@pytest.mark.parametrize(("depth", "leaves", "l1", "l2"), [(1, 2, 1.0, 2.0), (3, 8, 0.0, 0.0), (4, 5, 0.5, 1.0)])
def test_trees_equal_plain_ones(spark, depth, leaves, l1, l2):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 6, (300, 4))
    y = np.where(x[:, 0] > 2, 3.0, 0) + np.where(x[:, 1] * x[:, 2] > 6, 2.0, 0) + rng.normal(size=300)
    settings = bo.BoostSettings(rounds=3, step=0.5, depth=depth, leaves=leaves, l1=l1, l2=l2, row_share=1, feature_share=1)
    rows = [(i, "train", *map(int, a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "k int, split string, a int, b int, c int, d int, inNums double").repartition(4)
    data = bo.binned(df, ["a", "b", "c", "d"], ["inNums"], ["k"], 8, dict.fromkeys("abcd", range(5)))
    got = bo.predicted(data, bo.boosted(data, ["train"], settings), "train", ["k"]).toPandas().sort_values("k")
    want = np.full(300, y.mean())
    for _ in range(3):
        want = want + 0.5 * plain_tree(x, y - want, settings)
    assert got.inNums_predicted.to_numpy() == pytest.approx(want, abs=1e-9)


def test_rows_are_written_in_blocks(spark):
    """A pass hands tasks a few large rows: one for each task and split here."""
    data = bo.binned(stepped(spark), ["x", "z"], ["inNums"], ["k"], bins=16)
    assert data.blocks.count() <= 3 * 2 and data.blocks.agg({"n": "sum"}).first()[0] == 600


def test_rows_find_their_leaves():
    """Routing by bits, against a walk down the tree for each row."""
    rng = np.random.default_rng(1)
    for depth in (1, 3, 6, 8):
        for rows in (0, 1, 9, 200):
            x, tree = rng.integers(0, 32, (5, rows)).astype(np.uint8), bo.Tree.empty(depth)
            for n in range((1 << depth) - 1):
                if (n == 0 or tree.feature[(n - 1) // 2] >= 0) and rng.random() < 0.8:
                    tree.feature[n], tree.split[n] = rng.integers(5), rng.integers(0, 31)
            want = []
            for row in x.T:
                at = 0
                while tree.feature[at] >= 0:
                    at = 2 * at + 1 + (row[tree.feature[at]] > tree.split[at])
                want.append(at)
            assert tree.nodes(x, {}).tolist() == want


def test_blocks_keep_keys_and_unknown_splits(spark):
    """Keys of any type and rows of no split stay apart; nulls and numbers that are none find their bins."""
    rows = [(None, "b", "test", 1.0), (2, None, "test", float("nan")), (3, "c", None, 2.0), (4, "d", "train", 5.0), (5, "e", "train", None)]
    df = spark.createDataFrame([(*r, 7.0) for r in rows], "k int, w string, split string, x double, inNums double").coalesce(1)
    data = bo.binned(df, ["x"], ["inNums"], ["k", "w"], 4, {"x": [0.5, 3.0]})
    models = [bo.Model("inNums", 0.0, (bo.Tree(np.array([0, -1, -1]), np.array([0, 0, 0]), np.array([0.0, 1.0, 2.0])),), 1.0)]
    got = {tuple(r) for part in ("test", "train") for r in bo.predicted(data, models, part, ["w", "k"]).collect()}
    assert got == {("b", None, 7.0, 2.0), (None, 2, 7.0, 1.0), ("d", 4, 7.0, 2.0), ("e", 5, 7.0, 1.0)}


def test_no_rows_to_train_on(spark):
    data = bo.binned(stepped(spark).filter("split = 'valid'"), ["x", "z"], ["inNums"], ["k"], bins=4)
    got = bo.predicted(data, bo.boosted(data, ["train"], QUICK), "valid", ["k"])
    assert {r.inNums_predicted for r in got.collect()} == {0.0}


def test_peak_and_day_before_models(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    peak, _ = models.peak_model(
        f.slots(), f.stations(), PLAN.workdays(), fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET, (1,), fx.PEAK, QUICK
    )
    rows = peak.toPandas()
    assert set(rows.hour) == set(fx.PEAK) and set(rows.stationID) == {0}
    assert len(rows) == 5 * 6
    before, _ = models.day_before_model(
        f.slots(), f.stations(), f.template(), PLAN.workdays(),
        fx.WEEKDAY_SOURCE, fx.WEEKDAY_TARGET, "zero", settings=QUICK,
    )
    assert before.filter("inNums IS NULL OR inNums < 0").count() == 0


def test_station_vectors(spark):
    """Neighbours on a line lie nearer than stations of other lines and of the far end; the same on every run."""
    rows = [(s, s // 20, s % 20) for s in range(60)] + [(99, 7, 0)]
    stations = spark.createDataFrame(rows, "stationID int, lineID int, linePos int")
    got = md.station_vectors(stations).toPandas().set_index("stationID").sort_index()
    again = md.station_vectors(stations.repartition(3)).toPandas().set_index("stationID").sort_index()
    assert np.abs(got.to_numpy() - again.to_numpy()).max() < 1e-12
    assert sorted(got.index) == [*range(60), 99] and (got.loc[99] == 0).all()
    v = got.loc[:59].to_numpy()
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T
    line = np.arange(60) // 20
    beside = np.mean([near[i, i + 1] for i in range(59) if line[i] == line[i + 1]])
    far = np.mean([near[i, j] for i in range(60) for j in range(60) if line[i] == line[j] and abs(i - j) > 14])
    others = np.mean([near[i, j] for i in range(60) for j in range(60) if line[i] != line[j]])
    assert beside > 0.8 and beside > far + 0.2 and beside > others + 0.4


def test_line_neighbours_count_every_line(spark):
    rows = [(1, 0, 0), (2, 0, 1), (3, 0, 2), (1, 1, 0), (3, 1, 1)]
    stations = spark.createDataFrame(rows, "stationID int, lineID int, linePos int")
    got = {(r.stationID, r.otherID): r.n for r in md.line_neighbours(stations, 1).collect()}
    assert got == {(1, 2): 1, (2, 1): 1, (2, 3): 1, (3, 2): 1, (1, 3): 1, (3, 1): 1}
    weights = {(r.stationID, r.otherID): r.p for r in md.line_weights(md.line_neighbours(stations, 1)).collect()}
    assert sum(p for (a, _), p in weights.items() if a == 2) == pytest.approx(1)


def test_trial_and_final_fit_share_their_passes(spark, monkeypatch):
    """Trees as those of two fits one after the other, in no more passes than the trial needs."""
    df = stepped(spark).selectExpr("*", "inNums * 0.5 + x % 3 AS outNums")
    data = bo.binned(df, ["x", "z"], ["inNums", "outNums"], ["k"], bins=16)
    settings = bo.BoostSettings(rounds=6, patience=1, step=0.9, depth=3, row_share=0.8, feature_share=0.5)
    passes, level = [], bo.Fit.level
    monkeypatch.setattr(bo.Fit, "level", lambda self, turn, *rest: passes.append(turn) or level(self, turn, *rest))
    got = bo.fitted(data, settings)
    turns = max(len(m.validation_mae) for m in got)
    assert len(passes) <= turns * settings.depth and set(passes) == set(range(turns))
    want = bo.boosted(data, ["train", "valid"], settings, [m.best_rounds for m in got])
    trial = bo.boosted(data, ["train"], settings, [m.best_rounds for m in got])
    for m, w, t in zip(got, want, trial, strict=True):
        assert m.best_rounds == bo.best_round(m.validation_mae, 1) and m.base == w.base != t.base
        for one, other in zip(m.trees, w.trees, strict=True):
            assert (one.feature == other.feature).all() and (one.split == other.split).all()
            assert np.allclose(one.value, other.value, rtol=1e-12)
    best = bo.predicted(data, trial, "valid", ["k"]).selectExpr("avg(abs(inNums - inNums_predicted)) AS i", "avg(abs(outNums - outNums_predicted)) AS o").first()
    assert [min(m.validation_mae[: m.best_rounds]) for m in got] == pytest.approx([best.i, best.o])


@pytest.mark.parametrize(("depth", "leaves", "bins", "n"), [(3, 8, 8, 700), (5, 12, 8, 700), (4, 31, 4, 3000)])
def test_large_tables_grow_the_same_trees(spark, monkeypatch, depth, leaves, bins, n):
    """Only smaller leaves added up, by pairs of features or alone: the trees of the plain sums, in as many passes."""
    rng = np.random.default_rng(n + depth)
    x = rng.integers(0, bins, (n, 5))
    y = np.where(x[:, 0] > 2, 3.0, 0) + np.where(x[:, 1] * x[:, 2] > 4, 2.0, 0) + rng.normal(size=n)
    z = x[:, 3] * 0.7 + rng.normal(size=n)
    rows = [(i, "valid" if i % 4 == 0 else "train", *map(int, a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, z, strict=True))]
    df = spark.createDataFrame(rows, "k int, split string, a int, b int, c int, d int, e int, inNums double, outNums double").repartition(3)
    data = bo.binned(df, list("abcde"), ["inNums", "outNums"], ["k"], bins, dict.fromkeys("abcde", range(bins - 1)))
    settings = bo.BoostSettings(rounds=2, step=0.5, depth=depth, leaves=leaves, row_share=0.9, feature_share=0.8)
    want, counted, level = bo.fitted(data, settings), [], bo.Fit.level
    monkeypatch.setattr(bo, "LARGE", 0)
    monkeypatch.setattr(bo.Fit, "level", lambda self, turn, trees, nodes: counted.append(nodes) or level(self, turn, trees, nodes))
    got = bo.fitted(data, settings)
    # No two leaves of a split are added up.
    assert all(len({(node - 1) // 2 for node in own}) == len(own) for nodes in counted for own in nodes)
    for m, w in zip(got, want, strict=True):
        assert m.best_rounds == w.best_rounds and m.validation_mae == pytest.approx(w.validation_mae)
        for one, other in zip(m.trees, w.trees, strict=True):
            assert (one.feature == other.feature).all() and (one.split == other.split).all()
            assert np.allclose(one.value, other.value, rtol=1e-9)
