"""Models: seeded fits repeat, saved models reload, errors beat the label spread."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tremor import schema
from tremor.operators import ml, trees
from tremor.plans.catalog import train_test
from tremor.sources import fixture
from tremor.sources.catalog import load_model
from tremor.sources.sinks import save_model


@pytest.fixture(scope="module")
def data(spark):
    train, test = train_test(spark, SF_SMALL)
    return train.cache(), test.cache()


def test_split_sizes(data):
    train, test = data
    assert train.count() > 3 * test.count() > 0
    assert train.columns == ["Latitude", "Longitude", "Depth", "Magnitude"]


def test_seeded_fit_repeats(data):
    train, test = data
    a = ml.predict(ml.fit(train, "RandomForest"), test).select("prediction").collect()
    b = ml.predict(ml.fit(train, "RandomForest"), test).select("prediction").collect()
    assert a == b


def test_compare_and_select(data):
    train, test = data
    cmp_ = ml.compare(train, test)
    rows = cmp_.orderBy("pos").collect()
    assert [r.model for r in rows] == list(ml.MODEL_NAMES)
    sd = test.agg(F.stddev("Magnitude")).first()[0]
    assert all(r.rmse < sd for r in rows)
    assert all(r.accepted == (r.rmse < ml.RMSE_TARGET) for r in rows)
    best = ml.select_best(cmp_).first()
    assert best.rmse == min(r.rmse for r in rows)


def test_save_load_same_predictions(spark, data, tmp_dir):
    train, test = data
    model = ml.fit(train, "DecisionTree")
    save_model(model, f"{tmp_dir}/m")
    again = load_model(f"{tmp_dir}/m")
    a = ml.predict(model, test).select("prediction").collect()
    b = ml.predict(again, test).select("prediction").collect()
    assert a == b


def test_prediction_table_and_points(spark, data):
    train, test = data
    model = ml.fit(train, "LinearRegression")
    pt = ml.prediction_table(model, test)
    assert pt.columns == ["Latitude", "Longitude", "Pred_Magnitude", "Year", "RMSE"]
    assert pt.select("Year").distinct().collect()[0][0] == 2017
    assert pt.count() == test.count()
    sp = ml.score_points(model, fixture.points(spark, SF_SMALL))
    assert sp.count() == 25 and sp.where(F.col("Pred_Magnitude").isNull()).count() == 0


def test_unknown_model():
    with pytest.raises(ValueError):
        ml.regressor("SVM")
    with pytest.raises(ValueError):
        ml.fit(None, learner="guess")


_FIT_SCRIPT = r"""
import sys
sys.path.insert(0, {root!r})
from tremor.session import build_session
from tremor.operators import ml
from tremor.plans.catalog import train_test
spark = build_session("local[2]", conf={{"spark.sql.shuffle.partitions": "4"}})
train, test = train_test(spark, {sf!r})
preds = ml.predict(ml.fit(train, "RandomForest"), test).orderBy("Latitude", "Longitude", "Depth", "Magnitude")
print("PRED", ",".join(repr(r[0]) for r in preds.select("prediction").collect()))
"""


def test_seeded_fit_repeats_across_processes(data):
    """A fixed seed gives the same forest in another process (the default seed does not)."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = _FIT_SCRIPT.format(root=root, sf=SF_SMALL)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    line = [l for l in out.stdout.splitlines() if l.startswith("PRED ")]
    assert line, out.stderr[-2000:]
    other = [float(x) for x in line[0][5:].split(",")]
    train, test = data
    preds = ml.predict(ml.fit(train, "RandomForest"), test).orderBy("Latitude", "Longitude", "Depth", "Magnitude")
    mine = [r[0] for r in preds.select("prediction").collect()]
    assert mine == other


def test_parallel_compare_equals_sequential(data):
    train, test = data
    par = [tuple(r) for r in ml.compare(train, test, parallelism=4).orderBy("pos").collect()]
    seq = [tuple(r) for r in ml.compare(train, test, parallelism=1).orderBy("pos").collect()]
    assert par == seq


@pytest.mark.parametrize("local", [0, 1_000_000])
@pytest.mark.parametrize("name", ml.MODEL_NAMES[:1] + ml.MODEL_NAMES[2:])
def test_tree_models_do_not_depend_on_the_layout(data, monkeypatch, name, local):
    """4 or 64 partitions, any order, cells in memory or as a table: the same nodes."""
    train, _ = data
    want = ml.fit(train.repartition(4), name)
    monkeypatch.setattr(trees, "LOCAL_CELLS", local)
    fit = {"RandomForest": trees.fit_forest, "DecisionTree": trees.fit_tree, "GBT": trees.fit_boosted}[name]
    few = {"GBT": {"rounds": 3}, "RandomForest": {"trees": 20}, "DecisionTree": {}}[name]
    got = fit(train.orderBy("Magnitude").repartition(64), schema.FEATURES, schema.LABEL, ml.SEED, **few)
    assert got.nodes == tuple(n for n in want.nodes if n.tree < few.get("rounds", 20))


def slow_tree(rows, cuts, depth, features):
    """rows: (values, label, weight).  The stated rules, row by row: path -> leaf value or (feature, threshold)."""
    out = {}

    def grow(node, mine, level):
        weight, total = sum(r[2] for r in mine), sum(r[1] * r[2] for r in mine)
        best = None
        for f in features(node):
            for b, cut in enumerate(cuts[f]):
                left = [r for r in mine if r[0][f] <= cut]
                w, s = sum(r[2] for r in left), sum(r[1] * r[2] for r in left)
                if 0 < w < weight:
                    score = s * s // w + (total - s) ** 2 // (weight - w)
                    if best is None or score > best[0]:
                        best = (score, f, cut)
        if level == depth or best is None or best[0] < total * total // weight + 2:
            out[node] = total // weight
            return
        out[node] = best[1:]
        grow(2 * node, [r for r in mine if r[0][best[1]] <= best[2]], level + 1)
        grow(2 * node + 1, [r for r in mine if r[0][best[1]] > best[2]], level + 1)

    grow(1, [r for r in rows if r[2]], 0)
    return out


def nodes_of(model, tree):
    return {n.node: n.value if n.feature is None else (n.feature, n.threshold) for n in model.nodes if n.tree == tree}


def test_trees_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(float(rng.randrange(40)), rng.choice([0.5, 1.5, -2.0]), float(rng.randrange(900)) / 10, 5 + rng.randrange(4000) / 1000) for _ in range(300)]
    rows += rows[:40]  # repeated rows
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    cuts = []
    for f in range(3):
        ordered = sorted(r[f] for r in rows)
        ranks = {ordered[-(-k * len(rows) // 8) - 1] for k in range(1, 8)}
        cuts.append(sorted(x for x in ranks if x < ordered[-1]))
    exact = [(r[:3], round(r[3] * 10**9), 1) for r in rows]
    tree = trees.fit_tree(df, ("a", "b", "c"), "y", 7, max_depth=4, max_bins=8)
    assert nodes_of(tree, 0) == slow_tree(exact, cuts, 4, lambda n: range(3))

    def weight(row, t):
        key = ":".join(str(round(x * 10**6)) for x in row)
        u = int(hashlib.sha256(f"7:{t // 8}:{key}".encode()).hexdigest()[8 * (t % 8) :][:8], 16)
        return sum(u >= int(2**32 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(13))

    forest = trees.fit_forest(df, ("a", "b", "c"), "y", 7, trees=10, subset=2, max_depth=3, max_bins=8)
    for t in range(10):
        def some(node, t=t):
            return sorted(sorted(range(3), key=lambda f: hashlib.sha256(f"7:{t}:{node}:{f}".encode()).hexdigest())[:2])

        drawn = [(r[:3], round(r[3] * 10**9), weight(r, t)) for r in rows]
        assert nodes_of(forest, t) == slow_tree(drawn, cuts, 3, some)
    assert 0.9 < sum(weight(r, t) for r in rows for t in range(10)) / (10 * len(rows)) < 1.1


def test_table_and_column_agree_and_nulls_have_no_prediction(spark, data):
    """The node table, walked row by row in SQL, predicts what the compiled column does."""
    import duckdb

    train, test = data
    model = ml.fit(train, "RandomForest")
    nodes, rows = model.table(spark).toPandas(), test.toPandas()
    walk = duckdb.sql("""
        WITH RECURSIVE r AS (SELECT row_number() OVER () AS id, * FROM rows),
        w AS (
          SELECT id, tree, 1 AS node, NULL::BIGINT AS value FROM r, (SELECT DISTINCT tree FROM nodes)
          UNION ALL
          SELECT w.id, w.tree, CASE WHEN n.feature IS NULL THEN NULL
              WHEN CASE n.feature WHEN 'Latitude' THEN r."Latitude" WHEN 'Longitude' THEN r."Longitude" ELSE r."Depth" END <= n.threshold THEN 2 * w.node
              ELSE 2 * w.node + 1 END, n.value
          FROM w JOIN r USING (id) JOIN nodes n ON n.tree = w.tree AND n.node = w.node)
        SELECT any_value(r."Latitude"), any_value(r."Longitude"), any_value(r."Depth"), any_value(r."Magnitude"), sum(w.value)
        FROM w JOIN r USING (id) GROUP BY id""").fetchall()
    got = [(*r[:4], round(r[4] * model.divisor)) for r in ml.predict(model, test).collect()]
    assert sorted(got) == sorted((*r[:4], int(r[4])) for r in walk)
    holes = spark.createDataFrame([(None, 1.0, 1.0), (1.0, None, 1.0), (1.0, 1.0, None)], "Latitude double, Longitude double, Depth double")
    assert [r.prediction for r in model.transform(holes).collect()] == [None] * 3
    plan = model.transform(test)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan


@pytest.mark.parametrize("name", ml.MODEL_NAMES[:1] + ml.MODEL_NAMES[2:])
def test_spark_ml_models_as_node_tables(spark, data, tmp_dir, name):
    """A Spark ML model's node table predicts what its ``transform`` does, on all rows; ours errs no more than it."""
    train, test = data
    theirs = ml.fit(train, name, learner="spark-ml")
    save_model(theirs, f"{tmp_dir}/m")
    native = trees.from_spark_ml(spark, f"{tmp_dir}/m", schema.FEATURES)
    both = theirs.transform(test).withColumn("ours", native.column()).select("prediction", "ours").collect()
    assert len(both) == test.count() and all(r.ours == pytest.approx(r.prediction, abs=1e-12) for r in both)
    assert ml.rmse(ml.fit(train, name), test) < 1.15 * ml.rmse(theirs, test)


def test_no_training_rows(spark):
    none = spark.createDataFrame([], "Latitude double, Longitude double, Depth double, Magnitude double")
    for name in ("RandomForest", "GBT"):
        model = ml.fit(none, name)
        assert model.transform(none).count() == 0 and {n.value for n in model.nodes} == {0}


def test_tree_leaves_hold_the_mean_of_their_rows(spark):
    """A regression tree's prediction is the mean label of the training rows it puts in the same leaf."""
    train, _ = train_test(spark, SF_SMALL)
    scored = ml.predict(ml.fit(train, "DecisionTree"), train)
    leaves = scored.groupBy("prediction").avg("Magnitude").collect()
    assert len(leaves) > 5
    assert all(r[0] == pytest.approx(r[1], abs=1e-9) for r in leaves)


def test_forest_is_the_mean_of_its_trees_and_boosting_their_weighted_sum(spark):
    train, test = train_test(spark, SF_SMALL)
    rows = test.limit(20)
    for name in ("RandomForest", "GBT"):
        model = ml.fit(train, name, learner="spark-ml")
        frame, stage = model.stages[0].transform(rows), model.stages[-1]
        feats = [r.features for r in frame.collect()]
        got = [r.prediction for r in stage.transform(frame).collect()]
        for f, p in zip(feats, got):
            parts = [t.predict(f) for t in stage.trees]
            want = sum(parts) / len(parts) if name == "RandomForest" else sum(w * x for w, x in zip(stage.treeWeights, parts))
            assert p == pytest.approx(want, abs=1e-9)
