import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation, functions as F

from ledgerlight.ml import explain as ex
from ledgerlight.ml import iforest, lof, prep
from ledgerlight.ml import supervised as sup

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def points(spark):
    """200 normal points and 3 far away."""
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(200, 3)), [[9, 9, 9], [-9, 8, -9], [8, -9, 9]]])
    frame = pd.DataFrame(x, columns=FEATURES)
    frame.insert(0, "transaction_id", [f"p{i:03d}" for i in range(len(x))])
    frame["is_fraud"] = [0] * 200 + [1] * 3
    return spark.createDataFrame(frame).repartition(4).cache()


def top3(df, score):
    return {r[0] for r in df.orderBy(F.col(score).desc()).limit(3).select("transaction_id").collect()}


def test_forest_ranks_outliers_first(points):
    model = iforest.fit(points, "transaction_id", FEATURES, n_trees=60)
    out = iforest.detect(points, model, 0.05)
    ends = out.agg(F.min("anomaly_score"), F.max("anomaly_score"), F.avg("is_anomaly")).first()
    assert top3(out, "anomaly_score") == {"p200", "p201", "p202"}
    assert 0 < ends[0] < ends[1] < 1 and ends[2] == pytest.approx(0.05, abs=0.01)


def test_forest_is_the_same_on_any_partitioning(points):
    a = iforest.fit(points.repartition(1), "transaction_id", FEATURES, n_trees=10, size=64)
    b = iforest.fit(points.repartition(7), "transaction_id", FEATURES, n_trees=10, size=64)
    assert np.array_equal(a.threshold, b.threshold) and np.array_equal(a.feature, b.feature)


def test_long_table_uses_a_bounded_pool(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 97).alias("a"))
    drawn = iforest.subsamples(df, "k", ["a"], 10, 64, 42)
    per_tree = [r["count"] for r in drawn.groupBy("tree").count().collect()]
    assert len(per_tree) == 10 and 64 <= min(per_tree) and max(per_tree) < 64 * 3


def test_lof_equals_brute_force(spark, points):
    keyed = points.withColumn("i", F.xxhash64("transaction_id"))
    x = F.array(*FEATURES)
    out = keyed.join(lof.outlier_factors(keyed, "i", x, k=10), "i").toPandas()
    m = out[FEATURES].to_numpy()
    d = np.sqrt(((m[:, None] - m[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1)[:, :10]
    dist = np.take_along_axis(d, near, axis=1)
    lrd = 1 / (np.maximum(dist, dist[near, -1]).mean(axis=1) + 1e-10)
    assert np.allclose(out["lof"], lrd[near].mean(axis=1) / lrd)
    assert set(out.nlargest(3, "lof")["transaction_id"]) == {"p200", "p201", "p202"}


def test_lof_over_many_cells_and_a_hot_one(spark, monkeypatch):
    """A third of the rows in one place, cells cut into many blocks: still the neighbours of brute force."""
    monkeypatch.setattr(lof, "NEAR_BLOCK", 40)
    monkeypatch.setattr(lof, "FAR_BLOCK", 70)
    rng = np.random.default_rng(8)
    m = rng.normal(0, 1, (600, 3)) + rng.integers(0, 4, (600, 1)) * 6
    m[:200] = m[0]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "id long, x array<double>")
    near = lof.neighbours(df, 7).toPandas().sort_values(["id", "dist", "other"])
    d = np.sqrt(((m[:, None] - m[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    best = np.argsort(d, axis=1, kind="stable")[:, :7]
    assert np.array_equal(near["other"].to_numpy().reshape(600, 7), best)
    few = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, x array<double>")
    assert lof.neighbours(few, 5).count() == 2 and lof.outlier_factors(few, "id", F.col("x")).count() == 2


def brute_neighbours(m, k):
    d = np.sqrt(((m[:, None] - m[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, :k]


def test_lof_tree_of_many_levels(spark, monkeypatch):
    """Cells are split until they are small; copies that fill a third of the table leave the tree at once."""
    monkeypatch.setattr(lof, "LEAF_ROWS", 12)
    monkeypatch.setattr(lof, "BRANCH", 4)
    rng = np.random.default_rng(5)
    m = np.round(rng.normal(0, 1, (450, 2)) + rng.integers(0, 5, (450, 1)) * 9, 3)
    m[100:250] = m[7]
    m[300:306] = m[299]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "id long, x array<double>")
    leaves, levels = lof.tree(df)
    assert len(levels) > 2 and leaves.count() == 450 and leaves.select("id").distinct().count() == 450
    sizes = [(r["n"], r["radius"]) for t in levels for r in t.where("leaf").collect()]
    assert sum(n for n, _ in sizes) == 450 and all(n <= 12 or radius == 0 for n, radius in sizes)
    near = lof.neighbours(df, 5).toPandas().sort_values(["id", "dist", "other"])
    assert np.array_equal(near["other"].to_numpy().reshape(450, 5), brute_neighbours(m, 5))
    assert lof.neighbours(df.limit(0), 5).count() == 0


def test_lof_work_grows_below_the_square(spark, monkeypatch):
    """Pairs of rows that are compared, in the own leaf and in the visited ones, at three sizes."""
    monkeypatch.setattr(lof, "LEAF_ROWS", 64)
    monkeypatch.setattr(lof, "BRANCH", 16)
    rng = np.random.default_rng(6)
    points = rng.random((8_000, 2)) * 100
    work = []
    for n in (500, 2_000, 8_000):
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(points[:n])], "id long, x array<double>")
        leaves, levels = lof.tree(df)
        own = leaves.groupBy("cell").agg(F.count("*").alias("n"))
        near = lof._join(leaves, leaves, own.select("cell", F.col("n").alias("n_rows"), F.col("n").alias("n_others")), 5)
        bound = near.groupBy("id").agg(F.max("dist").alias("bound"))
        met = lof.visits(leaves.withColumnRenamed("cell", "own").join(bound, "id"), levels, 5).join(own, "cell")
        work.append(met.agg(F.sum("n")).first()[0] + own.agg(F.sum(F.col("n") * F.col("n"))).first()[0])
    print("pairs compared:", work)
    assert work[1] < 4**1.5 * work[0] and work[2] < 4**1.5 * work[1]


def test_forest_draws_alike_at_every_size(spark):
    for n in (50, 3_000, 60_000):
        df = spark.range(n).select(F.col("id").cast("string").alias("k"), (F.col("id") % 97).alias("a"))
        drawn = iforest.subsamples(df, "k", ["a"], 20, 64, 42)
        per_tree = [r["count"] for r in drawn.groupBy("tree").count().collect()]
        assert len(per_tree) == 20 and drawn.distinct().count() == sum(per_tree)
        assert min(per_tree) >= min(n, 64) and max(per_tree) <= 64 * 2.5
    small = iforest.fit(spark.range(5).select(F.col("id").cast("string").alias("k"), "id"), "k", ["id"], n_trees=5)
    assert small.size == 5


def test_reconstruction(points):
    scaled = prep.scale(points, prep.fit_scaler(points, FEATURES))
    out = sup.score_reconstruction(scaled, sup.fit_reconstruction(scaled, FEATURES, 2), FEATURES).toPandas()
    x = out[FEATURES].to_numpy()
    _, _, axes = np.linalg.svd(x - x.mean(axis=0))
    rest = x - x @ axes[:2].T @ axes[:2]
    assert np.allclose(out["reconstruction_error"], (rest**2).mean(axis=1))


def test_impute_and_constant_features(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0), ("b", None, 2.0), ("c", 3.0, 2.0), ("d", float("inf"), 2.0), ("e", float("nan"), 2.0), ("f", 9.0, 2.0)],
        "k string, x double, same double",
    )
    filled = prep.impute_median(df, ["x", "same"])
    assert [r["x"] for r in filled.orderBy("k").collect()] == [1, 3, 3, 3, 3, 9]
    assert prep.select_by_variance(filled, ["x", "same"]) == ["x"]
    assert prep.scale(filled, prep.fit_scaler(filled, ["same"])).first()["same"] == 0


def test_contributions_add_up(spark, points):
    scored = iforest.fit(points, "transaction_id", FEATURES, n_trees=30).score(points)
    model, split = sup.fit_surrogate(scored, FEATURES, "anomaly_score", iterations=8, depth=3)
    trees = ex.tree_sum(model, FEATURES, spark)
    from pyspark.ml.functions import vector_to_array

    out = model.transform(trees.explain(split)).withColumn("margin", vector_to_array("probability")[1])
    out = out.withColumn("margin", F.log(F.col("margin") / (1 - F.col("margin"))) / 2)
    total = F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c["contribution"])
    assert out.agg(F.max(F.abs(F.col("margin") - trees.base - total))).first()[0] < 1e-6
    top = trees.explain(split).select(ex.top_factors("contributions", 2).alias("t")).collect()
    assert all(len(r["t"]) == 2 and abs(r["t"][0]["contribution"]) >= abs(r["t"][1]["contribution"]) for r in top)


def test_forest_learns_the_label(spark):
    df = spark.range(2000).select(
        F.col("id").cast("string").alias("transaction_id"),
        (F.col("id") % 13).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
        (((F.col("id") % 13) > 9) & ((F.col("id") % 7) > 4)).cast("int").alias("is_fraud"),
    )
    model = sup.fit_random_forest(df, ["a", "b"], n_trees=20, depth=6)
    from ledgerlight.operators.evaluate import roc_auc

    assert roc_auc(sup.score_random_forest(df, model), "is_fraud", "rf_score").first()[0] > 0.8
    assert dict(sup.importances(model, ["a", "b"])).keys() == {"a", "b"}


def test_forest_scores_after_observed_metrics(spark, points):
    """A session that has observed metrics cannot be serialized; the model goes to the tasks without it."""
    seen = Observation()
    points.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 203}
    model = sup.fit_random_forest(points, FEATURES, n_trees=5, depth=4)
    assert not model.stages[-1].hasSummary
    assert sup.score_random_forest(points, model).agg(F.max("rf_score").between(0.0, 1.0)).first()[0]


def test_ensemble_without_supervised_scores(points):
    out = sup.ensemble(points.withColumn("iso_score", F.abs("a")), rf=None)
    assert out.filter(F.col("ensemble_score") != F.col("iso_score")).count() == 0


@pytest.mark.parametrize("name", ["rf_scores", "ensemble_table", "feature_importance", "surrogate_fit", "explained", "model_roundtrip", "stream_score"])
def test_registered_models_have_full_size(monkeypatch, name):
    """The fits get no sizes of their own, so the functions' defaults hold."""
    from unittest.mock import MagicMock

    from ledgerlight.plans import models, streams

    calls = []

    def fit(*args, **sizes):
        calls.append(sizes)
        return MagicMock()

    surrogate = lambda *a, **k: (fit(*a, **k), MagicMock())
    monkeypatch.setattr(models, "sup", MagicMock(fit_random_forest=fit, fit_surrogate=surrogate))
    monkeypatch.setattr(streams, "sup", models.sup)
    monkeypatch.setattr(models, "iforest", MagicMock(**{"fit.side_effect": lambda *a, **k: calls.append(k) or MagicMock()}))
    for module, mocked in ((models, ("prep", "ex", "cut", "PipelineModel", "scratch_dir", "F", "ev")), (streams, ("src", "st", "stateless_features"))):
        for m in mocked:
            monkeypatch.setattr(module, m, MagicMock())
    monkeypatch.setattr(models, "matrix", lambda *a: (MagicMock(), ["x"]))
    models.F.col.return_value.__gt__ = lambda *a: MagicMock()
    getattr(streams if name == "stream_score" else models, name)(MagicMock(), "folder")
    assert calls and not any(calls)


def test_later_rows_do_not_move_thresholds(spark):
    """Scores and flags of the later rows come from the earlier ones alone."""
    known = spark.createDataFrame([(i, i / 100.0, i / 200.0) for i in range(101)], "k int, iso_score double, rf_score double")
    one = spark.createDataFrame([(500, 0.5, 0.25), (501, 5.0, 0.9)], "k int, iso_score double, rf_score double")
    alone = sup.ensemble(one.where("k = 500"), known=known).first()
    beside = {r["k"]: r for r in sup.ensemble(one, known=known).collect()}
    assert beside[500]["ensemble_score"] == alone["ensemble_score"] and beside[500]["ensemble_flag"] == 0
    assert beside[501]["ensemble_score"] > 1 and beside[501]["ensemble_flag"] == 1


def test_small_tables_are_dealt_over_the_cores(spark):
    one = spark.range(1000).coalesce(1)
    assert sup.dealt(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 1000, 1, 50)
    assert sup.dealt(wide).rdd.getNumPartitions() == 50
