import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgerlight.ml import forest, iforest
from ledgerlight.ml import supervised as sup


class Held:
    """Rows as a task holds them."""

    def __init__(self, codes, label):
        self.codes, self.label, self.n = codes, label, len(label)

    def state(self):
        return tuple(np.zeros(self.n, kind) for kind in (np.uint32, np.uint16, np.uint8))


@pytest.fixture
def held():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 32, (6, 3000)).astype(np.uint8)
    label = ((codes[0] > 20) & (codes[3] < 9) | (rng.random(3000) < 0.02)).astype(np.uint8)
    return Held(codes, label)


def grown(held, tried, depth=15, seed=5):
    return forest.grow(held, np.array([1.0, 9.0]), depth, tried, 5, np.random.default_rng(seed), held.state())


def leaves(tree, held):
    child = tree["child"].astype(np.intp)
    return forest.walk(held.codes.T.copy(), tree["feature"].astype(np.intp), tree["bin"].astype(np.uint8), child, forest.levels_below(child))


def test_chunks_do_not_change_a_tree(held, monkeypatch):
    """The draws go on from chunk to chunk, so a tree is the one that a single chunk gives."""
    whole = grown(held, 3)
    monkeypatch.setattr(forest, "CHUNK_ROWS", 700)
    parts = grown(held, 3)
    assert all(np.array_equal(whole[k], parts[k]) for k in whole)


def test_splits_are_the_best_ones(held):
    """With all columns tried, the root and its children split where the weighted impurity falls most."""
    tree = grown(held, 6, depth=2)
    drawn = np.random.default_rng(5).poisson(1.0, held.n)
    weights = drawn * np.array([1.0, 9.0])[held.label]

    def impurity(inside):
        share = weights[inside & (held.label == 1)].sum() / max(weights[inside].sum(), 1e-300)
        return weights[inside].sum() * 2 * share * (1 - share)

    def best(inside):
        found = {}
        for j in range(6):
            for b in range(31):
                low, high = inside & (held.codes[j] <= b), inside & (held.codes[j] > b)
                if min(drawn[low].sum(), drawn[high].sum()) >= 5:
                    found[j, b] = impurity(inside) - impurity(low) - impurity(high)
        return found

    at, child = {0: np.ones(held.n, dtype=bool)}, tree["child"].reshape(-1, 2)
    for node in range(len(child)):
        counts = tree["counts"].reshape(-1, 2)[node]
        assert counts == pytest.approx([weights[at[node] & (held.label == c)].sum() for c in (0, 1)])
        if child[node][0] != node:
            j, b = tree["feature"][node], tree["bin"][node]
            gains = best(at[node])
            assert gains[j, b] == pytest.approx(max(gains.values()))
            assert tree["gain"][node] * weights[at[node]].sum() == pytest.approx(gains[j, b])
            at[child[node][1]], at[child[node][0]] = at[node] & (held.codes[j] <= b), at[node] & (held.codes[j] > b)


def test_leaves_keep_their_least_rows(held):
    tree = grown(held, 3)
    drawn = np.random.default_rng(5).poisson(1.0, held.n)
    inside = np.bincount(leaves(tree, held), weights=drawn, minlength=len(tree["feature"]))
    is_leaf = tree["child"][::2] == np.arange(len(tree["feature"]))
    assert inside[is_leaf].min() >= 5 and not inside[~is_leaf].any()
    # Two leaves of one node never predict the same class.
    winner = tree["counts"].reshape(-1, 2).argmax(axis=1)
    for a, b in tree["child"].reshape(-1, 2)[~is_leaf]:
        assert not (is_leaf[a] and is_leaf[b] and winner[a] == winner[b])


def test_bounds_share_the_weight():
    x = np.concatenate([np.arange(1000.0), [np.nan, np.inf]])
    w = np.where(x < 100, 9.0, 1.0)
    at = forest.bounds(x, w)
    shares = np.bincount(np.searchsorted(at, x[:1000]), weights=w[:1000]) / 1800
    assert len(at) == 31 and at[-1] == 999 and shares.max() < 0.05
    assert forest.bounds(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4)).tolist() == [1.5, 2.5]
    assert not len(forest.bounds(np.array([4.0, 4.0]), np.ones(2)))


def test_forest_through_spark(spark, tmp_path):
    """Nulls and NaN are above every threshold; a saved forest scores as the fitted one; odd labels are refused."""
    rows = [(float(i % 50), None if i % 4 == 0 else float("nan") if i % 4 == 1 else 1.0, int(i % 50 > 40 or i % 4 < 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, is_fraud int").repartition(5)
    model = sup.fit_random_forest(df, ["a", "b"], n_trees=12, depth=5)
    scored = sup.score_random_forest(df, model)
    assert scored.columns == ["a", "b", "is_fraud", "rf_score"]
    assert scored.where((F.col("rf_score") > 0.5).cast("int") != F.col("is_fraud")).count() == 0
    model.write().overwrite().save(f"{tmp_path}/forest")
    again = sup.score_random_forest(scored, PipelineModel.load(f"{tmp_path}/forest"), "again")
    assert again.where("rf_score <> again").count() == 0
    assert sum(share for _, share in sup.importances(model, ["a", "b"])) == pytest.approx(1)
    with pytest.raises(ValueError, match="labels"):
        sup.fit_random_forest(spark.createDataFrame([(1.0, None), (2.0, 1)], "a double, is_fraud int"), ["a"], n_trees=1)


def test_walk_goes_where_single_rows_go():
    """Also with values that are no numbers and with a tree of one leaf; the isolation forest's depths are the plain ones."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(5000, 4))
    x[rng.random(x.shape) < 0.02] = np.nan
    frames = []
    for t, points in enumerate((rng.normal(size=(64, 4)), rng.normal(size=(40, 4)), np.zeros((3, 4)))):
        nodes = pd.DataFrame(iforest._grow(points, np.arange(4), 6, rng), columns=["feature", "threshold", "left", "right", "path"])
        frames.append(nodes.assign(tree=t, node=np.arange(len(nodes))))
    model = iforest.IsolationForest.from_nodes(pd.concat(frames), list("abcd"), 64)

    def path(t, row):
        node = 0
        while model.feature[t, node] >= 0:
            node = (model.left if row[model.feature[t, node]] <= model.threshold[t, node] else model.right)[t, node]
        return model.path[t, node]

    some = rng.choice(len(x), 300, replace=False)
    assert np.array_equal(model.depths(x)[some], [sum(path(t, x[i]) for t in range(3)) / 3 for i in some])
    assert model.walked[2] == [6, 6, 0]
