"""Checks of trained models, against numpy and against models that are wrong."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnlens.operators import assemble as A
from churnlens.operators import evaluate as E
from churnlens.operators import models as M
from churnlens.operators.forest import forest_nodes, forest_votes
from churnlens.operators.labels import class_weights
from churnlens.operators.materialise import materialise
from churnlens.operators.optimality import hinge_objectives, log_loss_gradient, settled_logistic, settled_svm
from churnlens.operators.ratings import factorise, normal_residuals


@pytest.fixture(scope="module")
def rows_(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 3)) * [1, 5, 0.2]
    y = (x @ [1.5, -0.2, 3.0] + draw.normal(size=300) > 0.2).astype(int)
    cells = [(float(i), *map(float, r), 0.0, int(k)) for i, (r, k) in enumerate(zip(x, y))]
    table = spark.createDataFrame(cells, "userIdIndex double, a double, b double, c double, zero double, label int")
    vectors = class_weights(A.assemble_features(table, "userIdIndex"), 0.4)
    return materialise(A.max_abs_scaler().fit(vectors).transform(vectors))


def arrays(rows):
    got = rows.select(vector_to_array("scaled_features").alias("x"), "label", "weights").collect()
    return np.array([r["x"] for r in got]), np.array([r["label"] for r in got]), np.array([r["weights"] for r in got])


def test_gradient_and_settled_logistic(rows_):
    model = M.classifier("logistic_regression", "weights").fit(rows_)
    x, y, w = arrays(rows_)
    wide = np.column_stack([x, np.ones(len(x))])
    here = np.append(model.coefficients.toArray(), model.intercept)
    frame = model.transform(rows_.select("label", "scaled_features", "weights"))
    for coefficients, probability in ((here, vector_to_array("probability")[1]), (0 * here, F.lit(0.5))):
        p = 1 / (1 + np.exp(-wide @ coefficients))
        wanted = wide.T @ (w * (p - y)) / w.sum()
        assert np.allclose(log_loss_gradient(frame, probability, "weights"), wanted, atol=1e-9)
    assert settled_logistic(rows_, model, "weights") < 0.01
    early = M.classifier("logistic_regression", "weights").setMaxIter(1).fit(rows_)
    assert settled_logistic(rows_, early, "weights") > 0.05


def test_hinge_objective_and_settled_svm(rows_):
    model = M.classifier("linear_svm", "weights").fit(rows_)
    x, y, w = arrays(rows_)
    some = np.random.default_rng(1).normal(size=(5, x.shape[1] + 1))
    losses = np.maximum(0, 1 - np.where(y == 1, 1, -1)[:, None] * (x @ some[:, :-1].T + some[:, -1]))
    assert np.allclose(hinge_objectives(rows_, some, "weights"), w @ losses / w.sum())
    objective, lowered = settled_svm(rows_, model, "weights")
    assert 0 < objective < 1 and lowered < 0.01
    early = M.classifier("linear_svm", "weights").setMaxIter(1).fit(rows_)
    assert settled_svm(rows_, early, "weights")[1] > 0.01


def test_votes_by_joins_are_the_forest(spark, rows_, tmp_path):
    model = M.classifier("random_forest", "weights", trees=7).fit(rows_)
    nodes = forest_nodes(spark, model, str(tmp_path / "forest"))
    votes = {r["userIdIndex"]: r for r in forest_votes(rows_, nodes, "userIdIndex", depth=model.getMaxDepth()).collect()}
    for row in model.transform(rows_).collect():
        assert np.allclose(votes[row["userIdIndex"]]["votes"], row["rawPrediction"].toArray())
        assert votes[row["userIdIndex"]]["prediction"] == row["prediction"]
    assert len(votes) == 300


def test_unscaled_coefficients_give_the_margins(spark, rows_):
    train, test = M.hash_split(rows_.drop("scaled_features"), "userIdIndex")
    trained = M.train_and_score(train, test, "logistic_regression")
    scaler, model = trained.model.stages
    table = E.unscaled_coefficients(trained.coefficients(), scaler.maxAbs.toArray().tolist())
    assert [(r["position"], r["feature"]) for r in table.collect()] == list(enumerate(["a", "b", "c", "zero"]))
    margins = E.linear_margins(trained.predictions, table, float(model.intercept), "userIdIndex")
    raw = {r["userIdIndex"]: r["rawPrediction"][1] for r in trained.predictions.collect()}
    assert {r["userIdIndex"]: r["margin"] for r in margins.collect()} == pytest.approx(raw)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 27])
def test_factors_solve_their_normal_equations(spark, broadcast_bytes):
    draw = np.random.default_rng(5)
    pairs = {(u, i) for u, i in zip(draw.integers(0, 40, 500).tolist(), draw.integers(0, 15, 500).tolist())}
    cells = [(float(u), float(i), float((u * i) % 7) / 7) for u, i in pairs]
    table = materialise(spark.createDataFrame(cells, "userIdIndex double, artistIndex double, rating double"))
    users, items = (materialise(f) for f in factorise(table, rank=4))
    args = {"broadcast_bytes": broadcast_bytes}
    got = normal_residuals(table, users, items, "userIdIndex", "artistIndex", **args).collect()
    assert len(got) == len({u for u, _ in pairs}) and all(r["residual"] < 1e-3 and r["finite"] and r["rank"] == 4 for r in got)
    f = {r["id"]: np.array(r["features"]) for r in items.collect()}
    x = {r["id"]: np.array(r["features"]) for r in users.collect()}
    for row in got:
        mine = [(f[i], r) for u, i, r in cells if u == row["id"]]
        left = sum(np.outer(v, v) for v, _ in mine) + 0.01 * len(mine) * np.eye(4)
        right = sum(r * v for v, r in mine)
        wanted = np.linalg.norm(left @ x[row["id"]] - right) / (np.linalg.norm(right) or 1)
        assert row["ratings"] == len(mine) and row["residual"] == pytest.approx(wanted, abs=1e-6)
    wrong = users.selectExpr("id", "transform(features, v -> v + 0.1f) AS features")
    worse = normal_residuals(table, materialise(wrong), items, "userIdIndex", "artistIndex", **args).collect()
    assert min(r["residual"] for r in worse) > 0.01
