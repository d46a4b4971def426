import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import MaxAbsScaler
from pyspark.ml.functions import vector_to_array

from churnlens.operators import assemble as A
from churnlens.operators import evaluate as E
from churnlens.operators import models as M
from churnlens.operators.labels import class_weights
from churnlens.registry import queries as Q
from churnlens.sources import scores as S

from .helpers import rows


def predictions(spark, *pairs):
    return spark.createDataFrame([(a, float(b)) for a, b in pairs], "label int, prediction double")


@pytest.fixture(scope="module")
def training(spark):
    cells = [(float(i), float(i % 7), float((i * 5) % 11), 0.0, int(i % 7 > 3)) for i in range(200)]
    table = spark.createDataFrame(cells, "userIdIndex double, a double, b double, zero double, label int")
    return A.assemble_features(table, "userIdIndex").cache()


def test_features_keep_their_names(training, tmp_path, spark):
    assert training.columns == ["userIdIndex", "features", "label"]
    assert A.feature_names(training) == ["a", "b", "zero"]
    training.write.parquet(str(tmp_path / "f"))
    assert A.feature_names(spark.read.parquet(str(tmp_path / "f"))) == ["a", "b", "zero"]


def test_scaled_columns_equal_the_vector_scaler(spark):
    frame = spark.createDataFrame([(1.0, -4.0, 0.0), (2.0, 2.0, 0.0), (-0.5, 1.0, 0.0)], "a double, b double, c double")
    assembled = A.VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(frame)
    fitted = MaxAbsScaler(inputCol="features", outputCol="scaled").fit(assembled).transform(assembled)
    vectors = [tuple(r[0]) for r in fitted.select(vector_to_array("scaled")).collect()]
    assert rows(A.scale_columns(frame, ["a", "b", "c"])) == vectors


def test_hash_split_does_not_depend_on_layout(spark):
    frame = spark.range(2000).selectExpr("cast(id as double) as userIdIndex")
    parts = M.hash_split(frame, "userIdIndex")
    again = M.hash_split(frame.repartition(13), "userIdIndex")
    first, second = ([{r[0] for r in p.collect()} for p in ps] for ps in (parts, again))
    assert first == second
    assert not first[0] & first[1] and len(first[0] | first[1]) == 2000
    assert 0.70 < len(first[0]) / 2000 < 0.80
    assert [p.count() for p in M.hash_split(frame, "userIdIndex", seed=7)] != [len(p) for p in first]
    assert sum(p.count() for p in M.random_split(frame)) == 2000


@pytest.mark.parametrize("name", ["random_forest", "logistic_regression", "linear_svm"])
@pytest.mark.parametrize("weights", [None, "weights"])
def test_classifiers_learn(training, name, weights):
    options = {"trees": 5} if name == "random_forest" else {}
    train, test = M.hash_split(class_weights(training, 0.4), "userIdIndex")
    trained = M.train_and_score(train, test, name, weights, **options)
    assert 0.9 < trained.f1 <= 1
    assert trained.predictions.count() == test.count()
    if name != "random_forest":
        ranked = E.rank_coefficients(trained.coefficients(), by_size=True).collect()
        assert ranked[0]["feature"] == "a" and len(ranked) == 3
    with pytest.raises(ValueError, match="unknown classifier"):
        M.classifier("nearest")


def test_ranking_is_signed_or_by_size(spark):
    table = E.coefficient_table(spark, ["a", "b", "c"], [1.0, -3.0, 2.0])
    assert [r["feature"] for r in E.rank_coefficients(table).collect()] == ["c", "a", "b"]
    assert rows(E.rank_coefficients(table, by_size=True)) == [("b", 3.0), ("c", 2.0), ("a", 1.0)]


def test_f1_equals_the_built_in_evaluator(spark, sf_dir):
    for frame in (
        predictions(spark, (0, 0), (0, 1), (1, 1), (1, 0), (1, 1)),
        predictions(spark, (0, 0), (1, 0), (1, 0)),
        Q.judged(spark, sf_dir),
    ):
        built_in = MulticlassClassificationEvaluator(metricName="f1").evaluate(frame)
        assert math.isclose(E.weighted_f1(frame).first()["f1"], built_in, abs_tol=1e-12)


def test_report_when_nobody_is_predicted_to_leave(spark):
    report = {r["class"]: r for r in E.classification_report(predictions(spark, (0, 0), (0, 0), (1, 0))).collect()}
    assert (report["1"]["precision"], report["1"]["recall"], report["1"]["f1"]) == (0.0, 0.0, 0.0)
    assert report["0"]["f1"] == pytest.approx(0.8)
    assert report["accuracy"]["f1"] == pytest.approx(2 / 3) and report["accuracy"]["precision"] is None
    assert report["macro avg"]["f1"] == pytest.approx(0.4)
    assert report["weighted avg"]["recall"] == pytest.approx(2 / 3)
    assert [report[c]["support"] for c in ("0", "1", "accuracy")] == [2, 1, 3]


def test_confusion_cells_add_up(spark):
    frame = predictions(spark, (0, 0), (0, 1), (0, 0), (0, 0))
    assert sorted(rows(E.confusion_matrix(frame))) == [
        (0, 0, 3, 0.75),
        (0, 1, 1, 0.25),
        (1, 0, 0, 0.0),
        (1, 1, 0, 0.0),
    ]


@pytest.mark.parametrize(
    "f1, chosen",
    [
        ((0.7, 0.7, 0.7), "linear_svm"),
        ((0.6, 0.7, 0.7), "logistic_regression"),
        ((0.6, 0.7, 0.71), "random_forest"),
    ],
)
def test_ties_go_to_the_earlier_classifier(spark, tmp_path, f1, chosen):
    names = ("linear_svm", "logistic_regression", "random_forest")
    path = str(tmp_path / "scores")
    for name, value in zip(reversed(names), reversed(f1)):
        S.write_score(spark, path, name, False, 0.99)
        S.write_score(spark, path, name, True, 0.0)
        S.write_score(spark, path, name, True, value)
    scores = S.read_scores(spark, path)
    assert scores.count() == 6
    S.write_choice(E.best_model(S.comparable_scores(scores)), str(tmp_path / "choice"))
    assert S.read_choice(spark, str(tmp_path / "choice")) == chosen
