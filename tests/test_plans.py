"""A whole run over JSON lines, and the same run again."""

import json

import pytest
from pyspark.sql import functions as F

from churnlens.__main__ import main
from churnlens.constants import DERIVED_COLUMNS, EVENT_COLUMNS
from churnlens.operators.assemble import feature_names
from churnlens.operators.blocks import discover_values
from churnlens.plans import features
from churnlens.plans.features import write_features
from churnlens.plans.prepare import Layout, index_events, prepare
from churnlens.plans.reports import write_reports
from churnlens.plans.training import choose, run_chosen, train
from churnlens.registry import queries as Q

from .helpers import rows


@pytest.fixture(scope="module")
def json_path(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "events.json")
    Q.raw_events(spark, sf_dir).repartition(3).write.json(path)
    return path


@pytest.fixture(scope="module")
def run(spark, json_path, tmp_path_factory):
    out = prepare(spark, json_path, str(tmp_path_factory.mktemp("run")))
    write_features(spark, out)
    return out


def test_events_are_complete_and_sorted(spark, sf_dir, run):
    events = spark.read.parquet(run.events)
    assert tuple(events.columns) == (*EVENT_COLUMNS, *DERIVED_COLUMNS, "last_ts")
    expected = Q.QUERIES["indexed_events"](spark, sf_dir)
    assert sorted(rows(events.drop("last_ts")), key=repr) == sorted(rows(expected), key=repr)
    recent = spark.read.parquet(run.last_week_events)
    assert tuple(recent.columns) == (*EVENT_COLUMNS, *DERIVED_COLUMNS)
    assert recent.count() == Q.QUERIES["last_week_events"](spark, sf_dir).count()
    assert recent.exceptAll(events.drop("last_ts")).count() == 0
    assert spark.read.parquet(run.churn).columns == ["userIdIndex", "label"]


@pytest.mark.parametrize("sort", [False, True])
def test_indexing_is_the_same_without_broadcast(spark, sf_dir, sort):
    valid = Q.valid(spark, sf_dir)
    small = index_events(valid, sort=True)
    split = index_events(valid, broadcast_bytes=0, sort=sort)
    assert sorted(rows(small), key=repr) == sorted(rows(split), key=repr)
    if sort:
        keys = [(r["userId"], r["ts"]) for r in split.collect()]
        assert keys == sorted(keys)
        assert [(r["userId"], r["ts"]) for r in small.collect()] == keys


def test_feature_tables(spark, run):
    without, full = spark.read.parquet(run.no_lw_features), spark.read.parquet(run.features)
    for table, names in ((without, feature_names(without)), (full, feature_names(full))):
        assert table.columns == ["userIdIndex", "features", "label"]
        assert dict(table.dtypes)["userIdIndex"] == "double"
        assert table.first()["features"].size == len(names) == len(set(names))
    assert not [n for n in feature_names(without) if "_lw_" in n]
    assert len(feature_names(full)) > 1.8 * len(feature_names(without)) - 11
    events = spark.read.parquet(run.events)
    assert without.count() == events.where("artist is not null").select("userIdIndex").distinct().count()
    assert full.join(without, "userIdIndex", "left_anti").count() == 0


def test_features_read_events_four_times(spark, run, monkeypatch):
    """Every read of the events is a scan in a plan of its own or of a written table."""
    scans = []

    def noted(table, write):
        files = {f.rsplit("/", 1)[0].removeprefix("file:").lstrip("/") for f in table.inputFiles()}
        if run.events.lstrip("/") in files:
            # Other tables of the run begin with another column.
            scans.append(table._jdf.queryExecution().optimizedPlan().toString().count("Relation [userId#"))
        return write()

    writes, kept = features.write_table, features.materialise
    monkeypatch.setattr(features, "write_table", lambda t, p: noted(t, lambda: writes(t, p)))
    monkeypatch.setattr(features, "materialise", lambda t: noted(t, lambda: kept(t)))
    monkeypatch.setattr(features, "discover_values", lambda t, *a, **k: noted(t, lambda: discover_values(t, *a, **k)))
    write_features(spark, run)
    assert sum(scans) == 4


def test_reports_are_written(spark, run):
    tables = write_reports(spark, run)
    assert len(tables) == 8
    assert all(t.count() > 0 for t in tables.values())


def test_training_choice_and_second_dataset(spark, run, json_path, tmp_path):
    f1 = {}
    for name, options in (("linear_svm", {}), ("logistic_regression", {}), ("random_forest", {"trees": 5})):
        trained = train(spark, run, name, **options)
        f1[name] = trained.f1
        assert 0 <= trained.f1 <= 1
        report = spark.read.parquet(f"{run.class_report}/{name}")
        assert {"accuracy", "macro avg", "weighted avg"} <= {r["class"] for r in report.collect()}
        cells = spark.read.parquet(f"{run.confusion}/{name}").agg(F.sum("n")).first()[0]
        assert cells == spark.read.parquet(f"{run.predictions}/{name}").count()
    choice = str(tmp_path / "best")
    best = choose(spark, run, choice)
    assert f1[best] == max(f1.values())
    second = run_chosen(spark, json_path, str(tmp_path / "second"), choice)
    assert second.name == best
    # The same data, seeds and splits: the same predictions.
    key = lambda frame: sorted(rows(frame.select("userIdIndex", "label", "prediction")))
    assert key(second.predictions) == key(spark.read.parquet(f"{run.predictions}/{best}"))


def test_random_split_is_available(spark, run):
    assert 0 <= train(spark, run, "logistic_regression", how="random").f1 <= 1


def test_steps_by_name(spark, json_path, tmp_path, capsys):
    out, choice = str(tmp_path / "out"), str(tmp_path / "choice")
    assert main(["prepare", json_path, out]) == 0
    assert Layout(out).events.endswith("/events")
    assert spark.read.parquet(Layout(out).events).count() > 0
    assert main(["nonsense"]) == 2
    assert main(["train", out]) == 2
    assert "spark-submit" in capsys.readouterr().err


def test_lines_of_json_have_the_expected_fields(spark, json_path):
    assert set(json.loads(spark.read.text(json_path).first()[0])) <= set(EVENT_COLUMNS)
