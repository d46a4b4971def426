"""Every operator as a query over the test tables: ``name -> f(spark, sf_dir)``.

All queries run over whole tables. Doubles are rounded to six places, since two
engines do not add them up in the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.constants import ALS_RANK, CANCEL_PAGES, CLASSIFIER_PRIORITY, DERIVED_COLUMNS, EVENT_COLUMNS, SPLIT
from churnlens.operators import assemble, blocks, clean, evaluate, index, labels, models, order, ratings, reports, slices
from churnlens.operators.forest import forest_nodes, forest_votes
from churnlens.operators.materialise import materialise
from churnlens.operators.optimality import settled_logistic, settled_svm
from churnlens.plans.features import (
    ARTIST_INDEX,
    USER_INDEX,
    both_periods,
    feature_columns,
    feature_events,
    whole_period,
    write_features,
)
from churnlens.plans.prepare import index_events, prepare
from churnlens.plans.training import choose, train
from churnlens.session import ensure_checkpoint_dir, pin_time_zone
from churnlens.sources.clickstream import LEVELS, PAGES, clickstream
from churnlens.sources.events import name_table, read_table, write_table
from churnlens.sources.scores import read_scores

Query = Callable[[SparkSession, str], DataFrame]



# Inputs -----------------------------------------------------------------------


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_time_zone(spark)
    return clickstream(read_table(spark, f"{sf_dir}/events.parquet"))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.valid_events(clean.project_events(raw_events(spark, sf_dir)))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_events(raw_events(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = cleaned(spark, sf_dir)
    return events, labels.churn_label(events)


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.user_profile(cleaned(spark, sf_dir))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``labels`` table as predictions: quality is the truth, toxic the guess."""
    rows = read_table(spark, f"{sf_dir}/labels.parquet")
    return rows.select(F.col("quality").alias("label"), F.col("toxic").cast("double").alias("prediction"))


def formula_factors(artists: DataFrame, rank: int = ALS_RANK) -> DataFrame:
    """Item factors given by a formula of the artist id, so they can be checked."""
    item = F.col(ARTIST_INDEX).cast("long")
    ranks = F.sequence(F.lit(0), F.lit(rank - 1))
    factors = F.transform(ranks, lambda k: (((item * 7 + k * 3) % 11 - 5) / 10).cast("double"))
    return artists.select(item.alias("id"), factors.alias("features"))


def rounded(table: DataFrame, places: int = 6) -> DataFrame:
    # A mean that lies exactly between two roundings goes up or down by the order of
    # its summands, so all values are rounded 1e-9 above. Adding 0 makes -0.0 a 0.0.
    return table.selectExpr(
        *[f"round(`{c}` + 1e-9D, {places}) + 0D AS `{c}`" if kind == "double" else f"`{c}`" for c, kind in table.dtypes]
    )


# Cleaning, indices, slices ------------------------------------------------------


def projected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The used columns of all events, read by the name of a view."""
    name = f"raw_events_{uuid4().hex}"
    named = name_table(raw_events(spark, sf_dir), name)
    pruned = clean.project_events(named)
    spark.catalog.dropTempView(name)
    return pruned


def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid(spark, sf_dir)


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir)


EVENT_ORDER = ("userId", "ts", *[c for c in EVENT_COLUMNS if c not in ("userId", "ts")])


def sorted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their place in the order by user and time, then by all other columns."""
    return order.with_position(valid(spark, sf_dir), *EVENT_ORDER)


def event_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether sorted events stand in order: all of them, and where they do not."""
    return order.order_breaks(order.ordered_slots(valid(spark, sf_dir), "userId", "ts"), "userId", "ts")


def sessions_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered session report, with the place of each line."""
    report = reports.sessions_by_day(*labelled(spark, sf_dir))
    return rounded(order.with_position(report, "activity_time", "label"))


# Every so many milliseconds an event's line is followed by its first half, which is no JSON.
BROKEN_EVERY = 101


def _run_folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/run-{uuid4().hex}"


def _json_lines(events: DataFrame, path: str) -> str:
    """Write the events as JSON lines, some of them with a broken line after them."""
    whole = F.to_json(F.struct("*"))
    half = F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
    lines = F.when(F.col("ts") % BROKEN_EVERY == 0, F.array(whole, half)).otherwise(F.array(whole))
    events.select(F.explode(lines).alias("value")).write.text(path)
    return path


def events_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexed events of a prepared run over JSON lines, and how many lines were broken."""
    root = _run_folder(spark)
    out = prepare(spark, _json_lines(raw_events(spark, sf_dir), f"{root}/events.json"), f"{root}/out")
    bad = read_table(spark, out.load_report).first()["bad_lines"]
    events = read_table(spark, out.events).select(*EVENT_COLUMNS, *DERIVED_COLUMNS)
    return events.withColumn("bad_lines", F.lit(bad).cast("long"))


def index_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.frequency_index(valid(spark, sf_dir), "userId", USER_INDEX)


def indexed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_events(valid(spark, sf_dir)).select(*EVENT_COLUMNS, *DERIVED_COLUMNS)


def last_week_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.last_period(cleaned(spark, sf_dir))


def last_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.last_state(cleaned(spark, sf_dir), "level")


def first_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.first_state(cleaned(spark, sf_dir), "gender")


def _encoded(users: DataFrame, column: str) -> DataFrame:
    coded = index.encode_category(users, column, "vector")
    return coded.select("userId", column, f"{column}Index", vector_to_array("vector")[0].alias(f"{column}_0"))


def encoded_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(last_level(spark, sf_dir), "level")


def encoded_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(first_gender(spark, sf_dir), "gender")


# Labels -------------------------------------------------------------------------


def churn_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.churn_label(cleaned(spark, sf_dir))


def churn_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(labels.churn_rate(churn_label(spark, sf_dir)))


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = churn_label(spark, sf_dir)
    rate = labels.churn_rate(users).first()["churn_rate"]
    return rounded(labels.class_weights(users, rate))


# Reports ------------------------------------------------------------------------


def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.date_ranges(cleaned(spark, sf_dir))


def users_by_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.users_by_registration(profiles(spark, sf_dir))


def registration_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    chart = reports.chart_table(users_by_registration(spark, sf_dir), "registration")
    return reports.cumulative(chart, "registration")


def users_by_last_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.users_by_last_activity(profiles(spark, sf_dir))


def last_activity_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    chart = reports.chart_table(users_by_last_activity(spark, sf_dir), "ts")
    return reports.cumulative(chart, "ts")


def mean_age_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.mean_age_by_day(*labelled(spark, sf_dir)))


def mean_age_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.chart_table(reports.mean_age_by_day(*labelled(spark, sf_dir)), "ts"))


def user_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.user_age(profiles(spark, sf_dir)))


def churned_user_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.of_label(reports.user_age(profiles(spark, sf_dir)), 1, "age")


def age_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.histogram(profiles(spark, sf_dir), "age"))


def mean_age_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.histogram(profiles(spark, sf_dir), "avg_age"))


def activity_by_age_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.activity_by_age_day(*labelled(spark, sf_dir)))


def activity_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.activity_by_age_day(*labelled(spark, sf_dir))
    return rounded(reports.chart_table(report, "user_age_when_played"))


def sessions_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.sessions_by_day(*labelled(spark, sf_dir)))


def sessions_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.sessions_by_day(*labelled(spark, sf_dir))
    return rounded(reports.chart_table(report, "activity_time"))


# Feature blocks -----------------------------------------------------------------


def _block(build: Callable[..., blocks.Block], *args: object, period: blocks.Period | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = cleaned(spark, sf_dir)
        if period is None:
            return rounded(blocks.user_table(events, [build(*args)]))
        if period.flag is not None:
            events = slices.with_last_ts(events)
        return rounded(blocks.user_table(events, [build(*args, period=period)]))

    return query


def _found_block(build: Callable[..., blocks.Block], column: str, excluded: Sequence[str] = ()) -> Query:
    """A block over the values that the events turn out to have."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = cleaned(spark, sf_dir)
        values = blocks.discover_values(events, column, excluded)
        return rounded(blocks.user_table(events, [build(values)]))

    return query


def prefixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.prefix_columns(first_gender(spark, sf_dir), "first")


def base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow table that page, plan and hour features of both periods are rolled up from."""
    return rounded(blocks.base_counts(slices.with_last_ts(cleaned(spark, sf_dir))))


def session_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(blocks.session_features(cleaned(spark, sf_dir)))


# Ratings and latent features ----------------------------------------------------


def artist_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ratings.item_ratings(cleaned(spark, sf_dir)))


def last_week_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ratings.period_ratings(slices.with_last_ts(cleaned(spark, sf_dir))))


def carried_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = cleaned(spark, sf_dir)
    recent = ratings.item_ratings(slices.last_period(events))
    return rounded(ratings.carry_over(ratings.item_ratings(events), recent))


def _latent(events: DataFrame, artists: DataFrame, key: str) -> DataFrame:
    pairs = ratings.rated(ratings.period_ratings(events, key, ARTIST_INDEX))
    factors = materialise(formula_factors(artists))
    return ratings.latent_features(
        pairs, factors, {"als_all": "rating", "als_lw": "recent_rating"}, key, ARTIST_INDEX
    )


def latent_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = valid(spark, sf_dir)
    artists = index.frequency_index(usable, "artist", ARTIST_INDEX)
    kept = clean.after_registration(clean.with_times(usable))
    events = slices.with_last_ts(index.attach_index(kept, artists, "artist", ARTIST_INDEX, invalid="keep"))
    return rounded(_latent(events, artists, "userId"))


def _indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What features need of the indexed events, written once for several scans."""
    return materialise(feature_events(index_events(valid(spark, sf_dir))))


def _formula_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _indexed(spark, sf_dir)
    artists = events.where(F.col("artist").isNotNull()).groupBy(ARTIST_INDEX).agg(F.count(F.lit(1)).alias("n"))
    base = materialise(blocks.base_counts(events, USER_INDEX))
    return feature_columns(events, _latent(events, artists, USER_INDEX), base, PAGES, LEVELS)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(assemble.stored_key(whole_period(_formula_features(spark, sf_dir)), USER_INDEX))


def feature_table_last_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(assemble.stored_key(both_periods(_formula_features(spark, sf_dir)), USER_INDEX))


def assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and sum of each user's feature vector (of the rounded features)."""
    vectors = assemble.assemble_features(feature_table_last_week(spark, sf_dir), USER_INDEX)
    values = vectors.select(USER_INDEX, "label", vector_to_array("features").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, b: a + b)
    return rounded(values.select(USER_INDEX, "label", F.size("v").alias("width"), total.alias("total")))


def ranked_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session features ranked by how far users who left are from the others."""
    events, churn = labelled(spark, sf_dir)
    table = labels.with_label(blocks.session_features(events), churn)
    names = [c for c in table.columns if c not in ("userId", "label")]
    gone, stayed = F.col("label") == 1, F.col("label") == 0
    gaps = table.agg(*[(F.avg(F.when(gone, F.col(c))) - F.avg(F.when(stayed, F.col(c)))).alias(c) for c in names])
    long = gaps.unpivot([], names, "feature", "coefficient")
    return rounded(evaluate.rank_coefficients(long, by_size=True))


def max_abs_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = blocks.session_features(cleaned(spark, sf_dir))
    return rounded(assemble.scale_columns(table, [c for c in table.columns if c != "userId"]))


# Splits and metrics -------------------------------------------------------------


def _parts(parts: list[DataFrame]) -> DataFrame:
    train, test = (p.withColumn("part", F.lit(name)) for p, name in zip(parts, ("training", "test")))
    return train.unionByName(test)


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(models.hash_split(churn_label(spark, sf_dir), "userId"))


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each user is in a part: once, whatever parts the engine draws; and whether
    the share of the training part is one that such a draw has (within 5 standard
    deviations)."""
    parts = materialise(_parts(models.random_split(churn_label(spark, sf_dir))))
    n, drawn = parts.agg(F.count(F.lit(1)), F.count_if(F.col("part") == "training")).first()
    likely = (drawn - SPLIT[0] * n) ** 2 <= 25 * n * SPLIT[0] * SPLIT[1]
    return parts.groupBy("userId", "label").agg(F.count("part").alias("times"), F.lit(likely).alias("likely_share"))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.confusion_matrix(judged(spark, sf_dir)))


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.classification_report(judged(spark, sf_dir)))


def weighted_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.weighted_f1(judged(spark, sf_dir)))


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three guesses at the truth in ``labels``, scored and compared."""
    guesses = {
        "linear_svm": F.lit(0.0),
        "logistic_regression": F.col("prediction"),
        "random_forest": 1 - F.col("prediction"),
    }
    pairs = F.array(*[F.struct(F.lit(n).alias("classifier"), g.alias("prediction")) for n, g in guesses.items()])
    rows = judged(spark, sf_dir).select("label", F.inline(pairs))
    return rounded(evaluate.best_model(evaluate.weighted_f1(rows, ["classifier"])))


# Training (values depend on the engine) -----------------------------------------


def _training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _indexed(spark, sf_dir)
    pairs = materialise(ratings.rated(ratings.period_ratings(events, USER_INDEX, ARTIST_INDEX)))
    factors = materialise(ratings.item_factors(pairs))
    latent = ratings.latent_features(pairs, factors, {"als_all": "rating", "als_lw": "recent_rating"})
    base = materialise(blocks.base_counts(events, USER_INDEX))
    return materialise(assemble.stored_key(feature_columns(events, latent, base, PAGES, LEVELS), USER_INDEX))


# Users are solved last, so theirs are least-squares answers up to the factors' single precision;
# items were solved just before that.
USER_RESIDUAL, ITEM_RESIDUAL = 1e-3, 0.25


def als_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user and item with ratings: its factors' rank, whether they are numbers, and
    whether they solve its normal equations within the bound."""
    pairs = materialise(ratings.rated(ratings.period_ratings(_indexed(spark, sf_dir), USER_INDEX, ARTIST_INDEX)))
    users, items = (materialise(side) for side in ratings.factorise(pairs))
    of_users = ratings.normal_residuals(pairs, users, items, USER_INDEX, ARTIST_INDEX)
    of_items = ratings.normal_residuals(pairs, items, users, ARTIST_INDEX, USER_INDEX)
    sides = [
        side.select(
            F.lit(kind).alias("kind"), "id", "rank", "finite", "ratings", (F.col("residual") <= bound).alias("solved")
        )
        for kind, side, bound in (("user", of_users, USER_RESIDUAL), ("item", of_items, ITEM_RESIDUAL))
    ]
    return sides[0].unionByName(sides[1])


def _train(name: str, spark: SparkSession, sf_dir: str) -> tuple[models.Trained, DataFrame]:
    """The trained classifier, and the rows it was trained on with scaled features."""
    vectors = assemble.assemble_features(both_periods(_training_table(spark, sf_dir)), USER_INDEX)
    # Read back from Parquet: names of features come from what was stored.
    table = write_table(vectors, f"{_run_folder(spark)}/features")
    rate = labels.churn_rate(churn_label(spark, sf_dir)).first()["churn_rate"]
    training, test = models.hash_split(labels.class_weights(table, rate), USER_INDEX)
    trained = models.train_and_score(training, test, name, "weights")
    return trained, trained.model.stages[0].transform(training)


def _checked(trained: models.Trained) -> DataFrame:
    """Hold-out users: whether the prediction is a label, and whether the score of the
    predictions is the report's weighted F1."""
    f1 = evaluate.weighted_f1(trained.predictions).first()["f1"]
    return trained.predictions.select(
        USER_INDEX,
        "label",
        F.col("prediction").isin(0.0, 1.0).alias("is_label"),
        F.lit(abs(f1 - trained.f1) < 1e-9).alias("f1_agrees"),
    )


# Bounds of the checks: length of the loss gradient against that at the zero model, and how
# much a step may lower the hinge loss (1 at the zero model).
GRADIENT_BOUND, HINGE_BOUND = 0.01, 0.01


def train_logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, rows = _train("logistic_regression", spark, sf_dir)
    gradient = settled_logistic(rows, trained.model.stages[-1], "weights")
    return _checked(trained).withColumn("settled", F.lit(gradient <= GRADIENT_BOUND))


def train_linear_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, rows = _train("linear_svm", spark, sf_dir)
    _, lowered = settled_svm(rows, trained.model.stages[-1], "weights")
    return _checked(trained).withColumn("settled", F.lit(lowered <= HINGE_BOUND))


def train_random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With each hold-out user's vote by joins over the table of the forest's nodes."""
    trained, _ = _train("random_forest", spark, sf_dir)
    forest = trained.model.stages[-1]
    nodes = forest_nodes(spark, forest, f"{_run_folder(spark)}/forest")
    votes = forest_votes(trained.predictions, nodes, USER_INDEX, depth=forest.getMaxDepth())
    voted = votes.select(USER_INDEX, F.col("prediction").alias("voted"))
    joined = _checked(trained).join(trained.predictions.select(USER_INDEX, "prediction"), USER_INDEX)
    checked = joined.join(voted, USER_INDEX, "left")
    agrees = F.coalesce(F.col("voted") == F.col("prediction"), F.lit(False))
    return checked.select(USER_INDEX, "label", "is_label", "f1_agrees", agrees.alias("votes_agree"))


def logistic_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each feature's place in the vector, whether the ranking is by falling size, and
    whether the coefficients scaled back give the model's margins on unscaled features."""
    trained, _ = _train("logistic_regression", spark, sf_dir)
    scaler, model = trained.model.stages
    table = evaluate.unscaled_coefficients(trained.coefficients(), scaler.maxAbs.toArray().tolist())
    ranked = evaluate.rank_coefficients(table, by_size=True)
    sizes = [r["coefficient"] for r in ranked.collect()]
    margins = evaluate.linear_margins(trained.predictions, table, float(model.intercept), USER_INDEX)
    both = margins.join(trained.predictions.select(USER_INDEX, vector_to_array("rawPrediction")[1].alias("raw")), USER_INDEX)
    gap = both.agg(F.max(F.abs(F.col("margin") - F.col("raw")) / (1 + F.abs("raw")))).first()[0]
    return ranked.select(
        "feature",
        "position",
        F.lit(sizes == sorted(sizes, reverse=True)).alias("by_size"),
        F.lit(gap is not None and gap < 1e-6).alias("scaled_back"),
    )


def churn_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run on the users with an even id, from JSON lines to the choice of a
    classifier, then the chosen one on the other users.

    One row per score: whether it is the weighted F1 of the predictions that were written
    (for the class-weighted model, whose predictions are), whether the choice is the best
    class-weighted score, on equal scores the first in order, and how often the second
    dataset was trained on: once, with the chosen classifier.
    """
    root = _run_folder(spark)
    events = raw_events(spark, sf_dir).where("userId is null or userId <> ''")
    even = F.coalesce(F.col("userId").cast("long") % 2, F.lit(0)) == 0
    runs = []
    for name, part in (("first", events.where(even)), ("second", events.where(~even))):
        out = prepare(spark, _json_lines(part, f"{root}/{name}.json"), f"{root}/{name}")
        write_features(spark, out)
        runs.append(out)
    for classifier in CLASSIFIER_PRIORITY:
        train(spark, runs[0], classifier)
    chosen = choose(spark, runs[0], f"{root}/choice")
    train(spark, runs[1], chosen)

    found = []
    for name, out in zip(("first", "second"), runs):
        scores = read_scores(spark, out.scores).collect()
        best = {r["classifier"]: r["f1"] for r in scores if r["weighted"]}
        top = next(c for c in CLASSIFIER_PRIORITY if best.get(c) == max(best.values()))
        for row in scores:
            kept = row["f1"]
            if row["weighted"]:
                predictions = read_table(spark, f"{out.predictions}/{row['classifier']}")
                kept = evaluate.weighted_f1(predictions).first()["f1"]
            classifier = row["classifier"] if name == "first" else "chosen" * (row["classifier"] == chosen)
            found.append((name, classifier, row["weighted"], abs(kept - row["f1"]) < 1e-9, top == chosen))
    return spark.createDataFrame(found, "dataset string, classifier string, weighted boolean, f1_agrees boolean, best boolean")


QUERIES: dict[str, Query] = {
    "projected_events": projected_events,
    "valid_events": valid_events,
    "clean_events": clean_events,
    "sorted_events": sorted_events,
    "event_order": event_order,
    "events_from_json": events_from_json,
    "index_users": index_users,
    "indexed_events": indexed_events,
    "last_week_events": last_week_events,
    "last_level": last_level,
    "first_gender": first_gender,
    "encoded_level": encoded_level,
    "encoded_gender": encoded_gender,
    "churn_label": churn_label,
    "churn_rate": churn_rate,
    "class_weights": class_weights,
    "date_ranges": date_ranges,
    "users_by_registration": users_by_registration,
    "registration_chart": registration_chart,
    "users_by_last_activity": users_by_last_activity,
    "last_activity_chart": last_activity_chart,
    "mean_age_by_day": mean_age_by_day,
    "mean_age_chart": mean_age_chart,
    "user_age": user_age,
    "churned_user_ages": churned_user_ages,
    "age_histogram": age_histogram,
    "mean_age_histogram": mean_age_histogram,
    "activity_by_age_day": activity_by_age_day,
    "activity_chart": activity_chart,
    "sessions_by_day": sessions_by_day,
    "sessions_chart": sessions_chart,
    "sessions_in_order": sessions_in_order,
    "page_share": _block(blocks.page_share, PAGES, period=blocks.ALL),
    "page_share_last_week": _block(blocks.page_share, PAGES, period=blocks.LAST_WEEK),
    "page_share_found": _found_block(blocks.page_share, "page", CANCEL_PAGES),
    "page_counts": _block(blocks.page_counts, PAGES, period=blocks.ALL),
    "page_counts_last_week": _block(blocks.page_counts, PAGES, period=blocks.LAST_WEEK),
    "level_share": _block(blocks.level_share, LEVELS, period=blocks.ALL),
    "level_share_last_week": _block(blocks.level_share, LEVELS, period=blocks.LAST_WEEK),
    "level_share_found": _found_block(blocks.level_share, "level"),
    "length_stats": _block(blocks.length_stats, period=blocks.ALL),
    "length_stats_last_week": _block(blocks.length_stats, period=blocks.LAST_WEEK),
    "hourly_counts": _block(blocks.hourly_counts, period=blocks.ALL),
    "hourly_counts_last_week": _block(blocks.hourly_counts, period=blocks.LAST_WEEK),
    "hourly_mean_length": _block(blocks.hourly_mean_length, period=blocks.ALL),
    "hourly_mean_length_last_week": _block(blocks.hourly_mean_length, period=blocks.LAST_WEEK),
    "age_features": _block(blocks.age_features),
    "prefixed_columns": prefixed_columns,
    "base_counts": base_counts,
    "session_features": session_features,
    "artist_ratings": artist_ratings,
    "last_week_ratings": last_week_ratings,
    "carried_ratings": carried_ratings,
    "latent_projection": latent_projection,
    "feature_table": feature_table,
    "feature_table_last_week": feature_table_last_week,
    "assembled_features": assembled_features,
    "ranked_differences": ranked_differences,
    "max_abs_scaled": max_abs_scaled,
    "hash_split": hash_split,
    "random_split": random_split,
    "confusion_matrix": confusion_matrix,
    "classification_report": classification_report,
    "weighted_f1": weighted_f1,
    "best_model": best_model,
    "als_factors": als_factors,
    "train_random_forest": train_random_forest,
    "train_logistic_regression": train_logistic_regression,
    "train_linear_svm": train_linear_svm,
    "logistic_coefficients": logistic_coefficients,
    "churn_run": churn_run,
}
