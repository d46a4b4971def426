import numpy as np
import pytest

from churnlens.operators.ratings import (
    carry_over,
    item_factors,
    item_ratings,
    latent_features,
    period_ratings,
    rated,
)
from churnlens.operators.slices import last_period, with_last_ts
from churnlens.registry import queries as Q

from .helpers import START, event, events, rows

LONG_AGO = START - 8 * 24 * 3600 * 1000


def plays(*specs):
    return [event(u, ts, artist=a, song=s) for u, ts, a, s in specs]


def test_rating_is_relative_to_the_top_artist(spark):
    frame = events(
        spark,
        *plays(("u", 1, "x", "s"), ("u", 2, "x", "t"), ("u", 3, "y", "s"), ("u", 4, "z", None), ("u", 5, None, "s")),
    )
    assert sorted(rows(item_ratings(frame))) == [("u", "x", 1.0), ("u", "y", 0.5), ("u", "z", 0.0)]


def test_user_without_songs_has_no_rating(spark):
    frame = with_last_ts(events(spark, *plays(("u", 1, "x", None))))
    assert rows(item_ratings(frame)) == [("u", "x", None)]
    assert rows(period_ratings(frame)) == [("u", "x", None, 0.0)]
    assert rated(period_ratings(frame)).count() == 0


def test_last_week_ratings_keep_all_pairs(spark):
    frame = with_last_ts(
        events(
            spark,
            *plays(
                ("u", LONG_AGO, "x", "s"),
                ("u", LONG_AGO, "x", "s"),
                ("u", START, "y", "s"),
                ("u", START, "z", None),
                ("v", LONG_AGO, "x", "s"),
                ("v", START, None, None),
            ),
        )
    )
    got = {(u, a): (r, lw) for u, a, r, lw in rows(period_ratings(frame))}
    assert got == {
        ("u", "x"): (1.0, 0.0),
        ("u", "y"): (0.5, 1.0),
        ("u", "z"): (0.0, 0.0),
        ("v", "x"): (1.0, 0.0),
    }
    joined = carry_over(item_ratings(frame), item_ratings(last_period(frame)))
    assert {(u, a): lw for u, a, lw in rows(joined)} == {pair: lw for pair, (_, lw) in got.items()}


def test_period_ratings_need_the_last_time(spark):
    with pytest.raises(ValueError, match="last_ts"):
        period_ratings(events(spark, event()))


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_latent_features_are_a_matrix_product(spark, broadcast_bytes):
    rng = np.random.default_rng(3)
    matrix, factors = rng.random((12, 9)) * (rng.random((12, 9)) < 0.5), rng.random((9, 4))
    cells = [(float(u), float(i), float(matrix[u, i])) for u, i in zip(*np.nonzero(matrix))]
    ratings = spark.createDataFrame(cells, "userIdIndex double, artistIndex double, rating double")
    ratings = ratings.withColumn("half", ratings.rating / 2)
    table = spark.createDataFrame([(i, factors[i].tolist()) for i in range(9)], "id int, features array<double>")
    got = latent_features(ratings, table, {"a": "rating", "b": "half"}, rank=4, broadcast_bytes=broadcast_bytes)
    assert got.columns == ["userIdIndex", *[f"a_{k}" for k in range(4)], *[f"b_{k}" for k in range(4)]]
    product = matrix @ factors
    for row in got.collect():
        user = product[int(row[0])]
        assert np.allclose(row[1:5], user) and np.allclose(row[5:], user / 2)


def test_factors_reproduce_the_ratings(spark):
    cells = [(float(u), float(i), float((u + 1) * (i + 1)) / 12) for u in range(3) for i in range(4)]
    ratings = spark.createDataFrame(cells, "userIdIndex double, artistIndex double, rating double")
    factors = {r["id"]: np.array(r["features"]) for r in item_factors(ratings, rank=2, user_blocks=2, item_blocks=2).collect()}
    assert set(factors) == {0, 1, 2, 3}
    # Rank-one ratings: item factors are multiples of each other.
    base = factors[0]
    for i, f in factors.items():
        assert np.allclose(f, base * (i + 1), rtol=0.1)


def test_factors_are_the_same_when_run_again(spark, sf_dir):
    pairs = Q.ratings.period_ratings(Q._indexed(spark, sf_dir), "userIdIndex", "artistIndex")
    first, second = (
        {r["id"]: r["features"] for r in item_factors(pairs, rank=3, user_blocks=2, item_blocks=2).collect()} for _ in range(2)
    )
    assert first.keys() == second.keys()
    assert all(np.allclose(first[i], second[i], atol=1e-4) for i in first)
