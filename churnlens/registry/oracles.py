"""The same results as SQL for another engine, from the same tables.

Written in long form (per-page rows, then CASE columns; totals of a user in tables
of their own that are joined back), so that it checks the one-pass formulation of the operators.

Doubles are rounded to six places, 1e-9 above their value: a mean that lies exactly
between two roundings would otherwise go up or down by the order of its summands.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from churnlens.constants import ALS_RANK, CLASSIFIER_PRIORITY, EVENT_COLUMNS, HOURS
from churnlens.functions.scalars import name_part
from churnlens.sources.clickstream import LEVELS, PAGES

COLUMNS = ", ".join(EVENT_COLUMNS)

CLICK = """
click AS (
  SELECT
    CASE WHEN user_id = 0 THEN '' WHEN user_id <> 1 THEN CAST(user_id AS VARCHAR) END AS userId,
    CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    'city_' || CAST(user_id % 10 AS VARCHAR) AS location,
    CASE user_id % 3 WHEN 0 THEN 'paid' WHEN 1 THEN 'free'
      ELSE CASE WHEN k < 50 THEN 'free' ELSE 'paid' END END AS level,
    CASE WHEN k <> 0 THEN CAST(floor((ms - 1704067200000) / 86400000) AS BIGINT) END AS sessionId,
    CASE event_type
      WHEN 'view' THEN 'NextSong'
      WHEN 'click' THEN CASE WHEN k < 50 THEN 'Home' ELSE 'Thumbs Up' END
      WHEN 'signup' THEN 'Add to Playlist'
      WHEN 'purchase' THEN 'Upgrade'
      WHEN 'error' THEN CASE WHEN value >= 150 THEN 'Cancellation Confirmation'
        WHEN value >= 100 THEN 'Cancel' ELSE 'Error' END
    END AS page,
    CASE WHEN event_type = 'view' THEN 'artist_' || CAST(k % 20 AS VARCHAR) END AS artist,
    CASE WHEN event_type = 'view' AND k % 7 <> 0 THEN 'song_' || CAST(event_id % 500 AS VARCHAR) END AS song,
    CASE WHEN event_type = 'view' THEN value END AS length,
    'ua' AS userAgent,
    1703030400000 + (user_id % 25) * 86400000 AS registration,
    ms AS ts
  FROM (
    SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, epoch_us(ts) // 1000 AS ms FROM events
  )
)"""
VALID = f"""
valid AS (
  SELECT {COLUMNS} FROM click WHERE userId IS NOT NULL AND userId <> '' AND sessionId IS NOT NULL
)"""
CLEAN = """
clean AS (
  SELECT *, make_timestamp((ts // 1000) * 1000000) AS "timestamp",
    make_timestamp((registration // 1000) * 1000000) AS registration_date,
    ts - registration AS elapsed,
    CAST(round((ts - registration) / 86400000) AS INTEGER) AS elapsed_days
  FROM valid
  WHERE round((ts - registration) / 86400000) >= 0
)"""
RECENT = """
last_seen AS (SELECT userId, max(ts) AS last_ts FROM clean GROUP BY userId),
recent AS (SELECT clean.* FROM clean JOIN last_seen USING (userId) WHERE last_ts - ts <= 604800000)"""
CHURN = """
churn AS (
  SELECT userId, CAST(bool_or(coalesce(page = 'Cancellation Confirmation', false)) AS INTEGER) AS label
  FROM clean GROUP BY userId
)"""
USER_INDEX = """
users AS (
  SELECT userId, count(*) AS occurrences,
    CAST(row_number() OVER (ORDER BY count(*) DESC, userId) - 1 AS DOUBLE) AS userIdIndex
  FROM valid GROUP BY userId
)"""
ARTIST_INDEX = """
artists AS (
  SELECT artist, CAST(row_number() OVER (ORDER BY count(*) DESC, artist) - 1 AS DOUBLE) AS artistIndex
  FROM valid WHERE artist IS NOT NULL GROUP BY artist
)"""


def sql(select: str, *ctes: str) -> str:
    return "WITH" + ",".join([CLICK, VALID, CLEAN, *ctes]) + "\n" + select.strip()


# Reports ------------------------------------------------------------------------


def _by_date(day: str, name: str) -> str:
    return f"""
SELECT day AS {name}, label, count(*) AS count
FROM (SELECT userId, {day} AS day FROM clean GROUP BY userId) JOIN churn USING (userId)
GROUP BY day, label"""


def _date_chart(day: str, name: str) -> str:
    return f"""
SELECT {name}, n0 AS "count Not Cancelled", n1 AS "count Cancelled",
  CAST(sum(n0) OVER (ORDER BY {name}) AS BIGINT) AS "cumulative count Not Cancelled",
  CAST(sum(n1) OVER (ORDER BY {name}) AS BIGINT) AS "cumulative count Cancelled"
FROM (
  SELECT day AS {name}, count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1
  FROM (SELECT userId, {day} AS day FROM clean GROUP BY userId) JOIN churn USING (userId)
  GROUP BY day
)"""


REGISTERED = "min(CAST(registration_date AS DATE))"
LAST_ACTIVE = 'max(CAST("timestamp" AS DATE))'

MEAN_AGE = """
daily AS (
  SELECT userId, CAST("timestamp" AS DATE) AS ts, avg(elapsed_days) AS age FROM clean GROUP BY ALL
),
report AS (
  SELECT ts, label, count(*) AS users, avg(age) AS age FROM daily JOIN churn USING (userId) GROUP BY ts, label
)"""
USER_AGE = """
report AS (
  SELECT userId, max(elapsed_days) AS age, avg(elapsed_days) AS avg_age,
    CAST(count(*) FILTER (page = 'Cancellation Confirmation') > 0 AS INTEGER) AS label
  FROM clean GROUP BY userId
)"""
ACTIVITY = """
daily AS (
  SELECT userId, elapsed_days, count(*) FILTER (page = 'NextSong') AS songs,
    count(*) - count(*) FILTER (page = 'NextSong') AS others
  FROM clean GROUP BY userId, elapsed_days
),
report AS (
  SELECT elapsed_days AS user_age_when_played, label, count(*) AS users_count,
    CAST(sum(songs) AS BIGINT) AS songs_played, avg(songs) AS avg_songs_played,
    stddev_samp(songs) AS std_songs_played,
    CAST(sum(others) AS BIGINT) AS page_interactions, avg(others) AS avg_page_interactions,
    stddev_samp(others) AS std_page_interactions
  FROM daily JOIN churn USING (userId) GROUP BY elapsed_days, label
)"""
VISITS = """
visits AS (
  SELECT userId, sessionId, min(elapsed_days) AS first_day, count(*) AS events, count(page) AS pages,
    count(DISTINCT artist) AS artists, avg(length) AS mean_length, (max(ts) - min(ts)) / 1000 AS seconds
  FROM clean GROUP BY userId, sessionId
)"""
SESSIONS = """
report AS (
  SELECT first_day AS activity_time, label, count(*) AS sessions, avg(events) AS interactions,
    avg(seconds) AS session_time
  FROM visits JOIN churn USING (userId) GROUP BY first_day, label
)"""


def _long(index: str, counts: Iterable[str], measures: Iterable[str]) -> str:
    """All columns of ``report``, doubles rounded."""
    return (
        f"SELECT {index}, label, "
        + ", ".join([*counts, *(f"round({m} + 1e-9, 6) AS {m}" for m in measures)])
        + " FROM report"
    )


def _wide(index: str, counts: Iterable[str], measures: Iterable[str]) -> str:
    cell = "coalesce(max(CASE WHEN label = {l} THEN {m} END), 0)"
    parts = []
    for label, name in ((0, "Not Cancelled"), (1, "Cancelled")):
        parts += [f'{cell.format(l=label, m=m)} AS "{m} {name}"' for m in counts]
        parts += [f'round({cell.format(l=label, m=m)} + 1e-9, 6) AS "{m} {name}"' for m in measures]
    return f"SELECT {index}, {', '.join(parts)} FROM report GROUP BY {index}"


ACTIVITY_COUNTS = ("users_count", "songs_played", "page_interactions")
ACTIVITY_MEASURES = (
    "avg_songs_played",
    "std_songs_played",
    "avg_page_interactions",
    "std_page_interactions",
)


def _histogram(column: str) -> str:
    """Ten bins a label: those of the label's range first, then the users in each."""
    return f"""
SELECT label, bin, round(bin_low + 1e-9, 6) AS bin_low, round(bin_high + 1e-9, 6) AS bin_high,
  (SELECT count({column}) FROM report r WHERE r.label = bins.label AND r.{column} >= bin_low
    AND (r.{column} < bin_high OR bin = 9 AND r.{column} <= bin_high)) AS users
FROM (
  SELECT label, CAST(i AS INTEGER) AS bin, low + i * ((high - low) / 10) AS bin_low,
    CASE WHEN i = 9 THEN high ELSE low + (i + 1) * ((high - low) / 10) END AS bin_high
  FROM (
    SELECT label, CAST(min({column}) AS DOUBLE) - CASE WHEN min({column}) = max({column}) THEN 0.5 ELSE 0 END AS low,
      CAST(max({column}) AS DOUBLE) + CASE WHEN min({column}) = max({column}) THEN 0.5 ELSE 0 END AS high
    FROM report WHERE {column} IS NOT NULL GROUP BY label
  ), range(10) AS steps(i)
) bins"""


# Feature blocks: rows per (user, value) first, then one column per value ----------


class PeriodBlocks:
    """CTEs of the feature blocks of one period, over ``source``."""

    def __init__(self, name: str, source: str) -> None:
        self.name, self.source = name, source

    def pages(self) -> tuple[str, str, list[str]]:
        cte = f"""
page_rows_{self.name} AS (
  SELECT userId, page, count(*) AS n FROM {self.source}
  WHERE page NOT IN ('Cancel', 'Cancellation Confirmation') GROUP BY ALL
),
page_totals_{self.name} AS (SELECT userId, sum(n) AS total FROM page_rows_{self.name} GROUP BY userId),
pages_{self.name} AS (
  SELECT userId, page, n, n / total AS part FROM page_rows_{self.name} JOIN page_totals_{self.name} USING (userId)
)"""
        return cte, f"pages_{self.name}", [f"'{p}'" for p in PAGES]

    def page_share(self) -> tuple[str, str]:
        columns = _columns(
            (f"page_pct_{self.name}_{name_part(p)}", f"round(coalesce(sum(part) FILTER (page = '{p}'), 0) + 1e-9, 6)")
            for p in PAGES
        )
        return f"SELECT userId, {columns} FROM pages_{self.name} GROUP BY userId", self.pages()[0]

    def page_counts(self) -> tuple[str, str]:
        columns = _columns(
            (
                f"page_count_{self.name}_{name_part(p)}",
                f"CAST(coalesce(sum(n) FILTER (page = '{p}'), 0) AS BIGINT)",
            )
            for p in PAGES
        )
        return f"SELECT userId, {columns} FROM pages_{self.name} GROUP BY userId", self.pages()[0]

    def level_share(self) -> tuple[str, str]:
        cte = f"""
level_totals_{self.name} AS (SELECT userId, count(level) AS total FROM {self.source} GROUP BY userId),
levels_{self.name} AS (
  SELECT userId, level, count(*) / any_value(total) AS part
  FROM {self.source} JOIN level_totals_{self.name} USING (userId) WHERE level IS NOT NULL GROUP BY ALL
)"""
        columns = _columns(
            (f"level_pct_{self.name}_{v}", f"round(coalesce(sum(part) FILTER (level = '{v}'), 0) + 1e-9, 6)")
            for v in LEVELS
            if v != "free"
        )
        return f"SELECT userId, {columns} FROM levels_{self.name} GROUP BY userId", cte

    def length_stats(self) -> tuple[str, str]:
        name = f"song_length_{self.name}"
        return (
            f"""SELECT userId, round(coalesce(avg(length), 0) + 1e-9, 6) AS {name}_mean,
  round(coalesce(stddev_samp(length), 0) + 1e-9, 6) AS {name}_std
FROM {self.source} GROUP BY userId""",
            "",
        )

    def _hours(self) -> str:
        return f"""
hours_{self.name} AS (
  SELECT userId, hour("timestamp") AS hour, count(*) AS n, avg(length) AS mean
  FROM {self.source} GROUP BY ALL
)"""

    def hourly_counts(self) -> tuple[str, str]:
        columns = _columns(
            (f"hourly_event_counts_{self.name}_{h}", f"CAST(coalesce(sum(n) FILTER (hour = {h}), 0) AS BIGINT)")
            for h in HOURS
        )
        return f"SELECT userId, {columns} FROM hours_{self.name} GROUP BY userId", self._hours()

    def hourly_mean_length(self) -> tuple[str, str]:
        columns = _columns(
            (f"hourly_mean_song_length_{self.name}_{h}", f"round(coalesce(avg(mean) FILTER (hour = {h}), 0) + 1e-9, 6)")
            for h in HOURS
        )
        return f"SELECT userId, {columns} FROM hours_{self.name} GROUP BY userId", self._hours()

    def all(self) -> list[tuple[str, str]]:
        return [
            self.page_share(),
            self.page_counts(),
            self.level_share(),
            self.length_stats(),
            self.hourly_counts(),
            self.hourly_mean_length(),
        ]


def _columns(pairs: Iterable[tuple[str, str]]) -> str:
    return ",\n  ".join(f"{expression} AS {name}" for name, expression in pairs)


WHOLE, LAST_WEEK = PeriodBlocks("all", "clean"), PeriodBlocks("lw", "recent")


def _block(block: tuple[str, str], last_week: bool = False) -> str:
    select, cte = block
    return sql(select, *([RECENT] if last_week else []), *([cte] if cte else []))


AGE = "SELECT userId, max(elapsed_days) AS age, round(avg(elapsed_days) + 1e-9, 6) AS avg_age FROM clean GROUP BY userId"

SESSION_MEASURES = (
    ("pages", "avg_pages_accessed", "std_pages_accessed"),
    ("artists", "avg_count_artists", "std_count_artists"),
    ("mean_length", "avg_song_length", "std_song_length"),
    ("seconds", "avg_session_time", "std_session_time"),
)
SESSION_FEATURES = (VISITS + """,
session_table AS (
  SELECT userId, count(*) AS sessions_count, {columns}
  FROM visits GROUP BY userId
)""").format(
    columns=_columns(
        [(f"sessions_{avg}", f"coalesce(avg({m}), 0)") for m, avg, _ in SESSION_MEASURES]
        + [(f"sessions_{std}", f"coalesce(stddev_samp({m}), 0)") for m, _, std in SESSION_MEASURES]
    )
)
SESSION_COLUMNS = [f"sessions_{name}" for _, *names in SESSION_MEASURES for name in names]


def _session_select() -> str:
    columns = _columns((c, f"round({c} + 1e-9, 6)") for c in SESSION_COLUMNS)
    return f"SELECT userId, sessions_count, {columns} FROM session_table"


def _scaled() -> str:
    columns = _columns(
        (c, f"round(coalesce({c} / nullif(max(abs({c})) OVER (), 0), 0) + 1e-9, 6)")
        for c in ["sessions_count", *SESSION_COLUMNS]
    )
    return f"SELECT userId, {columns} FROM session_table"


# Ratings ------------------------------------------------------------------------


def _ratings(name: str, source: str) -> str:
    return f"""
{name}_plays AS (
  SELECT userId, artist, count(song) AS plays FROM {source} WHERE artist IS NOT NULL GROUP BY ALL
),
{name}_most AS (SELECT userId, nullif(max(plays), 0) AS most FROM {name}_plays GROUP BY userId),
{name} AS (SELECT userId, artist, plays / most AS rating FROM {name}_plays JOIN {name}_most USING (userId))"""


RATINGS = _ratings("ratings", "clean")
RECENT_RATINGS = _ratings("recent_ratings", "recent")


def _latent_cte() -> str:
    def product(k: int, rating: str) -> str:
        return f"sum({rating} * ((CAST(artistIndex AS BIGINT) * 7 + {k * 3}) % 11 - 5) / 10)"

    columns = _columns(
        [(f"als_all_{k}", f"round({product(k, 'rating')} + 1e-9, 6) + 0") for k in range(ALS_RANK)]
        + [(f"als_lw_{k}", f"round({product(k, 'recent_rating')} + 1e-9, 6) + 0") for k in range(ALS_RANK)]
    )
    return f"""
pairs AS (
  SELECT userId, artist, r.rating, coalesce(l.rating, 0) AS recent_rating
  FROM ratings r LEFT JOIN recent_ratings l USING (userId, artist)
  WHERE r.rating IS NOT NULL
),
latent AS (
  SELECT userId, {columns}
  FROM pairs JOIN artists USING (artist) GROUP BY userId
)"""


LATENT = _latent_cte()


def _feature_table(with_last_week: bool, final: str | None = None) -> str:
    blocks = WHOLE.all() + (LAST_WEEK.all() if with_last_week else [])
    ctes = dict.fromkeys(cte for _, cte in blocks if cte)
    selects = [s for s, _ in blocks] + [AGE, _session_select(), "SELECT userId, label FROM churn"]
    names = [f"b{i}" for i in range(len(selects))]
    named = [f"\n{n} AS (\n{s}\n)" for n, s in zip(names, selects)]
    joins = "\n".join(f"JOIN {n} USING (userId)" for n in names)
    drop = ["userId", "occurrences"] + ([] if with_last_week else [f"als_lw_{k}" for k in range(ALS_RANK)])
    select = f"SELECT * EXCLUDE ({', '.join(drop)}) FROM users JOIN latent USING (userId)\n{joins}"
    if final is not None:
        select = final.format(table=select)
    return sql(
        select,
        RECENT,
        CHURN,
        USER_INDEX,
        ARTIST_INDEX,
        RATINGS,
        RECENT_RATINGS,
        LATENT,
        SESSION_FEATURES,
        *ctes,
        *named,
    )


VECTOR_SUM = """
SELECT userIdIndex, CAST(any_value(label) AS INTEGER) AS label, CAST(count(*) AS INTEGER) AS width,
  round(sum(CAST(x AS DOUBLE)) + 1e-9, 6) AS total
FROM (
  UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM ({table})) ON COLUMNS(* EXCLUDE (userIdIndex, label)) INTO NAME f VALUE x
)
GROUP BY userIdIndex"""


def _differences() -> str:
    parts = [
        f"""SELECT '{c}' AS feature,
  round(abs(avg({c}) FILTER (label = 1) - avg({c}) FILTER (label = 0)) + 1e-9, 6) AS coefficient
FROM session_table JOIN churn USING (userId)"""
        for c in ["sessions_count", *SESSION_COLUMNS]
    ]
    return sql("\nUNION ALL\n".join(parts), CHURN, SESSION_FEATURES)


# Encoders -----------------------------------------------------------------------


def _encoded(column: str, order: str) -> str:
    states = f"""
states AS (
  SELECT userId, {column} FROM (
    SELECT userId, {column}, row_number() OVER (PARTITION BY userId ORDER BY {order}) AS place FROM clean
  ) WHERE place = 1
),
codes AS (
  SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS {column}Index
  FROM states GROUP BY {column}
)"""
    select = f"""
SELECT userId, {column}, {column}Index, CASE WHEN {column}Index = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {column}_0
FROM states JOIN codes USING ({column})"""
    return sql(select, states)


LAST_ORDER = "ts DESC, level DESC"
FIRST_ORDER = "ts, gender"


def _state(column: str, order: str, name: str | None = None) -> str:
    return sql(
        f"""
SELECT userId, {column} AS {name or column} FROM (
  SELECT userId, {column}, row_number() OVER (PARTITION BY userId ORDER BY {order}) AS place FROM clean
) WHERE place = 1"""
    )


# Metrics ------------------------------------------------------------------------

METRICS = """
judged AS (SELECT quality AS label, {guess} AS prediction FROM labels),
classes AS (SELECT label AS class FROM judged UNION SELECT prediction FROM judged),
sides AS (
  SELECT class,
    (SELECT count(*) FROM judged WHERE label = class) AS support,
    (SELECT count(*) FROM judged WHERE prediction = class) AS predicted,
    (SELECT count(*) FROM judged WHERE label = class AND prediction = class) AS hits
  FROM classes
),
metrics AS (
  SELECT class, support, hits, coalesce(hits / nullif(predicted, 0), 0) AS precision,
    coalesce(hits / nullif(support, 0), 0) AS recall,
    coalesce(2 * hits / nullif(predicted + support, 0), 0) AS f1
  FROM sides
)"""
F1 = "sum(f1 * support) / sum(support)"


def _best_model() -> str:
    guesses = {"linear_svm": "0", "logistic_regression": "toxic", "random_forest": "1 - toxic"}
    scores = []
    for place, (name, guess) in enumerate(guesses.items()):
        scores.append(
            f"SELECT '{name}' AS classifier, {place} AS place, (WITH {METRICS.format(guess=guess)} "
            f"SELECT {F1} FROM metrics) AS f1"
        )
    union = "\nUNION ALL\n".join(scores)
    return f"SELECT classifier, round(f1 + 1e-9, 6) AS f1 FROM ({union}) ORDER BY f1 DESC, place LIMIT 1"


JUDGED = METRICS.format(guess="toxic")

REPORT = f"""WITH {JUDGED}
SELECT CAST(class AS VARCHAR) AS class, round(precision + 1e-9, 6) AS precision, round(recall + 1e-9, 6) AS recall,
  round(f1 + 1e-9, 6) AS f1, support
FROM metrics
UNION ALL
SELECT 'accuracy', NULL, NULL, round(sum(hits) / sum(support) + 1e-9, 6), CAST(sum(support) AS BIGINT) FROM metrics
UNION ALL
SELECT 'macro avg', round(avg(precision) + 1e-9, 6), round(avg(recall) + 1e-9, 6), round(avg(f1) + 1e-9, 6),
  CAST(sum(support) AS BIGINT) FROM metrics
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support) + 1e-9, 6),
  round(sum(recall * support) / sum(support) + 1e-9, 6), round({F1} + 1e-9, 6), CAST(sum(support) AS BIGINT) FROM metrics"""

CONFUSION = """
SELECT a.v AS label, b.v AS prediction,
  count(l.quality) AS n,
  round(coalesce(count(l.quality) / nullif((SELECT count(*) FROM labels WHERE quality = a.v), 0), 0) + 1e-9, 6) AS share
FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) b(v)
LEFT JOIN labels l ON l.quality = a.v AND l.toxic = b.v
GROUP BY a.v, b.v"""

HASHED = "CAST('0x' || substr(md5(userId || '-42'), 1, 8) AS BIGINT) / 4294967296"


INDEXED = """
SELECT clean.*, userIdIndex,
  coalesce(artistIndex, (SELECT CAST(count(*) AS DOUBLE) FROM artists)) AS artistIndex{more}
FROM clean JOIN users USING (userId) LEFT JOIN artists USING (artist)"""
EVENT_ORDER = ["userId", "ts", *[c for c in EVENT_COLUMNS if c not in ("userId", "ts")]]


# Training: who is held out, and what has to hold --------------------------------


def _held_out(check: str) -> str:
    """Users of the hold-out part of the last-week feature table; each check has to hold."""
    place = HASHED.replace("userId", "CAST(userIdIndex AS VARCHAR)")
    return _feature_table(
        True,
        "SELECT userIdIndex, label, true AS is_label, true AS f1_agrees, true AS " + check
        + f" FROM ({{table}}) WHERE {place} >= 0.75",
    )


def _names(select: str) -> list[str]:
    return re.findall(r" AS (\w+)(?=,|\nFROM|\s+FROM)", select)


def _positions() -> str:
    """Feature names in the order of the vector."""
    names = [f"als_{period}_{k}" for period in ("all", "lw") for k in range(ALS_RANK)]
    for period, more in ((WHOLE, ["age", "avg_age"]), (LAST_WEEK, [])):
        names += [name for block, _ in period.all() for name in _names(block)] + more
    names += ["sessions_count", *[f"sessions_{m[side]}" for side in (1, 2) for m in SESSION_MEASURES]]
    rows = ",\n  ".join(f"('{name}', {place})" for place, name in enumerate(names))
    return f"SELECT feature, CAST(place AS INTEGER) AS position, true AS by_size, true AS scaled_back FROM (VALUES\n  {rows}\n) v(feature, place)"


def _scores_of_a_run() -> str:
    rows = [("first", name, weighted) for name in CLASSIFIER_PRIORITY for weighted in ("true", "false")]
    rows += [("second", "chosen", weighted) for weighted in ("true", "false")]
    values = ", ".join(f"('{dataset}', '{name}', {weighted}, true, true)" for dataset, name, weighted in rows)
    return f"SELECT * FROM (VALUES {values}) v(dataset, classifier, weighted, f1_agrees, best)"


ORACLES: dict[str, str] = {
    "projected_events": f"WITH{CLICK}\nSELECT {COLUMNS} FROM click",
    "valid_events": sql("SELECT * FROM valid"),
    "clean_events": sql("SELECT * FROM clean"),
    "sorted_events": sql(
        f"SELECT *, row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in EVENT_ORDER)}) - 1 AS position FROM valid"
    ),
    "event_order": sql("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS breaks FROM valid"),
    "events_from_json": sql(
        f"""
{INDEXED.format(more=", (SELECT count(*) FROM click WHERE ts % 101 = 0) AS bad_lines")}""",
        USER_INDEX,
        ARTIST_INDEX,
    ),
    "index_users": sql("SELECT userId, userIdIndex, occurrences FROM users", USER_INDEX),
    "indexed_events": sql(
        INDEXED.format(more=""),
        USER_INDEX,
        ARTIST_INDEX,
    ),
    "last_week_events": sql("SELECT * FROM recent", RECENT),
    "last_level": _state("level", LAST_ORDER),
    "first_gender": _state("gender", FIRST_ORDER),
    "encoded_level": _encoded("level", LAST_ORDER),
    "encoded_gender": _encoded("gender", FIRST_ORDER),
    "churn_label": sql("SELECT * FROM churn", CHURN),
    "churn_rate": sql(
        "SELECT count(*) AS users, CAST(sum(label) AS BIGINT) AS churned, round(avg(label) + 1e-9, 6) AS churn_rate FROM churn",
        CHURN,
    ),
    "class_weights": sql(
        """
SELECT userId, label,
  round(CASE WHEN label = 0 THEN avg(label) OVER () ELSE 1 - avg(label) OVER () END + 1e-9, 6) AS weights
FROM churn""",
        CHURN,
    ),
    "date_ranges": sql(
        """
SELECT CAST(min(registration_date) AS DATE) AS min_registration_date,
  CAST(max(registration_date) AS DATE) AS max_registration_date,
  CAST(min("timestamp") AS DATE) AS min_activity_date, CAST(max("timestamp") AS DATE) AS max_activity_date
FROM clean"""
    ),
    "users_by_registration": sql(_by_date(REGISTERED, "registration"), CHURN),
    "registration_chart": sql(_date_chart(REGISTERED, "registration"), CHURN),
    "users_by_last_activity": sql(_by_date(LAST_ACTIVE, "ts"), CHURN),
    "last_activity_chart": sql(_date_chart(LAST_ACTIVE, "ts"), CHURN),
    "mean_age_by_day": sql(_long("ts", ["users"], ["age"]), CHURN, MEAN_AGE),
    "mean_age_chart": sql(_wide("ts", ["users"], ["age"]), CHURN, MEAN_AGE),
    "user_age": sql("SELECT userId, age, round(avg_age + 1e-9, 6) AS avg_age, label FROM report", USER_AGE),
    "churned_user_ages": sql("SELECT age FROM report WHERE label = 1", USER_AGE),
    "age_histogram": sql(_histogram("age"), USER_AGE),
    "mean_age_histogram": sql(_histogram("avg_age"), USER_AGE),
    "activity_by_age_day": sql(
        _long("user_age_when_played", ACTIVITY_COUNTS, ACTIVITY_MEASURES), CHURN, ACTIVITY
    ),
    "activity_chart": sql(_wide("user_age_when_played", ACTIVITY_COUNTS, ACTIVITY_MEASURES), CHURN, ACTIVITY),
    "sessions_by_day": sql(
        _long("activity_time", ["sessions"], ["interactions", "session_time"]), CHURN, VISITS, SESSIONS
    ),
    "sessions_chart": sql(
        _wide("activity_time", ["sessions"], ["interactions", "session_time"]), CHURN, VISITS, SESSIONS
    ),
    "sessions_in_order": sql(
        "SELECT *, row_number() OVER (ORDER BY activity_time NULLS FIRST, label) - 1 AS position FROM ("
        + _long("activity_time", ["sessions"], ["interactions", "session_time"])
        + ")",
        CHURN,
        VISITS,
        SESSIONS,
    ),
    "page_share": _block(WHOLE.page_share()),
    "page_share_last_week": _block(LAST_WEEK.page_share(), True),
    "page_share_found": _block(WHOLE.page_share()),
    "page_counts": _block(WHOLE.page_counts()),
    "page_counts_last_week": _block(LAST_WEEK.page_counts(), True),
    "level_share": _block(WHOLE.level_share()),
    "level_share_last_week": _block(LAST_WEEK.level_share(), True),
    "level_share_found": _block(WHOLE.level_share()),
    "length_stats": _block(WHOLE.length_stats()),
    "length_stats_last_week": _block(LAST_WEEK.length_stats(), True),
    "hourly_counts": _block(WHOLE.hourly_counts()),
    "hourly_counts_last_week": _block(LAST_WEEK.hourly_counts(), True),
    "hourly_mean_length": _block(WHOLE.hourly_mean_length()),
    "hourly_mean_length_last_week": _block(LAST_WEEK.hourly_mean_length(), True),
    "age_features": sql(AGE),
    "base_counts": sql(
        """
SELECT userId, page, level, CAST(extract(hour FROM "timestamp") AS INTEGER) AS hour,
  count(*) AS events_all, round(sum(length) + 1e-9, 6) AS length_sum_all, count(length) AS length_n_all,
  count(*) FILTER (late) AS events_lw, round(sum(length) FILTER (late) + 1e-9, 6) AS length_sum_lw,
  count(length) FILTER (late) AS length_n_lw
FROM (SELECT clean.*, last_ts - ts <= 604800000 AS late FROM clean JOIN last_seen USING (userId))
GROUP BY ALL""",
        RECENT,
    ),
    "prefixed_columns": _state("gender", FIRST_ORDER, "first_gender"),
    "session_features": sql(_session_select(), SESSION_FEATURES),
    "artist_ratings": sql("SELECT userId, artist, round(rating + 1e-9, 6) AS rating FROM ratings", RATINGS),
    "last_week_ratings": sql(
        """
SELECT userId, artist, round(r.rating + 1e-9, 6) AS rating, round(coalesce(l.rating, 0) + 1e-9, 6) AS recent_rating
FROM ratings r LEFT JOIN recent_ratings l USING (userId, artist)""",
        RECENT,
        RATINGS,
        RECENT_RATINGS,
    ),
    "carried_ratings": sql(
        """
SELECT userId, artist, round(coalesce(l.rating, 0) + 1e-9, 6) AS rating
FROM ratings r LEFT JOIN recent_ratings l USING (userId, artist)""",
        RECENT,
        RATINGS,
        RECENT_RATINGS,
    ),
    "latent_projection": sql("SELECT * FROM latent", RECENT, ARTIST_INDEX, RATINGS, RECENT_RATINGS, LATENT),
    "feature_table": _feature_table(False),
    "feature_table_last_week": _feature_table(True),
    "assembled_features": _feature_table(True, VECTOR_SUM),
    "ranked_differences": _differences(),
    "max_abs_scaled": sql(_scaled(), SESSION_FEATURES),
    "hash_split": sql(
        f"SELECT userId, label, CASE WHEN {HASHED} < 0.75 THEN 'training' ELSE 'test' END AS part FROM churn", CHURN
    ),
    "random_split": sql("SELECT userId, label, CAST(1 AS BIGINT) AS times, true AS likely_share FROM churn", CHURN),
    "confusion_matrix": CONFUSION.strip(),
    "classification_report": REPORT,
    "weighted_f1": f"WITH {JUDGED}\nSELECT round({F1} + 1e-9, 6) AS f1 FROM metrics",
    "best_model": _best_model(),
    "als_factors": sql(
        f"""
SELECT 'user' AS kind, CAST(userIdIndex AS BIGINT) AS id, {ALS_RANK} AS rank, true AS finite, count(*) AS ratings, true AS solved
FROM ratings JOIN users USING (userId) WHERE rating IS NOT NULL GROUP BY userIdIndex
UNION ALL
SELECT 'item', CAST(artistIndex AS BIGINT), {ALS_RANK}, true, count(*), true
FROM ratings JOIN artists USING (artist) WHERE rating IS NOT NULL GROUP BY artistIndex""",
        USER_INDEX,
        ARTIST_INDEX,
        RATINGS,
    ),
    "train_random_forest": _held_out("votes_agree"),
    "train_logistic_regression": _held_out("settled"),
    "train_linear_svm": _held_out("settled"),
    "logistic_coefficients": _positions(),
    "churn_run": _scores_of_a_run(),
}
