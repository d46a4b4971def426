"""Small hand-written inputs."""

from churnlens.constants import DAY_MS
from churnlens.sources.events import EVENT_SCHEMA

START = 1_700_000_000_000
COLUMNS = EVENT_SCHEMA.names


def event(user="u", ts=START, **values):
    row = dict.fromkeys(COLUMNS)
    row.update(userId=user, sessionId=1, ts=ts, registration=START - 10 * DAY_MS, page="Home", level="free", gender="F")
    row.update(values)
    return tuple(row[c] for c in COLUMNS)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT_SCHEMA)


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def by_key(frame, key="userId"):
    return {r[key]: r.asDict() for r in frame.collect()}
