"""Column expressions shared by the operators. All of them are Spark built-ins."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlens.constants import DAY_MS, SECOND_MS


def epoch_timestamp(ms: Column) -> Column:
    """Epoch milliseconds as a timestamp of whole seconds."""
    return F.timestamp_seconds((ms / SECOND_MS).cast("long"))


def hour_of_day(ms: Column) -> Column:
    """Hour 0..23 of epoch milliseconds, in the session time zone."""
    return F.hour(epoch_timestamp(ms))


def elapsed_days(elapsed_ms: Column) -> Column:
    """Milliseconds as whole days, halves rounded away from zero.

    The same as ``round(days, 0)``, which goes through a decimal for every row.
    """
    days = elapsed_ms / DAY_MS
    return (F.signum(days) * F.floor(F.abs(days) + 0.5)).cast("int")


def seconds_between(first_ms: Column, last_ms: Column) -> Column:
    return (last_ms - first_ms) / SECOND_MS


def share(part: Column, whole: Column) -> Column:
    """Ratio of two counts; NULL when the whole is 0, in ANSI mode too."""
    return F.try_divide(part, whole)


def count_where(condition: Column) -> Column:
    """Aggregate: rows where the condition holds."""
    return F.count(F.when(condition, 1))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def name_part(value: object) -> str:
    """A data value as part of a column name: anything unusual becomes ``_``."""
    return re.sub(r"\W+", "_", str(value))


def name_parts(values: Iterable[object]) -> dict[object, str]:
    """Column name parts of distinct values. Of values that would share a name (Spark's
    names ignore case), the first in order keeps it and the others are numbered."""
    values = list(dict.fromkeys(values))
    taken, parts = {name_part(v).lower() for v in values}, {}
    first: set[str] = set()
    for value in sorted(values, key=str):
        part, number = name_part(value), 2
        if part.lower() in first:
            while f"{part}_{number}".lower() in taken:
                number += 1
            part = f"{part}_{number}"
        first.add(part.lower())
        taken.add(part.lower())
        parts[value] = part
    return {value: parts[value] for value in values}
