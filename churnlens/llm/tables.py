"""What the operators of this subpackage share: Arrow passes over texts, row removal."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from churnlens.operators.lookup import BROADCAST_BYTES, measure
from churnlens.operators.materialise import materialise
from churnlens.operators.order import with_position

BATCH_ROWS = 512
ROW = "__row"
_ID, _PAIR, _DIGEST = "__id", "__pair", "__digest"
_CAP = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts holds: with documents of up to a few MB
    Spark's 10,000 rows would not fit a worker. Lowers the session's setting only."""
    if not 0 < int(spark.conf.get(_CAP)) <= BATCH_ROWS:
        spark.conf.set(_CAP, str(BATCH_ROWS))


def map_batches(
    table: DataFrame, columns: dict[str, str], function: Callable[[Iterator[dict[str, list]]], Iterable[dict]], schema: str
) -> DataFrame:
    """Run ``function`` over Arrow batches of the named columns (``{name: type}``).

    It gets an iterator of ``{name: list of values}`` and yields ``{name: values}``
    in the columns of ``schema``. Text columns are asked for as binary, so a task
    works on UTF-8 bytes and never decodes what it only hashes or counts.
    """
    small_batches(table.sparkSession)
    wanted = table.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in columns.items()])
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = ({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches)
        for out in function(lists):
            arrays = [pa.array(out[f.name], f.type) for f in target]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return wanted.mapInArrow(run, schema)


def without_ids(table: DataFrame, ids: DataFrame, key: str, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``table`` without the rows whose ``key`` is in ``ids``.

    The ids are written and measured: few enough, they are broadcast and the texts
    stay where they are; else Spark shuffles both sides on the key.
    """
    stored = materialise(ids.where(F.col(key).isNotNull()).select(key).distinct())
    small = measure(stored)[1] <= broadcast_bytes
    return table.join(F.broadcast(stored) if small else stored, key, "left_anti").select(*table.columns)


def text_digest(text_col: str) -> Column:
    """SHA-256 of a text; null counts as empty."""
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)


def with_row_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, output: str = ROW) -> DataFrame:
    """``docs`` and a long ``output`` that tells rows apart by id and text together, in the
    order of the ids, null ids last.

    Where every row has an id of its own, that is the id itself. Otherwise the different
    (id, text) pairs are numbered by id and digest and joined back; rows that repeat both
    have one number. So a decision on a row is never one on another text of that id.
    """
    ids = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    if dict(docs.dtypes)[id_col] == "bigint" and ids.where(F.col(id_col).isNull() | (F.col("n") > 1)).isEmpty():
        return docs.withColumn(output, F.col(id_col))
    named = docs.withColumn(_DIGEST, text_digest(text_col))
    pairs = named.select(F.col(id_col).alias(_ID), F.col(_DIGEST).alias(_PAIR)).distinct()
    numbered = with_position(pairs, F.asc_nulls_last(_ID), _PAIR, output=output)
    same = F.col(id_col).eqNullSafe(F.col(_ID)) & (F.col(_DIGEST) == F.col(_PAIR))
    return named.join(numbered, same).drop(_ID, _PAIR, _DIGEST)
