"""Session helpers: the shared scratch folder and checked broadcast bounds."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension is only ever shipped whole to executors below this many rows.
DIMENSION_ROWS = 20_000

_local_base: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a fresh temporary one only on a local master."""
    global _local_base
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="palisade-")
    return _local_base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def is_small(df: DataFrame, rows: int = DIMENSION_ROWS) -> bool:
    """True when `df` has at most `rows` rows; reads no more than it must."""
    return df.limit(rows + 1).count() <= rows


def local_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A few constant rows, held in the plan: no Python task, and a size Spark knows."""
    columns = [list(c) for c in zip(*rows)]
    return spark.createDataFrame(pa.table(dict(zip(names, columns))))


def settled(df: DataFrame, rows: int = DIMENSION_ROWS) -> DataFrame:
    """Work out a table expected to be small now and mark it for broadcast.

    Should it turn out larger than `rows`, it comes back as it was, for a shuffled join.
    """
    # A null struct of fields that are never null is not to be had in Arrow.
    loose = df.select(*[F.col(f"`{f.name}`").cast(_nullable(f.dataType)).alias(f.name) for f in df.schema])
    held = loose.limit(rows + 1).toArrow()
    if held.num_rows > rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(held, schema=loose.schema))


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    return T.ArrayType(_nullable(kind.elementType)) if isinstance(kind, T.ArrayType) else kind
