"""JSON sources and the suggestion sink.

Schemas are always declared, so files are read once and unwanted fields are never parsed. Reading is
permissive: a malformed line becomes a row of nulls and takes no part in any result; scalars of
another type are coerced to the declared one, or to null where that is impossible.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cobasket.operators.lookup import look_up
from cobasket.schemas import schema_of
from cobasket.sources.snapshots import latest_generation_path, month_paths


# Rows per file of an output by client: a few tens of megabytes of documents.
ROWS_PER_FILE = 100_000


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(paths if isinstance(paths, str) else list(paths))


def read_events(
    spark: SparkSession,
    root: str,
    event: str,
    reference: date,
    n_months: int = 1,
    select: Sequence[str] = (),
    drop: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Events of the trailing full months, with a narrowed schema."""
    paths = month_paths(spark, root, event, reference, n_months)
    return read_json(spark, paths, schema or schema_of("event", event, select, drop))


def read_catalog(
    spark: SparkSession,
    root: str,
    catalog: str = "products",
    cutoff: date | str | None = None,
    select: Sequence[str] = (),
    drop: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """The latest finished snapshot of a catalog; all catalogs share the products schema."""
    path = latest_generation_path(spark, root, catalog, cutoff)
    return read_json(spark, path, schema or schema_of("catalog", "products", select, drop))


def read_suggestions(
    spark: SparkSession, root: str, algorithm: str, cutoff: date | str | None = None
) -> DataFrame:
    """The latest finished output of an earlier run, in either layout.

    Of an output by client, a filter on ``client`` reads that client's files alone.
    """
    path = latest_generation_path(spark, root, algorithm, cutoff)
    schema = schema_of("algorithm", "suggestions")
    return read_json(spark, path, schema).select(*schema.fieldNames())


def output_path(root: str, algorithm: str, generation: str) -> str:
    return f"{root.rstrip('/')}/{algorithm}/{generation}"


def write_json(data: DataFrame, path: str) -> None:
    """Write gzip JSON from the executors, replacing what the path holds."""
    data.write.mode("overwrite").option("compression", "gzip").json(path)


def write_json_by_client(data: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write gzip JSON with one directory ``client=...`` per client, replacing what the path holds.

    A client's rows are dealt by a hash of the row to as many tasks as files of ``rows_per_file`` rows would hold them, so
    a large client is written by several tasks and a small one to one file. ``data`` is computed
    once for the sizes of clients and once for the rows. A null client has a directory of its own.
    """
    rows = F.count(F.lit(1))
    large = data.groupBy("client").agg(F.ceil(rows / F.lit(float(rows_per_file))).alias("_files")).filter(F.col("_files") > 1)
    dealt = look_up(data, large, ["client"], "left")
    # Adaptive execution merges small partitions and leaves a key's rows together.
    dealt = dealt.withColumn("_file", F.pmod(F.xxhash64(*data.columns), F.coalesce(F.col("_files"), F.lit(1).cast("long"))))
    dealt = dealt.repartition("client", "_file").drop("_file", "_files")
    writer = dealt.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", 2 * rows_per_file)
    writer.partitionBy("client").json(path)
