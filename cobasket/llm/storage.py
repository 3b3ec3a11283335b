"""Tables that one operator writes once and reads several times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session, where all run on one machine, may leave it unset; it then gets one of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="cobasket-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses; all of an application lie in one folder."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a Parquet table in the shared folder.

    Later readers neither compute it again nor depend on the executors that made it.
    """
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
