"""Which dated snapshots a run reads: trailing months of events, the latest complete generation.

Both choices exist for datasets with a partition column, as predicates that prune partitions, and
for directories named after the month or generation, as a listing through the Hadoop file system of
the path's URI scheme. Listings read directory names only. They go through the session's JVM and so need
a classic session, not a Connect client.
"""

from __future__ import annotations

import re
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Directory names of generations and months, and the marker of a finished write.
GENERATION_FORMAT = "%Y%m%d-%H%M%S"
MONTH_FORMAT = "%Y-%m-%d"
SUCCESS_MARKER = "_SUCCESS"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def month_starts(reference: date, n_months: int) -> list[date]:
    """The ``n_months`` month starts before the month of ``reference``, oldest first."""
    this_month = reference.year * 12 + reference.month - 1
    return [date(m // 12, m % 12 + 1, 1) for m in range(this_month - n_months, this_month)]


def trailing_months(data: DataFrame, day: Column, reference: date, n_months: int = 1) -> DataFrame:
    """Rows of the ``n_months`` full months before the month of ``reference``.

    The bounds are literals, so on a partition column whole partitions drop out of the listing and
    on a data column row groups are skipped.
    """
    end = F.lit(date(reference.year, reference.month, 1))
    start = F.lit(month_starts(reference, n_months)[0]) if n_months > 0 else end
    return data.filter((day >= start) & (day < end))


def latest_snapshot(
    data: DataFrame, generation: str, complete: Column | None = None, cutoff: str | None = None
) -> DataFrame:
    """Rows of the newest complete generation, optionally not newer than ``cutoff``.

    The newest generation is a scalar subquery, computed once and then used as a filter; on a
    partition column it prunes the scan to one partition. Without any match the result is empty.
    """
    candidates = data
    if complete is not None:
        candidates = candidates.filter(complete)
    if cutoff is not None:
        candidates = candidates.filter(F.col(generation) <= F.lit(cutoff))
    newest = candidates.agg(F.max(generation)).scalar()
    return data.filter(F.col(generation) == newest)


def partition_values(data: DataFrame, column: str) -> list[str]:
    """Values of a partition column, ascending, from the names of the files that ``data`` was opened with.

    No file is opened. A null partition is left out.
    """
    named = re.compile(rf"/{re.escape(column)}=([^/]*)/")
    # Names are escaped once as partition values and once more as URLs.
    found = {unquote(unquote(m[1])) for m in map(named.search, data.inputFiles()) if m}
    return sorted(found - {NULL_PARTITION})


def latest_partition(data: DataFrame, generation: str, cutoff: str | None = None) -> DataFrame:
    """Rows of the newest partition of ``generation``, optionally not newer than ``cutoff``.

    Unlike :func:`latest_snapshot`, which reads rows to learn which generations there are, this asks the names of
    the partitions, and the scan is planned with a literal. Values are compared as text, so they should
    be of one width. Without any match the result is empty.
    """
    values = [v for v in partition_values(data, generation) if cutoff is None or v <= cutoff]
    kind = data.schema[generation].dataType
    return data.filter(F.col(generation) == F.lit(values[-1]).cast(kind) if values else F.lit(False))


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, text: str) -> bool:
    path, fs = _path(spark, text)
    return fs.exists(path)


def subdirectories(spark: SparkSession, text: str) -> list[str]:
    """Names of the directories right below a path, in no particular order."""
    path, fs = _path(spark, text)
    if not fs.exists(path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]


def month_paths(spark: SparkSession, root: str, event: str, reference: date, n_months: int = 1) -> list[str]:
    """Existing month directories ``root/event/YYYY-MM-01`` of the trailing months."""
    wanted = [f"{root.rstrip('/')}/{event}/{m.strftime(MONTH_FORMAT)}" for m in month_starts(reference, n_months)]
    found = [path for path in wanted if path_exists(spark, path)]
    if not found:
        raise ValueError(f"no {event} data for the {n_months} month(s) before {reference:%Y-%m}: looked for {wanted}")
    return found


def latest_generation_path(
    spark: SparkSession, root: str, name: str, cutoff: date | str | None = None, need_success: bool = True
) -> str:
    """The newest finished generation directory ``root/name/<generation>``, not newer than ``cutoff``."""
    if isinstance(cutoff, date):
        moment = cutoff if isinstance(cutoff, datetime) else datetime(cutoff.year, cutoff.month, cutoff.day)
        cutoff = moment.strftime(GENERATION_FORMAT)
    base = f"{root.rstrip('/')}/{name}"

    def finished(generation: str) -> bool:
        return not need_success or path_exists(spark, f"{base}/{generation}/{SUCCESS_MARKER}")

    early_enough = (g for g in subdirectories(spark, base) if cutoff is None or g <= cutoff)
    newest = max(filter(finished, early_enough), default=None)
    if newest is None:
        raise ValueError(f"no finished generation under {base}" + (f" up to {cutoff}" if cutoff else ""))
    return f"{base}/{newest}"
