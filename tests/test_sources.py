import json
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cobasket.operators.interactions import purchase_interactions
from cobasket.schemas import schema_of
from cobasket.sources.dumps import read_catalog, read_events, read_json, read_suggestions, write_json, write_json_by_client
from cobasket.sources.snapshots import (
    latest_generation_path,
    latest_partition,
    latest_snapshot,
    month_paths,
    month_starts,
    partition_values,
    trailing_months,
)
from testbed.folders import shared_path
from tests.helpers import executed_nodes, rows


def _json(folder, *lines, success=False):
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))
    if success:
        (folder / "_SUCCESS").touch()


@pytest.mark.parametrize("day", [1, 15, 31])
def test_months_end_before_the_month_of_the_reference(day):
    assert month_starts(date(2022, 5, day), 1) == [date(2022, 4, 1)]
    assert month_starts(date(2022, 5, day), 3) == [date(2022, 2, 1), date(2022, 3, 1), date(2022, 4, 1)]


def test_months_cross_the_year():
    assert month_starts(date(2022, 2, 3), 3) == [date(2021, 11, 1), date(2021, 12, 1), date(2022, 1, 1)]
    assert month_starts(date(2022, 2, 3), 0) == []


def test_trailing_months_filters_and_prunes_partitions(spark, tmp_path):
    days = ["2022-01-31", "2022-02-01", "2022-03-31", "2022-04-01"]
    df = spark.createDataFrame([(d,) for d in days], "text string")
    df.withColumn("month", F.trunc("text", "month")).write.partitionBy("month").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    kept = trailing_months(table, F.col("month"), date(2022, 4, 20), 2)
    assert rows(kept, "text") == [("2022-02-01",), ("2022-03-31",)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert trailing_months(table, F.col("month"), date(2022, 4, 20), 0).count() == 0


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("20220101-000000", 1), ("20220301-000000", 3), ("20220201-000000", 2)], "g string, n int")
    assert rows(latest_snapshot(df, "g"), "n") == [(3,)]
    assert rows(latest_snapshot(df, "g", F.col("n") != 3), "n") == [(2,)]
    assert rows(latest_snapshot(df, "g", cutoff="20220201-000000"), "n") == [(2,)]
    assert rows(latest_snapshot(df, "g", cutoff="20210101-000000"), "n") == []


def test_latest_generation_path(spark, tmp_path):
    for name, finished in [("20220301-000000", False), ("20220101-000000", True), ("20220201-000000", True)]:
        _json(tmp_path / "products" / name, {"client": "c"}, success=finished)
    found = lambda *args, **kw: latest_generation_path(spark, str(tmp_path), "products", *args, **kw)[-15:]
    assert found() == "20220201-000000"
    assert found(need_success=False) == "20220301-000000"
    assert found("20220131-235959") == "20220101-000000"
    assert found(date(2022, 2, 1)) == "20220201-000000"
    assert found(datetime(2022, 1, 31, 12)) == "20220101-000000"
    with pytest.raises(ValueError, match="up to 20210101-000000"):
        found(date(2021, 1, 1))
    with pytest.raises(ValueError, match="no finished generation"):
        latest_generation_path(spark, str(tmp_path), "nowhere")


def test_month_paths_skip_missing_months_and_report_none(spark, tmp_path):
    for month in ("2022-02-01", "2022-04-01"):
        _json(tmp_path / "buyorder" / month, {"client": "c"})
    found = month_paths(spark, str(tmp_path), "buyorder", date(2022, 5, 1), 3)
    assert [p[-10:] for p in found] == ["2022-02-01", "2022-04-01"]
    with pytest.raises(ValueError, match="before 2022-04"):
        month_paths(spark, str(tmp_path), "buyorder", date(2022, 4, 30), 1)


def test_events_are_read_with_a_narrow_schema_and_coerced(spark, tmp_path):
    item = lambda i: {"product": {"id": i, "price": 9.5, "specs": {"size": "M"}}}
    _json(
        tmp_path / "buyorder" / "2022-04-01",
        {"client": "c1", "order_id": "o1", "user_id": 7, "items": [item("A"), item(8)], "date": "2022-04-03"},
        "{broken",
        {"client": "c1", "user_id": "u2"},
    )
    df = read_events(
        spark, str(tmp_path), "buyorder", date(2022, 5, 1), select=["client", "items", "user_id"], drop=["items.product.specs"]
    )
    assert df.schema == schema_of("event", "buyorder", ["client", "items", "user_id"], ["items.product.specs"])
    assert rows(purchase_interactions(df)) == [("c1", "7", "8"), ("c1", "7", "A")]
    assert rows(df.filter("client is null")) == [(None, None, None)]


def test_catalog_and_custom_schema(spark, tmp_path):
    _json(tmp_path / "products" / "20220101-000000", {"client": "c1", "product_id": "A", "status": "X"}, success=True)
    assert rows(read_catalog(spark, str(tmp_path))) == [("c1", "A", "X")]
    assert read_catalog(spark, str(tmp_path), select=["status"]).columns == ["status"]
    custom = schema_of("catalog", "products", ["client"])
    assert read_catalog(spark, str(tmp_path), schema=custom).schema == custom


def test_sink_writes_gzip_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "algo" / "20220101-000000")
    for n in (1, 2):
        write_json(spark.range(n).select(F.lit("c1").alias("client"), F.col("id").cast("string").alias("product")), path)
    assert list((tmp_path / "algo" / "20220101-000000").glob("*.json.gz"))
    assert read_json(spark, path, schema_of("algorithm", "suggestions")).count() == 2
    assert read_suggestions(spark, str(tmp_path), "algo").count() == 2


def _session(master, **conf):
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_paths_need_a_shared_folder_on_a_cluster(spark):
    cluster = _session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://shared/tmp/"})
    assert shared_path(cluster, "x").startswith("hdfs://shared/tmp/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(_session("spark://host:7077"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(_session("local-cluster[2,1,1024]"), "x")
    assert shared_path(spark, "x") != shared_path(spark, "x")


def _files_read(df):
    """How many files the scan of ``df`` opened."""
    df.collect()
    scans = [n for n in executed_nodes(df) if n.nodeName().startswith("Scan")]
    (files,) = [n.metrics().apply("numFiles").value() for n in scans]
    return files


@pytest.fixture
def generations(spark, tmp_path):
    data = [(f"2022{m:02}01-000000", m * 10 + i) for m in (1, 2, 3, 4) for i in range(3)]
    path = str(tmp_path / "g")
    spark.createDataFrame(data, "g string, n int").repartition("g").write.partitionBy("g").parquet(path)
    return spark.read.schema("n int, g string").parquet(path)


def test_latest_partition_reads_one_partition_and_names_only(spark, generations):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("names", "names")
    newest = latest_partition(generations, "g")
    earlier = latest_partition(generations, "g", "20220315-000000")
    assert not tracker.getJobIdsForGroup("names")  # no data was read to choose
    assert rows(newest, "n") == [(40,), (41,), (42,)] and rows(earlier, "n") == [(30,), (31,), (32,)]
    assert "PartitionFilters: [isnotnull(g" in newest._jdf.queryExecution().executedPlan().toString()
    assert _files_read(newest) == _files_read(earlier) == 1
    assert latest_partition(generations, "g", "20210101-000000").count() == 0


def test_latest_snapshot_prunes_by_its_subquery(spark, generations):
    newest = latest_snapshot(generations, "g", F.col("n") < 40)
    assert rows(newest, "n") == [(30,), (31,), (32,)]
    assert "PartitionFilters: [isnotnull(g" in newest._jdf.queryExecution().executedPlan().toString()
    assert _files_read(newest) == 1


def test_partition_values_are_unescaped_and_nulls_left_out(spark, tmp_path):
    data = [("a b", 1), ("2022-01-01 10:00:00", 2), ("x=y/z%", 3), (None, 4)]
    spark.createDataFrame(data, "g string, n int").write.partitionBy("g").parquet(str(tmp_path / "g"))
    table = spark.read.schema("n int, g string").parquet(str(tmp_path / "g"))
    assert partition_values(table, "g") == ["2022-01-01 10:00:00", "a b", "x=y/z%"]
    assert rows(latest_partition(table, "g"), "n") == [(3,)]
    numbers = spark.createDataFrame([(1, 7), (2, 8)], "g int, n int")
    numbers.write.partitionBy("g").parquet(str(tmp_path / "numbers"))
    assert rows(latest_partition(spark.read.parquet(str(tmp_path / "numbers")), "g"), "n") == [(8,)]


def _documents(spark, sizes):
    rows_of = F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("n")
    clients = spark.createDataFrame(list(sizes.items()), "client string, rows int").select("client", rows_of)
    result = "struct<rec:string,amf:long,nmf:double,freq_rec:long,freq_ref:long,asl:double,nsl:double>"
    return clients.select(
        "client",
        F.struct(F.lit(0.4).alias("nmf"), F.lit(0.2).alias("alpha"), F.lit(2.0).alias("adjust"), F.lit(2.1).alias("amf")).alias("tuning"),
        F.concat(F.lit("p"), "n").alias("product"),
        F.array().cast(f"array<{result}>").alias("results"),
    )


def test_output_by_client_splits_large_clients_and_prunes(spark, tmp_path):
    data = _documents(spark, {"large": 1000, "small": 3, "007": 2, None: 1})
    path = str(tmp_path / "algo" / "20220101-000000")
    write_json(data, path)
    plain = rows(read_suggestions(spark, str(tmp_path), "algo"))
    for _ in range(2):  # replaced, not added to
        write_json_by_client(data, path, rows_per_file=100)
    back = read_suggestions(spark, str(tmp_path), "algo")
    assert back.schema == schema_of("algorithm", "suggestions")
    assert rows(back) == plain and back.count() == 1006
    files = {f.name: list(f.glob("*.json.gz")) for f in (tmp_path / "algo" / "20220101-000000").iterdir() if f.is_dir()}
    assert set(files) == {"client=large", "client=small", "client=007", "client=__HIVE_DEFAULT_PARTITION__"}
    assert 5 <= len(files["client=large"]) <= 10 and len(files["client=small"]) == 1
    one = back.filter(F.col("client") == "small")
    assert one.count() == 3 and _files_read(one) == 1
    write_json_by_client(data.limit(0), path)
    assert read_suggestions(spark, str(tmp_path), "algo").count() == 0
