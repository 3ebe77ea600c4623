import time
from datetime import date

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallywright import session
from tallywright.catalog.queries import SAMPLE_CONFIG, Sample
from tallywright.operators import scan
from tallywright.operators.joins import hot_keys
from tallywright.plans import warehouse
from tallywright.plans.contracts import run_report
from tallywright.plans.warehouse import MARTS, Warehouse, build
from tallywright.sources import sinks, tables
from tallywright.sources.schemas import SCHEMAS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_partitions_are_pruned(spark, tmp_path):
    df = spark.range(1000).select(
        "id", F.expr("date_add(date'2024-01-01', cast(id % 90 as int))").alias("d"), (F.col("id") % 3).alias("k"))
    kept = sinks.write_month_partitioned(df, str(tmp_path / "m"), "d", ["k"], ["id"])
    assert sorted(p.name for p in (tmp_path / "m").glob("partition_month=*")) == [
        f"partition_month=2024-0{m}-01" for m in (1, 2, 3)]
    assert kept.select(df.columns).exceptAll(df).count() == 0 and kept.count() == 1000
    one_month = kept.where("partition_month = date'2024-02-01'")
    assert "PartitionFilters: [isnotnull(partition_month" in plan(one_month)
    assert one_month.select(F.min("d"), F.max("d")).first()[0].month == 2


def test_dates_open_only_their_months(spark, tmp_path):
    df = spark.range(90).select("id", F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d"))
    kept = sinks.write_month_partitioned(df, str(tmp_path / "m"), "d", [], ["id"])
    some = sinks.between_dates(kept, "d", date(2024, 2, 10), date(2024, 2, 12))
    assert sorted(r.d.day for r in some.collect()) == [10, 11, 12]
    assert "(partition_month#" in plan(some).split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert {r[0].split("partition_month=")[1][:7] for r in some.select(F.input_file_name()).collect()} == {"2024-02"}


def test_sources_are_read_from_a_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE shop LOCATION '{tmp_path}/shop'")
    try:
        for name, schema in SCHEMAS.items():
            spark.createDataFrame([], schema).write.saveAsTable(f"shop.{name}")
        w = Warehouse(tables.catalog_sources(spark, "shop"), SAMPLE_CONFIG)
        assert w.fct_orders.count() == 0 and w.fct_daily_revenue.count() == 0
        assert w.mart_product_performance.count() == 0 and w.revenue_concentration.count() == 0
    finally:
        spark.sql("DROP DATABASE shop CASCADE")


def test_clustered_files_hold_key_ranges(spark, tmp_path):
    df = spark.range(10000).select("id", (F.col("id") % 50).alias("k"))
    kept = sinks.write_clustered(df, str(tmp_path / "c"), ["k"], ["id"])
    spans = kept.groupBy(F.input_file_name()).agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a").collect()
    assert all(left.b <= right.a for left, right in zip(spans, spans[1:]))
    assert kept.count() == 10000


def test_full_build_equals_the_lazy_models(spark, tmp_path):
    sample = Sample(spark, SMALL)
    built = build(sample.sources, SAMPLE_CONFIG, str(tmp_path / "marts"))
    for name in MARTS:
        lazy, stored = sample.frame(name), built.frame(name)
        assert lazy.columns == stored.columns
        assert lazy.exceptAll(stored).count() == 0 and stored.exceptAll(lazy).count() == 0, name


def test_sources_are_read_from_a_folder(spark, tmp_path):
    sample = Sample(spark, SMALL)
    for name, df in sample.sources.items():
        df.select(*(F.col(f.name).cast(f.dataType) for f in SCHEMAS[name])).write.parquet(str(tmp_path / name))
    w = Warehouse(tables.read_sources(spark, str(tmp_path)), SAMPLE_CONFIG)
    assert w.fct_orders.agg(F.sum("net_revenue").cast("string")).first()[0] == "640503.75"


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert session.shared_folder(spark) == named or "warehouse" in session.shared_folder(spark)

    class Named:
        def __init__(self, **conf):
            self.conf = conf

    assert session.shared_folder(Named(**{"spark.checkpoint.dir": "hdfs://x/y"})) == "hdfs://x/y"
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.shared_folder(Named(**{"spark.master": master}))


@pytest.mark.parametrize("wrong", ["renamed", "mistyped"])
def test_a_missing_or_mistyped_source_column_is_an_error(spark, tmp_path, wrong):
    for name, schema in SCHEMAS.items():
        empty = spark.createDataFrame([], schema)
        if name == "orders":
            empty = empty.withColumnRenamed("user_id", "customer") if wrong == "renamed" else empty.withColumn("user_id", F.lit("x"))
        empty.write.parquet(str(tmp_path / name))
    with pytest.raises(TypeError, match="orders: user_id"):
        tables.read_sources(spark, str(tmp_path))


def test_a_lost_rebuild_leaves_the_old_rows(spark, tmp_path):
    table = sinks.VersionedTable(spark, str(tmp_path / "mart"))
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.replace(lambda path: sinks.write_table(spark.range(10), path))
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") > 990, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        table.replace(lambda path: sinks.write_table(broken, path))
    assert table.read().count() == 10 and len(table.versions()) == 1
    second = table.replace(lambda path: sinks.write_table(spark.range(20), path))
    assert second.count() == 20 and first.count() == 10  # an open reader keeps its version
    assert table.read(table.versions()[0]).count() == 10 and table.versions()[-1] == table.current()


def test_old_versions_expire_but_the_current_one(spark, tmp_path):
    table = sinks.VersionedTable(spark, str(tmp_path / "mart"))
    for n in (1, 2, 3):
        table.replace(lambda path: sinks.write_table(spark.range(n), path))
    assert len(table.expire(keep=2)) == 1 and len(table.versions()) == 2
    assert table.expire(keep=0) and table.versions() == [table.current()] and table.read().count() == 3


def test_rebuilding_all_marts_switches_them(spark, tmp_path):
    sample = Sample(spark, SMALL)
    folder = str(tmp_path / "marts")
    build(sample.sources, SAMPLE_CONFIG, folder)
    smaller = {**sample.sources, "users": sample.sources["users"].where("id % 2 = 0")}
    old = sinks.VersionedTable(spark, f"{folder}/dim_customers").read()
    n = old.count()
    again = build(smaller, SAMPLE_CONFIG, folder)
    assert 0 < again.dim_customers.count() < n == old.count()


def test_a_run_removes_what_it_stored(spark):
    with session.run_folder(spark) as folder:
        kept = session.stored(spark.range(5), "rows")
        assert kept.count() == 5 and folder in kept.inputFiles()[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    outside = session.stored(spark.range(5), "rows")
    assert folder not in outside.inputFiles()[0] and outside.count() == 5


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.length()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files that are new and still there; Spark removes them in the background."""
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_a_finished_step_leaves_no_shuffle_files(spark, tmp_path):
    setting = spark.conf.get(session.FREEING)
    dealt = spark.range(1000).repartition(5, "id")
    before = _shuffle_files(spark)
    assert dealt.select(F.sum("id")).first()[0] == 499500 and _shuffle_files(spark) - before
    before = _shuffle_files(spark)
    kept = [session.stored(dealt, "rows"), sinks.write_table(dealt, str(tmp_path / "t")),
            sinks.write_clustered(dealt, str(tmp_path / "c"), ["id"])]
    months = dealt.withColumn("d", F.lit(date(2024, 1, 1)))
    kept.append(sinks.write_month_partitioned(months, str(tmp_path / "m"), "d", [], ["id"]))
    assert hot_keys(dealt.select(F.lit(7).cast("bigint").alias("k")), "k") == {"k": [7]}
    assert not _left(spark, before) and spark.conf.get(session.FREEING) == setting
    assert [df.count() for df in kept] == [1000] * 4


def test_a_build_and_its_report_leave_no_shuffle_files(spark, tmp_path):
    sample = Sample(spark, SMALL)
    before = _shuffle_files(spark)
    with session.run_folder(spark):
        built = build(sample.sources, SAMPLE_CONFIG, str(tmp_path / "marts"))
        report = run_report(lambda name: sample.events if name == "events" else built.frame(name), SAMPLE_CONFIG)
        assert not _left(spark, before)
        assert report.count() == 129 and report.where("failures is null").isEmpty()


def test_a_build_keeps_no_step_of_a_mart_after_it(spark, tmp_path, monkeypatch):
    """What a mart stores is narrow, and gone when the next one is built."""
    kept = {}

    def keep(df, label):
        kept[label] = stored(df, label)
        return kept[label]

    stored = session.stored
    for module in (warehouse, scan):
        monkeypatch.setattr(module, "stored", keep)
    build(Sample(spark, SMALL).sources, SAMPLE_CONFIG, str(tmp_path / "marts"))
    assert {"joined-items", "named-months", "placed"} <= set(kept)
    columns = set(kept["joined-items"].columns)
    assert {"sale_price", "unit_cost"} <= columns and not {"net_revenue", "net_cogs", "net_margin_pct"} & columns
    for df in kept.values():
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
            spark.read.schema(df.schema).parquet(*df.inputFiles()).collect()


def test_columns_are_finished_when_the_rows_have_been_ranged(spark, tmp_path):
    df = spark.range(90).select("id", F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d"))
    kept = sinks.write_month_partitioned(
        df, str(tmp_path / "m"), "d", [], ["id"], finish=lambda rows: rows.withColumn("twice", 2 * F.col("id")))
    assert set(kept.columns) == {"id", "d", "twice", "partition_month"}
    assert sorted((r.id, r.twice) for r in kept.collect()) == [(i, 2 * i) for i in range(90)]
    assert len(list((tmp_path / "m").glob("partition_month=*"))) == 3


def test_tasks_are_bounded_and_smaller_ones_kept(spark):
    read, merged = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    old = {key: spark.conf.get(key, None) for key in (read, merged, parts)}
    try:
        spark.conf.set(read, "128MB")
        spark.conf.set(merged, "4KB")
        spark.conf.set(parts, "24")
        session.configure(spark)
        assert [spark.conf.get(key) for key in old] == [str(16 << 20), str(4 << 10), "400"]
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
