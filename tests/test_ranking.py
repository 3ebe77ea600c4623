import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.operators import ranking


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("rows", [1, 7, 10, 1003])
def test_ntile_equals_the_built_in(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") % 5).alias("v"))  # heavy ties
    ours = ranking.with_ntile(df, 10, [F.col("v").desc(), F.col("id")], "tile")
    plain = df.withColumn("tile", F.ntile(10).over(W.orderBy(F.col("v").desc(), "id")).cast("bigint"))
    assert _same(ours, plain)


def test_positions_follow_the_total_order(spark):
    df = spark.range(500).select(((F.col("id") * 7919) % 503).alias("k"))
    got = ranking.with_position(df, [F.col("k").asc()]).orderBy("k").collect()
    assert [r.position for r in got] == list(range(1, 501))


def test_rank_within_equals_row_number_with_one_large_group(spark):
    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 != 0, "big").when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 7).cast("string")).alias("g"),
        (F.col("id") % 11).alias("v"),
    )
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    ours = ranking.rank_within(df, ["g"], order, "r").select("id", F.col("r").cast("int").alias("r"))
    plain = df.select("id", F.row_number().over(W.partitionBy("g").orderBy(*order)).alias("r"))
    assert _same(ours, plain)


def test_top_k_gathers_no_group(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    top = ranking.top_within(df, ["g"], [F.col("id").desc()], 2, "r")
    assert sorted((r.g, r.id, r.r) for r in top.collect()) == [
        (0, 996, 2), (0, 999, 1), (1, 994, 2), (1, 997, 1), (2, 995, 2), (2, 998, 1)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    # all rows meet a window by group and part only; the one by group sees what that left
    over_all = [line for line in plan.splitlines() if "Window [" in line][-1]
    assert "_salt" in over_all


@pytest.mark.parametrize("k", [1, 3, 50, 5000])
def test_top_k_equals_row_number_for_every_k(spark, k):
    df = spark.range(900).select(
        "id", F.when(F.col("id") % 3 != 0, "big").when(F.col("id") % 5 == 0, None).otherwise("small").alias("g"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 7).alias("v"))
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    ours = ranking.top_within(df, ["g"], order, k, "r")
    plain = df.withColumn("r", F.row_number().over(W.partitionBy("g").orderBy(*order)).cast("bigint")).where(F.col("r") <= k)
    assert _same(ours, plain)


@pytest.mark.parametrize("buckets", [1, 4, 10, 23])
def test_ntile_over_one_value_nulls_and_further_columns(spark, buckets):
    df = spark.range(211).select(
        "id", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 4).cast("decimal(9,2)").alias("v"),
        F.concat(F.lit("name "), "id").alias("other"))
    for order in ([F.col("v").desc(), F.col("id").desc()], [F.col("v").asc_nulls_last(), F.col("id")], ["v DESC NULLS FIRST", "id"]):
        ours = ranking.with_ntile(df, buckets, order, "tile")
        columns = [F.col("v").desc_nulls_first(), F.col("id")] if isinstance(order[0], str) else order
        plain = df.withColumn("tile", F.ntile(buckets).over(W.orderBy(*columns)).cast("bigint"))
        assert _same(ours, plain)


def test_ntile_of_no_rows(spark):
    assert ranking.with_ntile(spark.range(0).select("id", F.lit(1).alias("v")), 10, ["v", "id"], "t").count() == 0


def test_ntile_sorts_by_plain_columns_only(spark):
    with pytest.raises(ValueError, match="plain column"):
        ranking.with_ntile(spark.range(3), 2, [F.col("id") + 1], "t")


def test_rank_by_key_stores_nothing_wider(spark, tmp_path, monkeypatch):
    from tallywright.operators import scan

    kept = []
    monkeypatch.setattr(scan, "stored", lambda df, label: _keep(df, kept, tmp_path))
    df = spark.range(300).select("id", (F.col("id") % 3).alias("g"), (F.col("id") % 11).alias("v"), F.lit("wide").alias("w"))
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    order = [F.col("v").desc(), F.col("id")]
    ours = ranking.rank_within(df, ["g"], order, "r", key=["id"])
    plain = df.withColumn("r", F.row_number().over(W.partitionBy("g").orderBy(*order)).cast("bigint"))
    assert _same(ours, plain) and kept and "w" not in kept[0]


def _keep(df, kept, folder):
    kept.append(df.columns)
    path = str(folder / f"kept-{len(kept)}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
