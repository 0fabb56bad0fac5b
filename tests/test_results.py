"""A result is read again while its question and its input files are the same, and made anew when either changes."""

import pytest
from pyspark.sql import functions as F

from matchbook.sources.results import Results


@pytest.fixture()
def places(spark, tmp_path):
    for name, shift in (("a", 0), ("b", 3)):
        spark.range(20).select((F.col("id") + shift).alias("x"), (F.col("id") % 3).alias("g")).write.parquet(f"{tmp_path}/{name}")
    return tmp_path


def test_results_are_read_again(spark, places):
    results = Results(spark, f"{places}/results")
    table = lambda name: spark.read.parquet(f"{places}/{name}")
    ask = lambda: table("a").where("x > 4").groupBy("g").agg(F.sum("x").alias("total"))
    first = results.reload(ask())
    kept = results.manifests.names("data")
    again = results.reload(ask())
    assert sorted(first.collect()) == sorted(again.collect()) == sorted(ask().collect())
    assert results.manifests.names("data") == kept and len(kept) == 1
    assert all(f"{places}/results/data/{kept[0]}" in file for file in again.inputFiles())
    # Another literal, another name, and tables of one schema in another order are other questions.
    others = [
        table("a").where("x > 5").groupBy("g").agg(F.sum("x").alias("total")),
        table("a").where("x > 4").groupBy("g").agg(F.sum("x").alias("sum")),
        table("a").join(table("b"), "x", "left_anti"),
        table("b").join(table("a"), "x", "left_anti"),
    ]
    for n, other in enumerate(others, 2):
        assert sorted(results.reload(other).collect()) == sorted(other.collect())
        assert len(results.manifests.names("data")) == n
    # A changed input misses, the old result stays beside it.
    spark.range(100, 103).select(F.col("id").alias("x"), F.lit(0).cast("long").alias("g")).write.mode("append").parquet(f"{places}/a")
    assert sorted(results.reload(ask()).collect()) == sorted(ask().collect()) != sorted(first.collect())


def test_what_cannot_be_kept_is_returned(spark, places):
    results = Results(spark, f"{places}/results")
    table = spark.read.parquet(f"{places}/a")
    local = spark.createDataFrame([(1, 2)], "x long, g long")
    for frame in (local, table.join(local, "x"), table.withColumn("r", F.rand())):
        assert results.reload(frame) is frame
    assert results.manifests.names("data") == []


def test_wide_results_have_keys_of_their_own(spark, places):
    """More columns than a plan prints by default."""
    results, table = Results(spark, f"{places}/results"), spark.read.parquet(f"{places}/a")
    wide = lambda last: table.select(*[(F.col("x") + i).alias(f"c{i}") for i in range(60)], (F.col("x") + last).alias("z"))
    assert results.key(wide(1)) == results.key(wide(1)) != results.key(wide(2))
