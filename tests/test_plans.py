"""The physical plans are the ones wanted at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from sluice import BronzeTable, SilverTable, conform, contract_report, latest_per_key, table_changes, upsert
from sluice.operators.upsert import unmatched
from sluice.sources.csv_files import new_files
from tests.helpers import MEMBERS, Desk, plan
from tests.test_ingest import EPOCH, LINE
from tests.test_runs import KV


@pytest.fixture
def parquet(spark, root):
    path = f"{root}/table"
    wide = spark.range(2000).select(
        F.col("id").alias("k"), F.col("id").cast("string").alias("v"), F.lit("x").alias("pad")
    )
    wide.write.parquet(path)
    return spark.read.parquet(path)


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


def test_conform_is_one_narrow_generated_stage(spark, root):
    raw = spark.createDataFrame([("A", "15/05/2000", "z")], "member_id string, born_on string, junk string")
    raw.write.parquet(f"{root}/raw")
    text = plan(conform(spark.read.parquet(f"{root}/raw"), MEMBERS))
    assert "Exchange" not in text
    assert text.lstrip().startswith("*(1)")
    assert "Python" not in text
    assert re.search(r"ReadSchema: struct<member_id:string,born_on:string>", text)


def test_contract_report_is_one_scan(spark, root):
    raw = spark.createDataFrame([("A", "15/05/2000")], "member_id string, born_on string")
    raw.write.parquet(f"{root}/raw")
    text = plan(contract_report(spark.read.parquet(f"{root}/raw"), MEMBERS))
    assert text.count("FileScan") == 1
    assert "partial_count" in text


def test_upsert_of_a_small_source_does_not_move_the_target(parquet, spark, root):
    spark.createDataFrame([(1, "one", "y")], "k long, v string, pad string").write.parquet(f"{root}/new")
    source = spark.read.parquet(f"{root}/new")
    text = plan(upsert(parquet, source, ["k"]))
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text
    # The rows without a key are found by row-group statistics.
    assert "PushedFilters: [IsNull(k)]" in text
    assert "PushedFilters: [IsNotNull(k)]" in text


def test_a_checked_broadcast_survives_the_key_filter(parquet, spark, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    small = F.broadcast(parquet.select("k"))
    assert "BroadcastHashJoin" in plan(unmatched(parquet, small, ["k"]))
    assert "SortMergeJoin" in plan(unmatched(parquet, parquet.select("k"), ["k"]))


def test_latest_per_key_combines_before_the_shuffle(parquet):
    lines = plan(latest_per_key(parquet, ["k"], order=["v"])).splitlines()
    partial = next(i for i, line in enumerate(lines) if "partial_max" in line)
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert shuffle < partial  # the plan is printed from the top
    assert "Window" not in "".join(lines)


def test_table_changes_shuffles_both_tables_once(parquet, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    after = parquet.withColumn("v", F.when(F.col("k") < 10, "new").otherwise(F.col("v")))
    text = executed(table_changes(parquet, after, ["k"]))
    final = text.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan") == 2


def test_the_version_bound_prunes_directories(spark, root):
    bronze = BronzeTable(spark, f"{root}/t")
    line = spark.createDataFrame([("1", EPOCH, "f", 0, 0)], LINE)
    for version in range(4):
        bronze.write_version(line, version, "s")
    text = plan(bronze.read_upto(2))
    assert re.search(r"PartitionFilters: \[isnotnull\(_commit_version#\d+L\), \(_commit_version#\d+L <= 2\)\]", text)
    assert "ReadSchema: struct<k:string>" in plan(bronze.read_upto(2).select("k"))
    files = bronze.read_changes(0, 2).inputFiles()
    assert {file.split("/")[-2] for file in files} == {"_commit_version=1", "_commit_version=2"}


def test_reading_the_typed_table_prunes(spark, tmp_path):
    desk = Desk(spark, tmp_path, KV)
    desk.put("a.csv", "k,v,w\nA,1,x\nB,2,y\n")
    desk.run()
    desk.put("b.csv", "k,v,w\nA,3,x\n,4,x\n")
    desk.run()
    table = SilverTable(spark, desk.layout.typed_of(desk.dataset)).read()
    text = plan(table.filter("v > 1").select("k"))
    assert "Exchange" not in text
    assert "GreaterThan(v,1)" in text
    assert "ReadSchema: struct<k:string,v:int>" in text


def test_listing_the_landing_directory_reads_no_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("k\n1\n")
    stream = (
        new_files(spark, f"{tmp_path}/in", 10, "36500d")
        .writeStream.foreachBatch(lambda batch, number: batch.collect())
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    text = stream._jsq.explainInternal(False)
    assert "ReadSchema: struct<path:string,length:bigint>" in text
    assert "content" not in text.split("FileScan binaryFile")[1].split("Batched")[0]


@pytest.fixture
def skew(settings):
    """Small thresholds, so that AQE treats a few kilobytes as a big partition."""
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10000")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    settings("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10000")
    settings("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1000")


def hot(spark, root, rows=60_000):
    """A third of the rows under one key, the others under keys of their own."""
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    noise = F.sha2(F.col("id").cast("string"), 256)
    spark.range(0, rows, 1, 16).select(key.alias("k"), noise.alias("v")).write.parquet(f"{root}/hot")
    return spark.read.parquet(f"{root}/hot")


def test_a_hot_key_in_the_target_is_split(spark, root, skew):
    target = hot(spark, root)
    source = target.filter("k > 10").withColumn("v", F.lit("new"))
    merged = upsert(target, source, ["k"])
    assert "SortMergeJoin(skew=true)" in executed(merged)
    assert merged.count() == target.count()


def test_a_hot_key_with_many_changes_is_split(spark, root, skew):
    before = hot(spark, root)
    after = before.withColumn("v", F.concat("v", F.lit("!")))
    changes = table_changes(before, after, ["k"])
    assert "SortMergeJoin(skew=true)" in executed(changes)
    assert changes.count() == 2 * before.count()
