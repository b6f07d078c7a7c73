"""Derived tables follow their input; table versions count only when committed."""

import datetime as dt
import os
import shutil
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dealscope.plans import incremental as inc
from dealscope.session import SHUFFLE_CLEANUP
from dealscope.settings import DEFAULT
from dealscope.sources import fixtures as fx
from dealscope.sources.bucketed import BucketedTable
from dealscope.sources.target import VersionedTable

SF = "/root/testdata/sf0.001"


def test_a_changed_table_is_followed(spark, tmp_dir):
    sf = tmp_dir + "/sf"
    shutil.copytree(SF, sf)
    os.chmod(sf, 0o755)
    before = fx.usecases(spark, sf, DEFAULT).count()
    whole = pq.read_table(sf + "/orders.parquet")
    pq.write_table(whole.slice(0, whole.num_rows // 2), tmp_dir + "/half.parquet")
    os.replace(tmp_dir + "/half.parquet", sf + "/orders.parquet")
    now = spark.read.parquet(sf + "/orders.parquet").count()
    assert 0 < now < before and fx.usecases(spark, sf, DEFAULT).count() == now


def test_a_half_written_version_is_never_current(spark, tmp_dir):
    table = VersionedTable(spark, tmp_dir + "/t")
    assert not table.exists() and table.create_if_missing() and not table.create_if_missing()
    row = spark.createDataFrame([("a",)], "usecase_id string")
    full = row.select(*[F.col("usecase_id") if f.name == "usecase_id" else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in table.schema])
    assert table.write_next(full) == 1
    os.makedirs(tmp_dir + "/t/v=00000002")
    part = next(f for f in os.listdir(tmp_dir + "/t/v=00000001") if f.endswith(".parquet"))
    shutil.copy(f"{tmp_dir}/t/v=00000001/{part}", tmp_dir + "/t/v=00000002/" + part)  # no marker
    assert table.current_version() == 1 and table.read().count() == 1
    assert table.write_next(full.union(full)) == 3 and table.current_version() == 3
    assert table.expire(keep=1) == [0, 1] and table.versions() == [3] and table.read().count() == 2


def _shuffle_files(spark) -> set[str]:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    """Shuffle files since ``before``; Spark deletes them in the background."""
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_stored_results_leave_no_shuffles_behind(spark, tmp_dir):
    """shuffles of a finished write, checkpoint or merge do not pile up."""
    setting = spark.conf.get(SHUFFLE_CLEANUP)
    schema = "usecase_id string, last_modified_date date, note string"
    rows = spark.createDataFrame([(str(i), dt.date(2020, 1, 1), f"old {i}") for i in range(200)], schema)
    newer = rows.where("usecase_id < '3'").withColumns({"last_modified_date": F.lit(dt.date(2020, 1, 2)), "note": F.lit("new")})
    n = newer.count()  # a plain count keeps its shuffle, so it comes first
    before = _shuffle_files(spark)
    stored = inc.materialize(rows.repartition(5, "note"))
    fx.materialized(spark, "left", (tmp_dir,), lambda: rows, partition_col="usecase_id")
    table = BucketedTable(spark, tmp_dir + "/t", rows.schema, buckets=4)
    table.write_next(rows)
    done = table.merge(newer)
    assert done.actions["update"] == n > 0
    assert os.listdir(tmp_dir + "/t/work") == []  # a merge's working copy goes with it
    assert _left(spark, before) == set()
    assert stored.count() == 200
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting == "false"


def test_a_checkpoint_leaves_no_shuffles_while_its_plan_lives(spark):
    """F16-F18: the caller still holds the plan, so no collection of garbage gives the shuffles back."""
    schema = "usecase_id string, last_modified_date date, note string"
    rows = spark.createDataFrame([(str(i), dt.date(2020, 1, 1), f"note {i % 7}") for i in range(200)], schema)
    per_note = rows.groupBy("note").agg(F.count(F.lit(1)).alias("n"))
    batch = rows.repartition(5, "usecase_id").join(per_note.hint("merge"), "note").select("*", F.lit(None).alias("n"))
    before = _shuffle_files(spark)
    stored = inc.materialize(batch)
    assert _left(spark, before) == set()
    assert stored.schema == batch.schema and stored.count() == 200
    assert batch.count() == 200  # the plan itself can still be run


def test_a_merge_that_ends_early_leaves_no_working_copy(spark, tmp_dir):
    rows = spark.createDataFrame([("a", dt.date(2020, 1, 1), "x")], "usecase_id string, last_modified_date date, note string")
    table = BucketedTable(spark, tmp_dir + "/t", rows.schema, buckets=4)
    table.create_if_missing()

    def ends(version):
        raise InterruptedError

    with pytest.raises(InterruptedError):
        table.merge(rows, before_commit=ends)
    assert os.listdir(tmp_dir + "/t/work") == [] and table.read().count() == 0
