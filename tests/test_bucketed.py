"""Bucketed target: touched buckets only, safe commits, stored changes, run properties, expiry."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealscope.operators import upsert as up
from dealscope.sources.bucketed import BucketedTable, RunProperties
from dealscope.sources.target import VersionedTable

D = dt.date
SCHEMA = T.StructType([T.StructField("usecase_id", T.StringType(), False), T.StructField("last_modified_date", T.DateType()),
                       T.StructField("note", T.StringType())])


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def table_of(spark, tmp_dir, n=400, buckets=16):
    table = BucketedTable(spark, f"{tmp_dir}/t", SCHEMA, buckets=buckets)
    table.write_next(rows(spark, *[(str(i), D(2020, 1, 1), f"old {i} " + "x" * 400) for i in range(n)]))
    return table


def size_of(folder):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def content(df):
    return sorted((r.usecase_id, r.last_modified_date, r.note) for r in df.collect())


def test_a_merge_reads_and_writes_touched_buckets_only(spark, tmp_dir):
    table = table_of(spark, tmp_dir)
    before = table.layout()
    batch = rows(spark, ("7", D(2020, 1, 2), "new"), ("fresh", None, "new"), ("8", D(2019, 1, 1), "older"),
                 ("9", D(2020, 1, 1), "equal"))
    of = {r.usecase_id: r.b for r in batch.select("usecase_id", table.bucket().alias("b")).collect()}
    want = content(up.upsert(table.read(), batch))
    done = table.merge(batch)
    assert done.actions == {"update": 1, "insert": 1, "unchanged": 2} and done.batch_rows == 4
    assert done.read_buckets == sorted(set(of.values()))
    assert done.written_buckets == sorted({of["7"], of["fresh"]})
    assert content(table.read()) == want and len(want) == 401
    # untouched buckets are still the files of the first version, touched ones those of the second
    after = table.layout()
    assert {b for b in after if after[b] != before.get(b)} == {of["7"], of["fresh"]}
    first, second = size_of(f"{tmp_dir}/t/v={done.version - 1:08d}"), size_of(f"{tmp_dir}/t/v={done.version:08d}")
    assert second < first / 4
    assert content(table.read(done.version - 1)) != want  # the older version is still there, whole
    assert table.read(done.version - 1).count() == 400
    # the plan lists two folders and prunes by bucket
    plan = table.read_buckets(done.version, [of["7"], of["fresh"]])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in text.split("PartitionFilters")[1][:80] and len(plan.inputFiles()) <= 4


def test_merging_again_changes_nothing(spark, tmp_dir):
    table = table_of(spark, tmp_dir, 30, 4)
    batch = rows(spark, ("1", D(2021, 1, 1), "a"), ("new", D(2021, 1, 1), "b"))
    table.merge(batch)
    state = content(table.read())
    again = table.merge(batch)
    assert again.written_buckets == [] and again.actions == {"unchanged": 2}
    assert content(table.read()) == state and table.current_version() == again.version
    assert table.changes(again.version - 1).count() == 0
    empty = table.merge(batch.limit(0))
    assert empty.batch_rows == 0 and content(table.read()) == state


def test_random_merges_match_the_plain_upsert(spark, tmp_dir):
    import random
    rng = random.Random(4)
    table = BucketedTable(spark, f"{tmp_dir}/t", SCHEMA, buckets=5)
    table.create_if_missing()
    state, feeds = {}, []
    for run in range(5):
        batch = {str(rng.randrange(60)): (D(2020, 1, rng.randrange(1, 20)), f"run {run}") for _ in range(25)}
        first = table.merge(rows(spark, *[(k, *v) for k, v in batch.items()]))
        before = dict(state)
        for k, v in batch.items():
            if k not in state or v[0] > state[k][0]:
                state[k] = v
        feeds.append((first.version, before, dict(state)))
        assert content(table.read()) == sorted((k, *v) for k, v in state.items())
    # every range of versions: the stored changes, and what they come to
    for i in range(len(feeds)):
        for j in range(i, len(feeds)):
            old, new = feeds[i][1], feeds[j][2]
            net = {(r.usecase_id, r["_change_type"], r.last_modified_date, r.note)
                   for r in table.net_changes(feeds[i][0] - 1, feeds[j][0]).collect()}
            want = {(k, "insert", *new[k]) for k in new if k not in old}
            want |= {(k, "update_preimage", *old[k]) for k in old if old[k] != new[k]}
            want |= {(k, "update_postimage", *new[k]) for k in old if old[k] != new[k]}
            assert net == want
            assert {r["_version"] for r in table.changes(feeds[i][0] - 1, feeds[j][0]).select("_version").distinct().collect()} \
                <= {f[0] for f in feeds[i:j + 1]}


def test_a_run_that_ends_before_its_commit_leaves_the_table(spark, tmp_dir):
    table = table_of(spark, tmp_dir, 30, 4)
    version, state = table.current_version(), content(table.read())
    batch = rows(spark, ("1", D(2021, 1, 1), "a"))

    def ends(_):
        raise InterruptedError

    with pytest.raises(InterruptedError):
        table.merge(batch, before_commit=ends)
    assert table.current_version() == version and content(table.read()) == state
    assert table.changes().count() == 0 and table.properties().count() == 0
    done = table.merge(batch, version, RunProperties("m1", prompt_version="p2", watermark=D(2020, 5, 1)))
    assert done.version > version and ("1", D(2021, 1, 1), "a") in content(table.read())
    [p] = table.rows_per_version().collect()
    assert (p["_version"], p.primary_model, p.prompt_version, p.watermark, p.batch_rows, p.inserted, p.updated) == (
        done.version, "m1", "p2", D(2020, 5, 1), 1, 0, 1)


@pytest.mark.parametrize("kind", [VersionedTable, BucketedTable])
def test_two_writers_from_one_version(spark, tmp_dir, kind):
    """A has written its files when B, from the same version, commits: A is told so and B's row stays."""
    table = kind(spark, f"{tmp_dir}/t", SCHEMA)
    assert table.create_if_missing()
    start = table.current_version()
    mine = table._write_whole(rows(spark, ("a", None, "A")), table._claim(start))
    theirs = kind(spark, f"{tmp_dir}/t", SCHEMA).write_next(rows(spark, ("b", None, "B")), expected_version=start)
    assert theirs != mine
    with pytest.raises(RuntimeError):
        table._commit(mine, start)
    assert table.current_version() == theirs and content(table.read()) == [("b", None, "B")]
    with pytest.raises(RuntimeError):
        table.write_next(rows(spark, ("a", None, "A")), expected_version=start)
    assert table.write_next(rows(spark, ("a", None, "A"), ("b", None, "B")), expected_version=theirs) > max(mine, theirs)


@pytest.mark.parametrize("kind", [VersionedTable, BucketedTable])
def test_half_written_first_version_and_missing_marker(spark, tmp_dir, kind):
    table = kind(spark, f"{tmp_dir}/t", SCHEMA)
    os.makedirs(f"{tmp_dir}/t/v=00000000/_temporary")  # a crashed creation
    assert not table.exists() and table.create_if_missing() and table.exists() and table.read().count() == 0
    # a writer that ended between its commit and the marker: the next look sets the marker
    current = table.current_version()
    version = table._write_whole(rows(spark, ("a", None, "A")), table._claim(current))
    assert table._create(table._after(current), str(version)) and version not in table.versions()
    assert table.current_version() == version and content(table.read()) == [("a", None, "A")]


def test_expiry_keeps_the_buckets_that_are_needed(spark, tmp_dir):
    table = table_of(spark, tmp_dir, 100, 8)
    for i in range(4):
        table.merge(rows(spark, (str(i), D(2021, 1, 1 + i), f"run {i}")))
    state, previous = content(table.read()), content(table.read(table.versions()[-2]))
    kept = table.versions()[-2:]
    gone = table.expire(keep=2)
    assert table.versions() == kept and not set(gone) & set(kept)
    assert content(table.read()) == state and content(table.read(kept[0])) == previous
    assert table.changes().select("_version").distinct().count() == 2
    assert table.expire(keep=1) == kept[:1] and content(table.read()) == state
    table.write_next(rows(spark, ("only", None, "whole")))
    assert content(table.read()) == [("only", None, "whole")]  # buckets of before do not shine through
    table.expire(keep=1)
    assert content(table.read()) == [("only", None, "whole")]


def test_diff_by_digest(spark):
    old = rows(spark, ("a", D(2020, 1, 1), "x"), ("b", None, None), ("gone", None, "g"), ("n", None, "1"))
    new = rows(spark, ("a", D(2020, 1, 1), "x"), ("b", None, "null"), ("fresh", None, None), ("n", D(2020, 1, 1), None))
    got = sorted((r["_change_type"], r.usecase_id, str(r.last_modified_date), str(r.note)) for r in up.diff_versions(old, new).collect())
    assert got == [("delete", "gone", "None", "g"), ("insert", "fresh", "None", "None"),
                   ("update_postimage", "b", "None", "null"), ("update_postimage", "n", "2020-01-01", "None"),
                   ("update_preimage", "b", "None", "None"), ("update_preimage", "n", "None", "1")]
    plan = up.changed_keys(old, new)._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("FullOuter"):]
    exchanged = [line for line in join.splitlines() if "Project" in line]
    assert exchanged and all("_digest" in line and "note#" not in line.split("AS _")[0].split("sha2")[0] for line in exchanged[:2])
    assert up.diff_versions(old, old.limit(0)).count() == 4 and up.diff_versions(old, old).count() == 0
    wide = old.withColumn("usecase_id", F.when(F.col("usecase_id") != "a", F.col("usecase_id")))
    assert {r["_change_type"] for r in up.diff_versions(wide.where("usecase_id is null"), old.where("usecase_id = 'a'")).collect()} \
        == {"delete", "insert"}
