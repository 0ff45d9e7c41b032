import pytest
from helpers import file_job, record, rows_of, topic_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyrill.functions.codec import decode
from tallyrill.models import COMMENT, SUBMISSION
from tallyrill.plans.batch import pending
from tallyrill.sources import files, landed, offsets
from tallyrill.sources.offsets import Position, RunCommitted


def _land(spark, root, spans, bucket_size=1000, model=COMMENT):
    """``spans`` maps partition to a list of offsets."""
    for partition, offs in spans.items():
        for off in offs:
            rows = topic_of(spark, [record("k", 1)], model, partition, off)
            landed.write_landed(decode(rows, model, bucket_size=bucket_size), model, root)


def _found(spark, root, positions):
    rows = landed.read_since(spark, COMMENT, root, positions).select("partition", "offset")
    return rows_of(rows)


def test_offset_zero_is_read(spark, root):
    _land(spark, root, {0: [0, 1]})
    assert _found(spark, root, {}) == [(0, 0), (0, 1)]
    assert _found(spark, root, {0: Position(0, 0)}) == [(0, 1)]


def test_each_partition_has_its_own_position(spark, root):
    _land(spark, root, {0: [10, 11], 1: [5000, 5001], 2: [0, 3]})
    at = {0: Position(0, 10), 1: Position(5000, 5000)}
    # Partition 2 has no position yet, so it is read from its start.
    assert _found(spark, root, at) == [(0, 11), (1, 5001), (2, 0), (2, 3)]
    gap = {0: Position(0, 11), 2: Position(0, 0)}
    assert _found(spark, root, gap) == [(1, 5000), (1, 5001), (2, 3)]


def test_offsets_beyond_int_range(spark, root):
    _land(spark, root, {0: [3_000_000_000, 3_000_000_001]})
    rows = landed.read_since(spark, COMMENT, root, {0: Position(3_000_000_000, 3_000_000_000)})
    assert rows_of(rows.select("offset", "_offset_batch")) == [(3_000_000_001, 3_000_000_000)]


def test_directories_are_pruned_and_the_offset_reaches_the_scan(spark, root):
    _land(spark, root, {0: [0, 1000, 2000], 1: [0, 1000]})
    rows = landed.read_since(spark, COMMENT, root, {0: Position(2000, 2000), 1: Position(0, 0)})
    rows = rows.select("offset", "subreddit")
    assert rows_of(rows) == [(1000, "k")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_offset_batch" in plan
    assert "PushedFilters: [IsNotNull(offset), Or(GreaterThan(offset,0)" in plan
    assert "ReadSchema: struct<value:struct<subreddit:string>,partition:int,offset:bigint>" in plan
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
    # Of five directories, one of partition 0 and two of partition 1 are at or past the position.
    assert scan.metrics().apply("numFiles").value() == 3


def test_a_leaf_read_keeps_partition_and_bucket(spark, root):
    _land(spark, root, {1: [1500]})
    leaf = spark.read.parquet(f"{root}/_partition=1/_offset_batch=1000")
    assert rows_of(leaf.select("partition", "offset_batch")) == [(1, 1000)]


def test_flattened_fields_come_back_on_read(spark, root):
    texts = ['{"id":"1","subreddit":"s","over_18":true,"created_utc":3.7,"title":"t"}', "broken"]
    rows = decode(topic_of(spark, texts), SUBMISSION)
    landed.write_landed(rows, SUBMISSION, root)
    back = landed.read_landed(spark, SUBMISSION, root)
    names = ["offset", "id", "subreddit", "over_18", "title", "created_utc", "value", "topic"]
    assert rows_of(back.select(names)) == rows_of(rows.select(names).where("offset = 0"))
    assert set(back.columns) >= set(rows.columns)


def test_nothing_landed_yet(spark, root):
    empty = landed.read_since(spark, COMMENT, f"{root}/none", {})
    assert empty.isEmpty()
    assert empty.dtypes == landed.empty_landed(spark, COMMENT).dtypes


def test_pending_sources(spark, root):
    job = file_job(root)
    for model in (SUBMISSION, COMMENT):
        _land(spark, f"{job.landed}/{model.source}", {0: [0, 5]}, model=model)
    offsets.append(spark, job.offsets, _positions(spark, ("comment", 0, 0, 5), ("submission", 0, 0, 0)), 1)
    assert rows_of(pending(spark, job)) == [("submission", 1)]


def test_landed_reads_scan_the_key_and_one_flag(spark, root):
    _land(spark, f"{root}/submission", {0: [0, 5]})
    counted = landed.read_landed(spark, SUBMISSION, f"{root}/submission").groupBy("subreddit").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert read == "struct<value:struct<subreddit:string>,_unreadable:boolean>"


def test_the_log_reads_its_last_entry_only(spark, root):
    log = f"{root}/log"
    for run_id in range(1, 5):
        offsets.append(spark, log, _positions(spark, ("a", 0, 0, run_id)), run_id)
    read = offsets.read_log(spark, log)
    assert {f.split("/")[-2] for f in read.inputFiles()} == {"run_id=4"}
    assert rows_of(read) == [("a", 0, 0, 4, 4)]


def test_a_run_id_is_claimed_once(spark, root):
    log = f"{root}/log"
    first = offsets.claim(spark, log, 1)
    with pytest.raises(offsets.RunClaimed):
        offsets.claim(spark, log, 1)
    first.release(spark)
    second = offsets.claim(spark, log, 1)
    first.release(spark)
    second.require(spark)
    offsets.append(spark, log, _positions(spark, ("a", 0, 0, 5)), 1)
    second.release(spark)
    with pytest.raises(RunCommitted):
        offsets.claim(spark, log, 1)
    offsets.claim(spark, log, 2).release(spark)


def test_an_old_claim_is_taken_over(spark, root):
    log = f"{root}/log"
    crashed = offsets.claim(spark, log, 1)
    taken = offsets.claim(spark, log, 1, stale=-1)
    taken.require(spark)
    with pytest.raises(offsets.RunClaimed):
        crashed.require(spark)
    crashed.release(spark)
    taken.require(spark)
    taken.release(spark)
    offsets.prune(spark, log)
    assert [n for n in files.children(spark, log) if n.startswith("_")] == []


def _positions(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, partition int, offset_batch bigint, offset bigint")


def test_log_of_two_runs(spark, root):
    log = f"{root}/log"
    assert offsets.last_run(spark, log) == 0
    assert offsets.positions(offsets.read_log(spark, log)) == {}
    offsets.append(spark, log, _positions(spark, ("a", 0, 0, 5), ("b", 0, 1000, 1001)), 1)
    offsets.append(spark, log, _positions(spark, ("a", 0, 0, 9), ("a", 1, 0, 0)), 2)
    assert offsets.last_run(spark, log) == 2
    at = offsets.positions(offsets.read_log(spark, log))
    assert at == {"a": {0: Position(0, 9), 1: Position(0, 0)}, "b": {0: Position(1000, 1001)}}
    offsets.prune(spark, log, keep=1)
    assert offsets.positions(offsets.read_log(spark, log)) == at
    with pytest.raises(RunCommitted):
        offsets.append(spark, log, _positions(spark, ("a", 0, 0, 10)), 2)


def test_an_entry_without_success_is_not_committed(spark, root):
    log = f"{root}/log"
    offsets.append(spark, log, _positions(spark, ("a", 0, 0, 5)), 1)
    spark.sparkContext._jvm.java.io.File(f"{log}/run_id=2/_temporary").mkdirs()
    _positions(spark, ("a", 0, 0, 99)).write.mode("append").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{log}/run_id=2")
    assert offsets.last_run(spark, log) == 1
    assert offsets.positions(offsets.read_log(spark, log)) == {"a": {0: Position(0, 5)}}
    offsets.append(spark, log, _positions(spark, ("a", 0, 0, 6)), 2)
    assert offsets.last_run(spark, log) == 2
    assert offsets.positions(offsets.read_log(spark, log)) == {"a": {0: Position(0, 6)}}


@settings(max_examples=10, deadline=None)
@given(
    rows=st.sets(st.tuples(st.integers(0, 4), st.integers(0, 3500)), min_size=1, max_size=40),
    at=st.dictionaries(st.integers(0, 4), st.integers(0, 3500), max_size=5),
)
def test_since_against_python(spark, rows, at):
    df = spark.createDataFrame(sorted(rows), "partition int, offset bigint").withColumns({
        "_partition": F.col("partition"),
        "_offset_batch": F.floor(F.col("offset") / 1000) * 1000,
    })
    positions = {p: Position(o // 1000 * 1000, o) for p, o in at.items()}
    got = df.where(landed.since(positions)).select("partition", "offset")
    assert rows_of(got) == sorted(((p, o) for p, o in rows if o > at.get(p, -1)), key=repr)
