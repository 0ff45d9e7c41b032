"""Speed and batch layers over topics kept as files."""

import random

import pytest
from helpers import at, feed, file_job, record, rows_of, run, seconds_of, topic_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException, StreamingQueryException

from tallyrill.functions.codec import rejects
from tallyrill.models import COMMENT, MODELS, SUBMISSION, TRENDING, UNIQUE_ACTIVE
from tallyrill.models import WINDOWED_COMMENTS, WINDOWED_SUBMISSIONS
from tallyrill.plans import batch, speed, upkeep
from tallyrill.session import build_session, job_session, scratch, shared_folder
from tallyrill.sources import files, landed, offsets
from tallyrill.sources.serving import Serving
from tallyrill.sources.topics import Topics
from tallyrill.streaming.sinks import to_console


def _table(spark, job, table):
    return seconds_of(job.serving.latest(spark, table))


def _sub(*pairs):
    return [record(k, s) for k, s in pairs]


# Windows and late data


LATE_WAVES = [[("a", 1), ("a", 3)], [("a", 60)], [("a", 2), ("a", 61)]]


@pytest.mark.parametrize("by_table", [False, True])
@pytest.mark.parametrize("watermark, expected", [(None, {5: 3, 65: 2}), ("10 seconds", {5: 2, 65: 2})])
def test_late_rows(spark, root, by_table, watermark, expected):
    job = file_job(root, watermark=watermark)
    streams = job_session(spark)
    start = speed.start_stats_by_table if by_table else speed.start_stats
    for i, wave in enumerate(LATE_WAVES):
        feed(spark, job, comments=_sub(*wave), submissions=_sub(*wave), first_offset=10 * i)
        run(start(streams, job))
    assert _table(spark, job, WINDOWED_COMMENTS) == expected
    assert _table(spark, job, WINDOWED_SUBMISSIONS) == expected
    active = _table(spark, job, UNIQUE_ACTIVE)
    assert active == {end: (1, 2 * n) for end, n in expected.items()}


def test_update_mode_writes_only_changed_windows(spark, root):
    job = file_job(root)
    streams = job_session(spark)
    feed(spark, job, _sub(("a", 1), ("a", 8)))
    run(speed.start_stats(streams, job))
    feed(spark, job, _sub(("a", 9)), first_offset=5)
    run(speed.start_stats(streams, job))
    versions = job.serving.versions(spark, WINDOWED_SUBMISSIONS)
    assert rows_of(versions.selectExpr("version", "second(window)", "count")) == [
        (0, 10, 1), (0, 5, 1), (1, 10, 2),
    ]


def test_windows_are_counted_per_kind_only_where_it_occurs(spark, root):
    job = file_job(root)
    feed(spark, job, _sub(("a", 1), (None, 2)), _sub(("b", 1), ("b", 11), ("c", None)))
    run(speed.start_stats(job_session(spark), job))
    assert _table(spark, job, WINDOWED_SUBMISSIONS) == {5: 2}
    assert _table(spark, job, WINDOWED_COMMENTS) == {5: 1, 15: 1}
    assert _table(spark, job, UNIQUE_ACTIVE) == {5: (2, 2), 15: (1, 1)}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 30)), min_size=1, max_size=25),
    waves=st.integers(1, 3),
    seed=st.integers(0, 99),
)
def test_any_split_and_order_gives_the_batch_result(spark, tmp_path_factory, rows, waves, seed):
    job = file_job(str(tmp_path_factory.mktemp("job")))
    streams = job_session(spark)
    shuffled = random.Random(seed).sample(rows, len(rows))
    for i in range(waves):
        feed(spark, job, _sub(*shuffled[i::waves]), first_offset=100 * i)
        run(speed.start_stats(streams, job))
    expected = {}
    for _, second in rows:
        end = (second // 5 + 1) * 5
        expected[end] = expected.get(end, 0) + 1
    assert _table(spark, job, WINDOWED_SUBMISSIONS) == expected


def test_a_failed_batch_is_replayed_without_double_counting(spark, root, monkeypatch):
    job = file_job(root)
    streams = job_session(spark)
    feed(spark, job, _sub(("a", 1), ("b", 2)))
    upsert = type(job.serving).upsert
    calls = []

    def failing(self, df, table, version):
        upsert(self, df, table, version)
        calls.append(table.name)
        if len(calls) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(type(job.serving), "upsert", failing)
    with pytest.raises(StreamingQueryException):
        run(speed.start_stats(streams, job))
    run(speed.start_stats(streams, job))
    assert _table(spark, job, WINDOWED_SUBMISSIONS) == {5: 2}
    assert job.serving.versions(spark, WINDOWED_SUBMISSIONS).count() == 1


def test_a_new_generation_starts_over(spark, root):
    job = file_job(root)
    streams = job_session(spark)
    feed(spark, job, _sub(("a", 1)))
    run(speed.start_stats(streams, job))
    feed(spark, job, _sub(("a", 2)), first_offset=1)
    renewed = file_job(root, generation=1)
    run(speed.start_stats(streams, renewed))
    assert _table(spark, renewed, WINDOWED_SUBMISSIONS) == {5: 2}


def test_a_lost_checkpoint_begins_the_next_generation(spark, root):
    job, streams = file_job(root), job_session(spark)
    feed(spark, job, _sub(("a", 1), ("a", 2)))
    run(speed.start_stats(streams, job))
    files.remove(spark, f"{root}/checkpoints")
    with pytest.raises(ValueError):
        speed.start_stats(streams, file_job(root, generation=0))
    feed(spark, job, _sub(("a", 3)), first_offset=2)
    run(speed.start_stats(streams, job))
    assert _table(spark, job, WINDOWED_SUBMISSIONS) == {5: 3}
    feed(spark, job, _sub(("a", 4)), first_offset=3)
    run(speed.start_stats(streams, job))
    assert _table(spark, job, WINDOWED_SUBMISSIONS) == {5: 4}
    assert files.children(spark, job.checkpoint("windowed_activity")) == ["generation=1"]


def test_four_topics_land_while_two_are_counted(spark, root):
    every = {m.source: m for m in MODELS.values()}
    job, streams = file_job(root, sources=tuple(every)), job_session(spark)
    feed(spark, job, _sub(("a", 1)), _sub(("b", 2)))
    for model in every.values():
        topic_of(spark, ['{"id": "1", "created_utc": 1704067201.0}'], model).write.mode("append").parquet(job.topics.path(model))
    run(speed.run_speed(streams, job))
    landed_rows = {s: landed.read_landed(spark, m, f"{job.landed}/{s}").count() for s, m in every.items()}
    assert landed_rows == {s: 2 if s in job.kinds else 1 for s in every}
    assert batch.run_batch(streams, job) == 1
    assert _ranking(batch.current_ranking(spark, job)) == [("a", 1, 0, 1), ("b", 0, 1, 1)]


@pytest.mark.parametrize("wrong", [
    {"sources": ("submission",)},
    {"kinds": {"submission": "posts"}},
    {"sources": ("submission", "redditor"), "kinds": {"redditor": "submissions"}},
])
def test_a_job_that_cannot_work_is_refused_at_once(root, wrong):
    with pytest.raises(ValueError):
        file_job(root, **wrong)


def test_one_kind_alone_by_table(spark, root):
    job = file_job(root, sources=("comment",), kinds={"comment": "comments"})
    feed(spark, job, _sub(("a", 1)), _sub(("b", 2), ("c", 3)))
    run(speed.start_stats_by_table(job_session(spark), job))
    assert _table(spark, job, WINDOWED_COMMENTS) == {5: 2}
    assert _table(spark, job, UNIQUE_ACTIVE) == {5: (2, 2)}


def test_plan_of_the_counts(spark, root):
    job = file_job(root)
    feed(spark, job, _sub(("a", 1)), _sub(("b", 2)))
    queries = speed.start_stats(job_session(spark), job)
    run(queries)
    plan = queries[0]._jsq.explainInternal(False)
    assert plan.count("from_json") == 2
    assert plan.count("Exchange") == plan.count("StateStoreSave") == 1
    assert plan.index("Exchange") < plan.index("partial_approx_count_distinct")
    assert "ReadSchema: struct<value:binary>" in plan and "Python" not in plan


# Landing


def test_plan_of_landing(spark, root):
    job = file_job(root)
    feed(spark, job, _sub(("a", 1)))
    queries = speed.start_landing(job_session(spark), job)
    run(queries)
    plan = queries[0]._jsq.explainInternal(False)
    assert plan.count("from_json") == 1
    assert "Exchange" not in plan and "Sort" not in plan and "Python" not in plan


def test_landing_is_exactly_once_over_restarts(spark, root):
    job = file_job(root)
    streams = job_session(spark)
    for wave in range(3):
        feed(spark, job, _sub(("a", wave)), _sub(("b", wave)), first_offset=999 + wave)
        run(speed.start_landing(streams, job))
    run(speed.start_landing(streams, job))
    back = landed.read_landed(spark, SUBMISSION, f"{job.landed}/submission")
    assert rows_of(back.select("offset", "_offset_batch", "subreddit", "created_utc")) == [
        (1000, 1000, "a", at(1)), (1001, 1000, "a", at(2)), (999, 0, "a", at(0)),
    ]


def test_rejects_are_landed_apart_from_the_records(spark, root):
    job = file_job(root)
    feed(spark, job, [record("a", 1), "{", "", record("b", 2, over_18="x")])
    run(speed.start_landing(job_session(spark), job))
    path = f"{job.landed}/submission"
    assert rows_of(landed.read_landed(spark, SUBMISSION, path).select("offset")) == [(0,), (3,)]
    stored = landed.read_stored(spark, SUBMISSION, path)
    assert rows_of(rejects(stored).select("offset")) == [(1,), (2,), (3,)]


def test_uncommitted_files_are_not_read(spark, root):
    job = file_job(root)
    feed(spark, job, _sub(("a", 1)))
    run(speed.start_landing(job_session(spark), job))
    path = f"{job.landed}/submission"
    stray = spark.read.parquet(f"{path}/_partition=0/_offset_batch=0")
    stray.write.mode("append").parquet(f"{path}/_partition=0/_offset_batch=0")
    assert landed.read_landed(spark, SUBMISSION, path).count() == 1


def test_all_five_queries(spark, root):
    job = file_job(root)
    feed(spark, job, _sub(("a", 1)), _sub(("b", 2)))
    queries = speed.run_speed(job_session(spark), job, by_table=True)
    assert [q.name for q in queries] == [
        "land_submission", "land_comment", "windowed_submissions", "windowed_comments",
        "unique_active_subreddits",
    ]
    run(queries)
    assert _table(spark, job, UNIQUE_ACTIVE) == {5: (2, 2)}


def test_processing_time_trigger_runs_until_stopped(spark, root):
    job = file_job(root, trigger={"processingTime": "100 milliseconds"})
    feed(spark, job, _sub(("a", 1)))
    queries = speed.start_stats(job_session(spark), job)
    queries[0].processAllAvailable()
    assert queries[0].isActive
    queries[0].stop()
    assert _table(spark, job, WINDOWED_SUBMISSIONS) == {5: 1}


def test_console_sink(spark, root, capfd):
    job = file_job(root)
    feed(spark, job, _sub(("a", 1)))
    raw = job.topics.read_stream(job_session(spark), SUBMISSION)
    to_console(raw.groupBy("topic").count(), {"availableNow": True}).awaitTermination()


def test_kafka_needs_its_connector(spark):
    topics = Topics(options={"kafka.bootstrap.servers": "none:1"})
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        topics.read_stream(spark, SUBMISSION)
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        topics.publish(spark.createDataFrame([], SUBMISSION.spark_schema), SUBMISSION)


@pytest.mark.parametrize("streaming", [False, True])
def test_published_records_reach_the_tables(spark, root, streaming):
    job, streams = file_job(root), job_session(spark)
    schema = f"partition int, offset bigint, timestamp timestamp, {_ddl(COMMENT)}"
    rows = [(0, i, at(i), f"c{i}", "k", None, None, 1704067200.0 + i, "text") for i in range(7)]
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/records")
    reader = streams.readStream.schema(schema) if streaming else streams.read
    query = job.topics.publish(reader.parquet(f"{root}/records"), COMMENT, f"{root}/publish")
    if streaming:
        query.processAllAvailable()
        query.stop()
    feed(spark, job, [])
    run(speed.run_speed(streams, job))
    assert _table(spark, job, WINDOWED_COMMENTS) == {5: 5, 10: 2}
    back = landed.read_landed(spark, COMMENT, f"{job.landed}/comment")
    assert rows_of(back.select("id", "body")) == [(f"c{i}", "text") for i in range(7)]


def _ddl(model):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in model.spark_schema)


# Batch runs


def _land(spark, job, streams, submissions=(), comments=(), partition=0, first_offset=0):
    feed(spark, job, submissions, comments, partition, first_offset)
    run(speed.start_landing(streams, job))


def _ranking(df):
    return [tuple(r)[:4] for r in df.orderBy("subreddit").collect()]


def test_runs_rank_what_is_new_and_keep_old_keys(spark, root):
    job, streams = file_job(root), job_session(spark)
    assert batch.run_batch(streams, job) is None
    _land(spark, job, streams, _sub(("a", 1), ("a", 2)), _sub(("b", 3)))
    assert batch.run_batch(streams, job) == 1
    assert _ranking(batch.ranking_table(spark, job)) == [("a", 2, 0, 2), ("b", 0, 1, 1)]
    assert batch.run_batch(streams, job) is None
    _land(spark, job, streams, _sub(("b", 9)), first_offset=2)
    assert batch.run_batch(streams, job) == 2
    assert _ranking(batch.ranking_table(spark, job)) == [("a", 2, 0, 2), ("b", 1, 0, 1)]
    assert _ranking(batch.current_ranking(spark, job)) == [("b", 1, 0, 1)]
    assert {r.subreddit: r.last_update for r in batch.ranking_table(spark, job).collect()} == {
        "a": at(3), "b": at(9),
    }


def test_slow_partitions_are_not_skipped(spark, root):
    job, streams = file_job(root), job_session(spark)
    _land(spark, job, streams, _sub(("a", 1)), partition=0, first_offset=5000)
    batch.run_batch(streams, job)
    _land(spark, job, streams, _sub(("b", 2)), partition=1, first_offset=10)
    batch.run_batch(streams, job)
    assert _ranking(batch.current_ranking(spark, job)) == [("b", 1, 0, 1)]
    at_end = offsets.positions(offsets.read_log(spark, job.offsets))["submission"]
    assert {p: x.offset for p, x in at_end.items()} == {0: 5000, 1: 10}


def test_cumulative_ranking(spark, root):
    job, streams = file_job(root), job_session(spark)
    for i in range(2):
        _land(spark, job, streams, _sub(("a", i)), first_offset=i)
        batch.run_batch(streams, job, cumulative=True)
    assert _ranking(batch.current_ranking(spark, job)) == [("a", 2, 0, 2)]


def test_records_without_time_move_the_offsets_only(spark, root):
    job, streams = file_job(root), job_session(spark)
    _land(spark, job, streams, [record("a", None), "{"])
    assert batch.run_batch(streams, job) == 1
    assert batch.ranking_table(spark, job).isEmpty()
    assert batch.run_batch(streams, job) is None
    assert offsets.positions(offsets.read_log(spark, job.offsets))["submission"][0].offset == 1


def test_a_crash_before_the_commit_leaves_nothing_visible(spark, root, monkeypatch):
    job, streams = file_job(root), job_session(spark)
    _land(spark, job, streams, _sub(("a", 1)))
    batch.run_batch(streams, job)
    _land(spark, job, streams, _sub(("a", 2), ("b", 3)), first_offset=1)

    def crash(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(offsets, "append", crash)
        with pytest.raises(OSError):
            batch.run_batch(streams, job)
    assert job.serving.versions(spark, TRENDING).where("version = 2").count() == 2
    assert _ranking(batch.ranking_table(spark, job)) == [("a", 1, 0, 1)]
    assert _ranking(batch.current_ranking(spark, job)) == [("a", 1, 0, 1)]
    # More lands before the next run, which takes the same id and covers all of it.
    _land(spark, job, streams, _sub(("c", 4)), first_offset=3)
    assert batch.run_batch(streams, job) == 2
    assert _ranking(batch.current_ranking(spark, job)) == [
        ("a", 1, 0, 1), ("b", 1, 0, 1), ("c", 1, 0, 1),
    ]


def test_a_run_overtaken_by_another_leaves_its_ranking_alone(spark, root, monkeypatch):
    job, streams = file_job(root), job_session(spark)
    _land(spark, job, streams, _sub(("a", 1)))
    progress = batch.progress

    def overtaken(found):
        monkeypatch.setattr(batch, "progress", progress)
        assert batch.run_batch(streams, job) == 1
        return progress(found)

    monkeypatch.setattr(batch, "progress", overtaken)
    with pytest.raises(offsets.RunCommitted):
        batch.run_batch(streams, job)
    assert _ranking(batch.current_ranking(spark, job)) == [("a", 1, 0, 1)]
    assert batch.run_batch(streams, job) is None


@pytest.mark.parametrize("gap", ["kind_counts", "rank"])
def test_runs_that_overlap_after_the_check(spark, root, monkeypatch, gap):
    """The second run fails and changes neither log nor ranking, wherever the first one is."""
    job, streams = file_job(root), job_session(spark)
    _land(spark, job, streams, _sub(("a", 1)))
    inner = getattr(batch, gap)

    def overlapped(*args):
        monkeypatch.setattr(batch, gap, inner)
        before = offsets.last_run(spark, job.offsets), job.serving.versions(spark, TRENDING).count()
        with pytest.raises(offsets.RunClaimed):
            batch.run_batch(streams, job)
        assert (offsets.last_run(spark, job.offsets), job.serving.versions(spark, TRENDING).count()) == before
        return inner(*args)

    monkeypatch.setattr(batch, gap, overlapped)
    assert batch.run_batch(streams, job) == 1
    assert _ranking(batch.current_ranking(spark, job)) == [("a", 1, 0, 1)]


def test_overlap_between_ranking_and_commit(spark, root, monkeypatch):
    job, streams = file_job(root), job_session(spark)
    _land(spark, job, streams, _sub(("a", 1)))
    append = offsets.append

    def overlapped(*args):
        monkeypatch.setattr(offsets, "append", append)
        with pytest.raises(offsets.RunClaimed):
            batch.run_batch(streams, job)
        append(*args)

    monkeypatch.setattr(offsets, "append", overlapped)
    assert batch.run_batch(streams, job) == 1
    assert _ranking(batch.current_ranking(spark, job)) == [("a", 1, 0, 1)]


def test_a_killed_run_is_recovered(spark, root, monkeypatch):
    """A run that dies without clean-up keeps its claim until that is old enough."""
    job, streams = file_job(root), job_session(spark)
    _land(spark, job, streams, _sub(("a", 1)))
    offsets.claim(spark, job.offsets, 1)
    with pytest.raises(offsets.RunClaimed):
        batch.run_batch(streams, job)
    assert batch.run_batch(streams, file_job(root, stale_claim=-1)) == 1
    assert _ranking(batch.current_ranking(spark, job)) == [("a", 1, 0, 1)]


def test_ranking_in_an_external_store(spark, root):
    job = file_job(root, store=Serving(format="parquet", options={"path": f"{root}/out"}))
    streams = job_session(spark)
    for i, key in enumerate("ab"):
        _land(spark, job, streams, _sub((key, 10 * i)), first_offset=i)
        batch.run_batch(streams, job)
    assert _ranking(batch.current_ranking(spark, job)) == [("b", 1, 0, 1)]
    assert _ranking(batch.ranking_table(spark, job)) == [("a", 1, 0, 1), ("b", 1, 0, 1)]


def test_upkeep_changes_no_result(spark, root):
    job, streams = file_job(root), job_session(spark)
    for i in range(3):
        feed(spark, job, _sub(("a", i), ("b", 7 * i)), _sub(("b", i)), first_offset=2 * i)
        run(speed.run_speed(streams, job))
        batch.run_batch(streams, job)
    tables = (WINDOWED_SUBMISSIONS, WINDOWED_COMMENTS, UNIQUE_ACTIVE)
    before = [_table(spark, job, t) for t in tables]
    ranked = rows_of(batch.ranking_table(spark, job))
    upkeep.run_upkeep(spark, job, keep_runs=1)
    assert [_table(spark, job, t) for t in tables] == before
    assert rows_of(batch.ranking_table(spark, job)) == ranked
    feed(spark, job, _sub(("a", 3)), first_offset=8)
    run(speed.run_speed(streams, job))
    assert batch.run_batch(streams, job) == 4
    assert _table(spark, job, WINDOWED_SUBMISSIONS)[5] == before[0][5] + 1
    assert _ranking(batch.current_ranking(spark, job)) == [("a", 1, 0, 1)]


def test_a_run_scans_each_landed_table_once(spark, root):
    job, streams = file_job(root), job_session(spark)
    _land(spark, job, streams, _sub(("a", 1)), _sub(("b", 3)))
    plan = batch.updates(streams, job)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    assert "value:struct<subreddit:string>" in plan


# Sessions


def test_job_sessions_leave_the_callers_settings_alone(spark):
    streams = job_session(spark)
    assert "RocksDB" in streams.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert streams.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert job_session(spark, 7).conf.get("spark.sql.shuffle.partitions") == "7"


def test_scratch_lies_below_the_shared_folder(spark):
    folder = shared_folder(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or folder == configured
    assert scratch(spark).startswith(folder) and scratch(spark) != scratch(spark)


def test_build_session_takes_settings(spark):
    built = build_session("again", **{"spark.sql.shuffle.partitions": "4"})
    assert built.sparkContext is spark.sparkContext
    assert built.conf.get("spark.sql.session.timeZone") == "UTC"
    for key in ("spark.sql.streaming.stateStore.providerClass",
                "spark.sql.maxConcurrentOutputFileWriters"):
        built.conf.unset(key)


def test_landing_and_decoding_use_no_python(spark, root):
    job = file_job(root)
    feed(spark, job, _sub(("a", 1)))
    run(speed.start_landing(job_session(spark), job))
    rows = landed.read_landed(spark, COMMENT, f"{job.landed}/comment")
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


def test_a_micro_batch_writes_few_files_and_none_when_nothing_changed(spark, root):
    job, streams = file_job(root), job_session(spark)
    feed(spark, job, _sub(*[("a", 7 * i) for i in range(40)]))
    run(speed.start_stats(streams, job))
    feed(spark, job, ["{"], first_offset=40)
    run(speed.start_stats(streams, job))
    path = job.serving.path(WINDOWED_SUBMISSIONS)
    [part] = files.children(spark, path)
    assert part.startswith("part=0-")
    assert len([n for n in files.children(spark, f"{path}/{part}") if n.endswith(".parquet")]) == 1


def test_topics_can_be_read_in_several_batches(spark, root):
    job = file_job(root)
    for i in range(3):
        feed(spark, job, _sub(("a", i)), first_offset=i)
    bounded = file_job(root, topics=Topics("parquet", f"{root}/topics", {"maxBytesPerTrigger": "1"}))
    run(speed.start_stats(job_session(spark), bounded))
    versions = bounded.serving.versions(spark, WINDOWED_SUBMISSIONS)
    assert versions.select("version").distinct().count() == 3
    assert _table(spark, bounded, WINDOWED_SUBMISSIONS) == {5: 3}


# Fences


def test_an_overtaken_run_cannot_replace_a_committed_ranking(spark, root, monkeypatch):
    job, streams = file_job(root), job_session(spark)
    _land(spark, job, streams, _sub(("a", 1)))
    inner = batch.rank

    def stalled(*args):
        ranking = inner(*args)
        monkeypatch.setattr(batch, "rank", inner)
        _land(spark, job, streams, _sub(("b", 2)), first_offset=1)
        assert batch.run_batch(streams, file_job(root, stale_claim=-1)) == 1
        return ranking

    monkeypatch.setattr(batch, "rank", stalled)
    with pytest.raises(offsets.RunCommitted):
        batch.run_batch(streams, job)
    both = [("a", 1, 0, 1), ("b", 1, 0, 1)]
    assert _ranking(batch.current_ranking(spark, job)) == _ranking(batch.ranking_table(spark, job)) == both
    assert len(job.serving.parts(spark, TRENDING)) == 2
    # Upkeep drops what the overtaken run wrote, and later runs leave it out too.
    _land(spark, job, streams, _sub(("c", 3)), first_offset=2)
    assert batch.run_batch(streams, job) == 2
    upkeep.run_upkeep(spark, job)
    assert len(job.serving.parts(spark, TRENDING)) == 2
    assert _ranking(batch.ranking_table(spark, job)) == [*both, ("c", 1, 0, 1)]


def test_only_one_of_two_entries_with_one_id_commits(spark, root, monkeypatch):
    log = f"{root}/log"
    schema = "source string, partition int, offset_batch bigint, offset bigint"
    monkeypatch.setattr(offsets, "require_open", lambda *args: None)
    offsets.append(spark, log, spark.createDataFrame([("a", 0, 0, 5)], schema), 1, ["1-x"])
    with pytest.raises(offsets.RunCommitted):
        offsets.append(spark, log, spark.createDataFrame([("a", 0, 0, 9)], schema), 1, ["1-y"])
    assert offsets.parts(spark, log) == ["1-x"]
    assert offsets.positions(offsets.read_log(spark, log)) == {"a": {0: offsets.Position(0, 5)}}
    assert [n for n in files.children(spark, log) if n.startswith("_")] == []


def test_a_checkpoint_below_the_newest_generation_is_refused(spark, root):
    job, streams = file_job(root), job_session(spark)
    feed(spark, job, _sub(("a", 1), ("a", 2)))
    run(speed.start_stats(streams, job))
    run(speed.start_stats(streams, file_job(root, generation=1)))
    feed(spark, job, _sub(("a", 3), ("a", 4)), first_offset=2)
    with pytest.raises(ValueError, match="generation 1 is stored"):
        speed.start_stats(streams, file_job(root, generation=0))
    run(speed.start_stats(streams, job))
    assert _table(spark, job, WINDOWED_SUBMISSIONS) == {5: 4}


def test_a_running_query_stops_once_there_is_a_newer_generation(spark, root):
    job, streams = file_job(root, trigger={"processingTime": "100 milliseconds"}), job_session(spark)
    feed(spark, job, _sub(("a", 1)))
    [old] = speed.start_stats(streams, job)
    old.processAllAvailable()
    elsewhere = file_job(root, store=job.serving, topics=job.topics)
    object.__setattr__(elsewhere, "root", f"{root}/other")
    run(speed.start_stats(job_session(spark), elsewhere))
    feed(spark, job, _sub(("a", 2)), first_offset=1)
    with pytest.raises(StreamingQueryException, match="generation 1 is stored"):
        old.processAllAvailable()
    assert _table(spark, job, WINDOWED_SUBMISSIONS) == {5: 1}
