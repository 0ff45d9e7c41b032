"""Landing that goes on in a new root, and what reads roots as one table."""

import pytest
from helpers import feed, file_job, record, rows_of, run

from tallyrill.models import COMMENT, SUBMISSION
from tallyrill.plans import batch, speed
from tallyrill.session import job_session
from tallyrill.sources import files, landed, roots
from tallyrill.sources.topics import Topics


def _job(root, **settings):
    """One file of a topic is one micro-batch, two micro-batches fill a root."""
    settings.setdefault("root_batches", 2)
    return file_job(root, topics=Topics("parquet", f"{root}/topics", {"maxFilesPerTrigger": "1"}), **settings)


def _feed(spark, job, first, n, partition=0):
    for i in range(first, first + n):
        feed(spark, job, [record(f"k{i}", i)], [record("c", i)], partition, i)


def _offsets(spark, job, model=SUBMISSION):
    rows = landed.read_landed(spark, model, f"{job.landed}/{model.source}")
    return rows_of(rows.select("partition", "offset"))


def _numbers(spark, job):
    return [r.number for r in roots.roots(spark, f"{job.landed}/submission")]


def _land(spark, streams, job):
    queries = speed.start_landing(streams, job)
    run(queries)
    return speed.renew_full(streams, job, queries)


def test_no_record_is_lost_or_read_twice_at_a_change(spark, root):
    job, streams = _job(root), job_session(spark)
    for wave in range(4):
        _feed(spark, job, 10 * wave, 2)
        _feed(spark, job, 10 * wave + 5, 1, partition=1)
        _land(spark, streams, job)
        expected = [(p, 10 * w + i) for w in range(wave + 1) for p, i in ((0, 0), (0, 1), (1, 5))]
        assert _offsets(spark, job) == _offsets(spark, job, COMMENT) == sorted(expected, key=repr)
    assert _numbers(spark, job) == [0, 1, 2, 3, 4]
    assert {n for n in files.children(spark, f"{root}/checkpoints") if "submission" in n} == {
        "land_submission", "land_submission.1", "land_submission.2", "land_submission.3"}


def test_batch_runs_over_roots_rank_every_record_once(spark, root):
    job, streams = _job(root), job_session(spark)
    for wave in range(3):
        _feed(spark, job, 3 * wave, 3)
        _land(spark, streams, job)
        assert batch.run_batch(streams, job) == wave + 1
        ranking = {r["subreddit"]: r["total"] for r in batch.current_ranking(spark, job).collect()}
        assert ranking == {"c": 3, **{f"k{i}": 1 for i in range(3 * wave, 3 * wave + 3)}}
    assert batch.run_batch(streams, job) is None
    total = batch.updates(spark, job, cumulative=True).count()
    assert total == 18 and _numbers(spark, job)[-1] >= 2


def test_closed_roots_that_are_processed_are_not_listed(spark, root, monkeypatch):
    job, streams = _job(root), job_session(spark)
    for wave in range(4):
        _feed(spark, job, 2 * wave, 2)
        _land(spark, streams, job)
        batch.run_batch(streams, job)
    read, listed = landed.read_root, []
    monkeypatch.setattr(landed, "read_root", lambda s, m, r: (listed.append(r.number), read(s, m, r))[1])
    _feed(spark, job, 8, 1)
    run(speed.start_landing(streams, job))
    assert batch.run_batch(streams, job) == 5
    assert set(listed) == {4}


def test_what_an_old_query_still_lands_is_not_read(spark, root):
    job, streams = _job(root), job_session(spark)
    _feed(spark, job, 0, 2)
    old = speed.start_landing(streams, job)
    run(old)
    # The query is believed to have gone; a second one on its checkpoint goes on landing.
    speed.hand_over(streams, job, old[0])
    _feed(spark, job, 2, 2)
    table = f"{job.landed}/submission"
    run([speed._land(streams, job, SUBMISSION, roots.roots(spark, table)[0])])
    assert _offsets(spark, job) == [(0, 0), (0, 1)]
    run(speed.start_landing(streams, job))
    assert _offsets(spark, job) == [(0, i) for i in range(4)]


def test_running_queries_move_on(spark, root):
    job = _job(root, trigger={"processingTime": "50 milliseconds"}, land_trigger={"processingTime": "50 milliseconds"})
    streams = job_session(spark)
    _feed(spark, job, 0, 3)
    queries = speed.start_landing(streams, job)
    for wave in range(1, 3):
        for query in queries:
            query.processAllAvailable()
        renewed = speed.renew_full(streams, job, queries)
        assert [q.name for q in renewed] == ["land_submission", "land_comment"]
        assert all(q.isActive for q in renewed) and not any(q.isActive for q in queries)
        queries = renewed
        _feed(spark, job, 3 * wave, 3)
    for query in queries:
        query.processAllAvailable()
        query.stop()
    assert _offsets(spark, job) == _offsets(spark, job, COMMENT) == [(0, i) for i in range(9)]


def test_tend_ends_with_the_failure_of_a_query(spark, root, monkeypatch):
    job, streams = _job(root, mode="FAILFAST"), job_session(spark)
    feed(spark, job, [record("a", 1), "{"], [record("b", 1)])
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        speed.tend(streams, job, speed.start_landing(streams, job), every=0.1)


def test_a_root_opens_once(spark, root):
    table = f"{root}/landed/submission"
    first = roots.open_next(spark, table, {0: 5})
    assert (first.number, first.start, first.suffix) == (1, {0: 5}, ".1")
    second = roots.open_next(spark, table, {1: 7}, '{"t":{"0":6,"1":8}}')
    assert [r.number for r in roots.roots(spark, table)] == [0, 1, 2]
    assert (second.start, second.source_offsets) == ({0: 5, 1: 7}, '{"t":{"0":6,"1":8}}')
    assert [r.end for r in roots.roots(spark, table)] == [{0: 5}, {0: 5, 1: 7}, None]
    files.create(spark, f"{table}.3/x", "")
    assert not files.move_new(spark, table + ".2", f"{table}.3")


@pytest.mark.parametrize("end, offsets, done", [
    ({0: 5}, {0: 5}, True), ({0: 5}, {0: 4}, False), ({0: 5, 1: 0}, {0: 9}, False), ({}, {}, True), (None, {0: 9}, False),
])
def test_roots_that_are_done(end, offsets, done):
    assert roots.Root("t", end=end).done(offsets) is done


def test_a_brokers_stream_begins_where_the_last_one_ended(spark):
    asked = {}

    class Reader:
        def __getattr__(self, name):
            def call(*args, **kwargs):
                asked[name if name != "option" else args[0]] = args[-1] if args else kwargs
                return self
            return call

    class Session:
        readStream = Reader()

    Topics().read_stream(Session, SUBMISSION, roots.after({0: 5}), '{"submissions":{"0":6}}')
    assert asked["startingOffsets"] == '{"submissions":{"0":6}}' and asked["subscribe"] == SUBMISSION.topic
    assert "where" in asked
