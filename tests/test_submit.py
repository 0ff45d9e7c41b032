import sys

import pytest
from helpers import feed, file_job, record

import submit
from tallyrill.session import STREAM_CONF


@pytest.fixture
def jobs(spark, monkeypatch):
    """Runs jobs in this process and puts the session's settings back."""
    before = {key: spark.conf.get(key, None) for key in STREAM_CONF}

    def run(*args):
        monkeypatch.setattr(sys, "argv", ["submit.py", *args])
        submit.main()

    yield run
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_jobs_end_to_end(spark, root, jobs, capsys):
    job = file_job(root)
    feed(spark, job, [record("a", 1), record("a", 2)], [record("b", 3)])
    where = ["--root", root]
    topics = ["--topics", "parquet", "--topic-root", f"{root}/topics"]
    jobs("speed", *where, *topics, "--once", "--bucket-size", "1000")
    jobs("batch", *where)
    jobs("batch", *where)
    jobs("upkeep", *where)
    jobs("view", *where, "--table", "windowed_submissions")
    shown = capsys.readouterr().out
    assert "run 1" in shown and "run None" in shown
    assert "|2024-01-01 00:00:05|2  |2.0 |" in shown
    jobs("view", *where, "--table", "trending_subreddits")
    assert "|a        |2          |0       |2    |" in capsys.readouterr().out


def test_a_view_reads_only_the_look_back_after_its_first_round(spark, root, monkeypatch):
    from tallyrill.plans import speed, view
    from tallyrill.session import job_session
    from tallyrill.sources import files

    job = file_job(root)
    feed(spark, job, [record("a", s) for s in (1, 1, 200)])
    speed.drain(speed.start_stats(job_session(spark), job))
    newer, shown = [], []
    read = type(job.serving).read_since
    monkeypatch.setattr(type(job.serving), "read_since", lambda self, s, t, n=None: (newer.append(n), read(self, s, t, n))[1])
    table = submit.SERVING["windowed_submissions"]
    view.follow(spark, job, table, lambda rows: shown.append([r["y1"] for r in rows.orderBy("window").collect()]), 0, rounds=2)
    assert shown == [[2, 1], [2, 1]]
    assert newer[0] is None and newer[1] is not None
    assert files.children(spark, f"{root}/views") == []
