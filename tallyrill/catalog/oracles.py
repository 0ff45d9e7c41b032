"""The registered queries in SQL, for DuckDB on the same tables."""

from __future__ import annotations

SUBMISSIONS = "SELECT * FROM events WHERE event_type = 'purchase'"
COMMENTS = "SELECT * FROM events WHERE event_type = 'view'"
BOTH = "SELECT * FROM events WHERE event_type IN ('purchase', 'view')"
HALF = "(SELECT max(event_id) // 2 FROM events)"


def _end(size: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{size}', {ts}) + INTERVAL '{size}'"


def _counts(rows: str, size: str, measures: str = "count(*) AS count") -> str:
    return f"""
        SELECT CAST(w AS DATE) AS date, w AS "window", {measures}
        FROM (SELECT *, {_end(size)} AS w FROM ({rows}))
        GROUP BY w"""


def _ranking(rows: str, key: str = "user_id", ts: str = "ts", kind: str = "event_type",
             kinds: tuple[str, str] = ("purchase", "view")) -> str:
    first, second = kinds
    return f"""
        SELECT subreddit, submissions, comments, submissions + comments AS total, last_update
        FROM (SELECT CAST({key} AS VARCHAR) AS subreddit,
                     count(*) FILTER ({kind} = '{first}') AS submissions,
                     count(*) FILTER ({kind} = '{second}') AS comments
              FROM ({rows}) GROUP BY 1),
             (SELECT max({ts}) AS last_update FROM ({rows}))
        ORDER BY total DESC, subreddit
        LIMIT 25"""


# Later counts replace earlier ones of the same hour.
_P, _V = _counts(SUBMISSIONS, "1 hour"), _counts(COMMENTS, "1 hour")
_S = _counts("SELECT * FROM events WHERE event_type = 'signup'", "1 hour")


def _last_of(*versions: str) -> str:
    rows = " UNION ALL ".join(f"SELECT *, {i} AS version FROM ({v})" for i, v in enumerate(versions))
    return f"""
        SELECT date, "window", count FROM
          (SELECT *, row_number() OVER (PARTITION BY date, "window" ORDER BY version DESC) AS r
           FROM ({rows}))
        WHERE r = 1"""


_LAST_100 = f"""
    SELECT "window", count AS y1 FROM ({_counts("SELECT * FROM events", "5 seconds")})
    ORDER BY "window" DESC LIMIT 100"""
_HELD = f"""SELECT "window", count AS y1 FROM ({_P}) ORDER BY "window" DESC LIMIT 100"""
_REFRESHED = f"""
    SELECT "window", max(y1) AS y1
    FROM (SELECT * FROM ({_HELD}) UNION ALL
          SELECT "window", count AS y1 FROM ({_counts("SELECT * FROM events", "1 hour")}))
    GROUP BY "window" ORDER BY "window" DESC LIMIT 100"""

# Of two streams the slower one counts; record times are whole seconds.
_WATERMARK = f"""(SELECT min(t) - INTERVAL 20 DAY FROM (
    SELECT date_trunc('second', max(ts)) AS t FROM ({BOTH}) WHERE event_id > {HALF} GROUP BY event_type))"""


def _exact(rows: str) -> str:
    return _counts(rows, "1 hour", "count(DISTINCT user_id) AS exact, true AS within_bound")


ORACLES = {
    "active_approx_1h": _exact("SELECT * FROM events"),
    "win_submissions_5s": _counts(SUBMISSIONS, "5 seconds"),
    "win_comments_5s": _counts(COMMENTS, "5 seconds"),
    "win_all_1h": _counts("SELECT * FROM events", "1 hour"),
    "win_sliding_1h_15m": """
        SELECT CAST(w AS DATE) AS date, w AS "window", count(*) AS count
        FROM (SELECT time_bucket(INTERVAL '15 minutes', ts) + to_minutes(CAST(15 * i AS INTEGER)) AS w
              FROM events, range(1, 5) AS r(i))
        GROUP BY w""",
    "win_lines_7d": """
        SELECT CAST(w AS DATE) AS date, w AS "window", count(*) AS count
        FROM (SELECT time_bucket(INTERVAL '7 days', l_shipdate, TIMESTAMP '1970-01-01')
                     + INTERVAL '7 days' AS w FROM lineitem)
        GROUP BY w""",
    "active_exact_1h": _counts(
        "SELECT * FROM events", "1 hour",
        "count(DISTINCT user_id) AS active_subreddits, count(user_id) AS submissions_and_comments",
    ),
    "active_approx_error_1d": f"""
        SELECT w AS "window", count(DISTINCT user_id) AS exact, true AS within_bound
        FROM (SELECT *, {_end("1 day")} AS w FROM events) GROUP BY w""",
    "activity_5s": _counts(
        BOTH, "5 seconds",
        "count(*) FILTER (event_type = 'purchase') AS submissions, "
        "count(*) FILTER (event_type = 'view') AS comments, "
        "count(user_id) AS submissions_and_comments",
    ),
    "tag_union": f"""
        SELECT CAST(user_id AS VARCHAR) AS subreddit, 'submissions' AS kind FROM ({SUBMISSIONS})
        UNION ALL
        SELECT CAST(user_id AS VARCHAR), 'comments' FROM ({COMMENTS})""",
    "pivot_counts": f"""
        SELECT CAST(user_id AS VARCHAR) AS subreddit,
               count(*) FILTER (event_type = 'purchase') AS submissions,
               count(*) FILTER (event_type = 'view') AS comments
        FROM ({BOTH}) GROUP BY 1""",
    "latest_time": f"SELECT max(ts) AS last_update FROM ({BOTH})",
    "trending": _ranking(BOTH),
    "trending_lines": _ranking("SELECT * FROM lineitem", "l_partkey", "l_shipdate", "l_linestatus", ("O", "F")),
    "trending_since": _ranking(f"{BOTH} AND event_id > {HALF}"),
    "trending_one_kind": _ranking(SUBMISSIONS),
    "trending_null": """
        SELECT 'submission' AS source, CAST(0 AS INTEGER) AS partition, max(doc_id) AS "offset",
               CAST(0 AS BIGINT) AS ranked FROM documents
        UNION ALL SELECT 'comment', 0, max(conv_id), 0 FROM conversations""",
    "empty_side": f"""
        SELECT CAST(user_id AS VARCHAR) AS subreddit, 'submissions' AS kind FROM ({SUBMISSIONS})""",
    "scan_since": f"""
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS subreddit,
               props AS selftext, event_id AS "offset",
               CAST(event_id % 3 AS INTEGER) AS partition
        FROM ({SUBMISSIONS}) WHERE event_id > {HALF}""",
    "discover": f"""
        SELECT CASE event_type WHEN 'purchase' THEN 'submission' ELSE 'comment' END AS source,
               count(*) AS updates
        FROM ({BOTH}) WHERE event_id > {HALF} GROUP BY 1""",
    "offset_append": """
        SELECT event_type AS source, CAST(event_id % 3 AS INTEGER) AS partition,
               max(event_id // 1000 * 1000) AS offset_batch, max(event_id) AS "offset",
               CAST(1 AS BIGINT) AS run_id
        FROM events GROUP BY 1, 2""",
    "offset_latest": f"""
        SELECT event_type AS source, CAST(event_id % 3 AS INTEGER) AS partition,
               max(event_id // 1000 * 1000) AS offset_batch, max(event_id) AS "offset"
        FROM events
        WHERE event_id <= {HALF} OR event_type IN ('purchase', 'view')
        GROUP BY 1, 2""",
    "bucket": 'SELECT event_id AS "offset", event_id // 1000 * 1000 AS offset_batch FROM events',
    "epoch": "SELECT event_id, date_trunc('second', ts) AS created_utc FROM events",
    "encode": """
        SELECT 'SubmissionProducer' AS topic, CAST(8 AS BIGINT) AS n_keys,
               CAST(doc_id AS VARCHAR) AS id, source AS subreddit,
               CAST(n_chars AS VARCHAR) AS subreddit_subscribers, CAST(NULL AS VARCHAR) AS title,
               lang AS author, CAST(n_chars > 1000 AS VARCHAR) AS over_18, text AS selftext
        FROM documents""",
    "decode": """
        SELECT 'SubmissionProducer' AS topic, doc_id AS "offset",
               doc_id // 1000 * 1000 AS offset_batch, CAST(doc_id AS VARCHAR) AS id,
               source AS subreddit, CAST(n_chars AS INTEGER) AS subreddit_subscribers,
               CAST(NULL AS VARCHAR) AS title, lang AS author, n_chars > 1000 AS over_18,
               text AS selftext
        FROM documents""",
    "decode_conversations": """
        SELECT concat(conv_id, '-', turn) AS id, CAST(NULL AS VARCHAR) AS subreddit,
               CAST(conv_id AS VARCHAR) AS link_id, role AS author, text AS body
        FROM conversations""",
    "decode_props": """
        SELECT event_id AS "offset", CAST(props->>'$.k' AS INTEGER) AS k FROM events""",
    "decode_rejects": """
        SELECT event_id AS "offset", 'reject' AS part
        FROM events WHERE event_type IN ('error', 'signup', 'click')
        UNION ALL
        SELECT event_id, 'record' FROM events WHERE event_type NOT IN ('error', 'signup')""",
    "upsert": _last_of(_P, _V),
    "compact": _last_of(_P, _V, _S),
    "lookback": f"""
        WITH hours AS ({_counts("SELECT * FROM events", "1 hour")})
        SELECT * FROM hours
        WHERE "window" > (SELECT max("window") FROM hours) - INTERVAL '20 hours'""",
    "merge_max": f"""
        SELECT "window", max(count) AS y1
        FROM (SELECT * FROM ({_P}) UNION ALL SELECT * FROM ({_V}))
        GROUP BY "window" """,
    "latest_n": _LAST_100,
    "mean_line": f"SELECT *, avg(y1) OVER () AS mean FROM ({_LAST_100})",
    "view_refresh": f"SELECT *, avg(y1) OVER () AS mean FROM ({_REFRESHED})",
    "st_decode": f"""
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS subreddit,
               event_type AS link_id, props AS body, date_trunc('second', ts) AS created_utc,
               event_id AS "offset", event_id // 1000 * 1000 AS offset_batch,
               'CommentProducer' AS topic
        FROM ({COMMENTS})""",
    "st_land": f"""
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS subreddit,
               event_type AS title, props AS selftext, value > 20 AS over_18,
               event_id AS "offset", CAST(event_id % 3 AS INTEGER) AS partition,
               date_trunc('second', ts) AS created_utc, true AS same_bucket
        FROM ({SUBMISSIONS})""",
    "st_upsert": _counts(SUBMISSIONS, "5 seconds"),
    "st_late": _V,
    "st_watermark": _counts(f"{COMMENTS} AND {_end('1 hour')} > {_WATERMARK}", "1 hour"),
    "st_active_bound": _exact(BOTH),
    "st_active": _counts(BOTH, "5 seconds", "count(user_id) AS submissions_and_comments"),
    "st_replay": _counts(SUBMISSIONS, "5 seconds"),
    "st_restart": _P,
    "st_generation": _P,
    "st_all": f"""
        SELECT *, 'submissions' AS measure FROM ({_counts(SUBMISSIONS, "5 seconds")})
        UNION ALL SELECT *, 'comments' FROM ({_counts(COMMENTS, "5 seconds")})
        UNION ALL SELECT *, 'both' FROM ({_counts(BOTH, "5 seconds", "count(user_id) AS count")})""",
    "speed_and_batch": _ranking(
        f"SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM ({BOTH}) WHERE event_id > {HALF}"
    ),
}
ORACLES["st_roots"] = ORACLES["st_land"]
ORACLES["overtaken_batch"] = ORACLES["speed_and_batch"]
