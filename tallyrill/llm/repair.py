"""Conversations brought into order: an optional system turn, then user and assistant by turns.

Edits and what they cost: Keep a row (0), Rerole it to user or assistant (1), Delete it (2; needed for blank rows and
for those whose role and text came before), Insert an empty row (5). A truncated row that stays adds 5. The cheapest
edits win, of those as cheap the ones whose initials sort first.

Rows are dealt by conversation and sorted by turn, backwards, and one pass carries the cost from each of four
states to the conversation's end across Arrow batches. What is best in each state at a row takes two bits, one
byte a row. A conversation's rows and bytes are held up to HELD_ROWS or HELD_BYTES; longer ones go to files in the
shared folder, which are read from the last to the first when the conversation's first row has come. Repeats are found by a window
over hashes of role and text, which uses the same shuffle. So a conversation with a third of all rows takes one task long, but no memory.

Nulls: a null role or text is one space, null turns come first, null conversations are one conversation. Rows with
one turn go by role, then by text. Repeated rows are duplicates. Empty texts are blank, very long ones are passed on whole. An
empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrill.llm.store import FileStore

HELD_ROWS = 50_000
HELD_BYTES = 16 << 20
_BATCH = 5_000

_SPACE = r"\x20\x09-\x0D"
_BLANK, _DUPLICATE, _TRUNCATED = 1, 2, 3
_INSERT, _DELETE, _REROLE, _CUT = 5, 2, 1, 5

#: States: nothing yet, after a system, a user, an assistant turn. The role that an inserted or changed row takes in each.
_ROLE = ("user", "user", "assistant", "user")
_AFTER = (2, 2, 3, 2)
#: The state after a kept row, by state and initial of its role.
_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_LETTERS = "DIKR"
_NEVER = 1 << 62

_STEP_DDL = ("step long, edit string, role string, text string, gaps long, blank long, duplicate long, "
             "truncated long, illegal long, cost long")


def damage(rows: DataFrame) -> DataFrame:
    """The rows with every fault that their conversation and turn call for; ``present`` is false for dropped ones."""

    def plain(c: str) -> Column:
        return F.coalesce(rows[c].cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    out = rows.select(rows["conv_id"], rows["turn"], plain("role").alias("role"), plain("text").alias("text"), fault.alias("fault"))
    text = (F.when(F.col("fault") <= 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") != 0).alias("present"),
                      copies.alias("copy")).drop("copy")


def _described(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """Conversation by conversation, the last row first: turn, role, text, first fault."""
    there = F.coalesce(rows[present], F.lit(False)) if present else F.lit(True)
    blank = F.lit(" ")
    out = rows.select(
        rows[conv].alias("conv"), rows[turn].cast("long").alias("turn"), F.coalesce(rows[role], blank).alias("role"),
        F.coalesce(rows[text], blank).alias("text"), there.alias("present"))
    out = out.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "text", "role")})
    # The window needs no other shuffle: rows of one conversation are together already.
    seen = Window.partitionBy("conv", "present", "h1", "h2").orderBy(F.col("turn").asc_nulls_first())
    out = out.repartition("conv").withColumn("again", F.row_number().over(seen) > 1)
    fault = (F.when(~F.col("text").rlike(f"[^{_SPACE}]"), _BLANK).when(F.col("again"), _DUPLICATE)
             .when(~F.col("text").rlike(rf"[.!?][{_SPACE}]*+\z"), _TRUNCATED).otherwise(0))
    out = out.withColumn("fault", fault).sortWithinPartitions(
        "conv", F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text").desc(), F.col("again").desc())
    return out.select("conv", "turn", "role", "text", "present", "fault")


class _Conversation:
    """One conversation, read from its last row to its first."""

    def __init__(self, conv, store: FileStore):
        self.conv, self.store = conv, store
        self.costs = (0, 2 * _INSERT, _INSERT, 0)  # from each state, where no row is left
        self.codes, self.roles, self.texts, self.bytes = bytearray(), [], [], 0
        self.files: list[str] = []
        self.high = self.low = self.next = None
        self.turns = self.illegal = 0
        self.faults = [0, 0, 0, 0]

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if turn is not None and turn != self.low:
            self.turns += 1
            self.low = turn
            self.high = turn if self.high is None else self.high
        if self.next is not None and initial + self.next not in ("su", "ua", "au"):
            self.illegal += 1
        self.next = initial
        self.faults[fault] += 1
        self._step(initial, fault)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)
        if len(self.codes) >= HELD_ROWS or self.bytes >= HELD_BYTES:
            self._spill()

    def _step(self, initial: str, fault: int) -> None:
        """The costs from before this row, and the best edit in each state as two bits of a byte."""
        later, extra = self.costs, _CUT if fault == _TRUNCATED else 0
        ways = []
        for state in range(4):
            keep = rerole = _NEVER
            if fault not in (_BLANK, _DUPLICATE):
                kept = _KEPT[state].get(initial)
                keep = _NEVER if kept is None else extra + later[kept]
                rerole = _REROLE + extra + later[_AFTER[state]]
            ways.append((_DELETE + later[state], keep, rerole))
        least = [min(w) for w in ways]
        user, assistant = min(least[2], _INSERT + least[3]), min(least[3], _INSERT + least[2])
        self.costs = (min(least[0], _INSERT + user), min(least[1], _INSERT + user), user, assistant)
        code = 0
        for state, (delete, keep, _) in enumerate(ways):
            cost = self.costs[state]
            if cost == delete:
                best = 0
            elif cost == _INSERT + self.costs[_AFTER[state]]:
                best = 1
            else:
                best = 2 if cost == keep else 3
            code |= best << 2 * state
        self.codes.append(code)

    def _spill(self) -> None:
        name, out = self.store.create(".rows")
        batch = pa.record_batch([pa.array(list(self.codes), pa.uint8()), pa.array(self.roles, pa.string()),
                                 pa.array(self.texts, pa.string())], names=["code", "role", "text"])
        with out, pa.ipc.new_file(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as file:
            file.write_batch(batch)
        self.files.append(name)
        self.codes, self.roles, self.texts, self.bytes = bytearray(), [], [], 0

    def _rows(self) -> Iterator[tuple[int, str, str]]:
        """The rows by turn: best edits, role, text."""
        yield from zip(reversed(self.codes), reversed(self.roles), reversed(self.texts))
        for name in reversed(self.files):
            with self.store.read(name) as file:
                held = pa.ipc.open_file(file).read_all()
            for i in range(held.num_rows - 1, -1, -1):
                yield held["code"][i].as_py(), held["role"][i].as_py(), held["text"][i].as_py()

    def steps(self) -> Iterator[tuple]:
        """The edits in order: initial, role and text of the row that stays, if one does."""
        state = 0
        for code, role, text in self._rows():
            while (letter := _LETTERS[code >> 2 * state & 3]) == "I":
                yield "I", _ROLE[state], ""
                state = _AFTER[state]
            if letter == "K":
                yield "K", role, text
                state = _KEPT[state][role[:1]]
            elif letter == "R":
                yield "R", _ROLE[state], text
                state = _AFTER[state]
            else:
                yield "D", None, None
        while state in (1, 2):
            yield "I", _ROLE[state], ""
            state = _AFTER[state]

    def summary(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost."""
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, *self.faults[1:], self.illegal, self.costs[0]


def _repair_task(store: FileStore, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = None, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal size
            out = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            size = 0
            return out

        def finish(done: _Conversation) -> Iterator[pa.RecordBatch]:
            nonlocal size
            rows.append((done.conv, 0, None, None, None, *done.summary()))
            for step, (edit, role, text) in enumerate(done.steps(), 1):
                rows.append((done.conv, step, edit, role, text, *[None] * 6))
                size += len(text or "")
                if len(rows) >= _BATCH or size >= HELD_BYTES:
                    yield flush()

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for conv, turn, role, text, present, fault in zip(*columns):
                if held is None or conv != held.conv:
                    if held is not None:
                        yield from finish(held)
                    held = _Conversation(conv, store)
                if present:
                    held.add(turn, role, text, fault)
        if held is not None:
            yield from finish(held)
        if rows:
            yield flush()

    return run


def repair(
    rows: DataFrame, store: FileStore, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", present: str | None = None,
) -> DataFrame:
    """The cheapest edits of every conversation, one row each and in order within a partition.

    Columns: conv_id, step, edit (D, I, K or R), and role and text of the row that stays or comes. Step 0 has the
    conversation's counts and cost instead. Rows for which ``present`` is not true only name their conversation.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    ordered = _described(rows, conv_id, turn, role, text, present)
    kinds = StructType([StructField("conv_id", ordered.schema["conv"].dataType), *_parse_datatype_string(_STEP_DDL).fields])
    return ordered.mapInArrow(_repair_task(store, to_arrow_schema(kinds)), kinds)


def audits(steps: DataFrame) -> DataFrame:
    """One row per conversation from the rows of ``repair``, in their order: counts, audit, and a digest of what stays."""
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = f"conv_id {steps.schema['conv_id'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, letters, digest, empty = None, bytearray(), None, True

        def row(kind: pa.DataType) -> pa.RecordBatch:
            values = [*head, letters.decode(), digest.hexdigest()]
            kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, kinds)],
                                   names=["conv_id", *names, "audit", "repaired_sha256"])

        done: list[pa.RecordBatch] = []
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv, step, edit, role, text, *counts in zip(*[c.to_pylist() for c in batch.columns]):
                if step == 0:
                    if head is not None:
                        done.append(row(kind))
                    head, letters, digest, empty = (conv, *counts), bytearray(), hashlib.sha256(), True
                    continue
                letters += edit.encode()
                if role is not None:
                    digest.update((("" if empty else "\n") + role + ":" + text).encode())
                    empty = False
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                done = []
        if head is not None:
            yield row(kind)

    return steps.mapInArrow(run, schema + ", audit string, repaired_sha256 string")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a hash of their rows, with the edits that mend them."""
    rows = damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return audits(repair(rows, FileStore.fresh(spark, "conversations"), present="present"))


ORACLE = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
hashed AS (SELECT *, xor(list_reduce(
    list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(name, ''), lambda c: CAST(ord(c) AS UBIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: CAST(0 AS UBIGINT))),
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS UBIGINT)) ELSE c // 2 END)), CAST(4294967295 AS UBIGINT)) % 20 AS fault
  FROM src),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE fault <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM damaged),
marked AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM numbered),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) AS n
  FROM marked GROUP BY conv_id),
pairs AS (
  SELECT conv_id, count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, initial, lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS following FROM marked) GROUP BY conv_id),
steps AS (
  -- From each state (nothing yet, behind a system, a user, an assistant turn): cost, edits, and what stays, from row i on.
  SELECT conv_id, n + 1 AS i, n, {'c': 0, 'a': '', 't': ''} AS s0, {'c': 10, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS s1,
    {'c': 5, 'a': 'I', 't': chr(10) || 'assistant:'} AS s2, {'c': 0, 'a': '', 't': ''} AS s3 FROM counted
  UNION ALL
  SELECT conv_id, i, n,
    list_sort([w0, {'c': 5 + u.c, 'a': 'I' || u.a, 't': chr(10) || 'user:' || u.t}])[1],
    list_sort([w1, {'c': 5 + u.c, 'a': 'I' || u.a, 't': chr(10) || 'user:' || u.t}])[1], u, v
  FROM (SELECT *, list_sort([w2, {'c': 5 + w3.c, 'a': 'I' || w3.a, 't': chr(10) || 'assistant:' || w3.t}])[1] AS u,
      list_sort([w3, {'c': 5 + w2.c, 'a': 'I' || w2.a, 't': chr(10) || 'user:' || w2.t}])[1] AS v
    FROM (SELECT s.conv_id, m.i, s.n,
        list_sort([{'c': 2 + s0.c, 'a': 'D' || s0.a, 't': s0.t},
          {'c': CASE WHEN gone OR initial NOT IN ('s', 'u') THEN 1000000000 ELSE cut + CASE initial WHEN 's' THEN s1.c ELSE s2.c END END,
            'a': 'K' || CASE initial WHEN 's' THEN s1.a ELSE s2.a END, 't': chr(10) || role || ':' || text || CASE initial WHEN 's' THEN s1.t ELSE s2.t END},
          {'c': CASE WHEN gone THEN 1000000000 ELSE 1 + cut + s2.c END, 'a': 'R' || s2.a, 't': chr(10) || 'user:' || text || s2.t}])[1] AS w0,
        list_sort([{'c': 2 + s1.c, 'a': 'D' || s1.a, 't': s1.t},
          {'c': CASE WHEN gone OR initial <> 'u' THEN 1000000000 ELSE cut + s2.c END, 'a': 'K' || s2.a, 't': chr(10) || role || ':' || text || s2.t},
          {'c': CASE WHEN gone THEN 1000000000 ELSE 1 + cut + s2.c END, 'a': 'R' || s2.a, 't': chr(10) || 'user:' || text || s2.t}])[1] AS w1,
        list_sort([{'c': 2 + s2.c, 'a': 'D' || s2.a, 't': s2.t},
          {'c': CASE WHEN gone OR initial <> 'a' THEN 1000000000 ELSE cut + s3.c END, 'a': 'K' || s3.a, 't': chr(10) || role || ':' || text || s3.t},
          {'c': CASE WHEN gone THEN 1000000000 ELSE 1 + cut + s3.c END, 'a': 'R' || s3.a, 't': chr(10) || 'assistant:' || text || s3.t}])[1] AS w2,
        list_sort([{'c': 2 + s3.c, 'a': 'D' || s3.a, 't': s3.t},
          {'c': CASE WHEN gone OR initial <> 'u' THEN 1000000000 ELSE cut + s2.c END, 'a': 'K' || s2.a, 't': chr(10) || role || ':' || text || s2.t},
          {'c': CASE WHEN gone THEN 1000000000 ELSE 1 + cut + s2.c END, 'a': 'R' || s2.a, 't': chr(10) || 'user:' || text || s2.t}])[1] AS w3
      FROM steps s JOIN (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS cut FROM marked) m
        ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.i = s.i - 1))),
done AS (SELECT conv_id, s0.c AS cost, s0.a AS audit, substr(s0.t, 2) AS kept FROM steps WHERE i = 1)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(kept, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN pairs p ON p.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM a.conv_id
"""
