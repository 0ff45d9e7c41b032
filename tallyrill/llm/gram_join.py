"""Exact similarity join on word shingles, by prefixes of rare tokens and combinations of frequent ones.

A token is a shingle. Two sets link when 100 * |intersection| >= 75 * |union|; each then holds at
least 75 % of the other's tokens, so under any one order of all tokens their prefixes of 25 % share
a token, and their prefixes that are one longer share two. Tokens are ordered by how many sets
hold them, rare ones first:

1. Rows with the same set become one class. One shuffle of packed tokens finds which tokens only one
   class holds; a class with more than 25 % of those links with nothing and is done.
2. For the rest, tokens are counted again. Prefixes are indexed by single tokens if at most FREQUENT
   classes hold them, else by combinations of two tokens of the prefix. Frequent tokens that the same classes have in their
   prefixes (those of a template) are one group, so a combination is one of two groups, or of a group with itself.
3. Every class is first verified against the most central class of some of its tokens; what links
   is contracted. Exact candidates are then sought only between different components, so
   large groups of near copies never meet pair by pair, and every candidate is verified on whole sets.

Sets are 64-bit hashes of shingles: two different ones are taken for the same with a chance of about 2**-64 per pair. Classes
are known by half of a 128-bit digest of the set, and by the other half where two sets share the first. Groups of tokens are told apart
by 128 bits of hashes of their classes. All other steps are exact. Frequent tokens are dealt to SALTS parts in joins.

Nulls: a null text has no words; a row with a null id gets the smallest id of its class, or null.
Texts without words link with nothing. Repeated rows share a class. Very long texts are shingled whole. An empty
table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrill.llm.links import components
from tallyrill.llm.store import tidy, written
from tallyrill.llm.words import shingle_sets

SHINGLE = 5
PERCENT = 75
#: A token that more classes hold is frequent, and indexed in combinations.
FREQUENT = 128
#: Tokens by which a class meets central ones before exact candidates are sought; changes speed only.
STAR = 8
#: Bits of the filter of classes that are asked for, at most; beyond that it lets more rows through.
FILTER_BITS = 1 << 27
#: Tokens a task packs before it sends them, and tokens of one bucket, both about.
FLUSH = 1 << 20
BUCKET = 1 << 20
#: Parts of a frequent token in a join.
SALTS = 32
#: Classes whose counts are added up together, about.
RANGE = 1 << 14

_PACKED = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary())])
_PACKED_DDL = "bucket long, keys binary, counts binary, tokens binary"


def class_keys(tokens: np.ndarray) -> tuple[int, int]:
    """Two halves of a digest of a set; never 0, which marks "several classes" below."""
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    one, two = (int.from_bytes(digest[i : i + 8], "little", signed=True) or 1 for i in (0, 8))
    return one, two


def class_key(tokens: np.ndarray, shared: frozenset[int] = frozenset()) -> int:
    """The key of a set's class: half of its digest, the other half if several sets share the first."""
    one, two = class_keys(tokens)
    return two if one in shared else one


def _least(n: Column) -> Column:
    """What two sets must share at least if one of them has n tokens."""
    return F.ceil(n * F.lit(PERCENT) / F.lit(100))


def _describe(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = [], []
            for _, tokens in shingle_sets(batch.column(1), k):
                sizes.append(len(tokens))
                keys.append(class_keys(tokens) if len(tokens) else (None, None))
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()),
                 *[pa.array(x, pa.int64()) for x in (list(zip(*keys)) or [[], []])]],
                names=["doc_id", "text_key", "n_shingles", "key", "check"])

    return run


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return begin, np.diff(np.append(begin, len(keys)))


class _Sender:
    """Packs tokens with their class by bucket. Tokens that ``enough`` classes of one flush hold are
    reported to those classes at once and travel once, with class 0, however many rows hold them."""

    def __init__(self, bits: int, enough: int, whole: bool):
        self.bits, self.enough, self.whole = bits, enough, whole
        self.keys: list[int] = []
        self.sets: list[np.ndarray] = []
        self.size = 0

    def add(self, key: int, tokens: np.ndarray) -> bool:
        self.keys.append(key)
        self.sets.append(tokens)
        self.size += len(tokens)
        return self.size >= FLUSH

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        names = np.array([0, *self.keys], np.int64)
        tokens = np.concatenate(self.sets)
        owner = np.repeat(np.arange(1, len(names)), [len(s) for s in self.sets])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        begin, count = _runs(tokens)
        many = count >= self.enough
        known = np.repeat(many, count)
        rows = []
        if many.any():
            mine = np.argsort(owner[known], kind="stable")
            at, n = _runs(owner[known][mine])
            spread = -1 - (self.keys[0] & ((1 << self.bits) - 1))
            rows.append((spread, names[owner[known][mine][at]], n, tokens[known][mine] if self.whole else tokens[:0]))
        tokens = np.concatenate([tokens[begin[many]], tokens[~known]])
        owner = np.concatenate([np.zeros(int(many.sum()), owner.dtype), owner[~known]])
        bucket = (tokens >> np.uint64(64 - self.bits)).astype(np.int64)
        order = np.argsort(bucket * len(names) + owner, kind="stable")
        tokens, owner, bucket = tokens[order], owner[order], bucket[order]
        if not self.whole:
            tokens = (tokens >> np.uint64(32 - self.bits)).astype(np.uint32)
        for a, n in zip(*_runs(bucket)):
            at, size = _runs(owner[a : a + n])
            rows.append((int(bucket[a]), names[owner[a : a + n][at]], size, tokens[a : a + n]))
        self.keys, self.sets, self.size = [], [], 0
        yield pa.record_batch([
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1].tobytes() for r in rows], pa.binary()),
            pa.array([r[2].astype(np.int32).tobytes() for r in rows], pa.binary()),
            pa.array([r[3].tobytes() for r in rows], pa.binary()),
        ], schema=_PACKED)


def _send_texts(k: int, bits: int, shared: frozenset[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, seen = _Sender(bits, 2, False), set()
        for batch in batches:
            for _, tokens in shingle_sets(batch.column(0), k):
                key = class_key(tokens, shared)
                if len(tokens) and key not in seen:
                    seen.add(key)
                    if sender.add(key, tokens):
                        yield from sender.flush()
        yield from sender.flush()

    return run


def _send_sets(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(bits, FREQUENT + 1, True)
        for batch in batches:
            for key, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if sender.add(key, np.frombuffer(tokens, np.uint64)):
                    yield from sender.flush()
        yield from sender.flush()

    return run


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _repeated(table: pa.Table, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, token, how many classes hold it) of a bucket's tokens that several classes hold, at most FREQUENT + 1."""
    owner = np.repeat(_column(table, "keys", np.int64), _column(table, "counts", np.int32))
    tokens = _column(table, "tokens", kind)
    order = np.lexsort((owner, tokens))
    owner, tokens = owner[order], tokens[order]
    again = np.concatenate([[False], (tokens[1:] == tokens[:-1]) & (owner[1:] == owner[:-1])])
    owner, tokens = owner[~again], tokens[~again]
    begin, count = _runs(tokens)
    marked = owner == 0
    several = np.add.reduceat(marked, begin) > 0
    held = np.repeat(np.where(several, FREQUENT + 1, np.minimum(count, FREQUENT + 1)), count).astype(np.int32)
    use = (held > 1) & ~marked
    return owner[use], tokens[use], held[use]


def _shared_counts(ranges: int):
    """How many tokens of a bucket other classes hold too, per class, packed by ranges of classes."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            owner, count = _column(table, "keys", np.int64), _column(table, "counts", np.int32)
        else:
            owner, count = np.unique(_repeated(table, np.uint32)[0], return_counts=True)
        part = owner & (ranges - 1)
        order = np.argsort(part, kind="stable")
        owner, count = owner[order], count[order].astype(np.int32)
        begin, size = _runs(part[order])
        return pa.table([
            part[order][begin], *[pa.array([x[a : a + n].tobytes() for a, n in zip(begin, size)], pa.binary()) for x in (owner, count)],
            pa.nulls(len(begin), pa.binary())], schema=_PACKED)

    return run


def _sum_counts(key: tuple, table: pa.Table) -> pa.Table:
    """One row per class of a range."""
    owner, place = np.unique(_column(table, "keys", np.int64), return_inverse=True)
    total = np.bincount(place, _column(table, "counts", np.int32), len(owner)).astype(np.int64)
    return pa.table([owner, total], names=["key", "n_found"])


def _held(ranges: int):
    """Which tokens of a bucket other classes hold too, and how many do, packed by ranges of classes."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            owner = np.repeat(_column(table, "keys", np.int64), _column(table, "counts", np.int32))
            tokens = _column(table, "tokens", np.uint64)
            held = np.full(len(tokens), FREQUENT + 1, np.int32)
        else:
            owner, tokens, held = _repeated(table, np.uint64)
        part = owner & (ranges - 1)
        order = np.argsort(part, kind="stable")
        begin, size = _runs(part[order])
        return pa.table([
            part[order][begin],
            *[pa.array([x[order][a : a + n].tobytes() for a, n in zip(begin, size)], pa.binary()) for x in (owner, held, tokens)],
        ], schema=_PACKED)

    return run


def _bits(total: int, partitions: int) -> int:
    """Buckets as a power of two: of bounded size, and enough for all tasks."""
    return min(30, max(1, (total // BUCKET).bit_length(), (partitions - 1).bit_length()))


def _bitmap(keys: DataFrame):
    """A filter of bounded size that lets all of these keys pass, broadcast."""
    bits = min(FILTER_BITS, max(1 << 16, 1 << (16 * keys.count()).bit_length()))
    place = F.col("key").bitwiseAND(F.lit(bits - 1))
    words = keys.select((place / 32).cast("int").alias("word"), F.expr(f"shiftleft(1L, int(key & 31))").alias("bit"))
    words = words.groupBy("word").agg(F.expr("bit_or(bit)").alias("mask")).toArrow()
    bitmap = np.zeros(bits // 32, np.uint32)
    bitmap[words["word"].to_numpy()] = words["mask"].to_numpy().astype(np.uint32)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def _may_hold(bitmap):
    """A column function: whether a key may be one of those in the filter."""

    @F.pandas_udf("boolean")
    def test(keys: pd.Series) -> pd.Series:
        words = bitmap.value
        place = keys.to_numpy(np.int64) & (len(words) * 32 - 1)
        return pd.Series((words[place >> 5] >> (place & 31).astype(np.uint32)) & 1 > 0)

    return test


def _texts_of(k: int, bitmap, shared: frozenset[int]):
    """(key, text) of rows whose class passes the filter, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = bitmap.value, set()
        for batch in batches:
            keys, places = [], []
            for i, tokens in shingle_sets(batch.column(0), k):
                key = class_key(tokens, shared)
                place = key & (len(words) * 32 - 1)
                if len(tokens) and key not in seen and int(words[place >> 5]) >> (place & 31) & 1:
                    seen.add(key)
                    keys.append(key)
                    places.append(i)
            if keys:
                yield pa.record_batch(
                    [pa.array(keys, pa.int64()), batch.column(0).take(pa.array(places))], names=["key", "text"])

    return run


def _sets_of(k: int):
    """(key, n, tokens) of (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [tokens for _, tokens in shingle_sets(batch.column(1), k)]
            yield pa.record_batch([
                batch.column(0), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([x.tobytes() for x in sets], pa.binary())], names=["key", "n", "tokens"])

    return run


def _prefixes(key: tuple, found: pa.Table, sizes: pa.Table) -> pa.Table:
    """The prefix of each class of a range, one longer, without the tokens that no other class holds.

    own tokens come before the prefix listed, rest after it; often of those listed, the last, are
    frequent. star has some of all its repeated tokens, the same for sets that are much alike.
    """
    owner, held, tokens = (_column(found, *c) for c in (("keys", np.int64), ("counts", np.int32), ("tokens", np.uint64)))
    order = np.lexsort((tokens, owner))
    owner, held, tokens = owner[order], held[order], tokens[order]
    again = np.concatenate([[False], (tokens[1:] == tokens[:-1]) & (owner[1:] == owner[:-1])])
    owner, held, tokens = owner[~again], held[~again], tokens[~again]
    n_of = dict(zip(sizes["key"].to_pylist(), sizes["n"].to_pylist()))
    out = []
    for a, size in zip(*_runs(owner)):
        name, mine, many = int(owner[a]), tokens[a : a + size], held[a : a + size]
        n = n_of[name]
        own = n - len(mine)
        longer = n - (n * PERCENT + 99) // 100 + 2
        if own + 1 >= longer:  # even the last token of the prefix proper is the class's own
            continue
        use = np.lexsort((mine, many))[: longer - own]
        out.append((name, n, own, max(0, n - longer), int((many[use] > FREQUENT).sum()),
                    mine[:STAR].view(np.int64), many[:STAR] > FREQUENT, mine[use].view(np.int64)))
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())]
    columns = list(zip(*out)) or [[]] * 8
    return pa.table(
        [pa.array(c, t) for c, t in zip(columns, kinds)],
        names=["key", "n", "own", "rest", "often", "star", "hot", "prefix"])


_PREFIX_DDL = ("key long, n long, own long, rest long, often long, star array<long>, hot array<boolean>, "
               "prefix array<long>")


def _salt(hot: str) -> Column:
    """A class's part of a token: one for rare tokens, SALTS for frequent ones."""
    return F.when(F.col(hot), F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).otherwise(0).alias("salt")


def _salted(tokens: DataFrame, hot: str) -> DataFrame:
    """One row per token, once for every part of it."""
    last = F.when(F.col(hot), SALTS - 1).otherwise(0)
    return tokens.withColumn("salt", F.explode(F.sequence(F.lit(0), last))).drop(hot)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose whole sets are similar enough."""
    for batch in batches:
        u, v, x, y = (batch.column(name) for name in ("u", "v", "x", "y"))
        keep = []
        for i in range(len(batch)):
            a, b = (np.frombuffer(s[i].as_py(), np.uint64) for s in (x, y))
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(a) + len(b) - both))
        yield pa.record_batch([u, v], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    x = sets.select(F.col("key").alias("u"), F.col("tokens").alias("x"))
    y = sets.select(F.col("key").alias("v"), F.col("tokens").alias("y"))
    return pairs.join(x, "u").join(y, "v").select("u", "v", "x", "y").mapInArrow(tidy(_links), "u long, v long")


def _need(both: Column) -> Column:
    """What two sets with so many tokens in all must share."""
    return F.ceil(both * F.lit(PERCENT) / F.lit(100 + PERCENT))


def _may_link(a: str, b: str, before: int = 0) -> Column:
    """Sizes and places allow a link: with so many shared tokens before this one, what follows must suffice."""
    na, nb, pa_, pb = (F.col(f"{s}.{c}") for c in ("n", "place") for s in (a, b))
    enough = F.least(na - pa_, nb - pb) >= _need(na + nb) - before
    # What only one class holds is shared with none.
    shared = F.least(na - F.col(f"{a}.own"), nb - F.col(f"{b}.own")) >= _need(na + nb)
    return enough & shared & (F.least(na, nb) * 100 >= F.greatest(na, nb) * PERCENT)


def _stars(prefixes: DataFrame) -> DataFrame:
    """Pairs of each star token's most central class, the one with fewest tokens of its own, with its others."""
    star = F.explode(F.arrays_zip("star", "hot")).alias("s")
    entries = prefixes.select(star, "key", "n", "own").select(
        F.col("s.star").alias("token"), F.col("s.hot").alias("hot"), "key", "n", "own")
    centre = entries.groupBy("token").agg(
        F.min(F.struct("own", "key", "n")).alias("a"), F.count("*").alias("size"), F.max("hot").alias("hot"))
    centre = _salted(centre.where("size > 1").select("token", "a", "hot"), "hot")
    entries = entries.withColumn("salt", _salt("hot")).drop("hot")
    pairs = entries.alias("b").join(centre, ["token", "salt"]).where(F.col("a.key") != F.col("b.key"))
    both = F.col("a.n") + F.col("b.n")
    pairs = pairs.where(F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * PERCENT)
    pairs = pairs.where(F.least(F.col("a.n") - F.col("a.own"), F.col("b.n") - F.col("b.own")) >= _need(both))
    return pairs.select(*_pair()).distinct()


def _entries(prefixes: DataFrame, labels: DataFrame) -> DataFrame:
    """The index entries under which more than one component meets."""
    whole = prefixes.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    frequent = F.col("i") >= F.size("prefix") - F.col("often")
    entries = whole.select(F.posexplode("prefix").alias("i", "token"), "key", "label", "n", "own", "rest", "often", "prefix").select(
        "token", "key", "label", "n", "own", "rest", "often", (F.col("own") + F.col("i")).alias("place"), frequent.alias("frequent"))
    mixed = entries.groupBy("token").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max("frequent").alias("hot"))
    mixed = _salted(mixed.where("low <> high").select("token", "hot"), "hot")
    return entries.withColumn("salt", _salt("frequent")).join(mixed, ["token", "salt"], "left_semi").drop("salt")


def _mixed(entries: DataFrame, *on: str) -> DataFrame:
    """The entries under which more than one component meets, with the component that most of them belong to."""
    sizes = entries.groupBy(*on, "label").agg(F.count("*").alias("size"))
    found = sizes.groupBy(*on).agg(
        F.max_by("label", F.struct("size", "label")).alias("main"), F.count("*").alias("labels"))
    return entries.join(found.where("labels > 1").drop("labels"), [*on])


def _across(entries: DataFrame, on: list[str], and_: Column) -> DataFrame:
    """Entries of different components that meet: a outside the main one, b any. Nothing inside a component meets."""
    a, b = entries.where("label <> main").alias("a"), entries.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
    once = (F.col("b.label") == F.col("b.main")) | (F.col("a.key") < F.col("b.key"))
    return a.join(b, [*same, F.col("a.label") != F.col("b.label"), once, and_])


def _pair() -> list[Column]:
    return [F.least("a.key", "b.key").alias("u"), F.greatest("a.key", "b.key").alias("v")]


def _rare(entries: DataFrame) -> DataFrame:
    """Pairs that share rare tokens, and with all the frequent ones they can share, enough of them."""
    pairs = _across(_mixed(entries, "token"), ["token"], F.lit(True))
    pairs = pairs.groupBy(*_pair()).agg(
        F.count("*").alias("shared"), F.max(_may_link("a", "b")).alias("may"), F.first(_bound()).alias("more"))
    return pairs.where("may and shared + more >= 0").select("u", "v")


def _frequent(entries: DataFrame) -> DataFrame:
    """Pairs whose prefixes share two frequent tokens at least, and no rare one."""
    both = _combinations(_grouped(entries))
    room = _may_link("a", "b", 1) & (_bound() >= 0)
    return _across(_mixed(both, "one", "two"), ["one", "two"], room).select(*_pair()).distinct()


def _grouped(entries: DataFrame) -> DataFrame:
    """For each class its groups of tokens that the same classes have, with the places of a group's first two.

    Of such tokens two prefixes share all or none.
    """
    holders = entries.groupBy("token").agg(
        F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("h1"), F.sum(F.xxhash64(F.lit(3), "key").cast("decimal(38,0)")).alias("h2"),
        F.max("frequent").alias("hot"))
    holders = holders.select("token", F.struct("h1", "h2").alias("group"), "hot")
    named = entries.withColumn("salt", _salt("frequent")).join(_salted(holders, "hot"), ["token", "salt"])
    return named.groupBy("key", "n", "own", "label", "often", "rest", "group").agg(
        F.sort_array(F.collect_list("place")).alias("places"))


def _bound() -> Column:
    """What a and b can share besides rare tokens of their prefixes, less what they must share.

    What is shared up to where the first of two prefixes ends lies in both prefixes; after that, no
    more than the rest of that one's set is.
    """
    return (F.least("a.often", "b.often") + F.greatest("a.rest", "b.rest")
            - _need(F.col("a.n") + F.col("b.n")))


def _combinations(groups: DataFrame) -> DataFrame:
    """Two tokens of a prefix, by their groups, as one index entry at the place of the second."""
    of = ["key", "n", "own", "label", "often", "rest"]
    listed = F.sort_array(F.collect_list(F.struct(F.get("places", 0).alias("place"), "group", F.get("places", 1).alias("second"))))
    lists = groups.groupBy(*of).agg(listed.alias("list"))
    first = lists.select(*of, "list", F.posexplode("list").alias("i", "first"))
    own = F.when(F.col("first.second").isNotNull(), F.array(F.struct(F.col("first.second").alias("place"), F.col("first.group").alias("group"))))
    later = F.transform(F.expr("slice(list, i + 2, size(list))"), lambda x: F.struct(x["place"].alias("place"), x["group"].alias("group")))
    second = F.explode(F.concat(F.coalesce(own, F.filter(later, lambda _: F.lit(False))), later)).alias("second")
    both = first.select(*of, "first", second)
    return both.select(*of, "second.place", F.col("first.group").alias("one"), F.col("second.group").alias("two"))


def near_links(
    docs: DataFrame, described: DataFrame, classes: DataFrame, k: int, shared: frozenset[int] = frozenset()
) -> DataFrame:
    """Links (u, v) between class keys whose components are those of all links."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    total = described.agg(F.sum("n_shingles")).first()[0] or 0
    sent = docs.select("text").mapInArrow(tidy(_send_texts(k, _bits(total, partitions), shared)), _PACKED_DDL)
    ranges = 1 << max(1, (partitions - 1).bit_length(), (classes.count() // RANGE).bit_length())
    found = sent.groupBy("bucket").applyInArrow(_shared_counts(ranges), _PACKED_DDL)
    repeated = found.groupBy("bucket").applyInArrow(_sum_counts, "key long, n_found long")
    asked = classes.join(repeated, "key").where(F.col("n_found") >= _least(F.col("n"))).select("key")
    asked = written(asked, "asked")

    likely = docs.select("text").mapInArrow(tidy(_texts_of(k, _bitmap(asked), shared)), "key long, text string")
    wanted = likely.join(asked, "key").groupBy("key").agg(F.first("text").alias("text"))
    sets = written(wanted.mapInArrow(tidy(_sets_of(k)), "key long, n long, tokens binary"), "sets")

    total = sets.agg(F.sum("n")).first()[0] or 0
    sent = sets.select("key", "tokens").mapInArrow(tidy(_send_sets(_bits(total, partitions))), _PACKED_DDL)
    held = sent.groupBy("bucket").applyInArrow(_held(ranges), _PACKED_DDL)
    sizes = sets.select(F.col("key").bitwiseAND(F.lit(ranges - 1)).alias("bucket"), "key", "n")
    prefixes = written(
        held.groupBy("bucket").cogroup(sizes.groupBy("bucket")).applyInArrow(_prefixes, _PREFIX_DDL), "prefixes")

    tried = written(_stars(prefixes), "pairs")
    links = written(_verified(tried, sets), "links")
    now = written(_entries(prefixes, components(links)), "entries")
    pairs = _rare(now.where("not frequent")).unionByName(_frequent(now.where("frequent")))
    more = written(pairs.distinct().join(tried, ["u", "v"], "left_anti"), "pairs")
    return links.unionByName(written(_verified(more, sets), "links"))


def similar_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id reachable over links, for every row."""
    return _groups(docs, doc_id, text, k).select("doc_id", "n_shingles", "component_id")


def _groups(docs: DataFrame, doc_id: str, text: str, k: int = SHINGLE) -> DataFrame:
    """The same, with a hash of the text and the label of the component, which it has without an id too."""
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    described = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        tidy(_describe(k)), "doc_id long, text_key long, n_shingles long, key long, check long")
    described = written(described, "described")
    # Halves of digests that different sets share: about three of ten billion sets.
    halves = described.groupBy("key").agg(F.min("check").alias("low"), F.max("check").alias("high"))
    shared = frozenset(r["key"] for r in halves.where("low <> high").select("key").collect())
    key = F.when(F.col("key").isin(*shared), F.col("check")).otherwise(F.col("key")) if shared else F.col("key")
    described = described.select("doc_id", "text_key", "n_shingles", key.alias("key"))
    classes = described.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"))
    classes = written(classes, "classes")
    labels = written(components(near_links(docs, described, classes, k, shared)), "labels")
    lowest = classes.join(labels, "key").groupBy("label").agg(F.min("rep").alias("lowest"))
    lowest = labels.join(lowest, "label").select("key", "label", "lowest")
    named = classes.join(lowest, "key", "left").select(
        "key", F.coalesce("label", "key").alias("label"), F.coalesce("lowest", "rep").alias("component_id"))
    return described.join(written(named, "named"), "key", "left").select(
        "doc_id", "text_key", "n_shingles", "label", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, rows without an id last.

    Of several texts of it with that id the one with the smallest hash stays, of rows alike in both any one. Texts without words are all
    kept: they are like nothing. A row goes by its own text, whatever other rows have its id.
    """
    groups = written(_groups(docs, doc_id, text).where("n_shingles > 0"), "groups")
    first = groups.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first"), F.count("*").alias("n"))
    several = written(first.where("n > 1"), "several")
    # Only rows of components with several are shuffled; a bounded filter finds them.
    members = groups.join(several.select("label"), "label", "left_semi")
    row_key = F.xxhash64("doc_id", "text_key").alias("key")
    doubt = _may_hold(_bitmap(members.select(row_key).distinct()))
    stay = several.select(F.col("first.doc_id").alias("doc_id"), F.col("first.text_key").alias("text_key"))
    rows = docs.select(F.struct("*").alias("row"), docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("text_key"))
    rows = rows.withColumn("doubt", doubt(F.xxhash64("doc_id", "text_key")))
    # What a component has, and whether it is the one to stay.
    marked = members.select("doc_id", "text_key", F.lit(0).alias("stays")).unionByName(stay.withColumn("stays", F.lit(1)))
    marked = marked.groupBy("doc_id", "text_key").agg(F.max("stays").alias("stays"))
    marked = marked.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "stays")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & F.col("text_key").eqNullSafe(F.col("of_key"))
    found = rows.where("doubt").join(marked, same, "left")
    turn = F.row_number().over(Window.partitionBy("doc_id", "text_key", "stays").orderBy(F.xxhash64("row")))
    found = found.withColumn("turn", F.when(F.col("stays") == 1, turn).otherwise(1))
    kept = found.where("stays is null or stays = 1 and turn = 1")
    return kept.select("row.*").unionByName(rows.where("not doubt").select("row.*"))


def op10_gram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies among all documents."""
    return similar_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS t FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
k AS (SELECT doc_id, t FROM s WHERE t IN (SELECT t FROM s GROUP BY 1 HAVING count(*) > 1)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM k a JOIN k b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) m USING (doc_id)
"""
