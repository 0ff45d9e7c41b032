"""Secrets in texts: patterns, and Shannon entropy in a window that slides over candidate strings.

All of it is DataFrame functions. A pattern's matches come from regexp_extract_all, their places
from running sums over what split leaves between them, as code points with the end exclusive. Patterns are tried only
on texts that hold one; nothing is looked at position by position but the candidate strings.

Candidates for the entropy scan are runs of CANDIDATE. The window of WIDTH characters moves over one
with its counts per character, five bits each in six numbers: the character that leaves takes one off its count, the one
that enters adds one, and the sum of n * log2(n), in whole numbers, changes by these two. The entropy is log2(WIDTH) less that sum over WIDTH.
A candidate is scanned in pieces of PIECE windows, and lists that grow are built in blocks of BLOCK,
so time and memory are in proportion to the text, with one long candidate or many matches too. Its class (hexadecimal in
one case or both, base32, base36, or base62 and base64) sets the threshold: what all but one in 200
random windows of that alphabet reach. Letters of one case in parts between +/_- are like words of a
path and need more. Up to four words with _ or - before a string don't change its class. Windows over
the threshold join to spans. Allow-listed candidates are left out: runs without a digit or without a letter, UUIDs, words of letters with
digits only behind them, and what is named an example or a placeholder.

Nulls: a null text is empty and has no spans; a null id stays. Repeated rows are scanned alike. Very long texts are
scanned whole, in one task each. An empty table gives no rows. Characters outside the basic plane count as one.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kind, pattern, and which group of how many characters a match needs. Where a shorter match can't hide a longer
#: one, the pattern asks for the length itself.
PATTERNS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
#: Texts without one of these have no match long enough.
HINTS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]""",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24}",
}
WIDTH = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: Windows of a candidate that are scanned at once, and items of a list that are added up at once.
PIECE, BLOCK = 256, 128
#: Bits per character that a window needs: what 199 of 200 random windows of the class reach; of parts, what words don't.
THRESHOLDS = {
    "entropy_hex": 2.82, "entropy_any_hex": 2.96, "entropy_base32": 3.28, "entropy_base36": 3.34, "entropy_parts": 3.9,
    "entropy_mixed": 3.58}
_WORDS = r"(?:[A-Za-z]{1,16}[_-]){0,4}"
#: The first that a whole candidate matches is its class; entropy_mixed if none.
CLASSES = (
    ("entropy_hex", rf"[0-9a-f-]+|[0-9A-F-]+|{_WORDS}(?:[0-9a-f]{{20,}}|[0-9A-F]{{20,}})"),
    ("entropy_any_hex", rf"[0-9A-Fa-f-]+|{_WORDS}[0-9A-Fa-f]{{20,}}"),
    ("entropy_base32", rf"{_WORDS}(?:[a-z2-7]{{20,}}|[A-Z2-7]{{20,}})"),
    ("entropy_base36", rf"{_WORDS}(?:[a-z0-9]{{20,}}|[A-Z0-9]{{20,}})"),
    ("entropy_parts", r"[a-z0-9+/_-]+|[A-Z0-9+/_-]+"),
)
ALLOWED = (
    r"[^0-9]*", r"[^A-Za-z]*", r"[A-Za-z/_-]+[0-9]{1,4}",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(?i).*(example|placeholder|x{6}|0{8}|1234567|abcdef).*",
)
_SPAN = "array<struct<kind:string,start:long,end:long,at:long,to:long>>"
_SCALE = 1 << 40
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_PER_NUMBER = 12


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(items: Column, zero: Column, add: Callable[[Column, Column], Column], depth: int = 2) -> Column:
    """For each item what ``add`` makes of all items before it, in time proportional to their number.

    ``items`` must be a lambda's variable. Blocks are added up, then blocks of blocks, so that no list
    of more than BLOCK items is built one by one until there are BLOCK**3.
    """

    def one_by_one(part: Column, first: Column) -> Column:
        start = F.struct(first.alias("sum"), F.filter(F.array(first), lambda _: F.lit(False)).alias("out"))
        return F.aggregate(part, start, lambda s, x: F.struct(
            add(s["sum"], x).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out")), lambda s: s["out"])

    if depth == 0:
        return one_by_one(items, zero)
    starts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))

    def block(i: Column) -> Column:
        return F.slice(items, i * BLOCK + 1, BLOCK)

    blocks = _let(
        F.transform(starts, lambda i: F.aggregate(block(i), zero, add)),
        lambda sums: _let(_running(sums, zero, add, depth - 1), lambda before: F.flatten(
            F.transform(starts, lambda i: one_by_one(block(i), F.get(before, i))))))
    return F.when(F.size(items) <= BLOCK, one_by_one(items, zero)).otherwise(blocks)


def _joined(spans: Column) -> Column:
    """Spans (start, end), sorted and alike in length or apart, with those that touch made one."""
    starts = F.filter(spans, lambda s, i: F.coalesce(s["start"] > F.get(spans, i - 1)["end"], F.lit(True)))
    ends = F.filter(spans, lambda s, i: F.coalesce(F.get(spans, i + 1)["start"] > s["end"], F.lit(True)))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap: start and end in code points, at and to in bytes, and the text."""

    def placed(gaps: Column, hits: Column) -> Column:
        def size(x: Column) -> Column:
            return F.struct(F.char_length(x).cast("long").alias("n"), F.octet_length(x).cast("long").alias("bytes"))

        def add(a: Column, b: Column) -> Column:
            return F.struct((a["n"] + b["n"]).alias("n"), (a["bytes"] + b["bytes"]).alias("bytes"))

        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bytes"))
        sizes = F.transform(hits, lambda h, i: add(size(F.get(gaps, i)), size(h)))
        return _let(sizes, lambda sizes: _let(_running(sizes, zero, add), lambda before: F.transform(
            hits, lambda h, i: _let(add(F.get(before, i), F.get(sizes, i)), lambda end: F.struct(
                (end["n"] - F.char_length(h)).alias("start"), end["n"].alias("end"),
                (end["bytes"] - F.octet_length(h)).alias("at"), end["bytes"].alias("to"), h.alias("text"))))))

    return _let(F.split(text, pattern, -1), lambda gaps: _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: placed(gaps, hits)))


def _span(kind: str, start: Column, end: Column, at: Column, to: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), at.alias("at"), to.alias("to"))


def base_spans(text: Column) -> list[Column]:
    """Per kind the matches that are long enough; nothing where the text holds none."""

    def of(kind: str, pattern: str, group: int, least: int) -> Column:
        spans = F.filter(
            matches(text, pattern), lambda s: F.char_length(F.regexp_extract(s["text"], pattern, group)) >= least)
        spans = F.transform(spans, lambda s: _span(kind, s["start"], s["end"], s["at"], s["to"]))
        return F.when(F.regexp_like(text, F.lit(HINTS[kind])), spans).otherwise(F.array().cast(_SPAN))

    return [of(*p) for p in PATTERNS]


def needed(candidate: Column) -> Column:
    """The threshold of the candidate's class."""
    least = F.lit(THRESHOLDS["entropy_mixed"])
    for kind, pattern in reversed(CLASSES):
        least = F.when(F.regexp_like(candidate, F.lit(f"^(?:{pattern})$")), THRESHOLDS[kind]).otherwise(least)
    return least


def _bits(n: int) -> int:
    """n * log2(n) in whole numbers."""
    return round(n * math.log2(n) * _SCALE) if n > 1 else 0


def _places() -> Column:
    """For each ASCII character where its count is: the number, how far it is shifted, and one of it."""
    place = {c: divmod(i, _PER_NUMBER) for i, c in enumerate(_ALPHABET)}
    rows = [place.get(chr(i), (0, 0)) for i in range(128)]
    return F.array(*[F.struct(F.lit(k).alias("number"), F.lit(5 * i).alias("shift"), F.lit(1 << 5 * i).cast("long").alias("one"))
                     for k, i in rows])


def _hot_piece(piece: Column, most: Column) -> Column:
    """Starts in a short string of the windows whose sum of n * log2(n) is at most ``most``.

    The state is the window's counts and sum; a character that leaves and one that enters change them.
    """
    numbers = range(-(-len(_ALPHABET) // _PER_NUMBER))
    # What the sum grows by as a count reaches n.
    growth = F.array(*[F.lit(_bits(n) - _bits(n - 1)).cast("long") for n in range(1, WIDTH + 1)])

    def count(counts: Column, place: Column) -> Column:
        held = F.call_function("shiftright", F.get(counts, place["number"]), place["shift"])
        return held.bitwiseAND(F.lit(31).cast("long")).cast("int")

    def scan(places: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            come, gone = F.get(places, i), F.get(places, i - WIDTH)

            def moved(k: int) -> Column:
                more = F.when(come["number"] == k, come["one"]).otherwise(0)
                return F.get(s["counts"], k) + more - F.when(gone["number"] == k, gone["one"]).otherwise(0)

            same = F.when((come["number"] == gone["number"]) & (come["shift"] == gone["shift"]), 1).otherwise(0)
            less = F.coalesce(F.get(growth, count(s["counts"], gone) - 1), F.lit(0).cast("long"))
            hot = (i >= WIDTH) & (s["sum"] <= most)  # the window that the last step has filled
            return F.struct(
                F.array(*[moved(k) for k in numbers]).alias("counts"),
                (s["sum"] - less + F.get(growth, count(s["counts"], come) - same)).alias("sum"),
                F.when(hot, F.concat(s["hot"], F.array(i - WIDTH))).otherwise(s["hot"]).alias("hot"))

        zero = F.lit(0).cast("long")
        start = F.struct(F.array(*[zero for _ in numbers]).alias("counts"), zero.alias("sum"),
                         F.array().cast("array<int>").alias("hot"))
        size = F.size(places)
        return F.aggregate(
            F.sequence(F.lit(0), size - 1), start, step,
            lambda s: F.when(s["sum"] <= most, F.concat(s["hot"], F.array(size - WIDTH))).otherwise(s["hot"]))

    places = _places()
    return _let(F.transform(F.split(piece, ""), lambda c: F.get(places, F.ascii(c))), scan)


def hot_spans(candidate: Column, least: Column) -> Column:
    """Start and end of the joined windows whose entropy reaches ``least``, in a string of CANDIDATE."""
    most = F.floor((math.log2(WIDTH) - least) * WIDTH * _SCALE + 8).cast("long")

    def of(raw: Column, most: Column) -> Column:
        pieces = F.sequence(F.lit(0), F.floor((F.octet_length(raw) - WIDTH) / PIECE).cast("int"))

        def piece(k: Column) -> Column:
            part = F.substring(raw, k * PIECE + 1, F.lit(PIECE + WIDTH - 1)).cast("string")
            return _let(F.transform(_hot_piece(part, most), lambda i: F.struct(
                (k * PIECE + i).alias("start"), (k * PIECE + i + WIDTH).alias("end"))), _joined)

        return _let(F.flatten(F.transform(pieces, piece)), _joined)

    return _let(candidate.cast("binary"), lambda raw: _let(most, lambda most: of(raw, most)))


def entropy_spans(text: Column) -> Column:
    """Joined hot windows of the candidates that are not allow-listed."""
    allowed = "|".join(f"(?:{p})" for p in ALLOWED)
    found = F.filter(matches(text, CANDIDATE), lambda s: ~F.regexp_like(s["text"], F.lit(f"^(?:{allowed})$")))

    def windows(s: Column) -> Column:
        return F.transform(hot_spans(s["text"], needed(s["text"])), lambda w: _span(
            "entropy", s["start"] + w["start"], s["start"] + w["end"], s["at"] + w["start"], s["at"] + w["end"]))

    hot = F.flatten(F.transform(found, windows))
    # A text without a digit in a run of that length is passed over.
    hint = F.regexp_like(text, F.lit(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20}"))
    return F.when(hint, hot).otherwise(F.array().cast(_SPAN))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, their text (null: empty), base spans by kind and entropy spans."""
    value = F.coalesce(docs[text], F.lit(""))
    out = docs.select(F.struct("*").alias("row"), value.alias("text"))
    base = base_spans(F.col("text"))
    return out.select("row", "text", *[b.alias(k) for b, (k, *_) in zip(base, PATTERNS)], entropy_spans(F.col("text")).alias("entropy"))


def listed(spans: Column) -> Column:
    """kind:start:end by start, then by kind as listed, joined by commas."""
    order = F.create_map(*[x for i, k in enumerate([*[p[0] for p in PATTERNS], "entropy"]) for x in (F.lit(k), F.lit(i))])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.element_at(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(docs: DataFrame, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """The rows of ``docs`` with every secret in the text replaced by ``mark``; all other rows as they are.

    A null text stays null. A column n_chars, if there is one, follows the text.
    """
    found = scan(docs, text)
    spans = F.array_sort(F.transform(
        F.concat(*[p[0] for p in PATTERNS], "entropy"), lambda s: F.struct(s["at"].alias("at"), s["to"].alias("to"))))

    def cleaned(spans: Column, raw: Column) -> Column:
        def part(begin: Column, end: Column) -> Column:
            return F.substring(raw, (begin + 1).cast("int"), (end - begin).cast("int")).cast("string")

        def put(before: Column) -> Column:
            # A span that begins behind the end of all before it is masked apart from them.
            heads = F.filter(F.transform(spans, lambda s, i: F.struct(s["at"].alias("at"), F.get(before, i).alias("after"))),
                             lambda h: h["at"] >= h["after"])
            end = F.greatest(F.get(before, F.size(before) - 1), F.get(spans, F.size(spans) - 1)["to"])
            parts = F.transform(heads, lambda h: F.concat(part(h["after"], h["at"]), F.lit(mark)))
            return F.concat(F.array_join(parts, ""), part(end, F.octet_length(raw).cast("long")))

        ends = F.transform(spans, lambda s: s["to"])
        return _let(ends, lambda ends: _let(_running(ends, F.lit(0).cast("long"), lambda a, b: F.greatest(a, b)), put))

    clean = _let(F.col("text").cast("binary"), lambda raw: _let(F.col("spans"), lambda spans: cleaned(spans, raw)))
    found = found.select("row", "text", spans.alias("spans"))
    value = F.when(F.size("spans") > 0, clean).otherwise(F.col(f"row.{text}"))
    out = found.select("row", value.alias("value"), (F.size("spans") > 0).alias("changed"))
    columns = []
    for c, kind in docs.dtypes:
        if c == text:
            columns.append(F.col("value").alias(c))
        elif c == "n_chars":
            columns.append(F.when(F.col("changed"), F.char_length("value").cast(kind)).otherwise(F.col("row.n_chars")).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return out.select(*columns)


def op6_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    kinds = [p[0] for p in PATTERNS]
    base = F.concat(*kinds)
    return found.select(
        "row.doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.concat(base, F.col("entropy"))).alias("spans"))
