"""Secrets in texts: known shapes, and sliding-window entropy.

DataFrame functions only; one pass over the rows, nothing is shuffled.

Shapes (``ASSIGN``, ``ACCESS``, ``HEX``): assignments to a secret's name, access keys and long
hexadecimal runs, leftmost and non-overlapping for each kind.

Entropy.  Candidates are maximal runs of a character class (``CLASSES``) of at
least the window's length.  A window slides over a candidate one character at
a time: the count of the character that leaves goes down, that of the one that
comes goes up, and the sum of ``c * log2(c)`` over the counts follows from
these two changes alone.  A window's Shannon entropy is ``log2(W)`` less that
sum over ``W``; the sums are kept in whole millionths of a bit, so no rounding
depends on the order.  Windows of at least the class's bits are secret;
overlapping and touching ones are one span.  Candidates on the allow list
(``ALLOW``: words and numbers, the alphabet in order, digests of the empty
string) give no spans, and a span within a span of a shape adds nothing.

Positions are code points, ends exclusive.  A null text counts as empty; an
empty text has no spans.  Long texts are searched whole: positions are running
sums in two levels, so many matches in one text don't cost their square.  Rows
are independent: repeated rows, null ids and empty tables need no rule.  Of
the input only the named columns are used.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns.
#: ``letters`` writes a word's letters in either case.


def letters(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join([*map(letters, ("password", "passwd", "secret", "token")), letters("api") + "_?" + letters("key")])
ASSIGN = rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A maximal run is either long enough or holds no long enough match, so the
#: least length may stand in the pattern (not so in ``ASSIGN``).
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex")

#: (kind, characters, window, bits): random hexadecimal digits have about 3.5
#: bits in a window of 24, random base64 ones 4.0 in a window of 20; prose
#: without blanks has 3.3 to 3.7 there.
CLASSES = (
    ("entropy_hex", "0123456789abcdefABCDEF", 24, 3.0),
    ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 20, 3.9),
)
#: Candidates in which one of these is found are harmless.
ALLOW = (
    r"^[^0-9]+$",
    r"^[0-9+/_=-]+$",
    r"[aA][bB][cC][dD][eE][fF][gG][hH][iI][jJ][kK][lL]|0123456789[aA][bB][cC][dD][eE][fF]",
    "d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709|e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
)
#: Matches of a text whose positions are summed at a time.
CHUNK = 256
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def char_class(characters: str) -> str:
    """A class as patterns have it; the dash last."""
    return "[" + characters.replace("-", "") + "-" * ("-" in characters) + "]"


def weight(count: int) -> int:
    """``c * log2(c)`` in millionths."""
    return round(1e6 * count * math.log2(count)) if count > 0 else 0


def most_weight(window: int, bits: float) -> int:
    """The largest sum of weights in a window of at least that many bits."""
    return math.floor(1e6 * window * (math.log2(window) - bits))


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


def _running(sizes: Column) -> Column:
    """For each element of an array the sum of those before it."""
    starts = F.sequence(F.lit(1), F.size(sizes), F.lit(CHUNK))

    def before(values: Column, first: Column) -> Column:
        return F.aggregate(values, F.array(first), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)), lambda acc: F.slice(acc, F.lit(1), F.size(values)))

    def total(at: Column) -> Column:
        return F.aggregate(F.slice(sizes, at, F.lit(CHUNK)), F.lit(0), lambda a, v: a + v)

    firsts = before(F.transform(starts, total), F.lit(0))
    return F.flatten(F.zip_with(starts, firsts, lambda at, first: before(F.slice(sizes, at, F.lit(CHUNK)), first)))


def _located(matches: Column, rest: Column) -> Column:
    """``(text, start)`` of matches, from the pieces of text between them."""
    # a piece and the match behind it: sums of both lead to the next piece
    steps = F.zip_with(F.slice(rest, F.lit(1), F.size(matches)), matches, lambda r, m: F.length(r) + F.length(m))
    ends = F.zip_with(_running(steps), steps, lambda before, step: before + step)
    return F.zip_with(matches, ends, lambda m, end: F.struct(m.alias("text"), (end - F.length(m)).alias("start")))


def _found(text: Column, pattern: str, matches: Column) -> Column:
    """Matches with positions; the text is cut only if it has any."""
    return F.when(F.size(matches) > 0, _located(matches, F.split(text, pattern, -1))).otherwise(_empty("array<struct<text:string,start:int>>"))


def _span(start: Column, rank: int, kind: str, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))


def _hot(run: Column, rank: int, kind: str, characters: str, window: int, bits: float) -> Column:
    """The spans of a candidate whose windows have enough bits."""
    own = F.split(run["text"], "")
    zero = ord("0")
    weights = F.array(*[F.lit(weight(c)) for c in range(window + 1)])

    def event(character: Column, by: int) -> Column:
        return F.struct(F.instr(F.lit(characters), character).alias("slot"), F.lit(by).alias("by"))

    def events(character: Column, at: Column) -> Column:
        come = event(character, 1)
        return F.when(at >= window, F.array(event(F.get(own, at - window), -1), come)).otherwise(F.array(come))

    def after(acc: Column, e: Column) -> Column:
        """Counts (a digit a character), the sum, characters come so far, the
        open span and those done."""
        count = F.ascii(F.substring(acc["counts"], e["slot"], F.lit(1))) - zero
        counts = F.overlay(acc["counts"], F.char((count + e["by"] + zero).cast("long")), e["slot"], F.lit(1))
        total = acc["total"] + F.get(weights, count + e["by"]) - F.get(weights, count)
        seen = acc["seen"] + F.greatest(e["by"], F.lit(0))
        hot = (e["by"] > 0) & (seen >= window) & (total <= most_weight(window, bits))
        on = hot & (acc["to"] >= seen - window)  # touches the open span
        new = hot & ~on
        open_ = F.array(F.struct(acc["from"].alias("from"), acc["to"].alias("to")))
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            seen.alias("seen"),
            F.when(new, seen - window).otherwise(acc["from"]).alias("from"),
            F.when(hot, seen).otherwise(acc["to"]).alias("to"),
            F.when(new & (acc["to"] >= 0), F.concat(acc["done"], open_)).otherwise(acc["done"]).alias("done"),
        )

    start = F.struct(
        F.lit("0" * len(characters)).alias("counts"),
        F.lit(0).alias("total"),
        F.lit(0).alias("seen"),
        F.lit(-1).alias("from"),
        F.lit(-1).alias("to"),
        _empty("array<struct<from:int,to:int>>").alias("done"),
    )

    def spans(acc: Column) -> Column:
        last = F.when(acc["to"] >= 0, F.array(F.struct(acc["from"].alias("from"), acc["to"].alias("to")))).otherwise(_empty("array<struct<from:int,to:int>>"))
        return F.transform(F.concat(acc["done"], last), lambda s: _span(run["start"] + s["from"], rank, kind, run["start"] + s["to"]))

    return F.aggregate(F.flatten(F.transform(own, events)), start, after, spans)


def _candidates(text: Column, pattern: str, wide: Column) -> Column:
    return F.when(F.size(wide) > 0, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(_empty("array<string>"))


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), classes: tuple = CLASSES, allow: tuple = ALLOW) -> DataFrame:
    """``keep``, and ``found``: spans ``(start, rank, kind, end)`` by start,
    then by the kinds' order (shapes, then classes).  The result has one row
    for each row of ``docs``."""
    every = "".join(sorted(set("".join(c for _, c, _, _ in classes)) | set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789abcdef")))
    least = min(20, *(w for _, _, w, _ in classes))
    patterns = {kind: rf"(?<!{char_class(cs)}){char_class(cs)}{{{w},}}" for kind, cs, w, _ in classes}
    # every access key, hexadecimal run and candidate lies in such a run
    wide = rf"(?<!{char_class(every)}){char_class(every)}{{{least},}}"
    body = F.col("t")
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.select(*keep, "t", F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(0)).alias("assign"), F.regexp_extract_all("t", F.lit(wide), F.lit(0)).alias("wide"))
    shapes = {"access": ACCESS, "hex": HEX} | patterns
    values = F.when(F.size("assign") > 0, F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2))).otherwise(_empty("array<string>"))
    rows = rows.select(*keep, "t", "assign", values.alias("values"), *[_candidates(body, p, F.col("wide")).alias(k) for k, p in shapes.items()])
    rows = rows.select(*keep, "values", *[_found(body, p, F.col(k)).alias(k) for k, p in ({"assign": ASSIGN} | shapes).items()])

    def shape(rank: int, kind: str) -> Column:
        return F.transform(F.col(kind), lambda m: _span(m["start"], rank, kind, m["start"] + F.length(m["text"])))

    long_enough = F.zip_with("assign", "values", lambda m, v: F.when(F.length(v) >= LEAST_VALUE, m))
    rows = rows.withColumn("assign", F.filter(long_enough, lambda m: m.isNotNull()))
    base = F.concat(*[shape(i, k) for i, k in enumerate(KINDS)])

    def harmless(candidate: Column) -> Column:
        return reduce(lambda a, b: a | b, [candidate["text"].rlike(p) for p in allow], F.lit(False))

    def entropy(rank: int, kind: str, characters: str, window: int, bits: float) -> Column:
        hot = F.transform(F.filter(kind, lambda c: ~harmless(c)), lambda c: _hot(c, rank, kind, characters, window, bits))
        return F.when(F.size(kind) > 0, F.flatten(hot)).otherwise(_empty(SPAN))

    rows = rows.select(*keep, base.cast(SPAN).alias("base"), F.concat(*[entropy(len(KINDS) + i, *c) for i, c in enumerate(classes)]).cast(SPAN).alias("more"))
    added = F.filter("more", lambda s: ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
    return rows.select(*keep, F.array_sort(F.concat("base", added)).alias("found"))


def listed(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(scanned: DataFrame) -> DataFrame:
    """What ``op13`` returns."""

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["rank"] < len(KINDS))
    counts = [number(k) for k in KINDS]
    return scanned.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))
