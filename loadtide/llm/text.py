"""Column expressions over texts: words, places of matches, keyed permutations. No Python runs on the executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII white space, as in [\x20\x09-\x0D]
WS = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
WS_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """`fn(value)` with the value computed once, however often `fn` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def text_of(column: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """The runs of other characters than ASCII white space, in order."""
    trimmed = F.btrim(text, F.lit(WS_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS + "+"))


def chars(text: Column) -> Column:
    """The characters of a text of ASCII characters."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def upto(n: Column) -> Column:
    """0, 1, ..., n-1 as an array; empty for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def sums_before(values: Column, block: int = 256) -> Column:
    """For each element of an int array the sum of those before it.

    Sums inside blocks and over blocks, so that a text with very many matches stays cheap.
    """
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def place(v: Column) -> Column:
        blocks = F.transform(upto(F.ceil(F.size(v) / block).cast("int")), lambda b: total(F.slice(v, b * block + 1, F.lit(block))))
        return let(blocks, lambda t: let(
            F.transform(t, lambda _, i: total(F.slice(t, F.lit(1), i))),
            lambda before: F.transform(v, lambda _, i: F.get(before, F.floor(i / block).cast("int"))
                                       + total(F.slice(v, i - i % block + 1, i % block)))))

    return let(values, place)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, stop, found, value).

    Places count code points, stop exclusive; `value` is the pattern's group. Texts without a match
    cost one search. The gap before each match is a group of its own, from which the places follow.
    """
    anchored = F.lit(f"(?s)\\G(.*?)({pattern})")

    def build(t: Column) -> Column:
        gap, hit = F.regexp_extract_all(t, anchored, F.lit(1)), F.regexp_extract_all(t, anchored, F.lit(2))
        val = hit if group == 0 else F.regexp_extract_all(t, anchored, F.lit(2 + group))
        lengths = F.transform(F.arrays_zip(gap.alias("g"), hit.alias("h")),
                              lambda z: F.struct(F.length(z["g"]).alias("g"), F.length(z["h"]).alias("h")))
        return let(F.struct(lengths.alias("n"), hit.alias("h"), val.alias("v")), lambda s: let(
            sums_before(F.transform(s["n"], lambda z: z["g"] + z["h"])),
            lambda before: F.transform(s["h"], lambda h, i: F.struct(
                (F.get(before, i) + F.get(s["n"], i)["g"]).alias("start"),
                (F.get(before, i) + F.get(s["n"], i)["g"] + F.get(s["n"], i)["h"]).alias("stop"),
                h.alias("found"), F.get(s["v"], i).alias("value")))))

    none = F.array().cast("array<struct<start:bigint,stop:bigint,found:string,value:string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), build(text)).otherwise(none)


def permuted(left: Column, right: Column, left_size: Column, right_size: Column, key: Callable[[Column, Column], Column],
             rounds: int = 4) -> Column:
    """Feistel network over pairs (left, right) with left < left_size and right < right_size: struct (l, r).

    Each round shifts one half by a keyed hash of the other, so it is a permutation for any two
    sizes. `key(half, round)` gives the hash as a 64-bit number. `rounds` is even.
    """
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), start,
        lambda a, i: F.struct(a["r"].alias("l"), F.pmod(
            a["l"] + F.pmod(key(a["r"], i), F.when(i % 2 == 1, left_size).otherwise(right_size)),
            F.when(i % 2 == 1, left_size).otherwise(right_size)).cast("bigint").alias("r")))


def permuted_index(index: Column, n: Column, key: Callable[[Column, Column], Column]) -> Column:
    """A keyed permutation of 0..n-1, by walking a Feistel network over the smallest near-square that holds n.

    Fewer than sqrt(n) numbers of the square are not below n, so 32 steps always suffice below
    n = 1,000, and fail beyond with a chance under 1e-48.
    """
    side = F.ceil(F.sqrt(n)).cast("bigint")
    other = F.ceil(n / side).cast("bigint")

    def step(x: Column) -> Column:
        return let(permuted(F.floor(x / other), x % other, side, other, key), lambda p: p["l"] * other + p["r"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(32)), step(index), lambda x, _: F.when(x < n, x).otherwise(step(x)))
