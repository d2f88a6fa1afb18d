"""Comparison of an extracted value with the truth."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from formsift import constants as K
from formsift.functions import text as T, windows as W

PASS, FAIL, OPEN = "Pass", "Fail", "Not Verifiable"


def state_for_compare(value: Column) -> Column:
    """First token, commas as blanks and upper-cased, that is a state code; '' without one."""
    edge = f"[{K.SPACE_SET},]"
    return F.coalesce(
        F.regexp_extract(F.upper(value), rf"(?:^|{edge})({K.STATE_CODES})(?={edge}|\z)", 1), F.lit("")
    )


def zip_for_compare(value: Column, zip_position: str = "first") -> Column:
    """First ZIP-like number, '' without one.

    The first may be a five-digit street number; `zip_position="last"` takes the last one instead.
    """
    if zip_position == "last":
        found = F.try_element_at(F.regexp_extract_all(value, F.lit(K.ZIP_PLAIN), 0), F.lit(-1))
    else:
        found = F.regexp_extract(value, K.ZIP_PLAIN, 0)
    return F.coalesce(found, F.lit(""))


def popular_in(b: Column) -> Column:
    """Characters that begin no piece: those of over a hundredth of a text of 200 characters or more."""
    often = lambda c: F.char_length(b) - F.char_length(F.replace(b, c, F.lit(""))) > F.floor(F.char_length(b) / 100) + 1
    return F.when(F.char_length(b) >= 200, F.filter(F.array_distinct(F.split(b, "")), often)).otherwise(
        F.array().cast("array<string>")
    )


def longest_piece(a: Column, b: Column, popular: Column, open_range: Column) -> Column:
    """The longest piece of a range of `a` that its range of `b` holds, the first in `a`, then in `b`: size, i, j.

    One pass over the ends of pieces in `a`: what ends at a character is at most one longer than what ends before it,
    so each end only asks for a piece one longer than the longest so far, without a popular character in it.
    """
    within = F.substring(b, open_range["b_low"] + 1, open_range["b_high"] - open_range["b_low"])

    def search(text: Column) -> Column:
        def step(state: Column, end: Column) -> Column:
            floor = F.when(F.array_contains(popular, F.substring(a, end, F.lit(1))), end).otherwise(state["floor"])
            longer = (end - state["size"] > floor) & (
                F.instr(text, F.substring(a, end - state["size"], state["size"] + 1)) > 0
            )
            return F.struct(
                F.when(longer, state["size"] + 1).otherwise(state["size"]).alias("size"),
                F.when(longer, end).otherwise(state["end"]).alias("end"),
                floor.alias("floor"),
            )

        nothing = F.struct(F.lit(0).alias("size"), open_range["a_low"].alias("end"), open_range["a_low"].alias("floor"))
        ends = F.sequence(open_range["a_low"] + 1, open_range["a_high"])
        return F.aggregate(ends, nothing, step, lambda state: F.struct(
            state["size"].alias("size"),
            (state["end"] - state["size"]).alias("i"),
            (open_range["b_low"] + F.greatest(
                F.instr(text, F.substring(a, state["end"] - state["size"] + 1, state["size"])), F.lit(1)
            ) - 1).alias("j"),
        ))

    return W.let(within, search)


def equal_run(most: Column, left: Callable[[Column], Column], right: Callable[[Column], Column]) -> Column:
    """How many of the first `most` characters of two sides are equal, each given by its number from 1 on."""
    step = lambda run, n: F.when((run == n - 1) & (left(n) == right(n)), n).otherwise(run)
    return F.when(most > 0, F.aggregate(F.sequence(F.lit(1), most), F.lit(0), step)).otherwise(F.lit(0))


def lengthened(a: Column, b: Column, open_range: Column, piece: Column) -> Column:
    """A piece with the equal characters on both sides of it within the range; popular ones are only found so."""
    one = F.lit(1)
    before = equal_run(
        F.least(piece["i"] - open_range["a_low"], piece["j"] - open_range["b_low"]),
        lambda n: F.substring(a, piece["i"] - n + 1, one), lambda n: F.substring(b, piece["j"] - n + 1, one),
    )
    i_end, j_end = piece["i"] + piece["size"], piece["j"] + piece["size"]
    after = equal_run(
        F.least(open_range["a_high"] - i_end, open_range["b_high"] - j_end),
        lambda n: F.substring(a, i_end + n, one), lambda n: F.substring(b, j_end + n, one),
    )
    return W.let(before, lambda k: F.struct(
        (piece["size"] + k + after).alias("size"), (piece["i"] - k).alias("i"), (piece["j"] - k).alias("j")
    ))


def matching(a: Column, b: Column) -> Column:
    """Characters in matching blocks: the longest common piece (the first in `a`, then in `b`), then left and right of it.

    A fold over a work list of ranges. Each piece leaves at most two ranges, so a list of twice the shorter text and
    one more steps is worked off; steps after its end do nothing.
    """
    ranges = "array<struct<a_low:int,a_high:int,b_low:int,b_high:int>>"

    def rest(a_low: Column, a_high: Column, b_low: Column, b_high: Column) -> Column:
        own = F.array(F.struct(
            a_low.alias("a_low"), a_high.alias("a_high"), b_low.alias("b_low"), b_high.alias("b_high")
        )).cast(ranges)
        return F.when((a_low < a_high) & (b_low < b_high), own).otherwise(F.array().cast(ranges))

    def work(a: Column, b: Column, popular: Column) -> Column:
        def split_at(state: Column, now: Column, piece: Column) -> Column:
            i_end, j_end = piece["i"] + piece["size"], piece["j"] + piece["size"]
            left = rest(now["a_low"], piece["i"], now["b_low"], piece["j"])
            right = rest(i_end, now["a_high"], j_end, now["b_high"])
            later = F.slice(state["open"], F.lit(2), F.size(state["open"]))
            found = F.when(piece["size"] > 0, F.concat(left, right, later)).otherwise(later)
            return F.struct(found.alias("open"), (state["total"] + piece["size"]).alias("total"))

        def step(state: Column, _: Column) -> Column:
            def piece(now: Column) -> Column:
                whole = lambda p: F.when(F.size(popular) > 0, lengthened(a, b, now, p)).otherwise(p)
                return W.let(longest_piece(a, b, popular, now), whole)

            taken = W.let(F.get(state["open"], F.lit(0)), lambda now: W.let(
                piece(now), lambda found: split_at(state, now, found)
            ))
            return F.when(F.size(state["open"]) == 0, state).otherwise(taken)

        start = F.struct(rest(F.lit(0), F.char_length(a), F.lit(0), F.char_length(b)).alias("open"), F.lit(0).alias("total"))
        steps = F.sequence(F.lit(0), 2 * F.least(F.char_length(a), F.char_length(b)))
        return F.aggregate(steps, start, step, lambda state: state["total"])

    return W.let(a, lambda x: W.let(b, lambda y: W.let(popular_in(y), lambda often: work(x, y, often))))


def similarity(expected: Column, extracted: Column) -> Column:
    """Ratcliff-Obershelp ratio, argument order kept; NULL where either side is NULL, 1 for two empty texts.

    An expression: it stays in the JVM and is worked out only where a condition around it asks for it.
    """
    both = F.char_length(expected) + F.char_length(extracted)
    ratio = 2 * matching(expected, extracted).cast("double") / both
    return F.when(both == 0, 1.0).when(both > 0, ratio)


def outcome(field: Column, expected: Column, extracted: Column, same_place: Column) -> Column:
    """E5. The similarity is asked for only where neither equality, state, ZIP nor an upper bound decides."""
    want, have = T.alnum_for_compare(expected), T.alnum_for_compare(extracted)
    decided = outcome_without_similarity(field, expected, extracted, same_place)
    return F.coalesce(decided, F.when(similarity(want, have) >= K.SIMILARITY, PASS).otherwise(FAIL))


def outcome_without_similarity(field: Column, expected: Column, extracted: Column, same_place: Column) -> Column:
    """E5 as far as plain expressions decide it; NULL where the similarity has to.

    `expected` and `extracted` are stripped, `same_place` says that state and ZIP agree.
    """
    want, have = T.alnum_for_compare(expected), T.alnum_for_compare(extracted)
    return (
        F.when(expected == K.NOT_VERIFIABLE, OPEN)
        .when(want == have, PASS)
        .when((want == "") | (have == "") | (field != "employee_address"), FAIL)
        .when(~same_place | (similarity_bound(want, have) < K.SIMILARITY), FAIL)
        .when(shared_bound(want, have) < K.SIMILARITY, FAIL)
    )


def similarity_bound(a: Column, b: Column) -> Column:
    """Upper bound of the ratio from the lengths alone."""
    shorter, both = F.least(F.char_length(a), F.char_length(b)), F.char_length(a) + F.char_length(b)
    return F.coalesce(F.try_divide(F.lit(2.0) * shorter, both), F.lit(1.0))


def shared_bound(a: Column, b: Column) -> Column:
    """Tighter upper bound of the ratio: each character counts as often as both texts hold it, wherever it is."""

    def shared(x: Column, y: Column) -> Column:
        times = lambda text, c: F.char_length(text) - F.char_length(F.replace(text, c, F.lit("")))
        add = lambda total, c: total + F.least(times(x, c), times(y, c))
        total = F.aggregate(F.array_distinct(F.split(x, "")), F.lit(0), add)
        return F.coalesce(F.try_divide(2.0 * total, F.char_length(x) + F.char_length(y)), F.lit(1.0))

    return W.let(a, lambda x: W.let(b, lambda y: shared(x, y)))


def share(part: Column, whole: Column) -> Column:
    """Part of a whole, 0 when the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
