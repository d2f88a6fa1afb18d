"""Bounded look-ups in an array of line facts.

A document is one row, so its windows are slices of one array: no explode and no shuffle. A window is
read element by element (`F.get` is constant time), since `F.slice` would copy the whole array for
every street line of a long document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

Predicate = Callable[[Column], Column]


def window(array: Column, index: Column, first: int, last: int) -> Column:
    """Elements at `index + first` to `index + last` (0-based), as far as they exist."""
    offsets = F.sequence(F.lit(first), F.lit(last))
    return F.filter(
        F.transform(offsets, lambda offset: F.get(array, index + offset)), lambda item: item.isNotNull()
    )


def position(array: Column, predicate: Predicate) -> Column:
    """1-based position of the first element that fits, 0 when none does."""
    return F.array_position(F.transform(array, predicate), F.lit(True))


def first_of(array: Column, predicate: Predicate) -> Column:
    return F.get(F.filter(array, predicate), F.lit(0))


def last_of(array: Column, predicate: Predicate) -> Column:
    return F.try_element_at(F.filter(array, predicate), F.lit(-1))


def before(array: Column, place: Column) -> Column:
    """Elements before a 1-based position."""
    return F.slice(array, F.lit(1), F.greatest(place - 1, F.lit(0)))


def after(array: Column, place: Column) -> Column:
    """Elements after a 1-based position."""
    return F.slice(array, place + 1, F.size(array))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Work `value` out once and use it in `body` as often as needed."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
