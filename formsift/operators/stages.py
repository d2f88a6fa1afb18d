"""Building blocks for long expression chains."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, functions as F


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are worked out here, once.

    A filter or expression on a plain projected column is rewritten onto the expression behind it. For
    columns at the end of a long chain that copies the chain many times over. A filter does not pass a
    generator, and its columns are not copied.
    """
    entry = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(entry)))


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Keeps a Column that takes thousands of calls into the JVM to build, for as long as the link to it lives.

    Without such a link, as with a remote session, nothing is kept.
    """
    kept: WeakKeyDictionary = WeakKeyDictionary()

    @wraps(build)
    def column(*names: str | None) -> Column:
        gateway = SparkContext._gateway
        if gateway is None:
            return build(*names)
        own = kept.setdefault(gateway, {})
        if names not in own:
            own[names] = build(*names)
        return own[names]

    return column
