"""Array helpers as built-in column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from marquee.llm.common import WHITE


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text: runs of anything but ASCII white space."""
    return F.array_remove(F.split(text, WHITE, -1), "")


def positions(n: Column, first: int = 1) -> Column:
    """first .. n as an array, empty when n < first."""
    return F.when(n >= first, F.sequence(F.lit(first), n)).otherwise(F.array().cast("array<int>"))


def run_starts(sorted_values: Column, key: Callable[[Column], Column] = lambda c: c) -> Column:
    """1-based positions where a run of equal keys starts in a sorted array."""
    return F.filter(positions(F.size(sorted_values)),
                    lambda i: (i == 1) | (key(F.get(sorted_values, i - 1)) != key(F.get(sorted_values, i - 2))))
