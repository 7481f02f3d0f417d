"""Evaluating a costly value once inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated a single time per row.

    An expression that is written down several times inside lambdas or branches is evaluated as
    often; bound to the variable of a one-element transform it is a value.
    """
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))
