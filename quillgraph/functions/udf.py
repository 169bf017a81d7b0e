"""Arrow UDFs that need no session where they are defined."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_udf(return_type: str) -> Callable[[Callable], Callable[..., Column]]:
    """Like ``pandas_udf``, but made when it is first applied to columns."""

    def wrap(function: Callable) -> Callable[..., Column]:
        @functools.wraps(function)
        def call(*columns: Column | str) -> Column:
            return F.pandas_udf(function, return_type)(*columns)

        return call

    return wrap


def plain_arrow_udf(return_type: str) -> Callable[[Callable], Callable[..., Column]]:
    """Like ``pyspark.sql.functions.arrow_udf``, but made when it is first applied to columns."""

    def wrap(function: Callable) -> Callable[..., Column]:
        @functools.wraps(function)
        def call(*columns: Column | str) -> Column:
            return F.arrow_udf(function, return_type)(*columns)

        return call

    return wrap
