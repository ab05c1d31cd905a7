"""pandas UDFs that are declared at import, when there may be no session yet, and made when first used."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import functions as F


def pandas(kind: str) -> Callable:
    def wrap(f: Callable) -> Callable:
        @functools.wraps(f)
        def call(*columns):
            return F.pandas_udf(f, kind)(*columns)

        call.func = f
        return call

    return wrap
