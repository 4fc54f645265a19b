"""Python functions over columns, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mapped(function: Callable, column: Column, kind: T.DataType | None = None) -> Column:
    """``function`` of each value that is not null; null stays null. For what has no built-in expression."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(function, na_action="ignore")

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, kind or T.StringType())(column)
