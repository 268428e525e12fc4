"""Slices as predicates on columns; values never become SQL text."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.contracts import Slice


def apply_slice(df: DataFrame, wanted: Slice) -> DataFrame:
    tests = [
        F.col(column) == F.lit(getattr(wanted, part))
        for part, column in wanted.columns.items()
        if getattr(wanted, part) is not None
    ]
    return df.filter(reduce(and_, tests)) if tests else df
