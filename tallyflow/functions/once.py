"""Evaluate expensive per-row expressions exactly once.

Catalyst pushes a filter below the projection that defines the columns it
tests, substituting the projection's expressions into the filter. For a
filter on a parsed JSON value that means the parse runs twice per row (once
in the pushed filter, once in the projection), and the pushed copy can land
below a repartition, on the scan's own tasks. A generator output cannot be
substituted that way, so ``compute_once`` emits the expressions through
``inline_outer`` of a one-element array: one output row per input row, and
filters on the new columns stay above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, *named: Column, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) plus ``named`` columns (each must be
    aliased), each evaluated once per row."""
    cols = df.columns if keep is None else list(keep)
    return df.select(*cols, F.inline_outer(F.array(F.struct(*named))))
