"""Side outputs as tagged rows.

A process function that writes to a main and one or more side outputs is one
projection that adds a ``tag`` column; ``split_outputs`` turns the tagged
frame into one DataFrame per tag (each a filter over the same plan — persist
the tagged frame, or use a streaming ``foreachBatch``, to compute it once).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAIN = "main"


def tag_rows(df: DataFrame, rules: Iterable[tuple[str, Column]], default: str = MAIN,
             tag_col: str = "tag") -> DataFrame:
    """Tag each row with the first matching rule's name, else ``default``."""
    expr = None
    for name, cond in rules:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(tag_col, expr)


def split_outputs(tagged: DataFrame, tags: Iterable[str], tag_col: str = "tag") -> dict[str, DataFrame]:
    return {t: tagged.filter(F.col(tag_col) == F.lit(t)).drop(tag_col) for t in tags}
