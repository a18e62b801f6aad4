"""What a window holds and gives: user-defined accumulators and window functions.

Both work alike in the batch forms (:mod:`thermoflux.operators.windows`) and on streams
(:mod:`thermoflux.streaming.windowing`).

* An :class:`Accumulator` folds rows into a small state.  ``add`` takes a block of rows at a
  time, so the work inside can be vectorised; ``merge`` joins two states.  Folding must not
  depend on how rows were split into blocks or in which order states were merged.
* A :class:`WindowFunction` sees all rows of a window at once as an Arrow table.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa


class Span(NamedTuple):
    """A window: epoch ms, the end exclusive."""
    start: int
    end: int


class Accumulator:
    """An incremental window aggregate.  ``STATE`` and ``OUTPUT`` are DDL column lists; states
    and results are tuples in their order."""

    STATE = ""
    OUTPUT = ""

    def create(self) -> tuple:
        raise NotImplementedError

    def add(self, state: tuple, rows: pd.DataFrame) -> tuple:
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def finish(self, state: tuple) -> tuple:
        return state


class Count(Accumulator):
    """Number of rows."""

    STATE = OUTPUT = "cnt long"

    def create(self) -> tuple:
        return (0,)

    def add(self, state: tuple, rows: pd.DataFrame) -> tuple:
        return (state[0] + len(rows),)

    def merge(self, a: tuple, b: tuple) -> tuple:
        return (a[0] + b[0],)


@dataclass
class MinMax(Accumulator):
    """Least and greatest value, NaN if one is NaN (as Java's Math.min and Math.max); nulls
    are passed over."""

    value: str = "temperature"

    STATE = OUTPUT = "min double, max double"

    def create(self) -> tuple:
        return (None, None)

    def add(self, state: tuple, rows: pd.DataFrame) -> tuple:
        column = pa.array(rows[self.value], type=pa.float64(), from_pandas=False).drop_null().to_numpy(zero_copy_only=False)
        if not len(column):
            return state
        return self.merge(state, (float(np.min(column)), float(np.max(column))))

    def merge(self, a: tuple, b: tuple) -> tuple:
        if a[0] is None or b[0] is None:
            return b if a[0] is None else a
        if any(math.isnan(v) for v in (*a, *b)):
            return (math.nan, math.nan)
        return (min(a[0], b[0]), max(a[1], b[1]))


@dataclass
class Reduce(Accumulator):
    """A user's reduce of two records of ``columns``: ``function(a, b)`` takes and returns
    tuples in that order, and must be associative and commutative."""

    function: Callable[[tuple, tuple], tuple]
    columns: tuple[str, ...]
    STATE: str
    OUTPUT: str = ""

    def __post_init__(self) -> None:
        self.OUTPUT = self.STATE

    def create(self) -> tuple:
        return (None,) * len(self.columns)

    def add(self, state: tuple, rows: pd.DataFrame) -> tuple:
        held = None if all(v is None for v in state) else state
        for row in rows[list(self.columns)].itertuples(index=False, name=None):
            held = tuple(row) if held is None else self.function(held, tuple(row))
        return state if held is None else tuple(v.item() if isinstance(v, np.generic) else v for v in held)

    def merge(self, a: tuple, b: tuple) -> tuple:
        if all(v is None for v in a):
            return b
        return a if all(v is None for v in b) else self.function(a, b)


@dataclass
class WindowFunction:
    """``function(key, span, rows)`` over all rows of a window → a table of ``OUTPUT``."""

    function: Callable[[tuple, Span, pa.Table], pa.Table | dict[str, list[Any]]]
    OUTPUT: str

    def __call__(self, key: tuple, span: Span, rows: pa.Table, schema: pa.Schema) -> pa.Table:
        made = self.function(key, span, rows)
        if isinstance(made, dict):
            made = pa.table({f.name: pa.array(made[f.name], f.type) for f in schema})
        return made.select(schema.names).cast(schema)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl)) if ddl else pa.schema([])
