"""Keyed rolling operators: one output row per input row (batch forms).

Both are prefix scans per key in arrival (``seq``) order, built on
:mod:`thermoflux.operators.scan` so a hot key is split into bounded chunks
instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermoflux.operators.contents import Reduce, arrow_schema
from thermoflux.operators.scan import _CHUNK, _SIDE, CHUNK_ROWS, Measure, chunked, running_scan


def rolling_sum(df: DataFrame, key: str = "k", value: str = "v", carried: tuple[str, ...] = ("c",),
                seq: str = "event_id", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``keyBy(key).sum(value)``: each row gets the running sum of ``value`` per key;
    the ``carried`` fields keep the key's *first* row's values, null ones included."""
    # A struct is never null itself, so the first row wins whatever it holds.
    first = F.struct(*[F.col(c).alias(c) for c in carried])
    measures = [Measure("_sum", "sum", F.col(value))] + ([Measure("_first", "first", first)] if carried else [])
    out = running_scan(df, [key], [seq], measures, chunk_rows=chunk_rows)
    return out.select(seq, key, F.col("_sum").alias(value), *[F.col("_first")[c].alias(c) for c in carried])


def rolling_reduce(df: DataFrame, key: str, by: str, seq: str = "event_id", carried: Sequence[str] | None = None,
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rolling ``reduce((r1, r2) -> r1.by > r2.by ? r1 : r2)`` that keeps whole records: per
    input row, the ``carried`` fields (default: all but ``seq`` and the key) of the record with
    the greatest ``by`` so far; a tie takes the newer record.

    A comparison with NaN is false, so a NaN record always replaces the held one and is
    replaced by the next: every NaN begins the search anew.  Rows after the same number of
    NaN are one *epoch*, and the held record is the greatest by (epoch, not NaN, by, seq).
    """
    carried = [c for c in df.columns if c not in (seq, key)] if carried is None else list(carried)
    nan = F.isnan(F.col(by).cast("double"))
    rows = chunked(df.select(seq, key, *dict.fromkeys([by, *carried])), [key], F.col(seq), chunk_rows).withColumn("_nan", nan.cast("long"))

    def record(epoch: Column) -> Column:
        plain = F.when(nan, F.lit(None)).otherwise(F.col(by))
        return F.struct(epoch.alias("epoch"), (~nan).alias("real"), plain.alias("by"), F.col(seq).alias("seq"),
                        F.struct(*[F.col(c).alias(c) for c in carried]).alias("record"))

    # Hot keys only: the record held at the end of each chunk, then at the end of all before it.
    inside = Window.partitionBy(key, _CHUNK).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summ = (rows.filter(F.col(_CHUNK).isNotNull()).withColumn("_epoch", F.sum("_nan").over(inside))
            .groupBy(key, _CHUNK).agg(F.max(record(F.col("_epoch"))).alias("_held"), F.sum("_nan").alias("_nans")))
    chunks = Window.partitionBy(key).orderBy(_CHUNK)
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    based = summ.withColumn("_base", F.coalesce(F.sum("_nans").over(before), F.lit(0)))
    based = based.withColumn("_held", F.col("_held").withField("epoch", F.col("_held.epoch") + F.col("_base")))
    # The carried record is of the last epoch before the chunk: epoch 0 inside it.
    carry = (based.select(key, _CHUNK, F.lag(_CHUNK).over(chunks).alias("_before"), F.max("_held").over(before).alias("_held"))
             .filter(F.col("_before").isNotNull()).select(key, _CHUNK, F.lit(0).alias(_SIDE), F.lit(0).cast("long").alias("_nan"), "_held"))
    both = rows.withColumn(_SIDE, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(key, _CHUNK).orderBy(_SIDE, seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("_epoch", F.sum("_nan").over(w))
    own = F.when(F.col(_SIDE) == 1, record(F.col("_epoch"))).otherwise(F.col("_held").withField("epoch", F.lit(0).cast("long")))
    out = both.withColumn("_best", F.max(own).over(w)).filter(F.col(_SIDE) == 1)
    return out.select(seq, key, *[F.col("_best.record")[c].alias(c) for c in carried])


def rolling_max(df: DataFrame, key: str = "id", seq: str = "event_id", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The hottest reading so far of each sensor, as a whole record."""
    return rolling_reduce(df, key, "temperature", seq, ["timestamp", "temperature"], chunk_rows)


def rolling_fold(df: DataFrame, content: Reduce, key: str, seq: str = "event_id", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A user's rolling reduce: per input row, in the order of ``seq``, the record reduced so
    far → ``seq``, ``key`` and the content's columns.

    The function must be associative.  A hot key's chunks are reduced side by side; the records
    reduced before each chunk - one row for each chunk of a key - are handed to it, and the
    chunks are run through again, each on its own."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema}
    own = list(content.columns)
    rows = chunked(df.select(*dict.fromkeys([seq, key, *own])), [key], F.col(seq), chunk_rows).withColumn(_CHUNK, F.coalesce(_CHUNK, F.lit(-1)))
    ends_ddl = f"`{key}` {fields[key]}, {_CHUNK} long, {content.STATE}"
    out_ddl = f"`{seq}` {fields[seq]}, `{key}` {fields[key]}, {content.OUTPUT}"
    ends, out = arrow_schema(ends_ddl), arrow_schema(out_ddl)

    def table(columns: list, schema: pa.Schema) -> pa.Table:
        return pa.table([pa.array(list(c), f.type, from_pandas=False) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def states(rows: pa.Table, state: tuple) -> list[tuple]:
        made = []
        for row in zip(*(rows.sort_by(seq)[c].to_pylist() for c in own), strict=True):
            state = content.merge(state, row)
            made.append(state)
        return made

    def end(rows: pa.Table) -> pa.Table:
        return table([[rows[key][0].as_py()], [rows[_CHUNK][0].as_py()], *([v] for v in states(rows, content.create())[-1])], ends)

    def before(rows: pa.Table) -> pa.Table:
        rows, state, made = rows.sort_by(_CHUNK), content.create(), []
        for row in zip(*(rows[c].to_pylist() for c in ends.names), strict=True):
            made.append((*row[:2], *state))
            state = content.merge(state, row[2:])
        return table(list(zip(*made, strict=True)), ends)

    def run(rows: pa.Table, held: pa.Table) -> pa.Table:
        start = tuple(held[c][0].as_py() for c in ends.names[2:]) if len(held) else content.create()
        made = states(rows, start)
        return table([rows.sort_by(seq)[seq].to_pylist(), rows[key].to_pylist(), *zip(*made, strict=True)], out) if made else out.empty_table()

    carried = (rows.filter(F.col(_CHUNK) >= 0).groupBy(key, _CHUNK).applyInArrow(end, ends_ddl)
               .groupBy(key).applyInArrow(before, ends_ddl))
    return rows.groupBy(key, _CHUNK).cogroup(carried.groupBy(key, _CHUNK)).applyInArrow(run, out_ddl)
