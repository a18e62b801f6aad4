"""String and scalar helpers of the reading records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fahrenheit_to_celsius(col: str | Column) -> Column:
    """(t - 32) * (5/9) in this operand order, so results are bit-equal to the reference."""
    return (_c(col) - F.lit(32)) * F.lit(5.0 / 9.0)


def split_java(col: str | Column, sep: str = "_") -> Column:
    """``String.split(sep)`` semantics: trailing empty pieces are dropped.

    ``''`` → ``['']``; ``'a__'`` → ``['a']``; ``'_a'`` → ``['', 'a']``; ``'___'`` → ``[]``.
    ``sep`` is a literal separator (regex-escaped here).
    """
    s = _c(col)
    esc = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    stripped = F.regexp_replace(s, f"({esc})+$", "")
    return (
        F.when(s == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, esc))
    )


def reading_text(id_col: str | Column = "id", ts_col: str | Column = "timestamp",
                 temp_col: str | Column = "temperature") -> Column:
    """``(id, timestamp, temperature)`` — the reading's printed form."""
    return F.concat(F.lit("("), _c(id_col), F.lit(", "), _c(ts_col).cast("string"),
                    F.lit(", "), _c(temp_col).cast("string"), F.lit(")"))


def alert_message(id_col="id", ts_col="timestamp", temp_col="temperature") -> Column:
    return F.concat(F.lit("Risk of fire!"), reading_text(id_col, ts_col, temp_col))


def freezing_message(id_col: str | Column = "id") -> Column:
    return F.concat(F.lit("Freezing Alarm for "), _c(id_col))
