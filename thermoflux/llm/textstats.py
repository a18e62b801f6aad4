"""Whole-text statistics shared by the quality rules and the quality classifier.

Words are runs of anything but U+0020 and U+0009..U+000D.  A null text counts as empty, and
every statistic of an empty text is 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Counted characters of `[#*$%&|<>]`.
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper",
          "n_digits", "n_bangs", "n_stops", "n_commas", "n_quotes", "n_chars"]


def repeat_words(ids: np.ndarray) -> int:
    """Words in 3-word windows that occur twice or more, the first included."""
    n = len(ids)
    if n < 4:
        return 0
    key = ids[:-2] * n + ids[1:-1]
    if n >= 1 << 20:  # keep the product below 2**63
        key = np.unique(key, return_inverse=True)[1]
    key = key * n + ids[2:]
    run = np.sort(key)
    twice = run[1:][run[1:] == run[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(key, twice))
    covered = np.zeros(n, bool)
    covered[at] = covered[at + 1] = covered[at + 2] = True
    return int(covered.sum())


def text_counts(text: str | None) -> list[int]:
    """The counts of ``COUNTS``, in that order."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    place = dict(zip(words, range(n), strict=True))
    repeats = repeat_words(np.fromiter(map(place.__getitem__, words), np.int64, n)) if len(place) < n else 0
    c = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = len(data) - int(c[0x80:0xC0].sum())
    spaces = int(c[0x20] + c[9:14].sum())
    of = lambda s: int(c[list(s)].sum())
    return [n, chars - spaces, of(SYMBOLS), len(lines) - len(set(lines)), repeats, len(lines), len(place), int(c[0x41:0x5B].sum()),
            int(c[0x30:0x3A].sum()), of(b"!?"), of(b"."), of(b",;:"), of(b"\"'()[]{}"), chars]


def _counts(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_counts(t) for t in text], columns=COUNTS, dtype="int64")


def counts_of(text: Column) -> Column:
    """Struct of the counts of a text column."""
    fields = ", ".join(f"{c} bigint" for c in COUNTS)
    return F.pandas_udf(_counts, fields)(text.cast("string"))


#: Rates that rules test, by name: numerator and denominator among the counts.
RATES = {
    "word_length": ("word_chars", "n_words"), "symbol_rate": ("n_symbols", "n_chars"), "dup_line_rate": ("n_dup_lines", "n_lines"),
    "repeat_rate": ("n_repeat_words", "n_words"), "distinct_rate": ("n_distinct", "n_words"), "upper_rate": ("n_upper", "n_chars"),
    "digit_rate": ("n_digits", "n_chars"), "bang_rate": ("n_bangs", "n_words"), "stop_rate": ("n_stops", "n_words"),
    "comma_rate": ("n_commas", "n_words"), "quote_rate": ("n_quotes", "n_chars"), "line_words": ("n_words", "n_lines"),
}
FEATURES = ["n_words", "n_lines", *RATES]


def feature_columns(counts: Column) -> dict[str, Column]:
    """The features as JVM expressions over a struct of counts; a rate over 0 is 0."""
    out = {name: counts[name].cast("double") for name in ("n_words", "n_lines")}
    for name, (a, b) in RATES.items():
        out[name] = F.when(counts[b] > 0, counts[a].cast("double") / counts[b].cast("double")).otherwise(F.lit(0.0))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, usable: Column | None = None) -> pd.DataFrame:
    """Features and label of at most ``rows`` labelled documents, in ``doc_id`` order.

    The labels with the least hashes of ``doc_id`` are taken, so the sample has its bound at
    any scale and is the same at every run; broadcasting it is bounded by it too.  Of repeated
    labels of a document the least counts; null labels and ids are left out.
    """
    good = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if usable is not None:
        good = good.where(usable)
    one = good.groupBy("doc_id").agg(F.min(label).alias("label"))
    # Hashes are even over their range: a range that holds the least ``rows`` with room to
    # spare goes first, so no more than about twice as many reach the task that sorts them.
    hashed, share = F.xxhash64("doc_id"), (1.5 * rows + 1000) / max(1, one.count())
    if share < 1:
        one = one.where(hashed < int(-(1 << 63) + share * (1 << 64)))
    few = one.orderBy(hashed, "doc_id").limit(rows)
    docs = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").withColumn("c", counts_of(F.col("text")))
    wide = docs.select("doc_id", "label", *[c.alias(n) for n, c in feature_columns(F.col("c")).items()])
    # Documents that repeat an id fold to one row before anything reaches the driver.
    return wide.groupBy("doc_id", "label").agg(*[F.min(c).alias(c) for c in FEATURES]).toPandas().sort_values("doc_id", ignore_index=True)
