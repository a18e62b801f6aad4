"""Packing by optimal length buckets (operator 7).

One pass builds the global histogram of lengths.  Dynamic programming over it finds the
``buckets`` boundaries that minimise padding when every document is padded to its bucket's
boundary.  Inside a bucket documents are numbered in ``doc_id`` order and cut into batches that
hold as many documents as the token budget allows at the boundary (one at least).

The histogram has a cell for each length up to ``EXACT_CELLS`` and ``OCTAVE_CELLS`` cells for
each doubling beyond, each with its true greatest length, so the driver gets a few thousand
rows at most whatever the data are.  Boundaries are optimal among the cells' greatest lengths:
the exact optimum up to ``EXACT_CELLS``, within 1 / ``OCTAVE_CELLS`` (0.4 %) of the padded length beyond.
Numbering needs no task per bucket: rows are range-partitioned by (bucket, doc_id), numbered
inside the partition, and moved on by the counts of the partitions before.

Defined cases: null and empty texts have length 0 and pad to their bucket like any other;
a document above the budget is a batch of its own; ties in ``doc_id`` go by the text's hash,
then by place in the input; repeated rows are each packed; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermoflux.llm.common import as_text, map_texts, tokenizer_path, written
from thermoflux.llm.token_count import count_texts

EXACT_CELLS, OCTAVE_CELLS = 1024, 256


def word_length(docs: DataFrame, text: str = "text") -> Column:
    """Words of the whole text; JVM-side."""
    trimmed = F.btrim(as_text(docs, text), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def histogram_cell(n: Column) -> Column:
    """Cell number of a length: itself, or for long ones its octave and leading bits."""
    octave = F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int")
    width = F.greatest(F.lit(1), F.pow(F.lit(2.0), octave).cast("long") / OCTAVE_CELLS).cast("long")
    return F.when(n <= EXACT_CELLS, n).otherwise(F.floor(n / width).cast("long") * width)


def histogram(lengths: DataFrame) -> list[tuple[int, int]]:
    """(greatest length, documents) of each cell, ascending; the bound is given above."""
    cells = lengths.groupBy(histogram_cell(F.col("n")).alias("cell")).agg(F.max("n").alias("top"), F.count(F.lit(1)).alias("docs"))
    return sorted((r["top"], r["docs"]) for r in cells.select("top", "docs").collect())


def boundaries(cells: list[tuple[int, int]], buckets: int) -> list[int]:
    """The boundaries, ascending, that minimise padded length: best[k][j] over the first j
    cells in k buckets is the least of best[k - 1][i] + top of cell j * documents of i..j."""
    if not cells:
        return []
    tops = np.array([t for t, _ in cells], np.float64)
    before = np.concatenate([[0], np.cumsum([d for _, d in cells])]).astype(np.float64)
    n = len(cells)
    best = np.concatenate([[0], tops * before[1:]])
    froms = []
    for _ in range(1, min(buckets, n)):
        now, start = best.copy(), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + tops[j - 1] * (before[j] - before[:j])
            i = int(np.argmin(cost))
            now[j], start[j] = cost[i], i
        froms.append(start)
        best = now
    out, j = [], n
    for start in reversed(froms):
        out.append(int(tops[j - 1]))
        j = int(start[j])
        if j == 0:
            break
    if j:
        out.append(int(tops[j - 1]))
    return out[::-1]


def pack_words(docs: DataFrame, buckets: int = 16, budget: int = 8192, length: Column | None = None) -> DataFrame:
    """(doc_id, n_words, bucket, bucket_length, batch, slot, padding) for each row of ``docs``:
    lengths are words, or ``length``.  No tokenizer is needed; the budget is then one of words."""
    n = length if length is not None else word_length(docs)
    packed = _packed(docs.select("doc_id", F.xxhash64("text").alias("h"), n.alias("n"), F.monotonically_increasing_id().alias("place")), buckets, budget)
    return packed.withColumnRenamed("n_tokens", "n_words")


def pack_tokens(docs: DataFrame, buckets: int = 16, budget: int = 8192, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_length, batch, slot, padding) for each row of ``docs``:
    lengths are tokens of the vocabulary at ``path``, counted in the pass that writes them."""
    path = path or tokenizer_path()

    def work(keys: list, texts: list[str]) -> dict:
        return {"n": count_texts(texts, path)} | {c: [k[c] for k in keys] for c in ("doc_id", "h", "place")}

    key = F.struct("doc_id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("place"))
    keyed = docs.select(key.alias("key"), as_text(docs).alias("text"))
    return _packed(map_texts(keyed, work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, h bigint, n bigint, place bigint", key="key"), buckets, budget)


def _packed(lengths: DataFrame, buckets: int, budget: int) -> DataFrame:
    rows = written(lengths, "lengths")
    tops = boundaries(histogram(rows), buckets)
    bucket, top = F.lit(len(tops) - 1), F.lit(tops[-1] if tops else 0)
    for k in range(len(tops) - 2, -1, -1):
        bucket = F.when(F.col("n") <= tops[k], F.lit(k)).otherwise(bucket)
        top = F.when(F.col("n") <= tops[k], F.lit(tops[k])).otherwise(top)
    order = ["bucket", "doc_id", "h", "place"]
    dealt = rows.select("*", bucket.cast("int").alias("bucket"), top.cast("long").alias("top")).repartitionByRange(*order).sortWithinPartitions(*order)
    # The partition is part of the rows, so it must not change between the two readings.
    dealt = written(dealt.withColumn("part", F.spark_partition_id()), "dealt")
    counts = dealt.groupBy("bucket", "part").count()
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    skipped = counts.select("bucket", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("skipped"))
    inside = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("doc_id", "h", "place")) - 1
    placed = dealt.withColumn("inside", inside).join(skipped, ["bucket", "part"]).withColumn("at", F.col("skipped") + F.col("inside"))
    fits = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("top"), F.lit(1)))).cast("long")
    return placed.select("doc_id", F.col("n").alias("n_tokens"), "bucket", F.col("top").alias("bucket_length"),
                         F.floor(F.col("at") / fits).cast("long").alias("batch"), (F.col("at") % fits).cast("long").alias("slot"),
                         (F.col("top") - F.col("n")).alias("padding"))
