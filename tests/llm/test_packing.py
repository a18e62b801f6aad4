"""Operator 7 against all choices of boundaries and plain batching."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import SF
from thermoflux.llm import buckets
from thermoflux.llm.common import tokenizer_path
from thermoflux.llm.queries import QUERIES


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_optimal(seed):
    r = random.Random(seed)
    cells = sorted((t, r.randint(1, 30)) for t in r.sample(range(0, 60), 9))
    for k in (1, 2, 3, 4, 12):
        def cost(tops):
            return sum(n * min(b for b in tops if b >= t) for t, n in cells)

        inner = [t for t, _ in cells[:-1]]
        least = min(cost((*c, cells[-1][0])) for size in range(min(k, 9)) for c in itertools.combinations(inner, size))
        got = buckets.boundaries(cells, k)
        assert got == sorted(set(got)) and len(got) <= k and got[-1] == cells[-1][0] and cost(got) == least
    assert buckets.boundaries([], 4) == []


def check(docs, k=4, budget=300):
    rows = docs.select("doc_id", "text").collect()
    got = buckets.pack_words(docs, k, budget).withColumnRenamed("n_words", "n_tokens").collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == sorted(((r.doc_id, words(r.text)) for r in rows), key=str)
    lengths = sorted({r.n_tokens for r in got})
    cells = [(n, sum(r.n_tokens == n for r in got)) for n in lengths]
    if lengths[-1] <= buckets.EXACT_CELLS:
        tops = buckets.boundaries(cells, k)
        assert all(r.bucket_length == min(t for t in tops if t >= r.n_tokens) for r in got)
    for b in {r.bucket for r in got}:
        own = sorted((r for r in got if r.bucket == b), key=lambda r: (r.batch, r.slot))
        top = own[0].bucket_length
        fits = max(1, budget // max(1, top))
        assert {r.bucket_length for r in own} == {top} and max(r.n_tokens for r in own) == top
        assert [(r.batch, r.slot) for r in own] == [(i // fits, i % fits) for i in range(len(own))]
        assert [r.padding for r in own] == [top - r.n_tokens for r in own]
        ids = [(r.doc_id is not None, r.doc_id or 0) for r in own]
        assert ids == sorted(ids)


def test_rows(spark, odd, none, documents):
    check(odd)
    check(documents, 6, 2000)
    assert buckets.pack_words(none).count() == 0


def test_one_bucket_over_many_partitions(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    check(docs.repartition(7), 4, 8)
    same = spark.range(500).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a").alias("text"))
    check(same, 2, 10)


def test_cells_hold_every_length(spark):
    n = spark.range(0, 300_000, 37).select(F.col("id").alias("n")).withColumn("cell", buckets.histogram_cell(F.col("n")))
    r = n.agg(F.countDistinct("cell").alias("cells"), F.min(F.col("n") - F.col("cell")).alias("least"),
              F.max((F.col("n") - F.col("cell")) / F.greatest(F.col("n"), F.lit(1))).alias("wide")).first()
    assert r.cells < 4000 and r.least >= 0 and r.wide < 1 / 200


def test_long_texts_are_padded_nearly_as_little_as_can_be(spark):
    """Above ``EXACT_CELLS`` lengths share cells: padded length within 0.4 % of the exact optimum."""
    r = random.Random(11)
    lengths = [int(1.3 ** r.uniform(22, 42)) for _ in range(1500)]
    assert min(lengths) < buckets.EXACT_CELLS < 4 * buckets.EXACT_CELLS < max(lengths)
    docs = spark.createDataFrame([(i, "x", n) for i, n in enumerate(lengths)], "doc_id long, text string, n long")
    got = buckets.pack_words(docs, 8, 8192, F.col("n")).collect()
    tops = buckets.boundaries(sorted((n, lengths.count(n)) for n in set(lengths)), 8)
    least = sum(min(t for t in tops if t >= n) for n in lengths)
    assert least <= sum(x.bucket_length for x in got) <= 1.004 * least


def test_query_packs_by_tokens(spark, documents, odd, none):
    """The registered query fills its budget with tokens of the vocabulary, not words."""
    library = Tokenizer.from_file(tokenizer_path())
    tokens = lambda text: len(library.encode(text or "", add_special_tokens=False).ids)
    for docs, got in ((documents, QUERIES["op7_length_buckets"](spark, SF)), (odd, buckets.pack_tokens(odd))):
        got = got.collect()
        assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == sorted(((r.doc_id, tokens(r.text)) for r in docs.collect()), key=str)
        filled = {}
        for r in got:
            filled.setdefault((r.bucket, r.batch), []).append(r)
        assert all(len(rows) == 1 or sum(r.n_tokens + r.padding for r in rows) <= 8192 for rows in filled.values())
    assert buckets.pack_tokens(none).count() == 0
    unspaced = spark.createDataFrame([(1, "中文" * 900), (2, "a b")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in buckets.pack_tokens(unspaced).collect()}[1] == tokens("中文" * 900) > 900
