"""Operator 4 against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from thermoflux.llm import simhash


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(codes, bits=3):
    parent = list(range(len(codes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(codes))]


def near_codes(n, seed, flips=4):
    r, out = random.Random(seed), []
    while len(out) < n:
        base = r.getrandbits(64)
        for _ in range(r.randint(1, 12)):
            c = base
            for _ in range(r.randint(0, flips)):
                c ^= 1 << r.randrange(64)
            out.append(c)
            base = c if r.random() < 0.3 else base
    return sorted(set(out[:n]))


@pytest.mark.parametrize("text", [None, "", "One", "one TWO", "A b c d É e", "x\x1cy z\x85w v", "r " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == plain_fingerprint(text)


def test_gray_index_finds_every_pair():
    codes = np.array(near_codes(1500, 1), np.uint64)
    q, c = simhash.GrayIndex(codes).search(codes, 3)
    want = {(i, j) for i in range(len(codes)) for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= 3).tolist()}
    assert set(zip(q.tolist(), c.tolist(), strict=True)) == want


@pytest.mark.parametrize("bucket_rows", [20_000, 9, 2])
def test_components_are_those_of_all_pairs(spark, bucket_rows):
    """Small bounds deal buckets again and then to several tasks; no link may be lost."""
    codes = near_codes(400, 2) + [0, 1, 3, 7, 15, 31] + [1 << i | 1 << j for i in range(8) for j in range(8)]
    codes = sorted(set(codes))
    want = classes(codes)
    df = spark.createDataFrame([(simhash.signed(c),) for c in codes], "fp long")
    found = simhash.components(simhash.links(df, 3, bucket_rows)).collect()
    root = {r.node: r.root for r in found}
    groups, wanted = {}, {}
    for c, w in zip(codes, want, strict=True):
        groups.setdefault(root.get(simhash.signed(c), simhash.signed(c)), set()).add(c)
        wanted.setdefault(w, set()).add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


@pytest.mark.parametrize("bucket_rows", [200, 20])
def test_dense_buckets_are_dealt_until_they_are_small(spark, bucket_rows):
    """A cluster that is dense in a few bits: no task gets it whole, and no link is lost."""
    bits = [1 << k for k in (0, 1, 2, 17, 18, 33, 34, 35, 60, 63)]
    codes = [sum(b for k, b in enumerate(bits) if i >> k & 1) ^ 0x0123456789ABCDEF for i in range(1 << len(bits))]
    df = spark.createDataFrame([(simhash.signed(c),) for c in codes], "fp long")
    buckets = {}
    for r in simhash.dealt(df, 3, bucket_rows).collect():
        buckets.setdefault((r.mask, r.value), set()).add(r.fp & simhash.FULL)
    assert max(map(len, buckets.values())) <= max(bucket_rows, 8) and sum(map(len, buckets.values())) < 128 * len(codes)
    met = {(a, b) for own in buckets.values() if len(own) < 400 for a in own for b in own if (a ^ b).bit_count() <= 3}
    assert met == {(a, b) for a in codes for b in codes if (a ^ b).bit_count() <= 3}


def test_long_chain_of_edges(spark):
    n = 200
    order = list(range(n))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame([(max(a, b), min(a, b)) for a, b in zip(order, order[1:], strict=False)], "a long, b long")
    assert {(r.node, r.root) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(n)}


def check(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    codes = [plain_fingerprint(r.text) for r in rows]
    groups = classes(codes)
    least = {g: min((r.doc_id for r, x in zip(rows, groups, strict=True) if x == g and r.doc_id is not None), default=None) for g in set(groups)}
    want = sorted(((r.doc_id, f"{c:016x}", least[g]) for r, c, g in zip(rows, codes, groups, strict=True)), key=str)
    found = simhash.near_duplicates(docs).select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("f"), "component_id")
    assert sorted(map(tuple, found.collect()), key=str) == want


def test_odd_rows(spark, odd, none):
    check(spark, odd)
    assert simhash.near_duplicates(none).count() == 0


def test_table(spark, documents):
    check(spark, documents)


def test_one_row_of_each_component_stays(spark, odd, none):
    rows = odd.select("doc_id", "text").collect()
    groups = classes([plain_fingerprint(r.text) for r in rows])
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and simhash.one_of_each(none).count() == 0
    got = kept.select("doc_id", "text").collect()
    assert len(got) == len(set(groups))
    of = {(r.doc_id, r.text): g for r, g in zip(rows, groups, strict=True)}
    assert {of[tuple(r)] for r in got} == set(groups)
    for r in got:
        ids = [x.doc_id for x, g in zip(rows, groups, strict=True) if g == of[tuple(r)] and x.doc_id is not None]
        assert r.doc_id == min(ids, default=None)
