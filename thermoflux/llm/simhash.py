"""SimHash near-duplicates by a Gray-order hierarchical index (operator 4).

Each document gets a 64-bit fingerprint (map-only).  Equal fingerprints are folded first, so a
group of copies of any size is one node from then on.  Two fingerprints that differ in at most
``bits`` bits agree in one of ``bits + 1`` blocks of bits, so nodes are dealt by (block mask,
value).  Buckets above ``BUCKET_ROWS`` nodes are dealt again: the bits that vary in one are cut
into ``bits + 1`` blocks and the same argument holds inside the bucket; so it goes on until no
bucket is larger.  A task holds no more than a bucket and ``GATHER_ROWS`` nodes; nothing is capped.

In a bucket the nodes are sorted by Gray rank, so neighbours share long bit patterns.  Runs of
``FAN`` nodes get a parent that holds the bits on which all of them agree, runs of parents get
theirs, and children keep only the bits that the parent does not have.  A search goes down from
the top, adds up the differences on each node's bits, and drops a whole group when the sum is
above the bound.  Links are folded by union-find, so a task emits at most one edge per node,
never all pairs; the edges' connected components are found by large-star/small-star rounds.

Defined cases: a null or empty text has fingerprint zero and links like any other; a null
``doc_id`` row keeps its row and shares its component, whose id is the smallest non-null
``doc_id`` (null if there is none); repeated rows are repeated; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from thermoflux.llm.common import as_text, map_texts, written

#: Nodes in a bucket above which it is dealt again; children of a node of the index; nodes
#: that a task gathers before it searches.
BUCKET_ROWS, FAN, GATHER_ROWS = 20_000, 16, 60_000
FULL = (1 << 64) - 1


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    words = text.encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        hashes = np.array([xxh64_intdigest(joined, seed)], np.uint64)
    else:
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        ends = (starts[shingle:] - 1).tolist()
        starts = starts.tolist()
        hashes = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends)), np.uint64, n - shingle + 1)
    count = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 15):
        count += np.unpackbits(hashes[a:a + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view(np.uint64)[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_hash, fp); the hash is that of Spark's ``xxhash64`` of the text."""
    def work(keys: list, texts: list[str]) -> dict:
        return {"doc_id": keys, "text_hash": [signed(xxh64_intdigest(t.encode(), 42)) for t in texts],
                "fp": [signed(fingerprint(t, shingle, seed)) for t in texts]}

    return map_texts(docs, work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash bigint, fp bigint")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence: the running parity from the highest bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """``levels[0]`` are the codes in Gray order; each level has (own bits, mask of own bits)
    and the level above covers runs of ``FAN`` of its nodes."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        pattern, mask = codes[self.order], np.full(len(codes), FULL, np.uint64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while len(pattern) > FAN:
            heads = np.arange(0, len(pattern), FAN)
            any_one = np.bitwise_or.reduceat(pattern & mask, heads)
            all_one = np.bitwise_and.reduceat(pattern | ~mask, heads)
            shared = np.bitwise_and.reduceat(mask, heads) & ~(any_one ^ all_one)
            parent = all_one & shared
            self.levels.append((pattern, mask & ~np.repeat(shared, FAN)[:len(pattern)]))  # what the parent lacks
            pattern, mask = parent, shared
        self.levels.append((pattern, mask))

    def search(self, queries: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, code number) of all within ``bits`` bits."""
        pattern, mask = self.levels[-1]
        q = np.repeat(np.arange(len(queries)), len(pattern))
        node = np.tile(np.arange(len(pattern)), len(queries))
        spent = np.zeros(len(q), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            pattern, mask = self.levels[depth]
            spent = spent + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            keep = spent <= bits
            q, node, spent = q[keep], node[keep], spent[keep]
            if depth:
                below = len(self.levels[depth - 1][0])
                q, spent = np.repeat(q, FAN), np.repeat(spent, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                inside = node < below
                q, node, spent = q[inside], node[inside], spent[inside]
        return q, self.order[node]


def local_links(codes: np.ndarray, bits: int, labels: np.ndarray, block: int = 256) -> None:
    """Unite the labels (indices of roots) of codes of one bucket within ``bits`` bits."""
    index = GrayIndex(codes)
    for at in range(0, len(codes), block):
        own = np.arange(at, min(at + block, len(codes)))
        q, c = index.search(codes[own], bits)
        unite(labels, own[q], c)


def unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union by smallest root; links inside a class fall away in bulk before any loop."""
    while len(a):
        x, y = labels[a], labels[b]
        far = x != y
        if not far.any():
            return
        a, b = a[far], b[far]
        lo, hi = np.minimum(x[far], y[far]), np.maximum(x[far], y[far])
        np.minimum.at(labels, hi, lo)
        while True:  # roots of roots
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def split_mask(free: int, parts: int) -> list[int]:
    """Cut the set bits of ``free`` into ``parts`` blocks of about equal size."""
    bits = [i for i in range(64) if free >> i & 1]
    cuts = [round(k * len(bits) / parts) for k in range(parts + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def large_buckets(rows: DataFrame, bits: int, bucket_rows: int) -> DataFrame:
    """(mask, value, finer): buckets above ``bucket_rows`` nodes that can be dealt again, and
    the masks to do so: all bits that agree in the bucket, and a block of those that vary."""
    schema = pa.schema([("mask", pa.int64()), ("value", pa.int64()), ("finer", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            finer = [[signed(FULL & ~v | c) for c in split_mask(v, bits + 1)] for v in batch.column("varying").cast(pa.int64()).to_numpy().view(np.uint64).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("mask"), batch.column("value"), pa.array(finer, schema.field("finer").type)], schema=schema)

    varying = F.bit_or("fp").bitwiseXOR(F.bit_and("fp"))
    sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"), varying.alias("varying"))
    return (sizes.where((F.col("n") > bucket_rows) & (F.bit_count("varying") > bits)).select("mask", "value", "varying")
            .mapInArrow(run, "mask bigint, value bigint, finer array<bigint>"))


def dealt(nodes: DataFrame, bits: int, bucket_rows: int) -> DataFrame:
    """(mask, value, fp): nodes in buckets such that every two within ``bits`` bits share one.

    ``bits`` + 1 blocks of bits deal them at first.  A bucket above ``bucket_rows`` is dealt
    again by as many blocks of the bits that vary in it, and again while one is too large: each
    time fewer bits vary, and n nodes vary in log2(n) bits at least, so this ends."""
    def by(rows: DataFrame) -> DataFrame:
        return rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))

    rows = by(nodes.select("fp", F.explode(F.array(*[F.lit(signed(m)) for m in split_mask(FULL, bits + 1) if m])).alias("mask")))
    done = []
    while True:
        hot = written(large_buckets(rows, bits, bucket_rows), "buckets")
        if hot.isEmpty():
            break
        done.append(rows.join(hot, ["mask", "value"], "left_anti").select("mask", "value", "fp"))
        again = rows.join(hot, ["mask", "value"]).select("fp", F.explode("finer").alias("mask"))
        rows = written(by(again.distinct()), "finer")
    for cold in done:
        rows = rows.select("mask", "value", "fp").unionByName(cold)
    return rows


def links(nodes: DataFrame, bits: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges (a, b), b < a, over distinct fingerprints ``fp``: their connected components are
    those of all pairs within ``bits`` bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition holds whole buckets, sorted; they are searched some at a time."""
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def bounds(mask: np.ndarray, value: np.ndarray) -> np.ndarray:
            return np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1

        def edges(mask: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            codes, number = np.unique(fp.view(np.uint64), return_inverse=True)
            labels = np.arange(len(codes))
            cut = bounds(mask, value)
            small = np.diff(np.concatenate([[0], cut, [len(fp)]]))
            bucket = np.repeat(np.arange(len(small)), small)
            # Buckets of up to FAN nodes: compare at each distance in the sorted array at once.
            for d in range(1, min(FAN, int(small.max(initial=0)))):
                a = np.flatnonzero((bucket[d:] == bucket[:-d]) & (small[bucket[d:]] <= FAN))
                near = np.bitwise_count(codes[number[a]] ^ codes[number[a + d]]) <= bits
                unite(labels, number[a[near]], number[a[near] + d])
            for k in np.flatnonzero(small > FAN):
                a = 0 if k == 0 else int(cut[k - 1])
                own = number[a:a + int(small[k])]
                inner = np.arange(len(own))
                local_links(codes[own], bits, inner)
                unite(labels, own, own[inner])
            child = np.flatnonzero(labels != np.arange(len(labels)))
            ids = codes.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ids[child]), pa.array(ids[labels[child]])], names=["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)))
            size += batch.num_rows
            if size >= GATHER_ROWS:
                columns = tuple(np.concatenate(c) for c in zip(*held, strict=True))
                cut = bounds(*columns[:2])
                if len(cut):  # the last bucket may go on; it is bounded
                    yield edges(*(c[:cut[-1]] for c in columns))
                    columns = tuple(c[cut[-1]:] for c in columns)
                held, size = [columns], len(columns[0])
        if size:
            yield edges(*(np.concatenate(c) for c in zip(*held, strict=True)))

    key = ["mask", "value"]
    return dealt(nodes, bits, bucket_rows).select(*key, "fp").repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); the root is the smallest node.

    Large-star: each node gives its greater neighbours its smallest neighbour.  Small-star:
    each node gives its smaller neighbours their smallest.  Rounds of both end in stars."""
    def star(e: DataFrame, both: bool) -> DataFrame:
        """Smallest neighbour of each node, and edges to it; aggregated before any join."""
        near = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both else e
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = near.join(least, "a")
        if both:
            return moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))

    def clean(e: DataFrame) -> DataFrame:
        return written(e.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    now = clean(edges)
    if now.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        after = clean(star(clean(star(now, True)), False))
        if not open_stars(after):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = after


def open_stars(e: DataFrame) -> bool:
    """Whether a root still has a root, or a node has two."""
    twice = not e.groupBy("a").count().where("count > 1").isEmpty()
    return twice or not e.select(F.col("b").alias("a")).distinct().join(e, "a", "left_semi").isEmpty()


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for each row of ``docs``; ``root`` tells
    components apart even where they have no or the same smallest id."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(links(nodes, bits, bucket_rows))
    rooted = nodes.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    class_of = rooted.join(least, "root").select("fp", "root", "component_id")
    return prints.join(class_of, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """The row of the smallest (doc_id, text hash) of each component, null ids last; all
    columns of ``docs``."""
    near = near_duplicates(docs, shingle, bits)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    first = near.groupBy("root").agg(F.min(order).alias("r")).select(F.col("r.doc_id").alias("i"), F.col("r.text_hash").alias("h")).distinct()
    text_hash = "text_hash"
    while text_hash in docs.columns:
        text_hash += "_"
    keyed = docs.withColumn(text_hash, F.xxhash64(as_text(docs)))
    chosen = keyed.join(first, keyed["doc_id"].eqNullSafe(F.col("i")) & (keyed[text_hash] == F.col("h")), "left_semi")
    return chosen.dropDuplicates(["doc_id", text_hash]).select(*docs.columns)


def fingerprint_text(fp: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
