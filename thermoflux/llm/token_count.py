"""Token counts by heap-and-linked-list byte-pair merging (operator 1).

A word's symbols form a linked list; a heap holds its adjacent pairs by rank, then place.
The lowest pair is popped again and again, merged, and its new neighbours pushed.  The count
is the number of initial symbols minus the merges: no identifiers are made.

Defined cases: a null or empty text has 0 tokens and 0 bytes; repeated rows give repeated
rows; a null ``doc_id`` is kept; an empty table gives no rows; only ``doc_id`` and ``text``
are read, so extra columns never clash; strings of special tokens inside a text count as
one token each, as the library's default has it.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoflux.llm.common import map_texts, tokenizer_path
from thermoflux.llm.pretokens import Vocabulary, WordCache, parts_of, split_texts, vocabulary

SHIFT = 24


@lru_cache(maxsize=2)
def packed_merges(path: str) -> tuple[Vocabulary, dict[int, int]]:
    """Merges as one int -> int dict: left << 24 | right -> rank << 24 | new symbol."""
    v = vocabulary(path)
    return v, {a << SHIFT | b: r << SHIFT | c for (a, b), (r, c) in v.merges.items()}


def count_symbols(word: bytes, first: list[int], merges: dict[int, int]) -> int:
    """Symbols left when no adjacent pair of ``word`` has a rank."""
    n = len(word)
    if n < 2:
        return n
    low = (1 << SHIFT) - 1
    symbol = [first[b] for b in word]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap, get = [], merges.get
    for i in range(n - 1):  # an entry: rank, place, new symbol
        m = get(symbol[i] << SHIFT | symbol[i + 1])
        if m is not None:
            heap.append((m >> SHIFT) << 64 | i << SHIFT | m & low)
    heapq.heapify(heap)
    merged, place = 0, (1 << 40) - 1
    while heap:
        top = heapq.heappop(heap)
        i, new = top >> SHIFT & place, top & low
        j = after[i]
        if symbol[i] < 0 or j >= n:
            continue
        m = get(symbol[i] << SHIFT | symbol[j])
        if m is None or m >> SHIFT != top >> 64 or m & low != new:
            continue  # a neighbour has changed since
        merged += 1
        symbol[i], symbol[j] = new, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            m = get(new << SHIFT | symbol[k])
            if m is not None:
                heapq.heappush(heap, (m >> SHIFT) << 64 | i << SHIFT | m & low)
        h = before[i]
        if h >= 0:
            m = get(symbol[h] << SHIFT | new)
            if m is not None:
                heapq.heappush(heap, (m >> SHIFT) << 64 | h << SHIFT | m & low)
    return n - merged


@lru_cache(maxsize=1)
def _cache(path: str) -> WordCache:
    return WordCache()


def count_texts(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text."""
    vocab, merges = packed_merges(path)
    cache, added = _cache(path), {w.encode() for w in vocab.added}
    out = np.zeros(len(texts), np.int64)
    for parts in parts_of(texts):
        words = split_texts([p for _, p in parts], tuple(vocab.added))
        counts, missing = cache.known(words.distinct)
        for k in missing:
            w = words.distinct[k]
            counts[k] = 1 if w in added else count_symbols(w, vocab.first, merges)
            cache.keep(w, counts[k])
        sums = np.concatenate([[0], np.cumsum(np.array(counts, np.int64)[words.codes])])
        np.add.at(out, [k for k, _ in parts], sums[words.bounds[1:]] - sums[words.bounds[:-1]])
    return out


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``; map-only."""
    path = path or tokenizer_path()

    def work(keys: list, texts: list[str]) -> dict:
        return {"doc_id": keys, "n_bytes": [len(t.encode()) for t in texts], "n_tokens": count_texts(texts, path)}

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, work, f"doc_id {key}, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
