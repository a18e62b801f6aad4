"""BPE encoding and decoding with a pair occurrence index (operator 10).

The distinct words of a stretch of a partition lie end to end as one array of symbols linked
to their neighbours.  An index maps each mergeable pair, by its rank, to all its positions.
The lowest active rank is taken again and again: its positions are merged at once, and the
pairs that this makes are added to the lists of their ranks.  Runs like ``aaa`` of one pair
are merged from the left.  Work goes by stretches of bounded size, so a partition of any
size fits in memory; results do not depend on where a stretch ends.

Defined cases: a null or empty text has no identifiers and decodes to the empty text;
repeated rows give repeated rows; an empty table gives no rows; only ``doc_id`` and ``text``
are read; strings of special tokens become that token, as the library's default has it;
identifiers that do not form UTF-8 decode with U+FFFD for each faulty part, as in the library.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from thermoflux.llm.common import as_text, text_chunks, tokenizer_path
from thermoflux.llm.pretokens import WordCache, Words, gather, parts_of, split_texts, vocabulary

#: A stretch ends at so many characters of text or so many distinct new words.
STRETCH_CHARS, STRETCH_WORDS = 12 << 20, 200_000


@dataclass
class Tables:
    """The vocabulary as arrays: pairs sorted by left << 32 | right, and by rank."""

    first: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    by_rank: list[tuple[int, int, int]]
    flat: np.ndarray
    offsets: np.ndarray
    sizes: np.ndarray
    added: dict[str, int]


@lru_cache(maxsize=2)
def tables(path: str) -> Tables:
    v = vocabulary(path)
    pairs = np.array([a << 32 | b for a, b in v.merges], np.int64)
    ranks = np.array([r for r, _ in v.merges.values()], np.int64)
    order = np.argsort(pairs)
    by_rank: list[tuple[int, int, int]] = [(0, 0, 0)] * (int(ranks.max(initial=-1)) + 1)
    for (a, b), (r, c) in v.merges.items():
        by_rank[r] = (a, b, c)
    sizes = np.array([len(x) for x in v.bytes_of], np.int64)
    return Tables(np.array(v.first, np.int64), pairs[order], ranks[order], by_rank, np.frombuffer(b"".join(v.bytes_of), np.uint8), np.cumsum(sizes) - sizes, sizes, v.added)


def encode_words(words: list[bytes], t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the words end to end, and where each word's begin."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens)
    n = int(ends[-1]) if len(words) else 0
    symbol = t.first[np.frombuffer(b"".join(words), np.uint8)]
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    filled = lens > 0
    after[ends[filled] - 1] = -1
    before[(ends - lens)[filled]] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(places: np.ndarray) -> None:
        """List the pairs that begin at ``places`` under their ranks."""
        places = places[after[places] >= 0]
        key = symbol[places] << 32 | symbol[after[places]]
        at = np.minimum(np.searchsorted(t.pairs, key), len(t.pairs) - 1)
        found = t.pairs[at] == key
        places, rank = places[found], t.ranks[at[found]]
        if not len(places):
            return
        order = np.argsort(rank, kind="stable")
        places, rank = places[order], rank[order]
        cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        edges = [0, *cut.tolist(), len(rank)]
        for a, b, r in zip(edges[:-1], edges[1:], rank[[0, *cut]].tolist(), strict=True):
            held = index.get(r)
            if held is None:
                index[r] = [places[a:b]]
                heapq.heappush(active, r)
            else:
                held.append(places[a:b])

    if n and len(t.pairs):
        add(np.arange(n))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        left, right, new = t.by_rank[r]
        p = lists[0] if len(lists) == 1 else np.concatenate(lists)
        p = p[symbol[p] == left]
        q = after[p]
        keep = q >= 0
        keep[keep] = symbol[q[keep]] == right
        p = p[keep]
        if not len(p):
            continue
        if len(lists) > 1 or left == right:
            p = np.unique(p)
        if left == right and len(p) > 1:
            # In a run of overlapping pairs every second one is merged, from the left.
            fresh = np.concatenate([[True], after[p[:-1]] != p[1:]])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(p)), 0))
            p = p[(np.arange(len(p)) - run) % 2 == 0]
        q = after[p]
        symbol[p], symbol[q] = new, -1
        k = after[q]
        after[p] = k
        before[k[k >= 0]] = p[k >= 0]
        h = before[p]
        add(np.unique(np.concatenate([p, h[h >= 0]])))
    alive = symbol >= 0
    kept = np.concatenate([[0], np.cumsum(alive)])
    return symbol[alive].astype("<u4"), kept[np.concatenate([[0], ends])]


def decode_ids(ids: np.ndarray, t: Tables) -> bytes:
    """Bytes of the identifiers end to end."""
    each = t.sizes[ids]
    ends = np.cumsum(each)
    return t.flat[np.repeat(t.offsets[ids] - (ends - each), each) + np.arange(int(ends[-1]) if len(ids) else 0)].tobytes()


@lru_cache(maxsize=1)
def _cache(path: str) -> WordCache:
    return WordCache()


class Stretch:
    """Texts whose words wait to be encoded together."""

    def __init__(self, path: str):
        self.t, self.cache = tables(path), _cache(path)
        self.groups: list[tuple[list[int], Words, list]] = []
        self.new: dict[bytes, int] = {}
        self.keys: list = []
        self.chars = 0

    def take(self, keys: list, texts: list[str]) -> None:
        base = len(self.keys)
        self.keys += keys
        for parts in parts_of(texts):
            words = split_texts([p for _, p in parts], tuple(self.t.added))
            values, missing = self.cache.known(words.distinct)
            for k in missing:
                w = words.distinct[k]
                values[k] = self.t.added.get(w.decode()) if w.startswith(b"<") else None
                if values[k] is None:
                    values[k] = self.new.setdefault(w, len(self.new))
                else:
                    values[k] = np.array([values[k]], "<u4").tobytes()
            self.groups.append(([base + k for k, _ in parts], words, values))
            self.chars += sum(len(p) for _, p in parts)

    def full(self) -> bool:
        return self.chars >= STRETCH_CHARS or len(self.new) >= STRETCH_WORDS

    def encoded(self) -> Iterator[tuple[int, np.ndarray]]:
        """(text number, identifiers of a piece of it), in order."""
        new = list(self.new)
        ids, bounds = encode_words(new, self.t)
        made = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for w, v in zip(new, made, strict=True):
            self.cache.keep(w, v)
        for numbers, words, values in self.groups:
            ids, bounds = gather([made[v] if isinstance(v, int) else v for v in values], words)
            for k, a, b in zip(numbers, bounds[:-1], bounds[1:], strict=True):
                yield k, ids[a:b]


def encode_all(texts: list[str], path: str) -> list[np.ndarray]:
    """Identifiers of each text."""
    s = Stretch(path)
    s.take(list(range(len(texts))), texts)
    out: list[list[np.ndarray]] = [[np.zeros(0, "<u4")] for _ in texts]
    for k, ids in s.encoded():
        out[k].append(ids)
    return [np.concatenate(x) for x in out]


def coded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): identifiers as little-endian uint32, and the text that they
    decode to; map-only."""
    return _coded(docs, path, "ids binary, decoded string", lambda ids, text: (ids.tobytes(), text))


def coded_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) by the same encoder and decoder."""
    def digest(ids: np.ndarray, text: str) -> tuple:
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    return _coded(docs, path, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", digest)


def _coded(docs: DataFrame, path: str | None, columns: str, made) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    path = path or tokenizer_path()
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {columns}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def results(s: Stretch) -> Iterator[pa.RecordBatch]:
        """Rows in order, in batches of about a million identifiers; every text has a piece."""
        def batch() -> pa.RecordBatch:
            columns = zip(*((s.keys[k], *made(ids, decode_ids(ids, s.t).decode("utf-8", "replace"))) for k, ids in whole), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        whole, size = [], 0
        for k, pieces in groupby(s.encoded(), key=itemgetter(0)):
            whole.append((k, np.concatenate([ids for _, ids in pieces])))
            size += len(whole[-1][1])
            if size >= 1 << 20:
                yield batch()
                whole, size = [], 0
        if whole:
            yield batch()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Stretch(path)
        for batch in batches:
            for a, b, texts in text_chunks(batch, "t"):
                s.take(batch.column("k").slice(a, b - a).to_pylist(), texts)
                if s.full():
                    yield from results(s)
                    s = Stretch(path)
        if s.keys:
            yield from results(s)

    return docs.select(docs["doc_id"].alias("k"), as_text(docs).alias("t")).mapInArrow(run, schema)
