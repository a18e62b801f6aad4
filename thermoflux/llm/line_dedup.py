"""Line deduplication over the whole corpus by deletion neighbourhoods (operator 8).

A line of ``MIN_WORDS`` words or more goes when an earlier line - by (doc_id, text hash, line
number) - equals it or is within the edit bound of it (words put in, left out or replaced).
The bound is one edit, or with ``growing`` one edit for every ``words_per_edit`` words of the
longer line, one at least.  Lines with fewer words stay, or with ``least`` = 1 go when an
earlier line equals them.

1. Equal lines fold to their earliest place by a 128-bit signature, with partial aggregation.
2. Each line gives its rarest word pairs as hashed keys, s + 2 of them where s is the most pairs
   that a partner within the bound may lack (``spoiled_pairs``), so two lines within the bound
   have two keys in common (prefix filter; the order of the pairs is any fixed one, rarest first
   sets only the cost: pairs and words of all documents are counted, by cells).  This loses no
   pair for ``words_per_edit`` of four or more.  Keys are packed by part and run of texts and shuffled once; copies of a line count as
   one line.
3. A key of up to ``SMALL`` lines gives its pairs, if their lengths allow the bound.  Lines of a
   larger key wait.  Pairs that share two small keys, or a small one and a large one, are
   compared, the later line goes.  Parities of word counts go first: an edit turns two bits at
   most, so they rule out no pair within the bound, and texts meet for what they leave.
4. Lines that share large keys alone emit their deletion neighbourhood as hashed keys: all
   variants with one word left out and the line itself, for bounds of one edit; for larger
   bounds, where all variants are too many to emit, all combinations of two of the line's large
   keys (long lines: the large keys).  Lines of an equal key meet as in step 3; those of a larger
   key meet its earliest line first, and only those that it does not settle all earlier lines,
   a pair not again at a key when one of their three least keys has brought it together.

With ``keys``, a line gives at most so many keys, of its runs of words those of least hash.  That
form is not exact: every pair is found up to (keys - 1) // 4 edits, beyond that all but a few.
No registered query uses it.

Texts are fetched for candidate lines alone: a bitmap of ``BITS`` bits of their ids is a filter
without loss in the pass over the texts (when it is full, all lines pass and a join sorts them
out).  Defined cases: a null or empty text has no lines and stays; lines of white space stay; two rows
with equal ``doc_id`` and text are one document and are treated alike; a null ``doc_id`` comes
first; an empty table gives no rows; extra columns are kept, clashing names included.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoflux.llm.common import as_text, text_chunks, written

MIN_WORDS = 5
#: With ``growing``, one edit is allowed for so many words of the longer line.
WORDS_PER_EDIT = 5
#: Bits of the cells of word pairs' counts, least and most; cells of words' counts; cells that
#: are added up at once; steps of a count's level for each power of two.
PAIR_BITS, WORD_CELLS, BLOCK, STEPS = (16, 24), 1 << 20, 1 << 16, 8
#: Cells of the filter of lines whose texts are compared.
CELLS = 1 << 20
#: Lines of a key that are all compared with each other.
SMALL = 12
#: Bits of the filter of candidate lines; its set bits reach the driver.
BITS = 1 << 22
#: Keys of a line in the form that is not exact; the registered query and the pipeline's stage
#: take every key.
KEYS = 9
#: Words in a run: least and most words of lines that give such runs.  Two lines within the
#: bound have one kind in common, and enough of it for two edits.
RUNS = {2: (5, 7), 3: (7, 13), 4: (12, 1 << 40)}
#: Words from which a neighbourhood has single keys, not combinations of two.
LONG = 128
PLACE = ["doc_id", "row_key", "line"]
#: Columns of a line's parities.
PARITY = ["p0", "p1", "p2", "p3"]
#: Columns of the least of a line's large keys of the neighbourhood.
LEAST = ["k0", "k1", "k2"]
#: Bits of the words' hash in a line id, and of a key below its part.
HASH_BITS, KEY_BITS = 40, 36
#: Characters of text whose keys make a part, and keys that are packed at once.
PART_CHARS, RUN_KEYS = 1 << 23, 1 << 20

_tables = np.random.default_rng(8).integers(0, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, b in enumerate((_BASE, _INVERSE)):
            _powers[k] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))])
    return _powers[0][:n], _powers[1][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)  # odd constants spread the bits
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(32)


class Words:
    """The words of a run of texts: byte bounds, two 64-bit hashes each, and their lines."""

    def __init__(self, texts: list[str], hashes: int = 1) -> None:
        self.data = "\n".join(texts).encode()
        b = np.frombuffer(self.data, np.uint8)
        blank = (b == 32) | (b >= 9) & (b <= 13)
        edge = np.diff(np.concatenate([[1], blank, [1]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.breaks = np.flatnonzero(b == 10)
        self.line = np.searchsorted(self.breaks, starts)
        power, inverse = _power(len(b) + 1)
        self.hash = []
        for k in range(hashes):
            run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_tables[k][b] * power[:len(b)])])
            self.hash.append(_mixed((run[ends] - run[starts]) * inverse[starts]))
        lines = len(self.breaks) + 1 if texts else 0
        self.n = np.bincount(self.line, minlength=lines).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        counts = np.fromiter((t.count("\n") + 1 for t in texts), np.int64, len(texts))
        self.doc = np.repeat(np.arange(len(texts)), counts)
        self.number = np.arange(lines) - np.repeat(np.cumsum(counts) - counts, counts)

    def signature(self, k: int = 0) -> np.ndarray:
        """A 64-bit hash of each line's words in their order."""
        place = (np.arange(len(self.line)) - self.first[self.line]).astype(np.uint64)
        each = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(self.hash[k] + place * _BASE))])
        return _mixed(each[self.first[1:]] - each[self.first[:-1]] + self.n.astype(np.uint64))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(line, hash) of adjacent words."""
        same = self.line[1:] == self.line[:-1]
        h = self.hash[0]
        return self.line[1:][same], _mixed(h[:-1] * _BASE + h[1:])[same]

    def text(self, line: int) -> str:
        lo = self.breaks[line - 1] + 1 if line else 0
        hi = self.breaks[line] if line < len(self.breaks) else len(self.data)
        return self.data[lo:hi].decode()


def most_edits(n, per: int | None):
    """The most edits between a line of ``n`` words and any partner; ``per``: words for each
    edit, None for one edit whatever the length."""
    return np.maximum(1, np.asarray(n) // (per - 1)) if per else np.ones_like(np.asarray(n))


def spoiled_pairs(n, per: int | None):
    """The most word pairs of a line of ``n`` words that a partner lacks.  A word left out or
    replaced spoils two, one put in spoils one; so a longer partner allows one more at most, when
    its next word allows one more edit."""
    n = np.asarray(n)
    return np.maximum(2, 2 * (n // per) + (n % per == per - 1)) if per else np.full_like(n, 2)


class Times(NamedTuple):
    """How often word pairs and words occur, as levels of ``STEPS`` to a power of two, by cells."""

    pairs: np.ndarray
    words: np.ndarray
    all: int


def pair_cells(pair: np.ndarray, cells: int) -> list[np.ndarray]:
    """The two cells, of a power of two, that count a pair."""
    return [(h & np.uint64(cells - 1)).view(np.int64) for h in (pair, _mixed(pair + _BASE))]


def ranked_pairs(words: Words, times: Times | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, hash, rank) of adjacent words, the rarest of least rank: how often the pair stands
    out of its cells, or if that is more often, how often its words would meet by chance.  An
    array has the ranks by the pair's hash alone."""
    line, pair = words.pairs()
    if isinstance(times, np.ndarray):
        return line, pair, times[pair % np.uint64(len(times))]
    out = np.minimum(*(times.pairs[c] for c in pair_cells(pair, len(times.pairs)))).astype(np.int16)
    level = times.words[(words.hash[0] & np.uint64(WORD_CELLS - 1)).view(np.int64)].astype(np.int16)
    chance = (level[1:] + level[:-1] - np.int16(times.all))[words.line[1:] == words.line[:-1]]
    return line, pair, np.where(out > 0, np.maximum(out, chance), chance)


def in_order(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Places by ``first``, which is not negative, and the unsigned ``then`` of equal ones.  One
    number is sorted, of the first and the high bits of the second; where those do not tell
    seconds apart, both."""
    low = int(first.max(initial=0)).bit_length()
    one = first.astype(np.uint64) << np.uint64(64 - low) | then >> np.uint64(low) if low else then
    order = np.argsort(one)
    one, full = one[order], then[order]
    return np.lexsort((then, first)) if ((one[1:] == one[:-1]) & (full[1:] != full[:-1])).any() else order


def prefix(words: Words, times: Times | np.ndarray, per: int | None, more: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of the rarest word pairs of each line with enough words, ``more`` than a
    partner may lack; a pair that stands several times in a line counts as several, by number."""
    line, pair, rank = ranked_pairs(words, times)
    keep = words.n[line] >= MIN_WORDS
    line, pair, rank = line[keep], pair[keep], rank[keep]
    rank = rank.astype(np.int64)
    least = rank.min(initial=0)
    order = in_order(line * (rank.max(initial=0) - least + 1) + rank - least, pair)
    line, pair = line[order], pair[order]
    at = np.arange(len(line))
    taken = at < np.searchsorted(line, line) + spoiled_pairs(words.n[line], per) + more
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (pair[1:] != pair[:-1])
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    return line[taken], _mixed(pair + nth.astype(np.uint64) * _BASE)[taken]


def sketch(words: Words, per: int | None, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key): of each line's runs of r words the r d + 1 of least hash, ``keys`` at most;
    r by the line's length, as in ``RUNS``.  Runs that stand several times in a line count as
    several, by number."""
    h, line = words.hash[0], words.line
    out = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    if len(h) > 3:
        pair = _mixed(h[:-1] * _BASE + h[1:])
        runs = {2: pair, 3: _mixed(pair[:-1] * _BASE + h[2:]), 4: _mixed(pair[:-2] * _BASE + pair[2:])}
        for spoiled, (least, most) in RUNS.items():
            n = words.n[line[spoiled - 1:]]
            fit = (line[spoiled - 1:] == line[:1 - spoiled]) & (n >= least) & (n <= most)
            at, token = line[spoiled - 1:][fit], runs[spoiled][fit]
            enough = words.n[at] >= MIN_WORDS
            at, token = at[enough], token[enough]
            order = np.lexsort((token, at))
            at, token = at[order], token[order]
            place = np.arange(len(at))
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1]) | (token[1:] != token[:-1])
            nth = place - np.maximum.accumulate(np.where(new, place, 0))
            taken = place < np.searchsorted(at, at) + np.minimum(spoiled * most_edits(words.n[at], per) + 1, keys)
            out.append((at[taken], _mixed(token + nth.astype(np.uint64) * _BASE)[taken]))
    at, token = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.argsort(at, kind="stable")
    return at[order], token[order]


def pair_times(docs: DataFrame, parts: int | None = None) -> Times:
    """How often word pairs and words occur in all documents.  Cells are counted in each task and
    added up by blocks; what reaches the driver is a byte for each cell."""
    least, most = PAIR_BITS
    cells = 1 << min(most, max(least, ((parts or part_count(docs)) * PART_CHARS >> 8).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(cells + WORD_CELLS, np.int32)
        for batch in batches:
            for _, _, texts in text_chunks(batch, "t"):
                words = Words(texts)
                for at in pair_cells(words.pairs()[1], cells):
                    np.add.at(times, at, np.int32(1))
                np.add.at(times, (words.hash[0] & np.uint64(WORD_CELLS - 1)).view(np.int64) + cells, np.int32(1))
        for k in range(len(times) // BLOCK):
            block = times[k * BLOCK:(k + 1) * BLOCK]
            if block.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "times": [pack(block.astype(np.int64), 0, 4)]})

    def levels(k: int, times: np.ndarray) -> pa.RecordBatch:
        total = int(times.sum())
        if k * BLOCK < cells:  # beyond what other pairs of the cell and their chance make
            times = (times - np.median(times)) / (1 + np.sqrt(total / BLOCK))
        level = np.rint(STEPS * np.log2(np.maximum(times, 1))).astype(np.uint8)
        return pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "level": [level.tobytes()], "total": pa.array([total], pa.int64())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, times = None, np.zeros(BLOCK, np.int64)
        for batch in batches:
            for k, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != at and at is not None:
                    yield levels(at, times)
                    times = np.zeros(BLOCK, np.int64)
                at = k
                times += unpack(data, BLOCK, 0, 4)
        if at is not None:
            yield levels(at, times)

    counted = (_texts(docs).select("t").mapInArrow(count, "block int, times binary").repartition("block").sortWithinPartitions("block")
               .mapInArrow(add, "block int, level binary, total bigint").toArrow())
    out, words = np.zeros(cells + WORD_CELLS, np.uint8), 1
    for k, level, total in zip(*(c.to_pylist() for c in counted.columns), strict=True):
        out[k * BLOCK:(k + 1) * BLOCK] = np.frombuffer(level, np.uint8)
        words += total * (k * BLOCK >= cells)
    return Times(out[:cells], out[cells:], round(STEPS * np.log2(words)))


def line_ids(words: Words) -> np.ndarray:
    """48 bits for each line: its number of words, 255 at most, then a hash of the words."""
    return (np.minimum(words.n, 255).astype(np.uint64) << np.uint64(HASH_BITS) | words.signature() >> np.uint64(64 - HASH_BITS)).view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "row_key", as_text(docs).alias("t"))


def _map_lines(docs: DataFrame, ddl: str, work, hashes: int = 1) -> DataFrame:
    """``work(words, batch slice)`` → columns of ``ddl`` over bounded runs of texts."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_chunks(batch, "t"):
                made = work(Words(texts, hashes), batch.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(made, schema, strict=True)], schema=schema)

    return docs.mapInArrow(run, ddl)


def equal_lines(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, row_key, line) of lines that equal an earlier one."""
    ddl = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row_key bigint, line int, s1 bigint, s2 bigint"

    def work(words: Words, batch: pa.RecordBatch) -> list:
        at = np.flatnonzero(words.n >= least)
        doc = words.doc[at]
        return [batch.column("doc_id").take(pa.array(doc)), batch.column("row_key").take(pa.array(doc)), words.number[at].astype(np.int32),
                words.signature(0)[at].view(np.int64), words.signature(1)[at].view(np.int64)]

    lines = written(_map_lines(_texts(docs), ddl, work, hashes=2), "lines")
    folded = lines.groupBy("s1", "s2").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    again = folded.select("s1", "s2", F.col("first.doc_id").alias("f_doc"), F.col("first.row_key").alias("f_row"), F.col("first.line").alias("f_line"))
    return (lines.join(again, ["s1", "s2"]).where(~(F.col("row_key").eqNullSafe(F.col("f_row")) & F.col("line").eqNullSafe(F.col("f_line"))
                                                       & F.col("doc_id").eqNullSafe(F.col("f_doc")))).select(*PLACE))


def part_count(docs: DataFrame) -> int:
    """Parts of the keys, so that each holds those of about ``PART_CHARS`` characters."""
    return int((docs.agg(F.sum(F.char_length(as_text(docs)))).first()[0] or 0) // PART_CHARS) + 1


def canonical(keys: np.ndarray, parts: int) -> np.ndarray:
    """Keys as a part and ``KEY_BITS`` bits below it; keys that fall together are only
    candidates more."""
    return (keys % np.uint64(parts) << np.uint64(KEY_BITS) | keys >> np.uint64(64 - KEY_BITS)).view(np.int64)


def pack(a: np.ndarray, raw: int, width: int) -> bytes:
    """The ``width`` low bytes of each number, plane by plane; planes from ``raw`` on are
    compressed, those below are as good as random."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T
    return planes[:raw].tobytes() + zlib.compress(planes[raw:width].tobytes(), 1)


def unpack(data: bytes, n: int, raw: int, width: int) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    planes[:raw] = np.frombuffer(data, np.uint8, raw * n).reshape(raw, n)
    planes[raw:width] = np.frombuffer(zlib.decompress(data[raw * n:]), np.uint8).reshape(width - raw, n)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


def distinct_rows(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, id) in order of the keys, and where each one's key starts."""
    order = in_order(keys, (ids << 64 - HASH_BITS | ids >> HASH_BITS).view(np.uint64))  # by hash: lengths are often equal
    k, i = keys[order], ids[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (i[1:] != i[:-1])
    k, i = k[new], i[new]
    return k, i, np.searchsorted(k, k)


#: Packed rows of one part and run of texts: n sorted keys by their differences, ids beside
#: them.  With ``known``, keys that are large within the run, whole; they go to any part, so
#: that no part gathers them.
KEYED = "part int, n int, known boolean, keys binary, ids binary"
_PACKED = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("known", pa.bool_()), ("keys", pa.binary()), ("ids", pa.binary())])


def packed(keys: np.ndarray, ids: np.ndarray, parts: int) -> pa.RecordBatch:
    """A run's canonical keys in the form of ``KEYED``.  Of a key that is large within the run
    ``SMALL`` + 1 lines go to its part, which so knows it as large, the others as known."""
    k, i, start = distinct_rows(keys, ids)
    more = np.arange(len(k)) - start > SMALL
    rows = []
    kept, own = k[~more], i[~more]
    part = kept >> KEY_BITS
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(kept) else np.zeros(0, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        step = np.diff(kept[a:b] & (1 << KEY_BITS) - 1, prepend=0)
        rows.append((int(part[a]), b - a, False, pack(step, 2, 5), pack(own[a:b], 5, 6)))
    for a in range(0, int(more.sum()), 1 << 14):
        known, own = k[more][a:a + (1 << 14)], i[more][a:a + (1 << 14)]
        rows.append((int(own[0] % parts), len(known), True, pack(known, 0, 8), pack(own, 5, 6)))
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _PACKED, strict=True)] if rows
                                      else [pa.array([], f.type) for f in _PACKED], schema=_PACKED)


def _packed_rows(made: Iterator[tuple[np.ndarray, np.ndarray]], parts: int) -> Iterator[pa.RecordBatch]:
    """(keys, ids) in ``KEYED``'s form, about ``RUN_KEYS`` at a time."""
    keys, ids, held = [], [], 0
    for k, i in made:
        keys.append(canonical(k, parts))
        ids.append(i)
        held += len(k)
        if held >= RUN_KEYS:
            yield packed(np.concatenate(keys), np.concatenate(ids), parts)
            keys, ids, held = [], [], 0
    if held:
        yield packed(np.concatenate(keys), np.concatenate(ids), parts)


def keyed_lines(docs: DataFrame, times: Times | np.ndarray | None, per: int | None, keys: int | None = None, parts: int | None = None) -> DataFrame:
    """The keys of each line: of two lines within the bound they have two in common (with
    ``keys``, so many at most, one as a rule)."""
    parts = parts or part_count(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                for _, _, texts in text_chunks(batch, "t"):
                    words = Words(texts)
                    line, key = sketch(words, per, keys) if keys else prefix(words, times, per, more=2)
                    yield key, line_ids(words)[line]
        return _packed_rows(made(), parts)

    return _texts(docs).select("t").mapInArrow(run, KEYED)


def shared_keys(keyed: DataFrame, per: int | None = WORDS_PER_EDIT) -> DataFrame:
    """(a, b, null): ids of lines of bounded difference in length that share a key of up to
    ``SMALL`` lines, once for each such key; (a, null, key): the lines of each larger key.  One
    shuffle of packed keys; a part's keys are sorted at once."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])

    def batch_of(pairs: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        n, m = len(pairs), len(ids)
        wide = np.arange(n + m) >= n
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([pairs[:, 0], ids])), pa.array(np.concatenate([pairs[:, 1], ids]), mask=wide),
                                           pa.array(np.concatenate([pairs[:, 0], keys]), mask=~wide)], schema=schema)

    def finished(keys: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
        k, i, start = distinct_rows(np.concatenate(keys), np.concatenate(ids))
        big = np.searchsorted(k, k, side="right") - start > SMALL
        pairs = [np.empty((0, 2), np.int64)]
        for step in range(1, min(SMALL, len(k))):
            one = np.flatnonzero((k[:-step] == k[step:]) & ~big[:-step])
            x, y = np.minimum(i[one], i[one + step]), np.maximum(i[one], i[one + step])
            short, longer = np.minimum(x >> HASH_BITS, y >> HASH_BITS), np.maximum(x >> HASH_BITS, y >> HASH_BITS)
            fit = (longer == 255) | (longer - short <= (np.maximum(1, longer // per) if per else 1))
            pairs.append(np.stack([x[fit], y[fit]], 1))
        return batch_of(np.concatenate(pairs), i[big], k[big])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, ids = None, [], []
        for batch in batches:
            for at, n, known, k, i in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = unpack(i, n, 5, 6)
                if known:
                    yield batch_of(np.empty((0, 2), np.int64), own, unpack(k, n, 0, 8))
                    continue
                if at != part and keys:
                    yield finished(keys, ids)
                    keys, ids = [], []
                part = at
                keys.append(np.cumsum(unpack(k, n, 2, 5)) | at << KEY_BITS)
                ids.append(own)
        if keys:
            yield finished(keys, ids)

    return keyed.repartition("part").sortWithinPartitions("part").mapInArrow(run, "a bigint, b bigint, key bigint")


def parities(words: Words, at: np.ndarray) -> np.ndarray:
    """Four rows of 64 bits for each of the lines ``at``: whether the words of a cell are odd in
    number.  A word put in or left out turns one bit, a word replaced turns two or none."""
    size = 64 * len(PARITY)
    bits, slot = np.zeros((len(at), size), np.uint8), np.full(len(words.n), -1)
    slot[at] = np.arange(len(at))
    own = slot[words.line]
    cells, odd = np.unique((own * size + (words.hash[0] % np.uint64(size)).astype(np.int64))[own >= 0], return_counts=True)
    bits.reshape(-1)[cells] = odd & 1
    return np.ascontiguousarray(np.packbits(bits, axis=1).view(np.int64).T)


def candidate_lines(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, own, place, text) of the lines with these ids, each at its earliest place; ``own``
    is the whole 64-bit hash of the words, for lines that fall together under one id."""
    cells = ids.select(F.pmod("id", F.lit(BITS)).cast("int").alias("cell")).distinct().toArrow()["cell"].to_numpy()  # BITS at most
    bits = np.zeros(BITS, bool)
    bits[cells] = True
    packed = np.packbits(bits)
    ddl = f"id bigint, own bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, row_key bigint, line int, text string, n int, {', '.join(f'{c} bigint' for c in PARITY)}"

    def work(words: Words, batch: pa.RecordBatch) -> list:
        ids = line_ids(words)
        cell = ids % BITS
        at = np.flatnonzero((packed[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool) & (words.n >= MIN_WORDS))
        doc = words.doc[at]
        return [ids[at], words.signature()[at].view(np.int64), batch.column("doc_id").take(pa.array(doc)), batch.column("row_key").take(pa.array(doc)),
                words.number[at].astype(np.int32), [words.text(i) for i in at.tolist()], words.n[at].astype(np.int32), *parities(words, at)]

    found = _map_lines(_texts(docs), ddl, work).join(ids, "id", "left_semi")
    rest = ["text", "n", *PARITY]
    return (found.groupBy("id", "own").agg(F.min(F.struct(*PLACE, *rest)).alias("p"))
            .select("id", "own", F.struct(*[F.col(f"p.{c}") for c in PLACE]).alias("place"), *[f"p.{c}" for c in rest]))


def variants(h: np.ndarray) -> tuple[np.ndarray, int]:
    """Hashes of the variants of a line, given its words' hashes, with one word left out, and
    the whole line's."""
    place = np.arange(len(h), dtype=np.uint64)
    stay, moved = _mixed(h + place * _BASE), _mixed(h + (place - np.uint64(1)) * _BASE)
    before = np.cumsum(stay) - stay
    after = np.cumsum(moved[::-1])[::-1] - moved
    return before + after, stay.sum()


@lru_cache(256)
def _two_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def neighbourhood(texts: list[str], times: Times | np.ndarray | None, per: int | None, keys: int | None = None,
                  large: list[np.ndarray] | None = None, parts: int = 1) -> list[np.ndarray]:
    """Of each line the keys of its deletion neighbourhood: two lines within the bound share
    one (with ``keys``, beyond one edit, as a rule).  With ``large``, the large ones among each
    line's keys, no others are combined: a pair that shares another key is known by that."""
    words = Words(texts)
    out: list[list[np.ndarray]] = [[] for _ in texts]
    one_edit = np.flatnonzero(words.n < (2 * per if per else words.n + 1))
    for i in one_edit.tolist():
        left, whole = variants(words.hash[0][words.first[i]:words.first[i + 1]])
        at = np.arange(len(left), dtype=np.uint64)
        out[i] += [_mixed(left ^ _mixed(at + np.uint64(7))), _mixed(np.append(left, whole) + np.uint64(3))]
    if per:
        line, key = sketch(words, per, keys) if keys else prefix(words, times, per, more=2)
        if large is not None:  # hashed with their line; a chance equal only adds a key
            owner = np.repeat(np.arange(len(texts)), [len(x) for x in large])
            many = np.concatenate(large) if large else np.zeros(0, np.int64)
            mark = [_mixed(k.view(np.uint64) * _BASE + i.astype(np.uint64)) for k, i in ((canonical(key, parts), line), (many, owner))]
            stays = np.isin(*mark)
            line, key = line[stays], key[stays]
        start = np.searchsorted(line, np.arange(len(texts) + 1))
        for i in np.flatnonzero(words.n >= 2 * per - 2).tolist():
            own = key[start[i]:start[i + 1]]
            if keys or words.n[i] < LONG + 2 * LONG // per:
                a, b = _two_of(len(own))
                low, high = np.minimum(own[a], own[b]), np.maximum(own[a], own[b])
                out[i].append(_mixed(low * _BASE + high))
            if not keys and words.n[i] >= LONG - LONG // per:
                out[i].append(own)
    return [np.unique(np.concatenate(x)) if x else np.zeros(0, np.uint64) for x in out]


def distance(x: list, y: list) -> int:
    """Edit distance by bit vectors as long as ``x``."""
    k, least = 0, min(len(x), len(y))
    while k < least and x[k] == y[k]:
        k += 1
    x, y = x[k:], y[k:]
    while x and y and x[-1] == y[-1]:
        x, y = x[:-1], y[:-1]
    if not x or not y:
        return len(x) + len(y)
    at: dict = {}
    for i, w in enumerate(x):
        at[w] = at.get(w, 0) | 1 << i
    full, last, score = (1 << len(x)) - 1, 1 << len(x) - 1, len(x)
    more, less = full, 0
    for w in y:
        eq = at.get(w, 0)
        v = eq | less
        h = ((eq & more) + more ^ more) | eq
        up, down = less | ~(h | more) & full, more & h
        score += bool(up & last) - bool(down & last)
        up, down = (up << 1 | 1) & full, down << 1 & full
        more, less = down | ~(v | up) & full, up & v
    return score


def within_bound(a: str, b: str, per: int | None) -> bool:
    """Whether the lines are within the bound of the longer one."""
    x, y = a.encode().split(), b.encode().split()
    longer = max(len(x), len(y))
    d = max(1, longer // per) if per else 1
    if abs(len(x) - len(y)) > d or (Counter(x) & Counter(y)).total() < longer - d:
        return False
    return distance(x, y) <= d


def are_within_bound(texts: list[str], others: list[str], per: int | None) -> np.ndarray:
    """``within_bound`` of many pairs of lines: lengths and common words by their hashes at once,
    which rule out no pair that is within the bound; the distance of those that are left."""
    x, y = Words(texts), Words(others)
    longer = np.maximum(x.n, y.n)
    most = np.maximum(1, longer // per) if per else np.ones_like(longer)
    line, h = np.concatenate([x.line, y.line]), np.concatenate([x.hash[0], y.hash[0]])
    order = np.lexsort((h, line))
    line, h = line[order], h[order]
    starts = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, np.int64)
    own = np.add.reduceat((order < len(x.line)).astype(np.int64), starts) if len(h) else starts
    both = np.minimum(own, np.diff(np.append(starts, len(h))) - own)
    common = np.bincount(line[starts], both, len(texts))
    keep = (np.abs(x.n - y.n) <= most) & (common >= longer - most)
    for i in np.flatnonzero(keep).tolist():
        keep[i] = distance(texts[i].encode().split(), others[i].encode().split()) <= most[i]
    return keep


def lines_that_go(near: DataFrame, pairs: DataFrame, per: int | None) -> DataFrame:
    """(own) of the later line of each pair (a, b) within the bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_chunks(batch, "text"):
                keep = are_within_bound(texts, batch.column("o_text")[a:b].to_pylist(), per)
                yield pa.RecordBatch.from_arrays([batch.column("own")[a:b].filter(pa.array(keep, pa.bool_()))], names=["own"])

    def side(id_: str, at: str, columns: list[str]) -> DataFrame:
        return near.select(F.col("id").alias(id_), *[F.col(c).alias(f"{at}{c}") for c in columns])

    longer = F.greatest("n", "o_n")
    most = F.greatest(F.lit(1), F.floor(longer / per)) if per else F.lit(1)
    turned = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"o_{c}"))) for c in PARITY), F.lit(0))
    few = ["own", "n", *PARITY]
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    likely = (pairs.join(side("a", "", few), "a").join(side("b", "o_", few), "b")
              .where((F.abs(F.col("n") - F.col("o_n")) <= most) & (turned <= 2 * most)).select("a", "own", "b", "o_own"))
    likely = written(likely, "likely")
    # Texts of these alone, in one exchange of what a bounded filter without loss leaves.
    ends = likely.select(F.explode(F.array(F.struct("a", "own"), F.struct(F.col("b").alias("a"), F.col("o_own").alias("own")))).alias("e")).select("e.a", "e.own").distinct()
    cells = ends.select(F.pmod("a", F.lit(CELLS)).alias("cell")).distinct()  # CELLS at most
    texts = (near.withColumn("cell", F.pmod("id", F.lit(CELLS))).join(F.broadcast(cells), "cell", "left_semi")
             .select(F.col("id").alias("a"), "own", "place", "text").join(ends, ["a", "own"], "left_semi"))
    texts = written(texts, "texts")
    other = texts.select(F.col("a").alias("b"), F.col("own").alias("o_own"), F.col("place").alias("o_place"), F.col("text").alias("o_text"))
    both = likely.join(texts, ["a", "own"]).join(other, ["b", "o_own"])
    later = F.when(F.col("place") > F.col("o_place"), F.col("own")).otherwise(F.col("o_own"))
    return both.select(later.alias("own"), "text", "o_text").mapInArrow(run, "own bigint").distinct()


def waiting_lines_that_go(near: DataFrame, gone: DataFrame, times: Times | np.ndarray | None, per: int | None, most: int | None, parts: int) -> DataFrame:
    """(own) of the lines ``near`` of large keys, beside ``gone``, that have an earlier one within
    the bound.  Lines of a key of their neighbourhoods meet each other; if it is large too, they
    meet its first line, and what that leaves meets all earlier lines of the key."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                large = batch.column("large")
                for a, b, texts in text_chunks(batch, "text"):
                    keys = neighbourhood(texts, times, per, most, [large[i].values.to_numpy() for i in range(a, b)], parts)
                    yield np.concatenate(keys), np.repeat(batch.column("id").to_numpy()[a:b], [len(k) for k in keys])
        return _packed_rows(made(), parts)

    found = written(shared_keys(near.select("id", "text", "large").mapInArrow(emit, KEYED), per), "neighbours")
    near = near.drop("large")
    open_ = written(near.select("id", "own").join(gone, "own", "left_anti").select("id").distinct(), "open")
    pairs = found.where("b IS NOT NULL").select("a", "b").distinct()
    pairs = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(open_.withColumnRenamed("id", "a"), "a", "left_semi")
    rows = found.where("b IS NULL").select("key", F.col("a").alias("id"))
    own = rows.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("keys")).select("id", *[F.get("keys", F.lit(k)).alias(c) for k, c in enumerate(LEAST)])
    wide = written(rows.join(own, "id").join(near.select("id", "place"), "id"), "wide")
    first = wide.groupBy("key").agg(F.min(F.struct("place", "id")).alias("first")).select("key", F.col("first.id").alias("b"))
    led = wide.select("key", F.col("id").alias("a")).join(open_.withColumnRenamed("id", "a"), "a", "left_semi").join(first, "key").where("a <> b").where(_lengths_fit(per))
    settled = written(lines_that_go(near, pairs.unionByName(led.select("a", "b")), per), "settled")
    rest = near.select("id", "own").join(open_, "id", "left_semi").join(settled, "own", "left_anti").select("id").distinct()
    later = wide.join(rest, "id", "left_semi").select("key", F.col("id").alias("a"), F.col("place").alias("later"), *LEAST)
    earlier = (later.join(wide.select("key", F.col("id").alias("b"), "place", *[F.col(c).alias(f"o_{c}") for c in LEAST]), "key")
               .where((F.col("a") != F.col("b")) & (F.col("place") < F.col("later")) & _lengths_fit(per) & ~_met_before()))
    return settled.unionByName(lines_that_go(near, earlier.select("a", "b"), per))


def _met_before() -> F.Column:
    """Whether two lines that meet at a large key meet at a lesser one too: one of the least that
    each has.  A pair meets at its least common key in any case."""
    same = [(F.col(x) < F.col("key")) & (F.col(x) == F.col(f"o_{y}")) for x in LEAST for y in LEAST]
    return F.coalesce(reduce(Column.__or__, same), F.lit(False))


def _lengths_fit(per: int | None) -> F.Column:
    short, longer = (f(F.shiftright("a", HASH_BITS), F.shiftright("b", HASH_BITS)) for f in (F.least, F.greatest))
    return (longer == 255) | (longer - short <= (F.greatest(F.lit(1), F.floor(longer / per)) if per else F.lit(1)))


def near_lines(docs: DataFrame, per: int | None, keys: int | None = None) -> DataFrame:
    """(doc_id, row_key, line) of lines within the bound of an earlier one, each at its
    earliest place."""
    parts = part_count(docs)
    times = None if keys else pair_times(docs, parts)
    found = written(shared_keys(keyed_lines(docs, times, per, keys, parts), per), "found")
    large = written(found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.collect_set("key").alias("large")), "large")
    links = written(found.where("b IS NOT NULL").groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")), "shared")
    if not keys:  # two keys in common: both small, or one small and one large
        one = links.where("times = 1").select("a", "b")
        for side in ("a", "b"):
            one = one.join(large.select(F.col("id").alias(side), F.col("large").alias(f"{side}_large")), side)
        links = links.where("times > 1").select("a", "b").unionByName(one.where(F.arrays_overlap("a_large", "b_large")).select("a", "b"))
    links = written(links.select("a", "b"), "links")
    n = F.shiftright("id", HASH_BITS)
    waits = large.where((F.size("large") > 1) | (n < 2 * per) | (n >= LONG - LONG // per)) if per else large
    ids = links.select(F.explode(F.array("a", "b")).alias("id")).unionByName(waits.select("id")).distinct()
    near = written(candidate_lines(docs, ids).join(waits, "id", "left"), "candidates")
    gone = written(lines_that_go(near, links, per), "gone")
    waiting = near.where("large IS NOT NULL")
    late = written(gone.unionByName(waiting_lines_that_go(waiting, gone, times, per, keys, parts)).distinct(), "late")
    return near.join(late, "own", "left_semi").select("place.*")


def removed_lines(docs: DataFrame, least: int = MIN_WORDS, growing: bool = False, words_per_edit: int = WORDS_PER_EDIT,
                  keys: int | None = None) -> DataFrame:
    """(doc_id, row_key, line) of every line that goes.  ``docs``: doc_id, row_key, text."""
    near = near_lines(docs, words_per_edit if growing else None, keys)
    return equal_lines(docs, least).unionByName(near)


def dedup_lines(docs: DataFrame, count: str | None = None, least: int = MIN_WORDS, growing: bool = False, words_per_edit: int = WORDS_PER_EDIT,
                keys: int | None = None) -> DataFrame:
    """``docs`` with the lines that go taken out of ``text``; a column ``count`` with their
    number if a name is given.  Lines of fewer than ``least`` words stay; ``growing`` lets the
    bound grow by one edit for every ``words_per_edit`` words; ``keys`` bounds the keys of a
    line, None finds every pair."""
    row, gone, own, doc = (_free(docs, name) for name in ("row_key", "gone", "own_row", "own_doc"))
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    core = keyed.select("doc_id", F.col(row).alias("row_key"), "text")
    removed = removed_lines(core, least, growing, words_per_edit, keys).groupBy(F.col("doc_id").alias(doc), F.col("row_key").alias(own)).agg(F.collect_set("line").alias(gone))
    removed = written(removed, "removed")
    joined = keyed.join(removed, (F.col(row) == F.col(own)) & F.col("doc_id").eqNullSafe(F.col(doc)), "left")
    kept = F.array_join(F.filter(F.split(F.col("text"), "\n"), lambda x, i: ~F.array_contains(F.col(gone), i)), "\n")
    out = joined.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept))
    if count:
        out = out.withColumn(count, F.coalesce(F.size(F.col(gone)), F.lit(0)).cast("long"))
    return out.drop(row, gone, own, doc)


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name
