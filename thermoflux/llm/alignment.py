"""Cross-tokenizer alignment by tokenizer spans (operator 12).

Tokenizer A (``tokenizers``, byte-level) encodes space + text, tokenizer B (``sentencepiece``)
the text, to which it adds the space.  The spans that both libraries give are coarse cuts: a
token border at which the spans before and after meet lies on a character border and is taken
as it stands.  Tokens of one character - byte-level parts of a multibyte character, byte
fallback - have spans that overlap or are empty; inside such a stretch the lengths of the
decoded bytes give the borders.  Byte offsets where tokens of both end cut them into groups;
every A token of a group is linked to every B token of it.

(The installed ``sentencepiece`` has withdrawn ``immutable_proto``; ``offset_mapping`` gives the
spans of the same proto.)

1. Both tokenizers' borders fall before each space that follows a non-space (checked against
   the two vocabularies; else a text is one stretch), so a text is cut there and each distinct
   stretch of a shard is aligned once.  A shard is a bounded run of a task's documents; it
   keeps its stretches' links, and for each document which stretches it has and how often.
2. Each shard gives one row for each of its id pairs with the number of its documents that
   hold it; a Spark aggregate sums them, and another finds each A id's highest count.
3. The counts go back to the shards by a join on the pair, and each shard's documents are
   scored with them.  Groups of that step are shards, bounded by ``SHARD_CHARS``.

No group grows with the corpus: a pair has one row for each shard at most.

Defined cases: null and empty texts, and texts whose decoded tokens differ from space + text
(U+2581 among their characters, say), have no tokens: zeros and an empty string; a document
counts once for a pair, each row by itself, so a repeated row counts again; a null ``doc_id``
is kept; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoflux.llm.common import CHUNK_CHARS, as_text, quiet_tokenizers, text_chunks, tokenizer_path, written

#: Characters in a shard, about: its stretches and links are in one task's memory.
SHARD_CHARS = 6 << 20
#: Stretches kept between shards of a task, and the longest of them.
CACHED, CACHED_CHARS = 150_000, 64
#: Short stretches that A encodes as one text.
RUN = 64
SPACE = "▁"
SPACES = re.compile(r"\s ")


def byte_of_letter() -> dict[str, int]:
    """The byte-level letters: printable bytes stand for themselves, the others follow U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Pair:
    """The two tokenizers, their decoded bytes, and whether texts may be cut before spaces."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        quiet_tokenizers()
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = byte_of_letter()
        vocab = sorted((i, t) for t, i in self.a.get_vocab().items())
        tokens = dict(vocab)
        self.bytes_a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in (tokens.get(i, "") for i in range(vocab[-1][0] + 1))]
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.lengths_a, self.lengths_b = ([len(x) for x in y] for y in (self.bytes_a, self.bytes_b))
        self.sizes_a, self.sizes_b = np.array(self.lengths_a, np.int64), np.array(self.lengths_b, np.int64)
        # Ids in the groups' text: "," within a side, "|" after A's, ";" after a group, LF after a stretch.
        self.written = [f"{i}{c}" for c in ",|" for i in range(len(self.bytes_a))] + [f"{i}{c}" for c in ",;\n" for i in range(len(self.bytes_b))]
        made = json.loads(self.a.to_str())
        before = made["pre_tokenizer"] or {}
        self.cuts = (made["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                     and not before.get("add_prefix_space") and not any(SPACE in p.lstrip(SPACE) or " " in p for p in pieces)
                     and b"".join(self.bytes_b[i] for i in self.b.encode("a  b ")) == b" a  b ")

    def ends_a(self, text: str, ids: list[int], spans: list[tuple[int, int]]) -> list[int]:
        """The byte offset where each token of ``text`` ends."""
        if text.isascii():  # a character is a byte: every span is a cut as it stands
            return [end for _, end in spans]
        at = [0, *accumulate(len(c.encode()) for c in text)]
        ends, place = [], 0
        for k, (i, (_, end)) in enumerate(zip(ids, spans, strict=True)):
            place += self.lengths_a[i]
            if k + 1 == len(spans) or spans[k + 1][0] == end:  # spans meet: a character border
                place = at[end]
            ends.append(place)
        return ends

    def ends_b(self, text: str, ids: list[int], spans: list[tuple[int, int]]) -> list[int]:
        """The same for B over space + ``text``; its spans are in bytes of ``text``."""
        ends, place = [], 0
        for k, (i, (begin, end)) in enumerate(zip(ids, spans, strict=True)):
            place += self.lengths_b[i]
            if begin < end and (k + 1 == len(spans) or spans[k + 1][0] == end):  # of a character's bytes only the last has a span
                place = end + 1  # one space stands before the text
            ends.append(place)
        return ends

    def aligned_many(self, stretches: list[str], ascii_only: bool) -> list[tuple] | None:
        """``aligned`` for short stretches, all at once; None if one of them is refused.

        Stretches end where both tokenizers end a token, so A encodes runs of them as one text.
        In ASCII text a character is a byte and B's pieces tile it by their decoded bytes; its
        spans are asked for where there are other characters."""
        spaced = [" " + s for s in stretches]
        ids, spans, base = [], [], 0
        for lo in range(0, len(spaced), RUN):
            run = "".join(spaced[lo:lo + RUN])
            done = self.a.encode(run, add_special_tokens=False)
            ids += done.ids
            spans += [(base + start, base + end) for start, end in done.offsets] if base else done.offsets
            base += len(run)
        data = "".join(spaced).encode()
        edge = np.cumsum([len(s.encode()) for s in spaced])
        if ascii_only:
            flat = [i for x in self.b.encode(stretches, num_threads=1) for i in x]
        else:
            of_b = self.b.encode(stretches, return_type="offset_mapping", return_bytes=True, num_threads=1)  # the proto's spans
            flat = [i for x in of_b for i in x["ids"]]
        if not b"".join([self.bytes_a[i] for i in ids]) == data == b"".join([self.bytes_b[i] for i in flat]):
            return None
        a, b, cuts = np.array(ids, np.int64), np.array(flat, np.int64), np.array(spans, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])  # by decoded bytes
        # A span's end is a cut on a character border where the next span begins with it.
        char = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80), len(data))
        ends_a = np.where(np.append(cuts[1:, 0], cuts[-1, 1]) == cuts[:, 1], char[cuts[:, 1]], ends_a)
        if not ascii_only:
            own = np.array([x for o in of_b for x in o["offsets"]], np.int64) + np.repeat(edge - [len(s.encode()) for s in stretches], [len(o["ids"]) for o in of_b])[:, None]
            meets = (np.append(own[1:, 0], -1) == own[:, 1]) & (own[:, 0] < own[:, 1])  # of a character's bytes only the last has a span
            ends_b = np.where(meets, own[:, 1], ends_b)
        common = np.intersect1d(ends_a, ends_b)
        if len(common) == 0 or not np.isin(edge, common).all():
            return None
        of_a, of_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)  # group of each token
        n_a, n_b = (np.bincount(g, minlength=len(common)) for g in (of_a, of_b))
        if (n_a * n_b).sum() > 1 << 22:
            return None
        stretch = np.searchsorted(edge, common)  # of each group
        # The groups' text: each token with what stands behind it, A's of a group before B's.
        behind_a, behind_b = np.cumsum(n_a), np.cumsum(n_b)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[behind_a[n_a > 0] - 1] = 1
        last_b[behind_b[n_b > 0] - 1] = 1
        last_b[np.searchsorted(ends_b, edge)] = 2
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + (behind_b - n_b)[of_a]] = a + last_a * len(self.bytes_a)
        code[np.arange(len(b)) + behind_a[of_b]] = b + last_b * len(self.bytes_b) + 2 * len(self.bytes_a)
        texts = "".join([self.written[c] for c in code.tolist()]).split("\n")
        # Links: every A token of a group with every B token of it.
        many = n_b[of_a]
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        keys = np.repeat(a << 32, many) | b[np.repeat((behind_b - n_b)[of_a], many) + inside]
        at = np.repeat(stretch[of_a], many)
        order = np.lexsort((keys, at))
        keys, at = keys[order], at[order]
        new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])]))
        times = np.diff(np.append(new, len(keys)))
        count = len(stretches)
        first = np.searchsorted(at[new], np.arange(count + 1)).tolist()
        sizes = [np.bincount(x, minlength=count).tolist() for x in (stretch[of_a], stretch[of_b], stretch, at)]
        keys, times = keys[new], times.astype(np.int64)
        return [(*size, text, keys[lo:hi].tobytes(), times[lo:hi].tobytes()) for size, text, lo, hi in zip(zip(*sizes, strict=True), texts, first, first[1:], strict=False)]

    def stretches(self, text: str) -> list[str]:
        """Space + text, cut where both tokenizers always end a token; each stretch without
        the space that it begins with."""
        if not self.cuts:
            return [text]
        if text[0] != " " and text[-1] != " " and not SPACES.search(text):
            return text.split(" ")
        # A run of blanks stays whole, and a lone space at the end stays with what is before
        # it: B gives an empty text no space.
        return [s[1:] for s in re.split(r"(?<=\S)(?= (?s:.))", " " + text)]

    def aligned(self, stretches: list[str]) -> list[tuple | None]:
        """Of each stretch (n_a, n_b, groups, links, group text, pairs as a << 32 | b, times), the
        last two as packed integers; None where the decoded tokens differ from it."""
        out: list[tuple | None] = [None] * len(stretches)
        short = [k for k, s in enumerate(stretches) if len(s) <= CACHED_CHARS and SPACE not in s] if self.cuts else []
        known = {k for k, s in enumerate(stretches) if SPACE in s}  # B reads a space there: refused
        for ascii_only in (True, False):
            own = [k for k in short if stretches[k].isascii() == ascii_only]
            found = self.aligned_many([stretches[k] for k in own], ascii_only) if own else None
            if found is not None:
                known.update(own)
                for k, fact in zip(own, found, strict=True):
                    out[k] = fact
        other = [k for k in range(len(stretches)) if k not in known]
        of_a = self.a.encode_batch([" " + stretches[k] for k in other], add_special_tokens=False)
        of_b = self.b.encode([stretches[k] for k in other], return_type="offset_mapping", return_bytes=True, num_threads=1)  # the proto's spans
        for k, a, b in zip(other, of_a, of_b, strict=True):
            text, ids_a, ids_b = " " + stretches[k], a.ids, b["ids"]
            if b"".join([self.bytes_a[i] for i in ids_a]) == text.encode() == b"".join([self.bytes_b[i] for i in ids_b]):
                out[k] = linked(ids_a, self.ends_a(text, ids_a, a.offsets), ids_b, self.ends_b(stretches[k], ids_b, b["offsets"]))
        return out


def linked(ids_a: list[int], ends_a: list[int], ids_b: list[int], ends_b: list[int]) -> tuple:
    """Groups between common ends, and the links inside them."""
    groups: list[str] = []
    pairs: dict[int, int] = {}
    i = j = p = q = links = 0
    n, m = len(ids_a), len(ids_b)
    while i < n and j < m:
        x, y = ends_a[i], ends_b[j]
        if x < y:
            i += 1
            continue
        j += 1
        if x > y:
            continue
        i += 1
        if i == p + 1 and j == q + 1:  # one token each
            a, b = ids_a[p], ids_b[q]
            groups.append(f"{a}|{b}")
            pairs[a << 32 | b] = pairs.get(a << 32 | b, 0) + 1
            links += 1
        else:
            left, right = ids_a[p:i], ids_b[q:j]
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            links += len(left) * len(right)
            others = counted(right)
            for a, k in counted(left).items():
                for b, l in others.items():
                    pairs[a << 32 | b] = pairs.get(a << 32 | b, 0) + k * l
        p, q = i, j
    return n, m, len(groups), links, ";".join(groups), array("q", pairs).tobytes(), array("q", pairs.values()).tobytes()


def counted(ids: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i in ids:
        out[i] = out.get(i, 0) + 1
    return out


class Kept:
    """Facts of short stretches that were met before, in two generations: when the young one
    is full the old one goes, so the frequent ones stay."""

    def __init__(self) -> None:
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def get(self, stretch: str) -> tuple | None | int:
        fact = self.young.get(stretch, 0)
        if fact == 0 and (fact := self.old.get(stretch, 0)) != 0:
            self.put(stretch, fact)
        return fact

    def put(self, stretch: str, fact: tuple | None) -> None:
        if len(stretch) <= CACHED_CHARS:
            if len(self.young) >= CACHED:
                self.old, self.young = self.young, {}
            self.young[stretch] = fact


@lru_cache(maxsize=2)
def tokenizer_pair(byte_path: str, piece_path: str) -> Pair:
    return Pair(byte_path, piece_path)


class Shard:
    """Documents of a bounded run of rows, their stretches and the pairs these link."""

    def __init__(self, pair: Pair, kept: Kept) -> None:
        self.pair, self.kept, self.chars = pair, kept, 0
        self.number: dict[str, int] = {}
        self.facts: list[tuple | None] = []
        self.docs: list[tuple] = []

    def add(self, keys: list, texts: list[str]) -> None:
        cut, new = [], []
        for text in texts:
            self.chars += len(text) + 32  # rows of empty texts count, too
            parts = self.pair.stretches(text) if text else []
            at = list(map(self.number.get, parts))
            if None in at:
                for k, s in enumerate(parts):
                    if at[k] is None:
                        if (i := self.number.get(s)) is None:
                            i = self.number[s] = len(self.facts)
                            fact = self.kept.get(s)
                            self.facts.append(fact)
                            if fact == 0:
                                new.append(s)
                        at[k] = i
            cut.append(at)
        for p in range(0, len(new), 4096):
            part = new[p:p + 4096]
            for s, fact in zip(part, self.pair.aligned(part), strict=True):
                self.facts[self.number[s]] = fact
                self.kept.put(s, fact)
        self.docs += zip(keys, [np.array(at, np.int32) for at in cut], strict=True)

    def rows(self, number: int) -> list[tuple]:
        """A row for each document and one for the shard, in the order of ``SHARDS``."""
        nothing = (0, 0, 0, 0, "", b"", b"")
        facts = [f or nothing for f in self.facts]
        refused = np.array([f is None for f in self.facts], bool)
        sizes = np.array([f[:4] for f in facts], np.int64).reshape(-1, 4)
        texts = [f[4] for f in facts]
        first = np.array([0, *accumulate(len(f[5]) // 8 for f in facts)], np.int64)  # of each stretch's links
        keys = np.frombuffer(b"".join([f[5] for f in facts]), np.int64)
        times = np.frombuffer(b"".join([f[6] for f in facts]), np.int64)
        distinct, pair = np.unique(keys, return_inverse=True)
        held = np.zeros(len(distinct), np.int64)  # documents with each pair
        out = []
        for key, at in self.docs:
            which, often = np.unique(at, return_counts=True)
            if not len(which) or refused[which].any():
                out.append((number, key, False, 0, 0, 0, 0, "", b"", b"", None, None, None))
                continue
            digest = hashlib.sha256(";".join([texts[i] for i in at.tolist()]).encode()).hexdigest()
            lo, size = first[which], first[which + 1] - first[which]
            mine = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            held[np.unique(pair[mine])] += 1
            out.append((number, key, False, *(often @ sizes[which]).tolist(), digest, packed(np.diff(which, prepend=0)), packed(often), None, None, None))
        out.append((number, None, True, 0, 0, 0, 0, None, pair.astype(np.int32).tobytes(), times.tobytes(), distinct.tobytes(), held.tobytes(), first.tobytes()))
        return out


def packed(values: np.ndarray) -> bytes:
    """Numbers that are mostly small: 16 bits each, or 32 after a mark, compressed."""
    small = len(values) == 0 or values.max() < 1 << 16
    return zstandard.compress((b"\0" if small else b"\1") + values.astype(np.uint16 if small else np.uint32).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    return np.frombuffer(raw, np.uint32 if raw[0] else np.uint16, offset=1).astype(np.int64)


SHARDS = ("shard bigint, doc_id {id}, whole boolean, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
          "which binary, times binary, pairs binary, docs binary, first binary")


def shards_of(docs: DataFrame, byte_path: str, piece_path: str, chars: int = SHARD_CHARS) -> DataFrame:
    """A row for each document, and one (``whole``) for each shard."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = SHARDS.format(id=docs.schema["doc_id"].dataType.simpleString())
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def rows_of(shard: Shard, number: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*shard.rows(number), strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of small tuples without cycles: collections cost a third of the time
        try:
            yield from shards(batches)
        finally:
            gc.enable()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(byte_path, piece_path)
        kept = Kept()
        number = TaskContext.get().partitionId() << 32
        shard = Shard(pair, kept)
        for batch in batches:
            for a, b, texts in text_chunks(batch, "t", min(chars, CHUNK_CHARS)):
                shard.add(batch.column("k").slice(a, b - a).to_pylist(), texts)
                if shard.chars > chars:
                    yield rows_of(shard, number)
                    shard, number = Shard(pair, kept), number + 1
        if shard.docs:
            yield rows_of(shard, number)

    return docs.select(docs["doc_id"].alias("k"), as_text(docs).alias("t")).mapInArrow(run, ddl)


def pair_rows(shards: DataFrame) -> DataFrame:
    """(shard, at, a, b, docs) of each shard's pairs."""
    schema = pa.schema([("shard", pa.int64()), ("at", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, pairs, docs in zip(*(batch.column(c) for c in ("shard", "pairs", "docs")), strict=True):
                keys, held = np.frombuffer(pairs.as_py(), np.int64), np.frombuffer(docs.as_py(), np.int64)
                for p in range(0, len(keys), 1 << 16):
                    k = keys[p:p + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), shard.as_py())), pa.array(np.arange(p, p + len(k), dtype=np.int32)),
                                                      pa.array((k >> 32).astype(np.int32)), pa.array((k & 0xFFFFFFFF).astype(np.int32)), pa.array(held[p:p + len(k)])], schema=schema)

    return shards.where("whole").select("shard", "pairs", "docs").mapInArrow(run, "shard bigint, at int, a int, b int, docs bigint")


def aligned_documents(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, chars: int = SHARD_CHARS) -> tuple[DataFrame, DataFrame]:
    """Two tables: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for
    each document, and (a, b, docs, best) for each id pair that any document holds linked."""
    byte_path, piece_path = byte_path or tokenizer_path(), piece_path or tokenizer_path("piece_bpe_32k.model")
    shards = written(shards_of(docs, byte_path, piece_path, chars), "shards")
    pairs = written(pair_rows(shards).where("docs > 0"), "pairs")
    sums = written(pairs.groupBy("a", "b").agg(F.sum("docs").alias("docs")), "counts")
    highest = sums.groupBy("a").agg(F.max("docs").alias("highest"))
    counts = sums.join(highest, "a").select("a", "b", "docs", (F.col("docs") == F.col("highest")).alias("best"))
    found = pairs.select("shard", "at", "a", "b").join(counts, ["a", "b"]).select("shard", "at", "docs", "best")
    ddl = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

    def score(rows: pa.Table, counted: pa.Table) -> pa.Table:
        whole = rows.filter(rows["whole"])
        number, times, first = (np.frombuffer(whole[c][0].as_py(), kind) for c, kind in (("which", np.int32), ("times", np.int64), ("first", np.int64)))
        size = len(whole["pairs"][0].as_py()) // 8
        docs_of, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = counted["at"].to_numpy()
        docs_of[at] = counted["docs"].to_numpy()
        best[at] = counted["best"].to_numpy().astype(np.int64)
        running = [np.concatenate([[0], np.cumsum(times * x[number])]) for x in (best, docs_of)]
        each = [r[first[1:]] - r[first[:-1]] for r in running]  # of each stretch
        own = rows.filter(pa.compute.invert(rows["whole"]))
        sums = [[], []]
        for which, m in zip(own["which"], own["times"], strict=True):
            i, m = (np.cumsum(unpacked(which.as_py())), unpacked(m.as_py())) if which.as_py() else (np.zeros(0, np.int64),) * 2
            for out, e in zip(sums, each, strict=True):
                out.append(int((e[i] * m).sum()))
        return pa.table({**{c: own[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}, "n_best": pa.array(sums[0], pa.int64()),
                         "count_sum": pa.array(sums[1], pa.int64()), "groups_sha256": own["groups_sha256"]})

    scored = shards.drop("docs").groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(score, ddl)
    return scored, counts


def alignment_digests(docs: DataFrame) -> DataFrame:
    return aligned_documents(docs)[0].select(F.col("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
