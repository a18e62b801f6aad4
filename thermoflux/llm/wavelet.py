"""Token files as wavelet matrices (operator 2).

Documents are put in ascending ``doc_id`` order by a range partitioning (ties by the text's
hash; null first), encoded, closed with an end identifier and cut into shards of whole
documents.  A shard is one row of a Parquet table in the shared folder: the documents'
identifiers and lengths, and a blob with the token sequence as a wavelet matrix, that is one
bit-plane for each bit of a token, every plane sorted stably by the bits above it.  From the
blob alone ``access``, ``count``, ``rank`` and ``select`` answer without decoding the rest.

Blob: ``WVM1``, then little-endian uint64 tokens, uint32 planes, and for each plane uint64
zeros, uint64 stored bytes and the plane's zstd-compressed bits, first bit lowest.

Defined cases: a null or empty text is the end identifier alone; an empty table gives an
empty token table; repeated rows are stored as often as they occur; a null ``doc_id`` comes
first; only ``doc_id`` and ``text`` are read; a very long document makes its shard longer.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thermoflux.llm.common import as_text, quiet_tokenizers, scratch_table, text_chunks, tokenizer_path
from thermoflux.llm.pretokens import WordCache, gather, parts_of, split_texts, vocabulary

MAGIC = b"WVM1"
#: Tokens after which a shard is closed.
SHARD_TOKENS = 1 << 20


class WaveletMatrix:
    """Planes from the highest bit down; ``words``: the bits as uint64; ``ones``: set bits
    before each word, the rank directory."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray]):
        self.n, self.zeros, self.planes = n, zeros, planes
        self.words, self.ones = [], []
        for p in planes:
            w = np.zeros(n // 64 + 1, np.uint64)
            w.view(np.uint8)[:len(p)] = p
            self.words.append(w)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(w), dtype=np.int64)]))

    @classmethod
    def build(cls, ids: np.ndarray, levels: int | None = None) -> WaveletMatrix:
        return cls(len(ids), *cls._cut(ids, levels))

    @staticmethod
    def _cut(ids: np.ndarray, levels: int | None) -> tuple[list[int], list[np.ndarray]]:
        levels = levels or max(1, int(ids.max(initial=0)).bit_length())
        if len(ids) and int(ids.max()) >> levels:
            raise ValueError(f"an identifier needs more than {levels} planes")
        now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        zeros, planes = [], []
        for level in range(levels - 1, -1, -1):
            bit = (now >> level & 1).astype(bool)
            planes.append(np.packbits(bit, bitorder="little"))
            low = now[~bit]
            zeros.append(len(low))
            now = np.concatenate([low, now[bit]])
        return zeros, planes

    @classmethod
    def pack(cls, ids: np.ndarray, levels: int) -> bytes:
        """The blob of ``ids``, without the rank directory, which opening rebuilds."""
        zeros, planes = cls._cut(ids, levels)
        shrink = zstandard.ZstdCompressor(level=1)
        out = [MAGIC, struct.pack("<QI", len(ids), levels)]
        for z, p in zip(zeros, planes, strict=True):
            small = shrink.compress(p.tobytes())
            out += [struct.pack("<QQ", z, len(small)), small]
        return b"".join(out)

    @staticmethod
    def _parts(blob: bytes) -> tuple[int, list[int], list[np.ndarray]]:
        if blob[:4] != MAGIC:
            raise ValueError("not a token shard")
        n, levels = struct.unpack_from("<QI", blob, 4)
        at, zeros, planes, grow = 16, [], [], zstandard.ZstdDecompressor()
        for _ in range(levels):
            z, size = struct.unpack_from("<QQ", blob, at)
            at += 16
            zeros.append(z)
            planes.append(np.frombuffer(grow.decompress(blob[at:at + size]), np.uint8) if n else np.zeros(0, np.uint8))
            at += size
        return n, zeros, planes

    @classmethod
    def open(cls, blob: bytes) -> WaveletMatrix:
        return cls(*cls._parts(blob))

    @classmethod
    def decode(cls, blob: bytes) -> np.ndarray:
        """All tokens in order: from the lowest plane up, undo each stable partition."""
        n, zeros, planes = cls._parts(blob)
        levels = len(planes)
        now = np.zeros(n, np.uint16 if levels <= 16 else np.uint32)
        for level, (z, p) in enumerate(zip(reversed(zeros), reversed(planes), strict=True)):
            bit = np.unpackbits(p, count=n, bitorder="little").view(bool)
            above = np.empty_like(now)
            above[~bit] = now[:z]
            above[bit] = now[z:] | now.dtype.type(1 << level)
            now = above
        return now.astype("<u4")

    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.ones[level][word] + np.bitwise_count(self.words[level][word] & below)

    def access(self, places) -> np.ndarray:
        """Tokens at ``places``."""
        i = np.asarray(places, np.int64).copy()
        out = np.zeros(i.shape, np.uint32)
        for level in range(len(self.planes)):
            bit = (self.words[level][i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            r = self._rank1(level, i)
            i = np.where(bit, self.zeros[level] + r, i - r)
            out = out << np.uint32(1) | bit
        return out

    def _range(self, token: int, a: int, b: int) -> tuple[int, int]:
        """Places below the lowest plane of the occurrences of ``token`` in [a, b)."""
        levels = len(self.planes)
        if token < 0 or token >> levels:
            return 0, 0
        ends = np.array([a, b], np.int64)
        for level in range(levels):
            r = self._rank1(level, ends)
            ends = self.zeros[level] + r if token >> (levels - 1 - level) & 1 else ends - r
        return int(ends[0]), int(ends[1])

    def count(self, token: int, a: int = 0, b: int | None = None) -> int:
        """Occurrences of ``token`` in [a, b)."""
        lo, hi = self._range(token, a, self.n if b is None else b)
        return hi - lo

    def rank(self, token: int, i: int) -> int:
        return self.count(token, 0, i)

    def _select(self, level: int, k: int, one: bool) -> int:
        ones = self.ones[level]
        before = ones if one else np.arange(len(ones)) * 64 - ones
        word = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.words[level][word:word + 1].view(np.uint8), bitorder="little").astype(bool)
        return word * 64 + int(np.flatnonzero(bits == one)[k - int(before[word])])

    def select(self, token: int, k: int) -> int:
        """Place of occurrence ``k`` (from 0) of ``token``."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(f"token {token} has {hi - lo} occurrences")
        i, levels = lo + k, len(self.planes)
        for level in range(levels - 1, -1, -1):
            one = bool(token >> (levels - 1 - level) & 1)
            i = self._select(level, i - self.zeros[level] if one else i, one)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]


@lru_cache(maxsize=2)
def _library(path: str):
    quiet_tokenizers()
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), WordCache(room=400_000)


def encode_texts(texts: list[str], path: str) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, identifiers of a piece of it), in order.  Distinct words go through the
    library once; texts are made of their words' identifiers."""
    library, cache = _library(path)
    for parts in parts_of(texts):
        words = split_texts([p for _, p in parts], tuple(vocabulary(path).added))
        values, missing = cache.known(words.distinct)
        made = library.encode_batch_fast([words.distinct[k].decode() for k in missing], add_special_tokens=False)
        for k, e in zip(missing, made, strict=True):
            values[k] = array("I", e.ids).tobytes()
            cache.keep(words.distinct[k], values[k])
        ids, bounds = gather(values, words)
        for (k, _), a, b in zip(parts, bounds[:-1], bounds[1:], strict=True):
            yield k, ids[a:b]


SHARD_FIELDS = "part int, shard int, doc_ids array<{key}>, lengths array<bigint>, n_tokens bigint, planes binary"


def token_shards(docs: DataFrame, path: str | None = None, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per shard, in ascending ``doc_id`` order by (part, shard)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    path = path or tokenizer_path()
    schema = SHARD_FIELDS.format(key=docs.schema["doc_id"].dataType.simpleString())
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, keys, lengths, held, size = TaskContext.get().partitionId(), 0, [], [], [], 0
        levels = max(len(vocabulary(path).bytes_of) - 1, end_id).bit_length()

        def row() -> pa.RecordBatch:
            blob = WaveletMatrix.pack(np.concatenate(held), levels)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((part, shard, keys, lengths, size, blob), arrow, strict=True)], schema=arrow)

        for batch in batches:
            for a, b, texts in text_chunks(batch, "t"):
                ids = batch.column("k").slice(a, b - a).to_pylist()
                tokens: list[list[np.ndarray]] = [[] for _ in texts]
                for k, piece in encode_texts(texts, path):
                    tokens[k].append(piece)
                for key, pieces in zip(ids, tokens, strict=True):
                    own = np.concatenate([*pieces, np.array([end_id], "<u4")]).astype("<u4")
                    keys.append(key)
                    lengths.append(len(own))
                    held.append(own)
                    size += len(own)
                    if size >= shard_tokens:
                        yield row()
                        shard, keys, lengths, held, size = shard + 1, [], [], [], 0
        if keys:
            yield row()

    order = [F.col("k").asc_nulls_first(), F.xxhash64("t").asc()]
    narrow = docs.select(docs["doc_id"].alias("k"), as_text(docs).alias("t"))
    return narrow.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the token table; Spark's commit keeps it whole when executors are lost."""
    token_shards(docs, path, end_id, shard_tokens).write.parquet(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a token table.

    Two prefix sums give the start: over the parts (one row for each partition that wrote)
    and over the shards inside a part; the blobs themselves are never shuffled.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    shards = spark.read.parquet(folder)
    key = shards.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"part int, shard int, doc_id {key}, inside bigint, n_tokens bigint, ids_crc32 bigint"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part, shard, doc_ids, lengths, blob = (batch.column(c)[k].as_py() for c in ("part", "shard", "doc_ids", "lengths", "planes"))
                ids = WaveletMatrix.decode(blob)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n:e]) for e, n in zip(ends, lengths, strict=True)]
                columns = ([part] * len(lengths), [shard] * len(lengths), doc_ids, ends - lengths, lengths, crc)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = parts.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    inner = Window.partitionBy("part").orderBy("shard")
    starts = (sizes.join(before, "part")
              .select("part", "shard", (F.col("before") + F.sum("n_tokens").over(inner) - F.col("n_tokens")).alias("first")))
    rows = shards.select("part", "shard", "doc_ids", "lengths", "planes").mapInArrow(run, schema)
    return rows.join(starts, ["part", "shard"]).select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_file_digests(docs: DataFrame, path: str | None = None, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as a token table into the shared folder and read every document back."""
    folder = scratch_table(docs.sparkSession, "tokens")
    write_tokens(docs, folder, path, end_id)
    return read_documents(docs.sparkSession, folder)
