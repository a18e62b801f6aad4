"""Vectorised byte-level pre-tokenizing.

The byte-level tokenizer first cuts a text into words by the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` and then merges
inside each word.  Here the cut is done on an array of code points, and equal words of a
chunk of texts are folded by Arrow's dictionary encoding, so that each operator works on the
distinct words only.  Strings of added (special) tokens are cut out first, as the library does.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers.pre_tokenizers import ByteLevel

from thermoflux.llm.common import CHUNK_CHARS

LETTER, NUMBER, OTHER, SPACE, EDGE, ADDED = range(6)
#: Unicode White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    # Python, regex and the tokenizers library know different Unicode versions: where the
    # first two differ, the library's own pre-tokenizer is asked.
    newer = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, code in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for run in regex.findall(kind, every):
            newer[np.frombuffer(run.encode("utf-32-le"), np.uint32)] = code
    cut = ByteLevel(add_prefix_space=False).pre_tokenize_str
    for c in np.flatnonzero(newer != table).tolist():
        words = [a for _, (a, _) in cut(f"a{chr(c)}1")]
        table[c] = {(0, 2): LETTER, (0, 1): NUMBER}.get(tuple(words), OTHER)
    table[WHITE_SPACE] = SPACE
    return table


@dataclass
class Words:
    """``codes[bounds[i]:bounds[i + 1]]`` are the words of text i, as places in ``distinct``."""

    distinct: list[bytes]
    codes: np.ndarray
    bounds: np.ndarray


def split_texts(texts: list[str], added: tuple[str, ...] = ()) -> Words:
    joined = "\0".join(texts) + "\0"
    cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    cls = class_table()[cps]
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.concatenate([[0], np.cumsum(lens + 1)])
    cls[firsts[1:] - 1] = EDGE
    cuts = []
    for word in added:
        for k, text in enumerate(texts):
            at = text.find(word)
            while at >= 0:
                a = firsts[k] + at
                cls[a:a + len(word)] = ADDED
                cuts.append(a)
                at = text.find(word, at + len(word))
    start = np.empty(len(cps), bool)
    start[0] = True
    start[1:] = cls[1:] != cls[:-1]
    start |= cls == EDGE
    start[cuts] = True
    # White space before a word: its last character stands alone, or leads the word if it is U+0020.
    last = np.flatnonzero((cls[:-1] == SPACE) & (cls[1:] < SPACE))
    start[last] = True
    start[last[cps[last] == 0x20] + 1] = False
    # 's 't 're 've 'm 'll 'd, where the quote itself starts a word.
    quote = np.flatnonzero((cps[:-2] == 0x27) & (cls[:-2] == OTHER) & start[:-2] & (cls[1:-1] == LETTER))
    if len(quote):
        one, two = cps[quote + 1], cps[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ~short & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        start[quote[short | long] + 1] = False
        start[quote[short] + 2] = True
        start[quote[long] + 3] = True
    starts = np.flatnonzero(start)
    widths = (1 + (cps >= 0x80).view(np.uint8) + (cps >= 0x800).view(np.uint8) + (cps >= 0x10000).view(np.uint8)).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(widths)])
    offsets = np.concatenate([at[starts], at[-1:]])
    data = joined.encode()
    array = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    folded = array.dictionary_encode()
    real = cls[starts] != EDGE
    codes = np.asarray(folded.indices)[real]
    bounds = np.searchsorted(starts[real], firsts)
    return Words(binary_values(folded.dictionary), codes, bounds)


def binary_values(array: pa.LargeBinaryArray) -> list[bytes]:
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1].tolist()
    data = data.to_pybytes() if data is not None else b""
    return [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


_CUT = re.compile(r"\S(?=[ \n])")


def pieces(text: str, chars: int = CHUNK_CHARS) -> list[str]:
    """Cut a very long text where a word ends before U+0020 or a line feed: no word, added
    token or run of white space is cut in two, so the pieces' words are the text's words.
    (A very long run without white space stays whole.)"""
    out, a = [], 0
    while len(text) - a > chars:
        m = _CUT.search(text, a + chars)
        if not m:
            break
        out.append(text[a:m.end()])
        a = m.end()
    out.append(text[a:])
    return out


def parts_of(texts: list[str], chars: int = CHUNK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """(text number, piece) in order, in groups of about ``chars`` characters: however long
    a text is, vectorised work sees bounded arrays."""
    group, size = [], 0
    for k, text in enumerate(texts):
        for p in pieces(text, chars):
            group.append((k, p))
            size += len(p)
            if size >= chars:
                yield group
                group, size = [], 0
    if group:
        yield group


@dataclass
class Vocabulary:
    """Byte-level BPE file: symbol of each byte, merges as pair -> (rank, symbol), bytes of symbols."""

    first: list[int]
    merges: dict[tuple[int, int], tuple[int, int]]
    added: dict[str, int]
    bytes_of: list[bytes]


def byte_letters() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    other bytes for code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, letters = spec["model"], byte_letters()
    if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec.get("normalizer"):
        raise ValueError(f"{path}: a byte-level BPE file without prefix space or normalizer is needed")
    added = {}
    for t in spec["added_tokens"]:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"]):
            raise ValueError(f"{path}: added token {t['content']!r} has options that are not supported")
        added[t["content"]] = t["id"]
    ids = model["vocab"]
    first = [0] * 256
    for letter, byte in letters.items():
        first[byte] = ids[letter]
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges[ids[a], ids[b]] = (rank, ids[a + b])
    bytes_of = [b""] * (1 + max([*ids.values(), *added.values()]))
    for token, i in ids.items():
        bytes_of[i] = token.encode() if token in added or any(c not in letters for c in token) else bytes(letters[c] for c in token)
    for token, i in added.items():
        bytes_of[i] = token.encode()
    return Vocabulary(first, merges, added, bytes_of)


class WordCache:
    """Results by word in two generations of at most ``room`` words: frequent words move to
    the young one before the old one goes.  Only work is saved; results never depend on it."""

    def __init__(self, room: int = 200_000, longest: int = 200):
        self.room, self.longest, self.young, self.old = room, longest, {}, {}

    def known(self, words: list[bytes]) -> tuple[list, list[int]]:
        """Results, and the places of the words that are missing."""
        young, old, out, missing = self.young, self.old, [], []
        for k, w in enumerate(words):
            got = young.get(w)
            if got is None:
                got = old.get(w)
                if got is None:
                    missing.append(k)
                else:
                    young[w] = got
            out.append(got)
        return out, missing

    def keep(self, word: bytes, result) -> None:
        if len(word) <= self.longest:
            if len(self.young) >= self.room:
                self.old, self.young = self.young, {}
            self.young[word] = result


def gather(values: list[bytes], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the texts end to end, and where each text's begin, from the little-endian
    uint32 identifiers of the distinct words."""
    lens = np.fromiter(map(len, values), np.int64, len(values)) // 4
    flat = np.frombuffer(b"".join(values), "<u4")
    offsets = np.cumsum(lens) - lens
    each = lens[words.codes]
    ends = np.concatenate([[0], np.cumsum(each)])
    place = np.repeat(offsets[words.codes] - ends[:-1], each) + np.arange(ends[-1])
    return flat[place], ends[words.bounds]
