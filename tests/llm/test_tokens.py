"""Operators 1, 2 and 10 against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from thermoflux.llm import pair_index, token_count, wavelet
from thermoflux.llm.common import scratch_table, tokenizer_path
from thermoflux.llm.pretokens import pieces, split_texts, vocabulary

PATH = tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_texts(n=3000):
    r = random.Random(1)
    parts = ["a", "b", "'s", "'", "'re", "'ll", "'t", " ", "  ", "\n", "\t", " \n", "1", "23", "!", "?!", "é", "中", "　", "<|endoftext|>", "<|endoftext|",
             "'ve", "\0", "\xa0", "x's", "\U0001f600", "aaa", "S", "l"]
    return ["".join(r.choices(parts, k=r.randint(0, 25))) for _ in range(n)]


def test_words_are_the_librarys_for_every_character(library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 20_000):
        text = "".join(f"a{chr(c)}1 {chr(c)}!b" for c in points[a:a + 20_000])
        words = split_texts([text])
        assert [words.distinct[c].decode() for c in words.codes] == [text[i:j] for _, (i, j) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_random_texts(library):
    texts = random_texts()
    want = [ids_of(library, t) for t in texts]
    assert token_count.count_texts(texts, PATH).tolist() == [len(x) for x in want]
    assert [x.tolist() for x in pair_index.encode_all(texts, PATH)] == want
    got = [[] for _ in texts]
    for k, ids in wavelet.encode_texts(texts, PATH):
        got[k] += ids.tolist()
    assert got == want


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ids = pair_index.encode_all([text], PATH)[0]
    assert ids.tolist() == ids_of(LIBRARY, text)
    assert pair_index.decode_ids(ids, pair_index.tables(PATH)).decode() == text


def test_long_texts_are_cut_between_words():
    text = ("word  two\n\nthree <|endoftext|> " * 200)[:-1]
    parts = pieces(text, 100)
    assert "".join(parts) == text and len(parts) > 20
    whole, cut = split_texts([text], ("<|endoftext|>",)), split_texts(parts, ("<|endoftext|>",))
    assert [whole.distinct[c] for c in whole.codes] == [cut.distinct[c] for c in cut.codes]


def test_identifiers_that_are_no_text_decode_as_in_the_library(library):
    t = pair_index.tables(PATH)
    ids = np.array([x for x in range(120, 256)] + [50256, 300], np.uint32)
    assert pair_index.decode_ids(ids, t).decode("utf-8", "replace") == library.decode(ids.tolist(), skip_special_tokens=False)


def test_queries_on_odd_rows(spark, library, odd, none):
    rows = odd.select("doc_id", "text").collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()), len(ids_of(library, r.text))) for r in rows)
    got = token_count.token_counts(odd).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    coded = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pair_index.coded_digests(odd).collect()}
    for r in rows:
        ids = np.array(ids_of(library, r.text), "<u4")
        assert (r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()) in coded
    real = pair_index.coded_documents(odd).collect()
    assert sorted(r.decoded for r in real) == sorted(r.text or "" for r in rows)
    assert token_count.token_counts(none).count() == pair_index.coded_digests(none).count() == 0


def test_token_files(spark, library, odd, none):
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in wavelet.token_file_digests(odd).collect())
    assert [r[1] for r in got] == sorted((r[1] for r in got), key=lambda x: (x is not None, x or 0))  # null first
    at = 0
    texts = {}
    for r in odd.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(np.array([*ids_of(library, r.text), 2], "<u4"))
    for start, doc, n, crc in got:
        assert start == at
        at += n
        assert (n, crc) in [(len(x), zlib.crc32(x.tobytes())) for x in texts[doc]]
    assert len(got) == odd.count() and wavelet.token_file_digests(none).count() == 0


def test_many_small_shards(spark, library, documents):
    folder = scratch_table(spark, "tokens")
    wavelet.write_tokens(documents, folder, shard_tokens=3000)
    rows = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in wavelet.read_documents(spark, folder).collect())
    at = 0
    for (doc, start, n, crc), r in zip(rows, documents.orderBy("doc_id").collect(), strict=True):
        ids = np.array([*ids_of(library, r.text), 2], "<u4")
        assert (doc, start, n, crc) == (r.doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += n
    shard = spark.read.parquet(folder).orderBy("part", "shard").first()
    w, ids = wavelet.WaveletMatrix.open(bytes(shard.planes)), wavelet.WaveletMatrix.decode(bytes(shard.planes))
    assert sum(shard.lengths) == w.n == len(ids)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_wavelet_matrix_against_lists(n):
    ids = np.random.default_rng(n).integers(0, 40, n).astype(np.uint32)
    w = wavelet.WaveletMatrix.open(wavelet.WaveletMatrix.pack(ids, 6))
    assert (w.access(np.arange(n)) == ids).all() and (wavelet.WaveletMatrix.decode(wavelet.WaveletMatrix.pack(ids, 6)) == ids).all()
    for token in range(42):
        assert w.occurrences(token) == np.flatnonzero(ids == token).tolist()
        assert w.count(token, n // 3, n // 2) == (ids[n // 3:n // 2] == token).sum()
    assert w.count(64) == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        vocabulary(tokenizer_path("word_bpe_49k.json"))
