"""Operator 12 against whole-text encodings and all links, counted one by one."""

import hashlib
import random

import pytest

from tests.llm.conftest import SF
from thermoflux.llm import alignment
from thermoflux.llm.common import tokenizer_path
from thermoflux.llm.queries import QUERIES


def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def brute(rows):
    a, b = tools()
    letters = alignment.byte_of_letter()
    per = []
    for key, text in rows:
        text = text or ""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            per.append((key, [], [], None))
            continue
        ends = []
        for parts in (bytes_a, bytes_b):
            at, out = 0, []
            for p in parts:
                at += len(p)
                out.append(at)
            ends.append(out)
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            p, q = i, j
            while i < len(ids_a) and ends[0][i] <= cut:
                i += 1
            while j < len(ids_b) and ends[1][j] <= cut:
                j += 1
            groups.append((ids_a[p:i], ids_b[q:j]))
            links += [(x, y) for x in ids_a[p:i] for y in ids_b[q:j]]
        per.append((key, groups, links, (len(ids_a), len(ids_b))))
    docs = {}
    for _, _, links, _ in per:
        for pair in set(links):
            docs[pair] = docs.get(pair, 0) + 1
    highest = {}
    for (x, _), c in docs.items():
        highest[x] = max(highest.get(x, 0), c)
    out = []
    for key, groups, links, sizes in per:
        if sizes is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((key, *sizes, len(groups), len(links), sum(docs[x] == highest[x[0]] for x in links), sum(docs[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return out, docs, highest


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(got, rows):
    assert got.columns == COLUMNS
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, brute(rows)[0]))


ODD = ["a  b   c", " leading", "trailing  ", "\n\n x\t\ty \r\n z", "中文 😀 naïve é ① ②③", "a▁b is refused", "¨ x ﬁ", "<s> </s> <unk> <0x41> <|endoftext|>",
       "\x00 \x01a", "x" * 3000, "　　 wide  spaces　", "don't we'll 'S 123 4567  89", "a\u0301 e\u0301", "\u200b \u200b", "\x85 \x1c b", " ", "\n", "  \n  ",
       "‍👩‍👩‍👧 family", "ab " * 500, "  two", ");\r }\r x"]


@pytest.mark.parametrize("chars", [1, 400, 1 << 22])
def test_odd_texts(spark, chars):
    r = random.Random(12)
    rows = [(i, t) for i, t in enumerate([*ODD, None, "", *ODD[:5]])]
    rows += [(100 + i, "".join(r.choices(["a", "é", " ", "  ", "\n", "中", "😀", "the", " the", "①", "\t", ".", "'s", "１"], k=40))) for i in range(60)]
    rows += [(None, "null id"), (3, ODD[3]), (3, "another text")]
    docs = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, n_a string").repartition(3)
    scored, counts = alignment.aligned_documents(docs, chars=chars)
    check(scored, rows)
    _, want, highest = brute(rows)
    assert {((x.a, x.b), x.docs, x.best) for x in counts.collect()} == {(k, c, c == highest[k[0]]) for k, c in want.items()}


def test_wide_and_empty_tables(spark, odd, none):
    scored, counts = alignment.aligned_documents(odd)
    check(scored, [(r.doc_id, r.text) for r in odd.collect()])
    scored, counts = alignment.aligned_documents(none)
    assert scored.count() == 0 and counts.count() == 0


def test_query(spark, documents):
    check(QUERIES["op12_alignment"](spark, SF), [tuple(r) for r in documents.select("doc_id", "text").collect()])


def test_spans_give_the_same_ends_as_bytes():
    pair = alignment.tokenizer_pair(tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    assert pair.cuts
    r = random.Random(2)
    for _ in range(400):
        text = " " + "".join(r.choices(["a", "é", " ", "中", "😀", "①", "\n", "the", "１", "\x00"], k=r.randint(1, 30)))
        a, b = pair.a.encode(text, add_special_tokens=False), pair.b.encode(text[1:], return_type="offset_mapping", return_bytes=True)
        for ids, ends, table in ((a.ids, pair.ends_a(text, a.ids, a.offsets), pair.bytes_a), (b["ids"], pair.ends_b(text[1:], b["ids"], b["offsets"]), pair.bytes_b)):
            at, want = 0, []
            for i in ids:
                at += len(table[i])
                want.append(at)
            assert ends == want and b"".join(table[i] for i in ids) == text.encode()


def test_texts_are_cut_the_same_with_and_without_runs_of_blanks():
    pair = alignment.tokenizer_pair(tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    r = random.Random(6)
    for _ in range(2000):
        text = "".join(r.choices(["a", "é.", " ", "\n", "  ", "b"], k=r.randint(1, 9)))
        assert "".join(" " + s for s in pair.stretches(text)) == " " + text
        ids = [i for s in pair.stretches(text) for i in pair.a.encode(" " + s, add_special_tokens=False).ids]
        assert ids == pair.a.encode(" " + text, add_special_tokens=False).ids
        assert [i for s in pair.stretches(text) for i in pair.b.encode(s)] == pair.b.encode(text)
