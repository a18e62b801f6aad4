"""Operator 8 against all pairs of lines."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from thermoflux.llm import common, line_dedup
from thermoflux.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows):
    """{(doc_id, text): (new text, lines gone)}; rows with equal id and text are one document."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len({i for i, _ in docs}) == len(docs), "ties by hash are tested apart"
    seen, out = [], {}
    for i, t in docs:
        kept, gone = [], 0
        for line in t.split("\n"):
            w = line.encode().split()
            if len(w) >= 5:
                if any(abs(len(w) - len(s)) <= 1 and distance(w, s) <= 1 for s in seen):
                    seen.append(w)
                    gone += 1
                    continue
                seen.append(w)
            kept.append(line)
        out[i, t] = "\n".join(kept), gone
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, row_key string").repartition(4)
    got = line_dedup.dedup_lines(docs, "n_removed")
    assert got.columns == ["doc_id", "text", "row_key", "n_removed"]
    want = brute(rows)
    expected = [(i, None if t is None else want[i, t][0], want[i, t or ""][1]) for i, t in rows]
    assert sorted((str((r.doc_id, r.text, r.n_removed)) for r in got.collect())) == sorted(map(str, expected))


@pytest.fixture(params=["plain", "large keys, full filter, no broadcast"])
def odd_sizes(request, spark, monkeypatch):
    """Every key of two lines is large, the filter lets all lines pass, joins are shuffled."""
    if request.param != "plain":
        monkeypatch.setattr(line_dedup, "SMALL", 1)
        monkeypatch.setattr(line_dedup, "BITS", 8)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("seed", range(2))
def test_edited_lines(spark, seed, odd_sizes):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(7)]
    lines = [r.choices(words, k=r.randint(3, 9)) for _ in range(25)]
    rows = []
    for doc in range(60):
        own = []
        for _ in range(r.randint(0, 5)):
            line = list(r.choice(lines))
            for _ in range(r.choice([0, 1, 1, 2])):
                at = r.randrange(len(line) + 1)
                kind = r.randrange(3)
                if kind == 0:
                    line.insert(at, r.choice(words))
                elif at < len(line) and len(line) > 2:
                    line[at:at + 1] = [] if kind == 1 else [r.choice(words)]
            own.append(r.choice([" ", "  "]).join(line))
        rows.append((doc, "\n".join(own)))
    check(spark, rows + rows[:3] + [(1000, None), (1001, ""), (None, "\n".join(" ".join(x) for x in lines[:3]))])


def test_hot_template(spark):
    """Hundreds of lines that differ in one word: all but the earliest go."""
    check(spark, [(i, f"the same long line of words with number {i} inside it") for i in range(300)])


def test_passages_and_long_lines(spark):
    r = random.Random(9)
    passage = " ".join(r.choices([f"p{i}" for i in range(500)], k=60))
    long = " ".join(r.choices([f"q{i}" for i in range(5000)], k=9000))
    edited = long.split()
    edited[4321] = "other"
    check(spark, [(1, f"own words of document one here\n{passage}"), (2, f"{passage}\nother words of the second document"), (3, long), (4, " ".join(edited)), (5, long + " end")])


def test_odd_rows(spark, odd, none):
    got = line_dedup.dedup_lines(odd)
    assert got.columns == odd.columns and got.count() == odd.count()
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r.doc_id, []).append(r.text)
    assert by_id[0] == [None] and by_id[1] == [""] and by_id[9] == ["same line of five words\n"] and by_id[6] == by_id[7] == [""]
    assert len(by_id[5]) == 3 and len(by_id[None]) == 2
    assert line_dedup.dedup_lines(none, "n").count() == 0


def test_bounds_against_the_full_table():
    r = random.Random(1)
    for _ in range(3000):
        a, b = (r.choices("ab c".split(), k=r.randint(0, 12)) for _ in range(2))
        for per in (None, 5, 8):
            bound = max(1, max(len(a), len(b)) // per) if per else 1
            assert line_dedup.within_bound(" ".join(a), " ".join(b), per) == (distance(a, b) <= bound)


def test_table(spark, documents):
    check(spark, [tuple(r) for r in documents.select("doc_id", "text").limit(60).collect()])


def test_equal_short_lines(spark):
    """With ``least`` = 1 equal lines go whatever their length; short lines are never near."""
    rows = [(1, "Home\n\nmy  own menu\nHome"), (2, "my own menu\nmy own page\n \nHome"), (3, "Home"), (None, "a line of five words\nend")]
    docs = spark.createDataFrame([*rows, rows[2]], "doc_id long, text string")
    got = sorted((str((r.doc_id, r.text, r.n)) for r in line_dedup.dedup_lines(docs, "n", least=1).collect()))
    want = [(1, "Home\n\nmy  own menu", 1), (2, "my own page\n ", 2), (3, "", 1), (3, "", 1), (None, "a line of five words\nend", 0)]
    assert got == sorted(map(str, want))


def test_query_takes_out_short_lines(spark, documents):
    seen, want = set(), {}
    for r in documents.select("doc_id", "text").orderBy("doc_id").collect():
        lines = [tuple(x.encode().split()) for x in (r.text or "").split("\n")]
        want[r.doc_id] = 0
        for words in lines:
            want[r.doc_id] += 0 < len(words) < 5 and words in seen
            seen.add(words)
    got = QUERIES["op8_line_dedup"](spark, SF).collect()
    assert sum(want.values()) > 0 and all(r.n_removed >= want[r.doc_id] for r in got)


def edited(r, line, words, most):
    line = list(line)
    for _ in range(r.randint(0, most)):
        at = r.randrange(len(line))
        line[at:at + 1] = r.choice([[], [r.choice(words)], [line[at], r.choice(words)]])
    return line


def brute_growing(rows, per):
    """{doc_id: lines gone}: one-line texts, against all earlier ones."""
    seen, want = [], {}
    for doc, text in sorted(rows):
        w = text.split()
        want[doc] = int(any(x == w or min(len(x), len(w)) >= 5 and distance(x, w) <= max(1, max(len(x), len(w)) // per) for x in seen))
        seen.append(w)
    return want


@pytest.mark.parametrize("per", [5, 8])
def test_growing_bound(spark, per, odd_sizes):
    """Every line within a fifth, or an eighth, of the longer line's words of an earlier one goes."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    lines = [r.choices(words, k=r.choice([5, 7, 8, 9, 10, 12, 14, 15, 16, 17, 20, 31, 60, 66, 70, 90])) for _ in range(40)]
    rows = [(doc, " ".join(edited(r, line, words, len(line) // 4 + 1))) for doc in range(150) for line in [r.choice(lines)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_growing(rows, per)
    assert {x.doc_id: x.n for x in line_dedup.dedup_lines(docs, "n", least=1, growing=True, words_per_edit=per).collect()} == want
    if per == 5:
        one = {x.doc_id: x.n for x in line_dedup.dedup_lines(docs, "n").collect()}
        assert sum(one.values()) < sum(want.values())


def test_growing_bound_with_odd_rows(spark):
    """Nulls, ties, repeated rows, clashing names, ids that are no numbers."""
    r = random.Random(14)
    words = [f"w{i}" for i in range(300)]
    line = r.choices(words, k=40)
    near = [" ".join(edited(r, line, words, 3)) for _ in range(6)]
    rows = [("b", near[0]), ("a", near[1]), ("a", near[1]), ("c", f"{near[2]}\n\n{near[2]}"), (None, near[3]), ("d", None), ("e", ""), ("f", " "), ("b", "another row under the id b\n" + near[4])]
    docs = spark.createDataFrame([(*x, "x", "y") for x in rows], "doc_id string, text string, row_key string, gone string")
    got = line_dedup.dedup_lines(docs, "n", least=1, growing=True)
    assert got.columns == ["doc_id", "text", "row_key", "gone", "n"]
    by = {}
    for x in got.collect():
        by.setdefault(x.doc_id, []).append((x.text, x.n))
    assert by[None] == [(near[3], 0)] and by["a"] == [("", 1)] * 2 and by["c"] == [("", 2)] and by["d"] == [(None, 0)] and by["e"] == [("", 0)] and by["f"] == [(" ", 0)]
    assert sorted(by["b"]) == [("", 1), ("another row under the id b", 1)]
    assert line_dedup.dedup_lines(docs.limit(0), "n", least=1, growing=True).count() == 0


@pytest.mark.parametrize("keys", [None, line_dedup.KEYS])
def test_query_against_all_pairs(spark, documents, keys):
    """The exact form finds the lines that all pairs give; the registered one 0.9 of them and no other."""
    rows = [tuple(x) for x in documents.select("doc_id", "text").limit(120).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen, want = [], {}
    for doc, text in sorted(rows):
        want[doc] = 0
        for line in (text or "").split("\n"):
            w = line.encode().split()
            if w:
                n = len(w)
                want[doc] += any(x == w or min(len(x), n) >= 5 and abs(len(x) - n) <= max(len(x), n) // 5 + 1 and line_dedup.distance(x, w) <= max(1, max(len(x), n) // 5) for x in seen)
                seen.append(w)
    got = {x.doc_id: x.n for x in line_dedup.dedup_lines(docs, "n", least=1, growing=True, keys=keys).collect()}
    if keys is None:
        assert got == want
    assert all(got[k] <= want[k] for k in want) and sum(got.values()) >= 0.9 * sum(want.values()) > 0


def test_bounded_keys_find_few_edits_always_and_most_beyond(spark):
    """Up to (keys - 1) // 4 edits every pair is found, at the whole bound 0.9 of them."""
    r = random.Random(21)
    words = [f"w{i}" for i in range(3000)]
    rows, sure = [], {}
    for i in range(400):
        line = r.choices(words, k=r.choice([5, 6, 7, 9, 14, 24, 40, 80]))
        n = min(2, max(1, len(line) // 5)) if i % 2 else max(1, len(line) // 5)
        new = list(line)
        for _ in range(n):
            at = r.randrange(len(new))
            new[at:at + 1] = r.choice([[], [r.choice(words)], [new[at], r.choice(words)]]) if len(new) > 5 else [r.choice(words)]
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(new))]
        longer = max(len(line), len(new))
        if distance(line, new) <= max(1, longer // 5):
            sure[2 * i + 1] = distance(line, new) <= 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x.doc_id: x.n for x in line_dedup.dedup_lines(docs, "n", growing=True, keys=line_dedup.KEYS).collect()}
    assert all(got[k] for k, always in sure.items() if always) and sum(got[k] for k in sure) >= 0.9 * len(sure)
    assert sum(got.values()) == sum(got[k] for k in sure)


def test_unlike_lines_of_frequent_words_meet_seldom(spark):
    """Lines of 12 words over 60 words share many pairs of words but are unlike: the pairs
    that are compared grow with the lines, not with their square."""
    r = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    counts = {}
    for n in (1500, 6000):
        docs = spark.createDataFrame([(i, " ".join(r.choices(words, k=12))) for i in range(n)], "doc_id long, text string").withColumn("row_key", line_dedup.F.xxhash64("doc_id"))
        times = line_dedup.pair_times(docs)
        found = line_dedup.shared_keys(line_dedup.keyed_lines(docs, times, 5))
        counts[n] = found.where("b IS NOT NULL").distinct().count()
    assert counts[6000] < 12 * counts[1500]


def test_distance_against_the_full_table():
    r = random.Random(2)
    for _ in range(3000):
        a, b = (r.choices("abcd", k=r.randint(0, 12)) for _ in range(2))
        assert line_dedup.distance(a, b) == distance(a, b)


def test_lines_of_few_edits_share_a_bounded_key():
    r = random.Random(31)
    for _ in range(1500):
        words = [f"{i}" for i in range(r.choice([1, 2, 5, 500]))]
        a = r.choices(words, k=r.choice([5, 6, 7, 8, 9, 10, 12, 20, 40]))
        b = list(a)
        for _ in range(min(2, max(1, len(a) // 5))):
            at = r.randrange(len(b))
            b[at:at + 1] = r.choice([[], [r.choice(words)], [b[at], r.choice(words)]])
        if len(b) < 5 or distance(a, b) > min(2, max(1, max(len(a), len(b)) // 5)):
            continue
        line, key = line_dedup.sketch(line_dedup.Words([" ".join(a), " ".join(b)]), 5, line_dedup.KEYS)
        assert set(key[line == 0]) & set(key[line == 1]), (a, b)


@pytest.mark.parametrize("per", [None, 5, 8])
def test_lines_within_the_bound_share_keys(per):
    r = random.Random(3)
    for k in range(700):
        words = [f"{i}" for i in range(r.choice([2, 5, 500]))]
        times = np.random.default_rng(k).integers(0, 3, 64).astype(np.int32)
        a = r.choices(words, k=r.choice([5, 7, 12, 15, 16, 17, 30, 66, 75, 90]))
        b = list(a)
        for _ in range(max(1, len(a) // per) if per else 1):
            at = r.randrange(len(b))
            b[at:at + 1] = r.choice([[], [r.choice(words)], [b[at], r.choice(words)]])
        if len(b) < 5 or distance(a, b) > (max(1, max(len(a), len(b)) // per) if per else 1):
            continue
        line, key = line_dedup.prefix(line_dedup.Words([" ".join(a), " ".join(b)]), times, per)
        assert set(key[line == 0]) & set(key[line == 1])
        x, y = line_dedup.neighbourhood([" ".join(a), " ".join(b)], times, per)
        assert set(x) & set(y)


def test_words_and_signatures():
    texts = ["a b\n\n a  b ", "", "naïve façade\u3000x\n", "b a", "a b", "\n"]
    w = line_dedup.Words(texts, 2)
    lines = [(d, n, x) for d, t in enumerate(texts) for n, x in enumerate(t.split("\n"))]
    assert [(d, n) for d, n, _ in lines] == list(zip(w.doc.tolist(), w.number.tolist(), strict=True))
    assert [w.text(i) for i in range(len(lines))] == [x for _, _, x in lines]
    assert w.n.tolist() == [len(x.encode().split()) for _, _, x in lines]
    for k in range(2):
        by = {}
        for s, (_, _, x) in zip(w.signature(k).tolist(), lines, strict=True):
            by.setdefault(tuple(x.encode().split()), set()).add(s)
        assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)
    assert len(line_dedup.Words([""]).n) == 1


def edited_at_the_whole_bound():
    """(doc_id, text): every odd document is the one before it with each fifth word another."""
    r = random.Random(41)
    rows = []
    for i in range(150):
        line = [f"w{r.randrange(10**6)}" for _ in range(r.choice([25, 60, 120]))]
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(f"other{i}x{k}" if k % 5 == 4 else w for k, w in enumerate(line)))]
    return rows


def test_query_loses_no_line_at_the_whole_bound(spark, tmp_path):
    rows = edited_at_the_whole_bound()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {x.doc_id: x.n_removed for x in QUERIES["op8_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {i: i % 2 for i, _ in rows}


def test_packed_keys_come_back():
    """Rows of ``packed``: each distinct (key, id) once; of a key that is large within the run a
    few go to its part, the others to parts of their own."""
    r = np.random.default_rng(5)
    keys = line_dedup.canonical(np.concatenate([r.integers(0, 1 << 63, 5000, dtype=np.uint64), np.repeat(r.integers(0, 1 << 63, 3, dtype=np.uint64), 20_000)]), 7)
    ids = r.integers(0, 1 << 48, len(keys))
    keys, ids = np.append(keys, keys[:10]), np.append(ids, ids[:10])
    got, known = [], 0
    for row in line_dedup.packed(keys, ids, 7).to_pylist():
        own = line_dedup.unpack(row["ids"], row["n"], 5, 6)
        k = line_dedup.unpack(row["keys"], row["n"], 0, 8) if row["known"] else np.cumsum(line_dedup.unpack(row["keys"], row["n"], 2, 5)) | row["part"] << line_dedup.KEY_BITS
        assert row["known"] or row["part"] < 7 and row["n"] <= 5000
        known += row["n"] * row["known"]
        got += zip(k.tolist(), own.tolist(), strict=True)
    assert sorted(got) == sorted(set(zip(keys.tolist(), ids.tolist(), strict=True))) and known == 3 * (20_000 - line_dedup.SMALL - 1)
    assert line_dedup.packed(keys[:0], ids[:0], 7).num_rows == 0


def test_pairs_that_a_partner_lacks():
    r = random.Random(6)
    for _ in range(4000):
        per = r.choice([None, 4, 5, 8])
        a = [f"{i}" for i in range(r.randint(5, 45))]
        b = list(a)
        for k in range(max(1, len(a) // 4)):
            at = r.randrange(len(b))
            b[at:at + 1] = r.choice([[], [f"x{k}"], [b[at], f"x{k}"], [b[at], f"x{k}"]])
            if len(b) >= 5 and distance(a, b) <= (max(1, max(len(a), len(b)) // per) if per else 1):
                lost = set(zip(a, a[1:], strict=False)) - set(zip(b, b[1:], strict=False))
                assert len(lost) <= line_dedup.spoiled_pairs(len(a), per)


def test_stage_loses_no_line_at_the_whole_bound(spark):
    import corpus_pipeline

    rows = edited_at_the_whole_bound()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {x.doc_id: x.text for x in corpus_pipeline.lines(spark, docs, SF).collect()} == {i: "" if i % 2 else t for i, t in rows}


def test_many_pairs_are_compared_as_single_ones_are():
    r = random.Random(12)
    texts = [" ".join(r.choices(["a", "b", "ç", "d" * 9], k=r.randint(0, 12))) for _ in range(4000)]
    for per in (None, 5, 8):
        got = line_dedup.are_within_bound(texts[::2], texts[1::2], per).tolist()
        assert got == [line_dedup.within_bound(a, b, per) for a, b in zip(texts[::2], texts[1::2], strict=True)] and 0 < sum(got) < len(got)
    assert line_dedup.are_within_bound([""], [""], 5).tolist() == [True] and len(line_dedup.are_within_bound([], [], 5)) == 0


def test_a_written_step_leaves_no_shuffle_files(spark):
    """The shuffle files of a step that is written go as it ends, and the session's setting stays
    what it was."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {x.getName() for x in (lambda found: [found.apply(i) for i in range(found.size())])(disk.getAllFiles()) if x.getName().startswith("shuffle_")}

    was, before = spark.conf.get(common.SHUFFLE_CLEANUP, "false"), files()
    back = common.written(spark.range(50_000).repartition(7).groupBy((F.col("id") % 999).alias("k")).count(), "step")
    until = time.time() + 20
    while (left := files() - before) and time.time() < until:
        time.sleep(0.5)
    assert not left and spark.conf.get(common.SHUFFLE_CLEANUP, "false") == was
    assert back.count() == 999 and back.agg(F.sum("count")).first()[0] == 50_000


def test_parities_rule_out_no_pair_within_the_bound():
    r = random.Random(17)
    pairs = []
    for _ in range(800):
        words = [f"{i}" for i in range(r.choice([2, 30, 5000]))]
        line = r.choices(words, k=r.choice([1, 5, 12, 60, 300]))
        pairs.append((line, edited(r, line, words, max(1, len(line) // 5))))
    pairs += [(r.choices(range(5000), k=60), r.choices(range(5000), k=60)) for _ in range(50)]
    x, y = (line_dedup.Words([" ".join(map(str, p[k])) for p in pairs]) for k in (0, 1))
    at = np.arange(len(pairs))
    turned = np.bitwise_count((line_dedup.parities(x, at) ^ line_dedup.parities(y, at)).view(np.uint64)).sum(axis=0, dtype=int)
    assert all(t <= 2 * line_dedup.distance(a, b) for t, (a, b) in zip(turned.tolist(), pairs, strict=True))
    assert (turned[800:] > 24).all()  # unlike lines: no text is fetched
    assert (line_dedup.parities(x, at[3:90:7]) == line_dedup.parities(x, at)[:, 3:90:7]).all()


def test_pairs_of_every_document_are_counted(spark, monkeypatch):
    """Lines of a phrase that 20 lines have, beside words of their own, over more documents than a
    sample would take: the phrase's pairs are known as frequent, so no line has a large key."""
    monkeypatch.setattr(line_dedup, "SAMPLE_DOCS", 500, raising=False)
    phrases = [[f"p{i}x{k}" for k in range(8)] for i in range(200)]
    rows = [(i, " ".join([*(f"own{i}x{k}" for k in range(12)), *phrases[i % 200]])) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("row_key", F.xxhash64("doc_id"))
    times = line_dedup.pair_times(docs)
    found = line_dedup.shared_keys(line_dedup.keyed_lines(docs, times, 5))
    assert found.where("b IS NULL").count() == 0
    words = line_dedup.Words([t for _, t in rows])
    frequent = np.tile(np.arange(19) >= 12, len(rows))
    rank = line_dedup.ranked_pairs(words, times)[2]
    assert rank[frequent].min() > np.quantile(rank[~frequent], 0.99)


def test_no_order_of_pairs_changes_what_goes(spark, monkeypatch):
    r = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    lines = [r.choices(words, k=r.choice([5, 9, 10, 16, 30, 70])) for _ in range(30)]
    rows = [(doc, " ".join(edited(r, line, words, len(line) // 4 + 1))) for doc in range(120) for line in [r.choice(lines)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_growing(rows, 5)
    for times in (np.zeros(1, np.int32), np.random.default_rng(3).integers(0, 9, 64).astype(np.int32)):
        monkeypatch.setattr(line_dedup, "pair_times", lambda *_, t=times: t)
        assert {x.doc_id: x.n for x in line_dedup.dedup_lines(docs, "n", least=1, growing=True).collect()} == want


def test_a_pair_meets_at_its_least_common_keys_alone(spark):
    r = random.Random(23)
    base = [r.sample(range(10**6), 60) for _ in range(3)]
    lines = {i: sorted(r.sample(base[i % 3], r.choice([2, 3, 20, 50]))) for i in range(60)}
    rows = [(k, i, *(own + [None] * 3)[:3]) for i, own in lines.items() for k in own]
    wide = spark.createDataFrame(rows, f"key long, id long, {', '.join(f'{c} long' for c in line_dedup.LEAST)}")
    other = wide.select("key", F.col("id").alias("b"), *[F.col(c).alias(f"o_{c}") for c in line_dedup.LEAST])
    met = wide.join(other, "key").where(F.col("id") < F.col("b"))
    got = [(x.id, x.b) for x in met.where(~line_dedup._met_before()).collect()]
    assert set(got) == {(i, j) for i in lines for j in lines if i < j and set(lines[i]) & set(lines[j])} and len(got) < met.count() / 2
