"""Operators 6 and 9: statistics against plain Python, models by held-out accuracy."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import odd_texts
from thermoflux.llm import decision_list, rule_ensemble
from thermoflux.llm.textstats import FEATURES, feature_columns, counts_of, labelled_sample, text_counts


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            covered |= {i, i + 1, i + 2}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


@pytest.mark.parametrize("text", [*odd_texts(), "a a a a", "a b c a b c d", "x\ny\nx\n \n ", "é è é è é è"])
def test_base_statistics(text):
    assert text_counts(text)[:5] == plain(text)


def test_rules_on_odd_rows(spark, odd, none, labels):
    rules = decision_list.fit_rules(odd, labels)
    got = decision_list.apply_rules(odd, rules).collect()
    want = Counter((r.doc_id, *plain(r.text)) for r in odd.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert decision_list.apply_rules(none, rules).count() == 0
    empty = decision_list.fit_rules(none, labels.where("false"))
    assert empty.rules == [] and empty.default


def test_list_as_a_column_is_the_list(spark, documents, labels):
    sample = labelled_sample(documents, labels, "quality", 20_000)
    rules = decision_list.learn(sample)
    assert rules.rules
    c = F.col("c")
    wide = documents.withColumn("c", counts_of(F.col("text"))).select("doc_id", rules.column(feature_columns(c)).alias("kept"))
    by_id = {r.doc_id: r.kept for r in wide.collect()}
    assert [by_id[i] for i in sample.doc_id] == rules.predict(sample).tolist()


def test_lists_and_ensembles_hold_on_rows_they_have_not_seen(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    sample = labelled_sample(docs, labels, "quality", 20_000)
    odd = sample.doc_id % 3 == 0
    rules = decision_list.learn(sample[~odd].reset_index(drop=True))
    right = rules.predict(sample[odd]) == (sample[odd].label == 1)
    assert right.mean() > 0.9
    scored = rule_ensemble.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in scored if r.quality == 1], [r.score for r in scored if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95 and np.mean([r.predicted == r.quality for r in scored]) > 0.93


def test_held_out_labels_do_not_matter(spark, documents, labels):
    turned = labels.withColumn("quality", F.when(rule_ensemble.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rule_ensemble.fit_quality(documents, labels) == rule_ensemble.fit_quality(documents, turned)
    for r in documents.select("doc_id", rule_ensemble.held_out(F.col("doc_id")).alias("h")).collect():
        assert r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_scores_of_odd_rows(spark, odd, none, labels):
    got = rule_ensemble.quality_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert len({r.score for r in got if r.doc_id in (0, 1, 2)}) == 1  # null, empty, white space
    assert rule_ensemble.quality_scores(none, labels).count() == 0
    blank = rule_ensemble.quality_scores(odd, labels.where("false")).collect()
    assert {r.score for r in blank} == {0.5}
    only = rule_ensemble.quality_scores(odd, labels.withColumn("quality", F.lit(1))).collect()
    assert len({r.score for r in only}) == 1 and 0.7 < only[0].score < 1
    nulls = spark.createDataFrame([(None, 1, 1), (3, None, 0), (5, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    assert rule_ensemble.quality_scores(odd, nulls).count() == odd.count()


def test_ensemble_as_a_column_is_the_ensemble(spark, documents, labels):
    sample = labelled_sample(documents, labels, "quality", 20_000)
    model = rule_ensemble.learn(sample)
    assert 0 < len(model.rules) <= 200 and all(n in FEATURES for cs, _ in model.rules for n, _, _ in cs)
    by_id = {r.doc_id: r.score for r in rule_ensemble.with_score(documents, model).collect()}
    assert np.allclose([by_id[i] for i in sample.doc_id], model.score(sample))


def test_sample_is_bounded(spark, documents, labels):
    assert len(labelled_sample(documents, labels, "quality", 10)) <= 10
