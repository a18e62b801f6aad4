"""The pipeline's stages against plain checks of what each must do."""

from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import SF
from tests.llm.test_simhash import classes, plain_fingerprint
from thermoflux.llm.common import tokenizer_path, written
from thermoflux.llm.feistel import pseudonymise
from thermoflux.llm.queries import DEMO_KEY


def test_stages(spark, documents):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "simhash", "pii", "packing"]
    stage, docs = dict(corpus_pipeline.STAGES), documents
    kept = written(stage["quality"](spark, docs, SF), "t")
    assert kept.columns == docs.columns and 0.5 * docs.count() < kept.count() < docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good, ours = labels.where("quality = 1"), kept.join(labels.where("quality = 1"), "doc_id")
    assert ours.count() >= 0.95 * good.count()
    cleaned = written(stage["line_dedup"](spark, kept, SF), "t")
    assert cleaned.columns == docs.columns and cleaned.count() == kept.count()
    assert all(r.n_chars == len(r.text) for r in cleaned.collect())
    single = written(stage["simhash"](spark, cleaned, SF), "t")
    rows = cleaned.orderBy("doc_id").collect()
    groups = classes([plain_fingerprint(r.text) for r in rows])
    assert sorted(r.doc_id for r in single.collect()) == sorted({g: rows[g].doc_id for g in groups}.values())
    hidden = written(stage["pii"](spark, single, SF), "t")
    assert {r.doc_id: r.text for r in hidden.collect()} == {r.doc_id: pseudonymise(r.text, DEMO_KEY.encode())[0] for r in single.collect()}
    packed = stage["packing"](spark, hidden, SF)
    library = Tokenizer.from_file(tokenizer_path())
    assert sorted((r.doc_id, r.n_tokens) for r in packed.collect()) == sorted((r.doc_id, len(library.encode(r.text, add_special_tokens=False).ids)) for r in hidden.collect())
    filled = {}
    for r in packed.collect():
        filled.setdefault((r.bucket, r.batch), []).append(r.n_tokens + r.padding)
    assert all(len(x) == 1 or sum(x) <= 8192 for x in filled.values())
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, packed.collect()))


def test_no_labels_no_verdict(spark, documents, monkeypatch):
    """Where nothing can be learned, no document is rejected."""
    read = corpus_pipeline.read_table
    monkeypatch.setattr(corpus_pipeline, "read_table", lambda s, d, n: read(s, d, n).where("false"))
    assert corpus_pipeline.quality(spark, documents, SF).count() == documents.count()


def test_odd_and_empty_tables(spark, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, none):
            out = written(stage(spark, docs, SF), "t")
            assert name == "packing" or out.columns == docs.columns
            assert out.count() <= docs.count() and (docs is odd or out.count() == 0)
