"""The pipeline against plain versions of what each stage decides."""

import re

import sentencepiece

from test_operators import brute_classes

import corpus_pipeline
from evisift.llm import sentencepieces

SF = "/root/testdata/sf0.001"


def test_stages_and_decisions(spark):
    kept = docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        kept = spark.createDataFrame(stage(spark, kept, SF).toPandas()) if k < 4 else stage(spark, kept, SF)
        if k < 4:
            assert kept.columns == corpus_pipeline.COLUMNS
            kept = kept.selectExpr("cast(doc_id as long) doc_id", "text", "lang", "source", "cast(n_chars as long) n_chars")
        rows[name] = {r.doc_id: r for r in kept.collect()}
    counts = [len(r) for r in rows.values()]
    assert counts == sorted(counts, reverse=True) and counts[-1] >= 0.6 * docs.count()
    texts = [tuple(r.text.split()) for r in rows["ngram_jaccard_join"].values()]
    assert len(texts) == len(set(texts))
    kept = rows["ngram_jaccard_join"]
    classes = brute_classes([(d, r.text) for d, r in rows["toxicity"].items()])
    assert set(kept) == {d for d, (first, _) in classes.items() if d == first} and len(kept) < len(rows["toxicity"])
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(i in " ".join(r.text.lower().split()) for r in rows["benchmark_decontamination"].values() for i in items)
    for d, r in rows["secret_scans"].items():
        assert not re.search(r"[0-9a-f]{24,}", r.text) and r.n_chars == len(r.text) if "[SECRET]" in r.text else r.text == rows["benchmark_decontamination"][d].text
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.default_model())
    assert all(r.ids == sp.encode(r.text) for r in rows["sentencepiece"].values())


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
