"""The pipeline against its stages by brute force."""

import numpy as np
import regex

import corpus_pipeline
from conftest import SF001
from mdmspark.llm import line_cleaning, packing, pii
from mdmspark.llm.common import materialize
from mdmspark.llm.queries import tokenizer_path
from test_simhash import brute_components, brute_fingerprint


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "redact", "pack"]


def test_run_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    kept = {d: v[9] for d, t in docs.items() if (v := line_cleaning.judge(t))[8]}
    prints = {d: brute_fingerprint(t) for d, t in kept.items()}
    parts, first = brute_components(sorted(set(prints.values()))), {}
    for d in sorted(kept):
        first.setdefault(parts[prints[d]], d)
    kept = {d: kept[d] for d in first.values()}
    words = lambda t: " " + " ".join(regex.findall(r"[\p{L}\p{M}\p{N}]+", t.lower())) + " "
    items = [words(r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    kept = {d: t for d, t in kept.items() if not any(i in words(t) for i in items)}
    ids = packing.WordIds(tokenizer_path())
    wanted = sorted((d, len(ids.encode(pii.redact(t))) // 4 + 1) for d, t in kept.items())
    rows = corpus_pipeline.run(spark, SF001).collect()
    assert sorted({(r.doc_id, r.doc_tokens) for r in rows}) == wanted
    whole = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        whole.setdefault(r.doc_id, []).extend(r.ids)
    assert whole == {d: [*np.frombuffer(ids.encode(pii.redact(t)), "<u4").tolist(), packing.END_ID] for d, t in kept.items()}
    assert sum(r.length for r in rows) == sum(n for _, n in wanted)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, docs, SF001), f"test-{name}")
        assert out.dtypes == docs.dtypes, name
        docs = out
