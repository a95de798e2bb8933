"""The pipeline's stages against plain code, one after the other."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.conftest import ROWS
from tests.llm.test_operators import hits, shingles, strong
from textmill.llm.common import materialize


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    kept = materialize(stages["quality_rules"](spark, docs, folder), "t")
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} <= {i for i, t, _ in ROWS if t and len(t.split()) >= 10}
    alone = stages["minhash_near_dedup"](spark, docs, folder)
    assert alone.columns == columns
    texts = {i: t for i, t, _ in ROWS}
    ids = sorted(r["doc_id"] for r in alone.collect())
    assert ids == sorted(set(texts) - {5, 7}) and all(shingles(texts[a]) != shingles(texts[b]) or not shingles(texts[a]) for a in ids for b in ids if a < b)
    clean = stages["decontamination"](spark, docs, folder)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    bad = {i for i, t in texts.items() if (h := hits(t, items))[1] and 20 * h[1] >= h[0]}
    assert clean.columns == columns and 9 in bad and {r["doc_id"] for r in clean.collect()} == set(texts) - bad
    masked = {r["doc_id"]: r for r in stages["secret_scan"](spark, docs, folder).collect()}
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in masked.values())
    assert all((masked[i]["text"] == t) == (not strong(t or "")) for i, t in texts.items() if i != 10)
    assert not strong(masked[10]["text"])


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    assert out and all(r["length"] <= 2048 for r in out)


def test_empty(spark, folder, tmp_path):
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").where("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
