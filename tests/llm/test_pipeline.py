"""Every stage of the pipeline against a plain version on its own input."""

import numpy as np

import corpus_pipeline
from tests.llm.test_operators import base_spans, components_of, shingles

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        ids = {r.doc_id for r in after}
        if name != "tokens":
            assert docs.columns == columns
        if name == "quality":
            assert 0 < len(after) < len(before) and all(len((r.text or "").split()) >= 50 for r in after)
        if name == "near_duplicates":
            sets = {r.doc_id: shingles(r.text) for r in before}
            want = components_of(list(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
            assert ids == {i for i, c in want.items() if i == c}
        if name == "personal_data":
            assert ids == {r.doc_id for r in before} and not any(base_spans(r.text) for r in after)
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "mixture":
            assert ids <= {r.doc_id for r in before} and max(np.unique([r.doc_id for r in after], return_counts=True)[1]) <= 3
        if name == "tokens":
            text = {r.doc_id: r.text for r in before}
            assert len(after) == len(before) and all(r.decoded == text[r.doc_id] and len(r.ids) == 4 * r.n_tokens for r in after)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
