"""The pipeline against a plain version of its stages."""

from collections import Counter

import pytest

import corpus_pipeline
from boxstar.llm import quality, secrets

from .conftest import SF
from .test_dedup import brute_components, brute_print
from .test_tokens import check_packing


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near-dedup", "secret scans", "packing"]


def plain_pipeline(rows, weights):
    """(doc_id, text) that reach packing, by loops and all pairs."""
    import numpy as np

    rows = [(i, t) for i, t in rows if quality.score_text(t, weights) >= quality.THRESHOLD]
    prints = np.array([brute_print(t) for _, t in rows], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    comps = brute_components([i for i, _ in rows], near)
    kept = [(i, t) for (i, t), c in zip(rows, comps) if i == c]
    return [(i, secrets.redact(t)) for i, t in kept]


def test_pipeline_against_plain_version(spark, small_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    weights = quality.train_scorer(docs, quality.label_model(docs))
    want = plain_pipeline(small_docs, weights)
    check_packing(corpus_pipeline.run(spark, SF).collect(), want)
    assert 0.5 * len(small_docs) < len(want) < len(small_docs)


def test_stages_keep_columns_and_survive_awkward_rows(spark, awkward, no_docs):
    for df in (awkward, no_docs):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = out
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        check_packing(rows, texts)


@pytest.mark.parametrize("k", [0, 1, 2])
def test_each_stage_does_its_work(spark, k):
    sf = "/root/testdata/sf0.01"  # large enough to hold secrets
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.STAGES[k][1](spark, docs, sf)
    before, after = Counter(map(tuple, docs.collect())), Counter(map(tuple, out.collect()))
    if k == 2:
        assert sum(after.values()) == sum(before.values()) and any("[REDACTED]" in (r[1] or "") for r in after)
        assert not any(secrets.base_spans(r[1] or "") for r in after if "[REDACTED]" in (r[1] or ""))
    else:
        assert not after - before and 0 < sum(after.values()) < sum(before.values())
