"""The pipeline: each stage's decisions take effect on all that its predecessor kept."""

import hashlib
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_and_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.7 * sizes[0]
    rows = docs.collect()
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not any(i in r.text for r in rows for i in items)
    assert not any(re.search("AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}", r.text) for r in rows)
    assert all(r.n_chars == len(r.text) for r in rows)
    texts = {r.doc_id: r.text for r in rows}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(out) == set(texts)
    assert all(out[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items())


def test_tidy_lets_go_of_what_python_has_dropped(spark):
    """What no name holds any more is gone when tidy() returns, and so what Spark keeps for it; py4j alone takes up to a second."""
    from lexloom.llm.common import tidy

    jvm = spark.sparkContext._jvm
    for _ in range(4):
        held = jvm.java.util.ArrayList()
        ref = jvm.java.lang.ref.WeakReference(held)
        del held
        tidy(spark)
        assert ref.get() is None
