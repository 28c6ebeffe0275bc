"""The pipeline: each stage keeps what it should, and the whole runs on odd input."""

import re

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")
DATA = "/root/testdata/sf0.001"


def heads(texts):
    """The smallest id of each class of texts linked by a similarity of 0.8 or more of their five-word shingles: all pairs."""
    sets = {}
    for i, x in texts.items():
        w = re.sub("[A-Z]", lambda m: m[0].lower(), x or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in root if find(i) == i}


def test_stages_in_turn(spark, tmp_path):
    from tessella.llm import quality

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        seen.append(docs)
        if i < 3:
            assert docs.columns == seen[0].columns and docs.count() == docs.join(seen[i], "doc_id", "left_semi").count()
    kept = quality.measure_quality(seen[0]).where("quality.kept")
    assert {r.doc_id for r in seen[1].collect()} == {r.doc_id for r in kept.collect()}
    assert {r.doc_id for r in seen[3].collect()} == heads({r.doc_id: r.text for r in seen[2].collect()})
    assert {r.doc_id for r in seen[4].collect()} == {r.doc_id for r in seen[3].collect()}


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).agg(F.max("offset")).first()[0] < 2048


def test_odd_documents(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, " ".join(f"w{i}" for i in range(99)), None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        assert out.count() <= 3
    assert corpus_pipeline.STAGES[2][1](spark, docs.limit(0), DATA).count() == 0
