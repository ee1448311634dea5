"""Stages of the pipeline against brute force on a small fixture."""

import numpy as np
import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from lexmill.llm import byte_bpe, toxicity  # noqa: E402
from lexmill.session import stored  # noqa: E402


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    s = "/root/testdata/sf0.001"
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{s}/{t}.parquet").write.parquet(str(d / f"{t}.parquet"))
    docs = spark.read.parquet(f"{s}/documents.parquet")
    one = docs.orderBy("doc_id").limit(1).select("text").first()[0]
    leak = spark.read.parquet(f"{s}/benchmark.parquet").orderBy("item_id").first()["text"]
    extra = [(9001, None), (9002, ""), (9003, one + " thêm"), (9004, "đầu " + leak + " cuối"), (None, "không tên"), (9005, "cùng"), (9005, "cùng")]
    more = spark.createDataFrame([(i, t, "vi", "s", len(t or "")) for i, t in extra], docs.schema)
    docs.unionByName(more).write.parquet(str(d / "documents.parquet"))
    return str(d)


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept.toPandas()
        kept = stored(stage(spark, kept, small), name)
        after = kept.toPandas()
        if name == "toxicity":
            lex = toxicity.fit(toxicity.training_rows(docs, spark.read.parquet(f"{small}/labels.parquet")))
            m = lex.matcher()
            good = before[[toxicity.score(lex.curve, toxicity.features(m, t or "")) < 0.5 or not lex.terms for t in before.text]]
            assert sorted(after.doc_id.fillna(-1)) == sorted(good.doc_id.fillna(-1))
        elif name == "ngram_jaccard":
            assert 9003 not in set(after.doc_id) and {9001, 9002} <= set(after.doc_id) and (after.doc_id == 9005).sum() == 1 and after.doc_id.isna().sum() == 1
            sets = []
            for t in after.text:
                w = (t or "").encode().lower().split()
                n = min(5, len(w))
                sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
            assert not any(a and b and 100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
        elif name == "decontamination":
            assert 9004 in set(before.doc_id) and 9004 not in set(after.doc_id)
            items = [" ".join(t.lower().split()) for t in spark.read.parquet(f"{small}/benchmark.parquet").toPandas().text]
            assert not any(i in " ".join((t or "").lower().split()) for i in items for t in after.text)
        else:
            code = byte_bpe.coder(corpus_pipeline.RANKS, corpus_pipeline.PATTERN)
            text = before.assign(doc_id=before.doc_id.fillna(-1)).set_index("doc_id").text
            for r in after.fillna({"doc_id": -1}).itertuples():
                assert bytes(r.ids) == code([text[r.doc_id] or ""])[0][0] and r.n_tokens == len(np.frombuffer(r.ids, "<u4"))
        if name != "byte_bpe":
            assert list(after.columns) == columns


def test_run_is_the_stages(spark, small):
    assert corpus_pipeline.run(spark, small).where(F.col("n_tokens") > 0).count() > 100
    empty = spark.read.parquet(f"{small}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, small).count() == 0
