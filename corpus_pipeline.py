"""From raw documents to token ids: toxicity, near duplicates, benchmark leaks, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. What goes between stages is written to
the shared folder, so that an executor that is lost costs a stage's tasks and not the stages before.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.base import batches, spread, table
from lexmill.llm.byte_bpe import byte_bpe
from lexmill.llm.decontaminate import contamination
from lexmill.llm.ngram_join import ngram_classes
from lexmill.llm.toxicity import fit, toxicity, training_rows
from lexmill.session import stored

#: Chance that two texts of 400 shingles or more that just link are not compared; keys that leave nothing to chance would need more than the disk that a stage has.
MISS = 1e-12
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score is 0.5 or more. The lexicon is learned from labels that aren't held out; without any, all stay. Null and empty texts stay; repeated rows are judged alike; all columns come through."""
    batches(spark)
    docs = spread(docs)
    lexicon = fit(training_rows(docs, table(spark, sf_dir, "labels")))
    kept = toxicity(docs, lexicon, whole=True)
    return (kept.where("predicted = 0") if lexicon.terms else kept).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest doc_id, of each group that links of Jaccard 0.8 or more on five-word shingles connect.

    Documents without words, or with a null doc_id, link with nothing and stay. Null and empty texts have none. Rows that repeat a doc_id are one document, whatever their texts, of which
    the row of the smallest text stays, and of equal texts that of the smallest JSON form. An empty table stays empty; all columns come through.
    """
    batches(spark)
    docs = spread(docs)
    groups = ngram_classes(docs, size=5, num=80, den=100, miss=MISS)
    stay = groups.where("doc_id = component_id").select("doc_id").distinct()
    row = F.struct(*(docs[c] for c in docs.columns))
    known = docs.join(stay.hint("merge"), "doc_id", "left_semi").select("doc_id", "text", row.alias("row"))
    known = known.groupBy("doc_id").agg(F.min_by("row", F.struct("text", F.to_json("row"))).alias("row")).select("row.*")
    return known.select(docs.columns).unionByName(docs.where("doc_id is null"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, whole or edited: half of its own alignment score or more, whichever passage gives it.

    Null and empty texts, and rows with a null doc_id, hold none and stay. Repeated rows are judged alike. Without benchmark items all stay; all columns come through.
    """
    batches(spark)
    found = contamination(spread(docs), table(spark, sf_dir, "benchmark"), whole=True)
    return found.where(F.size("matches") == 0).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit integers. Null and empty texts have none; repeated rows come out as often as they came in, an empty table gives no rows."""
    batches(spark)
    return byte_bpe(spread(docs.select("doc_id", "text")), RANKS, PATTERN).select("doc_id", "n_tokens", "ids")


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_duplicates), ("decontamination", drop_benchmark_leaks), ("byte_bpe", encode)]

#: Scores of a learned lexicon and encodings aren't expressible in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
