"""The pipelines of a site: parse, extract, embed, reduce, by name or all in order."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmill.functions.extract import extract
from lexmill.operators.embed import Settings, embed
from lexmill.operators.parse import BACKENDS, parse
from lexmill.operators.reduce import reduce
from lexmill.plans.config import SiteConfig, load, typed
from lexmill.session import importable, session
from lexmill.sources.readers import documents_with_sidecars, parquet
from lexmill.sources.sinks import write_json, write_parquet

EMBED_FIELDS = ["doc_name", "text_hash", "embedding", "embedding_dim", "embedding_model_id", "embedding_text_hash", "embedding_chunks_used", "embedding_chunking"]


def run_parse(spark: SparkSession, c: SiteConfig) -> DataFrame:
    docs = documents_with_sidecars(spark, c.path("pdf"), c.path("html"))
    write_parquet(parse(docs, BACKENDS[c.parse.backend], c.parse.backend), c.path("md"))
    return parquet(spark, c.path("md"))


def run_extract(spark: SparkSession, c: SiteConfig) -> DataFrame:
    out = extract(parquet(spark, c.path("md")), generic=c.extract.run_generic, site=c.extract.run_site)
    write_json(out, c.path("jsonl"))
    return out


def run_embed(spark: SparkSession, c: SiteConfig) -> DataFrame:
    e = c.embed
    s = Settings(e.max_seq, e.safety, e.chars_per_token, e.overlap_tokens, e.batch, e.chunking)
    docs = parquet(spark, c.path("md"), ["doc_name", "markdown"])
    write_parquet(embed(docs, model_id=e.model_id, s=s), c.path("embeddings"), EMBED_FIELDS)
    return parquet(spark, c.path("embeddings"))


def run_reduce(spark: SparkSession, c: SiteConfig) -> DataFrame:
    r = c.reduce
    write_parquet(reduce(parquet(spark, c.path("embeddings")), tuple(r.methods), n=r.n_components, cluster=r.cluster), c.path("reduced"))
    return parquet(spark, c.path("reduced"))


PIPELINES: dict[str, Callable[[SparkSession, SiteConfig], DataFrame]] = {"parse": run_parse, "extract": run_extract, "embed": run_embed, "reduce": run_reduce}


def run(spark: SparkSession, name: str, c: SiteConfig) -> dict[str, DataFrame]:
    """One pipeline, or all of them in order; what each wrote, by name."""
    if name != "all" and name not in PIPELINES:
        raise ValueError(f"no pipeline {name!r}; there are {', '.join(PIPELINES)} and all")
    importable(spark)
    return {n: f(spark, c) for n, f in PIPELINES.items() if name in (n, "all")}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Runs the pipelines of a site.")
    p.add_argument("--pipeline", default="all")
    p.add_argument("--config", required=True)
    p.add_argument("overrides", nargs="*", help="such as embed.batch=4")
    a = p.parse_args(argv)
    run(session("site pipeline"), a.pipeline, typed(SiteConfig, load(a.config, a.overrides)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
