"""Tables behind a corpus report, by name, and a static page that shows them."""

from __future__ import annotations

import functools
import html
import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import ontology
from lexmill.functions.text import year_of
from lexmill.operators import relational

#: Rows of a table that a page shows; a table of a report is an aggregate and has fewer.
SHOWN = 500


def _distribution(df: DataFrame, column: str, vocabulary: str) -> DataFrame | None:
    return relational.value_counts(df, column, ontology.ENUMS[vocabulary]).orderBy("ord", "value") if column in df.columns else None


def _timeline(df: DataFrame, this_year: int) -> DataFrame | None:
    if "adopted_date" not in df.columns:
        return None
    y = df.select(year_of("adopted_date").alias("year")).where("year is not null")
    return y.groupBy("year").agg(F.count("*").alias("n")).orderBy("year")


def _citations(df: DataFrame, n: int = 20) -> DataFrame | None:
    keys = ["applied_article_code", "applied_article_number"]
    if not set(keys) <= set(df.columns):
        return None
    return relational.top(df, keys, n).withColumn("legal_arc", F.coalesce(ontology.arc_for_code("applied_article_code"), F.lit("(unknown)")))


def _clusters(df: DataFrame) -> DataFrame | None:
    return df.groupBy(relational.cluster_label().alias("cluster")).agg(F.count("*").alias("n")).orderBy(F.col("cluster") != "noise", "cluster") if "cluster_id" in df.columns else None


#: name -> (documents, year of the report) -> table, or nothing where its columns are missing.
RENDERERS: dict[str, Callable[[DataFrame, int], DataFrame | None]] = {
    "legal_relation": lambda d, y: _distribution(d, "legal_relation", "LegalRelation"),
    "procedure_type": lambda d, y: _distribution(d, "procedure_type", "ProcedureType"),
    "timeline": _timeline,
    "taxonomy": lambda d, y: relational.treemap(d, "legal_type", ontology.taxonomy_table(d.sparkSession)) if "legal_type" in d.columns else None,
    "relations": lambda d, y: relational.present_relations(d, "legal_type", ontology.relation_table(d.sparkSession)) if "legal_type" in d.columns else None,
    "citations": lambda d, y: _citations(d),
    "clusters": lambda d, y: _clusters(d),
}


def dashboard(df: DataFrame, panels: dict[str, Column], chosen: dict[str, list] | None = None, most: dict[str, int] | None = None) -> DataFrame:
    """(panel, key, n): rows by each panel's key, in one pass; nulls are left out.

    What is chosen in a panel (a list of its keys) filters all others, not itself. ``most`` names panels that show only their most frequent keys, ties by key.
    """
    keys = {p: c.cast("string") for p, c in panels.items()}
    fits = {p: F.coalesce(keys[p].isin(*(str(v) for v in some)), F.lit(False)) for p, some in (chosen or {}).items()}

    def shown(p: str) -> Column:
        others = [ok for q, ok in fits.items() if q != p]
        key = F.when(functools.reduce(lambda a, b: a & b, others), keys[p]) if others else keys[p]
        return F.struct(F.lit(p).alias("panel"), key.alias("key"))

    cells = df.select(F.explode(F.array(*(shown(p) for p in keys))).alias("c")).select("c.*").where("key is not null")
    n = cells.groupBy("panel", "key").agg(F.count("*").alias("n"))
    if not most:
        return n
    bound = F.coalesce(F.create_map(*(F.lit(x) for kv in most.items() for x in kv))[F.col("panel")], F.lit(2**31 - 1))
    w = Window.partitionBy("panel").orderBy(F.desc("n"), "key")
    return n.withColumn("place", F.row_number().over(w)).where(F.col("place") <= bound).drop("place")


def dataset(spark: SparkSession, texts: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Texts and coordinates side by side, with the ontology's columns filled."""
    return ontology.with_ontology(relational.outer_join(texts, coordinates, "doc_name"))


def tables(df: DataFrame, this_year: int, names: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """The tables of a report that can be made; unknown names are an error."""
    made = {n: RENDERERS[n](df, this_year) for n in names or RENDERERS}
    return {n: t for n, t in made.items() if t is not None}


def page(made: dict[str, DataFrame], path: str, title: str = "Corpus", force: bool = False) -> int:
    """Writes one HTML page with the tables and returns how many it shows; an existing page stays unless ``force``."""
    if os.path.exists(path) and not force:
        return 0
    parts = [f"<!DOCTYPE html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name in sorted(made):
        rows = made[name].limit(SHOWN).collect()
        cell = lambda v: html.escape("" if v is None else str(v))
        head = "".join(f"<th>{cell(c)}</th>" for c in made[name].columns)
        parts.append(f"<h2>{cell(name)}</h2><table><tr>{head}</tr>" + "".join("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in r) + "</tr>" for r in rows) + "</table>")
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("".join(parts))
    return len(made)


def snapshot(df: DataFrame, texts: str = "markdown") -> str:
    """Counts and sizes of a corpus as one JSON object."""
    size = relational.describe(df.select(F.length(texts).alias("n")), "n", 1).first().asDict() if texts in df.columns else {}
    cover = relational.coverage(df, *(c for c in ("precedent_number", "adopted_date", "applied_article_number", "principle_text") if c in df.columns)).first().asDict()
    return json.dumps({"chars": size, "coverage": cover}, sort_keys=True)
