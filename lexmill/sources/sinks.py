"""Sinks: one dataset for a stage; a file for each document where that is asked for."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructType

from lexmill.functions.text import blank
from lexmill.operators.relational import project


def named(df: DataFrame, key: str = "doc_name") -> DataFrame:
    """Rows that have a name."""
    return df.where(~blank(F.col(key).cast("string")))


def jsonable(df: DataFrame) -> DataFrame:
    """Without binary columns; NaN as null."""
    keep = [f for f in df.schema if not isinstance(f.dataType, BinaryType)]
    return df.select(*(F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name) for f in keep))


def write_json(df: DataFrame, path: str, fields: list[str] | None = None, drop: list[str] | None = None) -> None:
    jsonable(project(df, fields, drop)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str, fields: list[str] | None = None, schema: StructType | None = None, partition_by: tuple[str, ...] = ()) -> None:
    """zstd Parquet, cast to a schema where one is given."""
    out = project(df, fields)
    if schema is not None:
        out = out.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
    w = out.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_mirror(df: DataFrame, path: str, day: str) -> None:
    """JSON lines in folders yyyy=/mm=/dd= of a date column; a run replaces the days that it has rows of and leaves the others. Rows without a day go to the folder of nulls."""
    d = jsonable(df)
    d = d.withColumns({"yyyy": F.date_format(day, "yyyy"), "mm": F.date_format(day, "MM"), "dd": F.date_format(day, "dd")})
    d = d.hint("rebalance", "yyyy", "mm", "dd")  # few files a day; AQE splits days of many rows
    d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("yyyy", "mm", "dd").json(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", connections: int = 8, batch: int = 10_000, **options: str) -> None:
    """Rows to a table of a database, over so many connections at most; the driver comes with the session's jars.

    A task that is run again repeats its rows in a table without a key: load a table of its own and merge it there, as ``mode="overwrite"`` does with a staging table's name.
    """
    df.coalesce(connections).write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options).mode(mode).save()


def write_markdown(df: DataFrame, path: str, key: str = "doc_name", text: str = "markdown") -> None:
    """The columnar form of Markdown files: (key, markdown, meta) with everything else in meta; rows without a name or text are left out."""
    rest = [c for c in jsonable(df).columns if c not in (key, text)]
    rows = named(df, key).where(~blank(text))
    rows.select(key, text, F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("meta") if rest else F.lit("{}").alias("meta")).write.mode("overwrite").option("compression", "zstd").parquet(path)


def per_document(df: DataFrame, folder: str, kind: str, key: str = "doc_name", text: str = "markdown") -> int:
    """Writes a file for each document (md with a .meta.json beside it, jsonl or parquet) and returns how many; the folder is one that all executors share.

    Each file is written beside its place and renamed, so that a task that is run again does no harm.
    """
    rows = named(df, key)
    rows = jsonable(rows.where(~blank(text))) if kind == "md" else jsonable(rows) if kind == "jsonl" else rows
    names = rows.columns

    def put(path: str, data: bytes) -> None:
        part = f"{path}.{os.getpid()}.tmp"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        n = 0
        for b in parts:
            for i, row in enumerate(b.to_pylist()):
                base = os.path.join(folder, str(row[key]).replace("/", "_"))
                if kind == "md":
                    put(base + ".md", row[text].encode())
                    put(base + ".meta.json", json.dumps({c: row[c] for c in names if c != text}, ensure_ascii=False, default=str).encode())
                elif kind == "jsonl":
                    put(base + ".jsonl", (json.dumps(row, ensure_ascii=False, default=str) + "\n").encode())
                else:
                    import pyarrow.parquet as pq

                    pq.write_table(pa.Table.from_batches([b.slice(i, 1)]), base + ".parquet.tmp")
                    os.replace(base + ".parquet.tmp", base + ".parquet")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    return rows.mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


# ---- consolidated tables

#: Columns of the consolidated table of parsed documents.
PARSED = {"doc_name": "string", "source": "string", "detail_url": "string", "precedent_number": "string", "adopted_date": "string", "text": "string", "num_pages": "int", "parser_model": "string", "parsed_at": "string", "confidence": "double"}


def as_text(c: str):
    """A column as text; NaN as null."""
    return F.nullif(F.col(c).cast("string"), F.lit("NaN"))


def parsed_table(df: DataFrame) -> DataFrame:
    d = df.withColumnRenamed("markdown", "text")
    has = lambda c, t: as_text(c) if t == "string" else F.col(c).cast(t)
    return d.select(*((has(c, t) if c in d.columns else F.lit(None).cast(t)).alias(c) for c, t in PARSED.items()))


def extracted_table(df: DataFrame) -> DataFrame:
    """Nested fields side by side; missing lists empty."""
    e = StructType(df.schema["extracted"].dataType.fields)
    flat = [F.coalesce(F.col(f"extracted.{f.name}"), F.array().cast(f.dataType)).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f"extracted.{f.name}").alias(f.name) for f in e if f.name not in ("text_hash", "char_len")]
    keep = ["doc_name", "text_hash", "char_len", "precedent_number", "adopted_date", "applied_article_code", "applied_article_number", "applied_article_clause", "principle_text"]
    return df.select(*(c for c in keep if c in df.columns), *flat)


def event(site: str, stage: str, **facts) -> str:
    """A line of a site's log."""
    return json.dumps({"site": site, "stage": stage, **facts}, ensure_ascii=False, sort_keys=True)
