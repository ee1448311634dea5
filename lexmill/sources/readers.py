"""Sources: files, JSON lines, Parquet, Markdown with sidecars, registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexmill.functions.text import blank, none_if_blank


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or pattern) names anything, in whichever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def stem(path: Column) -> Column:
    """A file's name without folder and last extension."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.url_decode(F.regexp_replace(F.regexp_replace(name, r"\.[^.]*$", ""), r"\+", "%2B"))


def binary_files(spark: SparkSession, path: str, extensions: tuple[str, ...] = (".pdf", ".docx", ".doc"), limit: int | None = None) -> DataFrame:
    """(doc_name, pdf_path, pdf_bytes) of the files below a folder; with a limit, the first by name."""
    pattern = "*{" + ",".join(extensions) + "}"
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    f = f.select(stem(F.col("path")).alias("doc_name"), F.col("path").alias("pdf_path"), F.col("content").alias("pdf_bytes"))
    return f.orderBy("pdf_path").limit(limit) if limit else f


def whole_texts(spark: SparkSession, path: str, extension: str) -> DataFrame:
    """(stem, path, text) of whole text files."""
    if not exists(spark, path):
        return spark.createDataFrame([], "stem string, path string, text string")
    t = spark.read.option("wholetext", "true").option("pathGlobFilter", f"*{extension}").text(path)
    return t.select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("path")).select(stem(F.col("path")).alias("stem"), "path", "text")


def documents_with_sidecars(spark: SparkSession, path: str, html_path: str | None = None) -> DataFrame:
    """(doc_name, pdf_path, pdf_bytes, detail_html, detail_url): files with what lies beside them; what is missing is empty."""
    files = binary_files(spark, path)
    html = whole_texts(spark, html_path or path, ".html").select(F.col("stem").alias("doc_name"), F.col("text").alias("detail_html"))
    url = whole_texts(spark, html_path or path, ".url").select(F.col("stem").alias("doc_name"), F.trim("text").alias("detail_url"))
    out = files.join(html, "doc_name", "left").join(url, "doc_name", "left")
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in ("detail_html", "detail_url")})


def markdown(spark: SparkSession, path: str, meta: StructType | str | None = None) -> DataFrame:
    """(doc_name, markdown, and the fields of ``meta``) of Markdown files with optional .meta.json sidecars.

    Blank files are left out; a sidecar that can't be read counts as missing; doc_name is the sidecar's, else the file's stem.
    """
    body = whole_texts(spark, path, ".md").where(~blank("text"))
    side = whole_texts(spark, path, ".meta.json").select(F.regexp_replace("stem", r"\.meta$", "").alias("stem"), F.col("text").alias("json"))
    schema = StructType.fromDDL(meta) if isinstance(meta, str) else meta or StructType.fromDDL("doc_name string")
    if "doc_name" not in schema.names:
        schema = StructType([*StructType.fromDDL("doc_name string").fields, *schema.fields])
    both = body.join(side, "stem", "left").withColumn("m", F.from_json("json", schema))
    rest = [F.col(f"m.{c}").alias(c) for c in schema.names if c not in ("doc_name", "markdown")]
    return both.select(F.coalesce(none_if_blank("m.doc_name"), F.col("stem")).alias("doc_name"), F.col("text").alias("markdown"), *rest)


def json_lines(spark: SparkSession, path: str, schema: StructType | str, fields: list[str] | None = None) -> DataFrame:
    """JSON lines with a schema, so that only the fields asked for are parsed; a missing path gives no rows."""
    s = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if fields:
        s = StructType([s[f] for f in fields if f in s.names])
    return spark.read.schema(s).json(path) if exists(spark, path) else spark.createDataFrame([], s)


def parquet(spark: SparkSession, path: str, fields: list[str] | None = None, schema: StructType | str | None = None) -> DataFrame:
    """Parquet files, of one schema or several; a missing path gives no rows of ``schema``."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema or StructType([]))
    r = spark.read.option("mergeSchema", "true")
    d = (r.schema(schema) if schema else r).parquet(path)
    return d.select(*(f for f in fields if f in d.columns)) if fields else d


def records(extracted: DataFrame, key: str = "doc_name") -> dict[str, DataFrame]:
    """Entities, relations and statute references as tables of their own, and counts for each document."""
    e = extracted.select(key, "extracted.*")
    return {
        "entities": e.select(key, F.inline("entities")),
        "relations": e.select(key, F.inline("relations")),
        "statutes": e.select(key, F.inline("statute_refs")),
        "counts": e.select(key, *(F.coalesce(F.size(c), F.lit(0)).alias(f"n_{c}") for c in ("entities", "relations", "statute_refs"))),
    }


def inventory(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """(stage, n): distinct file stems below each folder; contents aren't read."""
    out = None
    for name, path in folders.items():
        if exists(spark, path):
            f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            n = f.select(F.count_distinct(stem(F.col("path"))).alias("n"))
        else:
            n = spark.createDataFrame([(0,)], "n bigint")
        part = n.select(F.lit(name).alias("stage"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def since(df: DataFrame, cursor: str, last: str | None) -> DataFrame:
    """Rows after the last one that was imported; all without a cursor."""
    return df if last is None else df.where(F.col(cursor) > F.lit(last))


def partitioned(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """A folder whose subfolders key=value are columns."""
    return spark.read.format(file_format).option("basePath", path).load(path)
