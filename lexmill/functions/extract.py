"""Entities, statute references, relations and precedent fields, as expressions over one text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import ColumnLike, _c, date_iso, groups, none_if_blank, once, spans, strip, text_hash

# Patterns of Vietnamese legal text.
CODES = "BLHS|BLTTHS|BLDS|BLTTDS|BLLĐ|LTCTAND|LTCVKSND|LTHAHS|LTHADS|LXLVPHC|LTM|LTTHC|LTPCTN"
ARTICLE = rf"(?iU)(?:khoản\s+(\d+)[,\s]+)?(?:điểm\s+([a-z])[,\s]+)?điều\s+(\d+)(?:\s*({CODES})(?:\s*(19\d{{2}}|20\d{{2}}))?)?"
DATE = r"(?U)\b(\d{1,2})[/.](\d{1,2})[/.](19\d{2}|20\d{2})\b"
PRECEDENT = r"(?iU)Án\s+lệ\s+số\s+(\d+)\s*/\s*(\d{4})\s*/\s*([A-Z]{2,4})"
COURT = r"(?iU)(?:T[oò]a\s+án\s+nh[aâ]n\s+d[aâ]n|TAND|TANDTC)[^,\n.]{0,80}"
PRINCIPLES = ("Nội dung án lệ", "Nguyên tắc", "Khái quát")
WINDOW = 200

ENTITY = "array<struct<tag:string,text:string,start:bigint,end:bigint>>"
RELATION = "array<struct<src:string,rel:string,dst:string,evidence_span:array<bigint>>>"
STATUTE = "array<struct<article:bigint,clause:bigint,point:string,code:string,year:bigint,span:array<bigint>>>"


def _tagged(x: ColumnLike, tag: str, pattern: str, tidy: bool = False) -> Column:
    def one(s: Column) -> Column:
        text = s["text"]
        return F.struct(F.lit(tag).alias("tag"), (F.regexp_replace(text, "^[,. ]+|[,. ]+$", "") if tidy else text).alias("text"), s["start"].alias("start"), s["end"].alias("end"))

    return F.transform(spans(x, pattern), one)


def entities(x: ColumnLike) -> Column:
    """DATE, ORG-COURT, ARTICLE and PRECEDENT entities, in that order of groups; court texts lose marks at their ends, not their span."""
    return F.coalesce(F.concat(_tagged(x, "DATE", DATE), _tagged(x, "ORG-COURT", COURT, True), _tagged(x, "ARTICLE", ARTICLE), _tagged(x, "PRECEDENT", PRECEDENT)), F.array().cast(ENTITY)).cast(ENTITY)


def statutes(x: ColumnLike) -> Column:
    """Statute references with article, clause, point, code, year and span."""
    parts = F.struct(spans(x, ARTICLE).alias("whole"), *(groups(x, ARTICLE, k).alias(n) for n, k in (("clause", 1), ("point", 2), ("article", 3), ("code", 4), ("year", 5))))

    def refs(p: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            number = lambda n: F.get(p[n], i).try_cast("bigint").alias(n)
            return F.struct(number("article"), number("clause"), F.get(p["point"], i).alias("point"), F.get(p["code"], i).alias("code"), number("year"), F.array(s["start"], s["end"]).alias("span"))

        return F.transform(p["whole"], one)

    return F.coalesce(once(parts, refs), F.array().cast(STATUTE)).cast(STATUTE)


def relations(found: ColumnLike, source: str = "CHARGE", target: str = "ARTICLE", rel: str = "cites_article", window: int = WINDOW) -> Column:
    """Each source entity with the first target that begins more than 0 and less than ``window`` after its end."""
    e = _c(found)

    def first(c: Column) -> Column:
        return F.get(F.filter(e, lambda a: (a["tag"] == target) & (a["start"] - c["end"] > 0) & (a["start"] - c["end"] < window)), F.lit(0))

    def one(c: Column) -> Column:
        a = first(c)
        return F.struct(c["text"].alias("src"), F.lit(rel).alias("rel"), a["text"].alias("dst"), F.array(c["start"], a["end"]).alias("evidence_span"))

    made = F.transform(F.filter(e, lambda c: c["tag"] == source), one)
    return F.coalesce(F.filter(made, lambda r: r["dst"].isNotNull()), F.array().cast(RELATION)).cast(RELATION)


def precedent_number(metadata: ColumnLike, x: ColumnLike) -> Column:
    """The given number, else the first in the text in its canonical form."""
    n, y, s = (F.regexp_extract(_c(x), PRECEDENT, k) for k in (1, 2, 3))
    return F.coalesce(none_if_blank(metadata), F.when(n != "", F.concat(F.lit("Án lệ số "), n, F.lit("/"), y, F.lit("/"), s)))


def adopted_date(metadata: ColumnLike, x: ColumnLike) -> Column:
    return F.coalesce(date_iso(metadata), date_iso(x))


def principle(x: ColumnLike) -> Column:
    """What follows the first marker, in order of markers, that has something after it: 600 characters at most."""

    def after(marker: str) -> Column:
        at = F.locate(marker, _c(x))
        tail = strip(_c(x).substr(at + len(marker), F.lit(600)))
        return F.when(at > 0, F.nullif(strip(F.regexp_replace(tail, "^:+", "")), F.lit("")))

    return F.coalesce(*(after(m) for m in PRINCIPLES))


def applied_article(df: DataFrame, key: str, metadata: str, refs: str) -> DataFrame:
    """(key, applied_article_number, applied_article_code, applied_article_clause): from the metadata, else the most cited (article, code), first come first among equals."""
    m = {k: F.nullif(F.regexp_extract(F.col(metadata), ARTICLE, g), F.lit("")) for k, g in (("clause", 1), ("article", 3), ("code", 4))}
    given = df.select(key, m["article"].try_cast("bigint").alias("g_number"), m["code"].alias("g_code"), m["clause"].try_cast("bigint").alias("g_clause"))
    one = df.select(key, F.posexplode(refs).alias("pos", "r")).groupBy(key, F.col("r.article").alias("number"), F.col("r.code").alias("code")).agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    best = one.groupBy(key).agg(F.max_by(F.struct("number", "code"), F.struct("n", -F.col("first"))).alias("b"))
    has = F.col("g_number").isNotNull()
    return given.join(best, key, "left").select(key, F.coalesce("g_number", "b.number").alias("applied_article_number"), F.when(has, F.col("g_code")).otherwise(F.col("b.code")).alias("applied_article_code"), F.when(has, F.col("g_clause")).alias("applied_article_clause"))


def extract(df: DataFrame, key: str = "doc_name", text: str = "markdown", generic: bool = True, site: bool = True) -> DataFrame:
    """Adds text_hash, char_len, extracted and the precedent fields; scraper columns that are missing count as null."""
    for c in ("precedent_number", "adopted_date", "applied_article", "principle_text"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumns({"text_hash": text_hash(text), "char_len": F.length(F.coalesce(F.col(text), F.lit(""))).cast("long"), "__e": entities(text), "__s": statutes(text)})
    empty = {"__e": ENTITY, "__s": STATUTE}
    shown = {c: F.col(c) if generic else F.array().cast(t) for c, t in empty.items()}
    out = df.withColumn("extracted", F.struct(F.col(key).alias("doc_id"), "text_hash", "char_len", shown["__e"].alias("entities"), (relations("__e") if generic else F.array().cast(RELATION)).alias("relations"), shown["__s"].alias("statute_refs")))
    if not site:
        return out.withColumns({"applied_article_code": F.lit(None).cast("string"), "applied_article_number": F.lit(None).cast("bigint"), "applied_article_clause": F.lit(None).cast("bigint"), **{c: F.lit(None).cast("string") for c in ("precedent_number", "adopted_date", "principle_text")}}).drop("__e", "__s", "applied_article")
    applied = applied_article(out, key, "applied_article", "__s")
    out = out.withColumns({"precedent_number": precedent_number("precedent_number", text), "adopted_date": adopted_date("adopted_date", text), "principle_text": F.coalesce(none_if_blank("principle_text"), principle(text)), "source_case_ref": F.nullif(F.regexp_extract(text, r"(?U)(\d+/\d{4}/[A-ZĐa-zđ]+[-/][A-ZĐa-zđ]+)", 1), F.lit(""))})
    return out.join(applied, key, "left").drop("__e", "__s", "applied_article")


def first_wins(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row for each key, the first in the order given."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
