"""Queries over the tables, each beside the SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import chunks, extract, ontology, text, vectors
from lexmill.operators import casegraph, graph, knn, parse, relational, rules, temporal
from lexmill.operators.reduce import hdbscan_labels, pca, whole_matrix
from lexmill.plans import report
from lexmill.session import free_at_end, new_path, spread, table
from lexmill.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if SQL can express it."""

    def put(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return put


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _day(c: str):
    return F.to_date(c)


# ------------------------------------------------------------------ text and chunks


@query("""
SELECT lang, count(*) AS docs, sum(len)::BIGINT AS chars, sum(CASE WHEN len <= 500 THEN 1 ELSE CAST(floor((len - 1) / 400) AS BIGINT) + 1 END)::BIGINT AS chunks, min(h) AS first_hash
FROM (SELECT lang, length(text) AS len, sha256(text)[1:32] AS h FROM documents) GROUP BY lang
""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language: how many, how long, how many chunks."""
    d = table(spark, sf_dir, "documents").select("lang", F.length("text").alias("len"), F.size(chunks.sliding("text", 500, 100)).alias("c"), text.text_hash("text").alias("h"))
    return d.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("len").alias("chars"), F.sum("c").alias("chunks"), F.min("h").alias("first_hash"))


@query("SELECT doc_id, sha256(text)[1:32] AS text_hash, length(text)::INTEGER AS char_len FROM documents")
def doc_hash_len(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.text_hash("text").alias("text_hash"), F.length("text").alias("char_len"))


@query("""
WITH c AS (SELECT doc_id, length(text) AS len FROM documents),
p AS (SELECT d.doc_id, i, substr(d.text, i * 400 + 1, 500) AS chunk FROM documents d, range(0, 1000000) r(i) WHERE (length(d.text) <= 500 AND i = 0) OR (length(d.text) > 500 AND i * 400 < length(d.text)))
SELECT doc_id, count(*) AS n_chunks, sum(length(chunk))::BIGINT AS total, max(length(chunk))::INTEGER AS longest FROM p GROUP BY doc_id
""".replace("range(0, 1000000) r(i)", "(SELECT unnest(range(0, (SELECT max(length(text)) // 400 + 1 FROM documents))) AS i)"))
def chunk_sliding_stats(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(chunks.sliding("text", 500, 100)).alias("chunk"))
    return d.groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.sum(F.length("chunk")).alias("total"), F.max(F.length("chunk")).alias("longest"))


@query(r"""
WITH s AS (SELECT doc_id, text, string_split(regexp_replace(text, '([.!?。])[\s\x0B\x85\xA0]+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
f AS (SELECT doc_id, text, list_reduce(list_transform(parts, lambda x: {'done': []::VARCHAR[], 'open': x}), lambda a, b: {
    'done': CASE WHEN a.open = '' OR length(a.open) + 1 + length(b.open) <= 800 THEN a.done ELSE list_append(a.done, a.open) END,
    'open': CASE WHEN a.open = '' THEN b.open WHEN length(a.open) + 1 + length(b.open) <= 800 THEN a.open || ' ' || b.open ELSE right(a.open, 80) || ' ' || b.open END}, {'done': []::VARCHAR[], 'open': ''}) AS r FROM s),
c AS (SELECT doc_id, CASE WHEN length(text) <= 800 THEN [text] WHEN r.open = '' THEN r.done ELSE list_append(r.done, r.open) END AS c FROM f)
SELECT doc_id, len(c)::INTEGER AS n_chunks, list_max(list_transform(c, lambda x: length(x)))::INTEGER AS longest FROM c
""")
def chunk_sentence_stats(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", chunks.sentence("text", 800, 80).alias("c"))
    return d.select("doc_id", F.size("c").alias("n_chunks"), F.array_max(F.transform("c", lambda x: F.length(x))).alias("longest"))


@query("""
SELECT doc_id, length(text)::INTEGER AS char_len, (length(text) - length(regexp_replace(text, '[0-9]', '', 'g')))::BIGINT AS digits,
    (length(text) - length(regexp_replace(text, '[A-ZĐẪÁÀẢ]', '', 'g')))::BIGINT AS capitals FROM documents
""")
def sentence_features(spark, sf_dir):
    f = text.sentence_features("text")
    d = table(spark, sf_dir, "documents").select("doc_id", f.alias("f"))
    return d.select("doc_id", "f.char_len", F.round(F.col("f.digit_ratio") * F.greatest("f.char_len", F.lit(1))).cast("long").alias("digits"), F.round(F.col("f.uppercase_ratio") * F.greatest("f.char_len", F.lit(1))).cast("long").alias("capitals"))


# Text with citations, built from numbers so that any engine can build it: (o_orderkey, text).
_CITED = """SELECT o_orderkey, 'Tòa án nhân dân tỉnh X, ngày ' || strftime(o_orderdate, '%d/%m/%Y') || ' áp dụng khoản ' || (o_custkey % 5 + 1) || ' Điều ' || (o_orderkey % 300 + 1) || ' BLHS 2015 và điều ' || (o_custkey % 90 + 1) || '. Án lệ số ' || (o_orderkey % 70 + 1) || '/2021/AL' AS text FROM orders"""


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    part = lambda x: x.cast("string")
    t = F.concat(F.lit("Tòa án nhân dân tỉnh X, ngày "), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" áp dụng khoản "), part(F.col("o_custkey") % 5 + 1), F.lit(" Điều "), part(F.col("o_orderkey") % 300 + 1), F.lit(" BLHS 2015 và điều "), part(F.col("o_custkey") % 90 + 1), F.lit(". Án lệ số "), part(F.col("o_orderkey") % 70 + 1), F.lit("/2021/AL"))
    return o.select("o_orderkey", t.alias("text"))


@query(f"SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS adopted_date, year(d)::INTEGER AS year FROM (SELECT o_orderkey, strptime(regexp_extract(text, '([0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}})', 1), '%d/%m/%Y') AS d FROM ({_CITED}))")
def date_entities(spark, sf_dir):
    d = _cited(spark, sf_dir).select("o_orderkey", text.date_iso("text").alias("adopted_date"))
    return d.select("o_orderkey", "adopted_date", text.year_of("adopted_date").alias("year"))


@query("""
SELECT o_orderkey, (o_orderkey % 300 + 1)::BIGINT AS article, (o_custkey % 5 + 1)::BIGINT AS clause, 'BLHS' AS code, 2015::BIGINT AS year FROM orders
UNION ALL SELECT o_orderkey, (o_custkey % 90 + 1)::BIGINT, NULL, NULL, NULL FROM orders
""")
def article_refs(spark, sf_dir):
    return _cited(spark, sf_dir).select("o_orderkey", F.inline(extract.statutes("text"))).select("o_orderkey", "article", "clause", "code", "year")


@query(f"""
WITH t AS ({_CITED}), m AS (
    SELECT o_orderkey, 'DATE' AS tag, regexp_extract(text, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') AS x, text FROM t
    UNION ALL SELECT o_orderkey, 'ORG-COURT', regexp_extract(text, 'Tòa án nhân dân[^,.]*'), text FROM t
    UNION ALL SELECT o_orderkey, 'ARTICLE', regexp_extract(text, 'khoản [0-9]+ Điều [0-9]+ BLHS 2015'), text FROM t
    UNION ALL SELECT o_orderkey, 'ARTICLE', regexp_extract(text, 'điều [0-9]+'), text FROM t
    UNION ALL SELECT o_orderkey, 'PRECEDENT', regexp_extract(text, 'Án lệ số .*$'), text FROM t)
SELECT o_orderkey, tag, x AS text, (strpos(text, x) - 1)::BIGINT AS start, (strpos(text, x) - 1 + length(x))::BIGINT AS stop FROM m
""")
def entity_spans(spark, sf_dir):
    return _cited(spark, sf_dir).select("o_orderkey", F.inline(extract.entities("text"))).select("o_orderkey", "tag", "text", "start", F.col("end").alias("stop"))


@query("""
SELECT tag, count(*) AS n FROM (SELECT unnest(['DATE', 'ORG-COURT', 'ARTICLE', 'ARTICLE', 'PRECEDENT']) AS tag FROM orders) GROUP BY tag
""")
def entity_tag_counts(spark, sf_dir):
    e = _cited(spark, sf_dir).select(F.explode(extract.entities("text")).alias("e"))
    return e.groupBy(F.col("e.tag").alias("tag")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, 'Án lệ số ' || (o_orderkey % 70 + 1) || '/2021/AL' AS number, 'eli:vn:precedent:AL-' || (o_orderkey % 70 + 1) || '-2021' AS slug, 'eli:vn:law:BLHS-2015:article:' || (o_orderkey % 300 + 1) || ':clause:' || (o_custkey % 5 + 1) AS eli FROM orders")
def precedent_fields(spark, sf_dir):
    d = _cited(spark, sf_dir).select("o_orderkey", extract.precedent_number(F.lit(None).cast("string"), F.col("text")).alias("number"), F.get(extract.statutes("text"), F.lit(0)).alias("s"))
    return d.select("o_orderkey", "number", rules.precedent_slug(F.col("number")).alias("slug"), rules.eli(F.concat_ws("-", "s.code", F.col("s.year").cast("string")), F.col("s.article"), F.col("s.clause")).alias("eli"))


@query("""
WITH r AS (SELECT l_orderkey, l_partkey % 7 AS number, CASE WHEN l_suppkey % 2 = 0 THEN 'BLHS' ELSE 'BLDS' END AS code, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey % 7, CASE WHEN l_suppkey % 2 = 0 THEN 'BLHS' ELSE 'BLDS' END) AS pos FROM lineitem),
c AS (SELECT l_orderkey, number, code, count(*) AS n, min(pos) AS first FROM r GROUP BY ALL)
SELECT l_orderkey, number AS applied_article_number, code AS applied_article_code FROM c QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, first) = 1
""")
def applied_article_mode(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    ref = F.struct("l_linenumber", (F.col("l_partkey") % 7).alias("article"), F.when(F.col("l_suppkey") % 2 == 0, "BLHS").otherwise("BLDS").alias("code"))
    refs = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(ref)).alias("refs")).withColumn("meta", F.lit(None).cast("string"))
    return extract.applied_article(refs, "l_orderkey", "meta", "refs").drop("applied_article_clause")


@query("""
SELECT e.user_id, e.event_id AS src, b.event_id AS dst, (b.t - e.t)::BIGINT AS gap FROM (SELECT user_id, event_id, event_type, floor(epoch(ts))::BIGINT AS t FROM events) e
JOIN (SELECT user_id, event_id, event_type, floor(epoch(ts))::BIGINT AS t FROM events) b ON b.user_id = e.user_id AND b.event_type = 'purchase' AND b.t > e.t AND b.t - e.t < 86400
WHERE e.event_type = 'click' QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY b.t, b.event_id) = 1
""")
def proximity_relation(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.unix_timestamp("ts").alias("t"))
    return temporal.next_within(e, "user_id", "t", "event_type", "click", "purchase", 86400, "event_id")


@query("""
SELECT o_orderkey, substr('ngày áp dụng', 1, 4) || '|' || (o_orderkey % 3) AS key, 'P' || (o_orderkey % 4) || 'Y' || (o_custkey % 12) || 'M' || (o_custkey % 9) || 'D' AS term,
    ((o_orderkey % 4) * 12 + o_custkey % 12)::INTEGER AS total_months, (o_custkey % 9)::INTEGER AS days FROM orders
""")
def sentence_terms(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    part = lambda x: x.cast("string")
    term = F.concat(F.lit("P"), part(F.col("o_orderkey") % 4), F.lit("Y"), part(F.col("o_custkey") % 12), F.lit("M"), part(F.col("o_custkey") % 9), F.lit("D"))
    o = o.select("o_orderkey", F.concat(F.lit("ngày|"), part(F.col("o_orderkey") % 3)).alias("key"), term.alias("term"))
    return o.withColumn("d", text.duration("term")).select("o_orderkey", "key", "term", "d.total_months", "d.days")


# ------------------------------------------------------------------ ontology


@query("""
SELECT o_orderkey, CASE WHEN lower(o_orderpriority) = '1-urgent' THEN '1-Urgent' WHEN lower(o_orderpriority) = '2-high' THEN '2-High' ELSE '(off-ontology: ' || o_orderpriority || ')' END AS priority FROM orders
""")
def enum_normalize(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", ontology.normalise("o_orderpriority", ("1-Urgent", "2-High")).alias("priority"))


_ARCS = "(VALUES ('A1', 1483, 1857), ('A2', 1858, 1944), ('A3', 1945, 1974), ('A4', 1975, 1984), ('A5', 1985, 1999), ('A6', 2000, 2014), ('A7', 2015, 2023), ('A8', 2024, NULL)) a(arc, s, e)"


@query(f"SELECT arc, count(*) AS n, min(y)::INTEGER AS first_year FROM (SELECT year(o_orderdate) AS y FROM orders) LEFT JOIN {_ARCS} ON y >= s AND (e IS NULL OR y <= e) GROUP BY arc")
def arc_for_year(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"))
    return o.withColumn("arc", ontology.arc_for_year("y")).groupBy("arc").agg(F.count("*").alias("n"), F.min("y").alias("first_year"))


@query(f"SELECT o_orderkey, arc FROM orders LEFT JOIN {_ARCS} ON 1850 + o_orderkey % 180 >= s AND (e IS NULL OR 1850 + o_orderkey % 180 <= e)")
def arc_interval_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 180 + 1850).alias("y"))
    return temporal.in_interval(o, "y", ontology.arc_table(spark), "start_year", "end_year").select("o_orderkey", "arc")


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'BLHS' ELSE 'BLHS-' || (1980 + o_orderkey % 60) END AS code_id, CASE WHEN o_orderkey % 3 = 0 THEN '(unknown)' ELSE arc END AS legal_arc FROM orders LEFT JOIN {_ARCS} ON 1980 + o_orderkey % 60 >= s AND (e IS NULL OR 1980 + o_orderkey % 60 <= e)")
def ontology_fill(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    code = F.when(F.col("o_orderkey") % 3 == 0, "BLHS").otherwise(F.concat(F.lit("BLHS-"), (F.col("o_orderkey") % 60 + 1980).cast("string")))
    return ontology.with_ontology(o.select("o_orderkey", code.alias("applied_article_code"))).select("o_orderkey", "code_id", "legal_arc")


@query("SELECT n.n_name, CASE WHEN n.n_regionkey = 0 THEN 'Tòa án nhân dân tối cao' WHEN n.n_regionkey = 1 THEN 'Tòa án nhân dân cấp cao' WHEN n.n_regionkey = 2 THEN 'TAND tỉnh / thành phố' WHEN n.n_regionkey = 3 THEN 'TAND quận / huyện / thị xã' ELSE 'non-court / other' END AS bucket FROM nation n")
def court_bucket(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    words = F.create_map(*(F.lit(x) for kv in {0: "TAND Tối cao", 1: "Tòa án nhân dân CẤP CAO", 2: "TAND Tỉnh A.", 3: "TAND Huyện B", 4: "Viện"}.items() for x in kv))
    return n.select("n_name", text.bucket(F.element_at(words, F.col("n_regionkey"))).alias("bucket"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'Hình sự (criminal)' WHEN 1 THEN 'Dân sự (civil)' ELSE 'Unknown / unparsed' END AS sector, CASE o_orderkey % 3 WHEN 0 THEN 'Phúc thẩm (appellate)' WHEN 1 THEN 'Sơ thẩm (first instance)' ELSE 'Unknown / unparsed' END AS level FROM orders")
def case_number_labels(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    body = F.concat(F.lit("Bản án số "), k.cast("string"), F.when(k % 3 == 0, "/2020/TLPT-HS").when(k % 3 == 1, "/2020/DS-ST").otherwise("/x"))
    return o.select("o_orderkey", text.case_labels(body).alias("l")).select("o_orderkey", "l.sector", "l.level")


# ------------------------------------------------------------------ pages and URLs


@query("""
SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')), '') AS title, length(regexp_replace(html, '(?i)<a\\s[^>]*href=', chr(1), 'g')) - length(replace(regexp_replace(html, '(?i)<a\\s[^>]*href=', chr(1), 'g'), chr(1), '')) AS n_links FROM pages
""")
def html_title_links(spark, sf_dir):
    f = parse.page_fields(F.col("html"), "https://example.org")
    return table(spark, sf_dir, "pages").select("page_id", f["title"].alias("title"), f["n_links"].cast("long").alias("n_links"))


@query("""
SELECT page_id, length(trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g')))::INTEGER AS n FROM pages
""")
def strip_tags_len(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.length(text.strip_tags("html")).alias("n"))


@query("""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '([^/]*)$', 1) AS segment, CASE WHEN url LIKE '%page=2%' THEN '2' END AS page FROM pages
""")
def url_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), text.url_document("url").alias("segment"), F.nullif(F.regexp_extract("url", "[?&]page=(2)", 1), F.lit("")).alias("page"))


@query("SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, count(*) AS n, count(DISTINCT regexp_extract(url, '/(en|fr|de|es)/', 1)) AS n_langs FROM pages GROUP BY 1")
def pages_per_host(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.parse_url("url", F.lit("HOST")).alias("host"), F.regexp_extract("url", "/(en|fr|de|es)/", 1).alias("lang"))
    return p.groupBy("host").agg(F.count("*").alias("n"), F.count_distinct("lang").alias("n_langs"))


@query("SELECT i AS case_id, 'https://example.org/2ta' || i || 't1cvn' AS url, i AS parsed FROM (SELECT unnest(range(1, (SELECT count(*) FROM pages) + 1))::VARCHAR AS i)")
def numbered_urls(spark, sf_dir):
    from lexmill.sources.listing import numbered

    n = table(spark, sf_dir, "pages").count()
    return numbered(spark, 1, n, "https://example.org/2ta{}t1cvn").withColumn("parsed", text.url_case("url"))


# ------------------------------------------------------------------ joins


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.lang, d.source AS source_jsonl, l.quality, CASE WHEN l.doc_id IS NOT NULL THEN 'labels' END AS source FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id")
def outer_join_conflict(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit("labels").alias("source"))
    return relational.outer_join(d, lab, "doc_id")


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def left_join_labels(spark, sf_dir):
    return relational.left_lookup(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_resume(spark, sf_dir):
    return relational.not_done(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_present(spark, sf_dir):
    return relational.present(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").where("quality = 1"), "doc_id")


@query("SELECT c_mktsegment AS segment, n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def dictionary_lookup(spark, sf_dir):
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    return j.groupBy(F.col("c_mktsegment").alias("segment"), "n_name").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


_VERSIONS = "SELECT p_partkey, v, DATE '1992-01-01' + (v * 500)::INTEGER AS valid_from, CASE WHEN v = 4 THEN NULL ELSE DATE '1992-01-01' + (v * 500 + 480)::INTEGER END AS valid_to, p_retailprice * (1 + v) AS price FROM part, (SELECT unnest(range(0, 5)) AS v)"


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices with days in force, with gaps of 19 days between them and an open end."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("v"))
    first = F.lit("1992-01-01").cast("date")
    return p.select("p_partkey", "v", F.date_add(first, F.col("v") * 500).alias("valid_from"), F.when(F.col("v") < 4, F.date_add(first, F.col("v") * 500 + 480)).alias("valid_to"), (F.col("p_retailprice") * (1 + F.col("v"))).alias("price"))


@query(f"""
WITH v AS ({_VERSIONS}), l AS (SELECT o_orderkey, o_orderkey % 100 + 1 AS partkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT l.o_orderkey, v.v::INTEGER AS v, round(v.price, 4) AS price FROM l LEFT JOIN v ON v.p_partkey = l.partkey AND v.valid_from <= l.d AND (v.valid_to IS NULL OR v.valid_to >= l.d)
""")
def asof_price_version(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 100 + 1).alias("p_partkey"), _day("o_orderdate").alias("d"))
    out = temporal.as_of(o, _versions(spark, sf_dir), ["p_partkey"], "d")
    return out.select("o_orderkey", "v", F.round("price", 4).alias("price"))


@query(f"SELECT p_partkey, v::INTEGER AS v FROM ({_VERSIONS}) WHERE v > 0")
def version_gaps(spark, sf_dir):
    return temporal.gaps(_versions(spark, sf_dir), ["p_partkey"]).select("p_partkey", "v")


# ------------------------------------------------------------------ aggregations, sorts, sets


@query("SELECT count(n_chars) AS n, round(avg(n_chars), 4) AS mean, round(stddev_samp(n_chars), 4) AS std, min(n_chars)::DOUBLE AS least, round(quantile_cont(n_chars, 0.5), 4) AS p50, round(quantile_cont(n_chars, 0.9), 4) AS p90, round(quantile_cont(n_chars, 0.99), 4) AS p99, max(n_chars)::DOUBLE AS most FROM documents")
def doc_size_describe(spark, sf_dir):
    return relational.describe(table(spark, sf_dir, "documents"), "n_chars")


@query("SELECT count(*) AS n, max(n_chars) AS longest FROM documents WHERE n_chars <= (SELECT quantile_cont(n_chars, 0.99) FROM documents)")
def p99_clip_count(spark, sf_dir):
    return relational.clipped(table(spark, sf_dir, "documents").select("n_chars"), "n_chars").agg(F.count("*").alias("n"), F.max("n_chars").alias("longest"))


@query("SELECT lang AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 4) AS percent, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 10000 END AS ord FROM documents GROUP BY lang")
def lang_distribution(spark, sf_dir):
    return relational.value_counts(table(spark, sf_dir, "documents"), "lang", ("en", "fr"))


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL ORDER BY n DESC, source, lang LIMIT 20")
def top_sources(spark, sf_dir):
    return relational.top(table(spark, sf_dir, "documents"), ["source", "lang"], 20)


@query("SELECT sha256(text)[1:32] AS text_hash, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1")
def exact_dup_groups(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", text.text_hash("text").alias("text_hash"))
    return d.groupBy("text_hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def dedup_first_wins(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", text.text_hash("text").alias("h"))
    return relational.first_of(d, "h", "doc_id").select("doc_id", "source")


@query("SELECT CASE WHEN lower(text) LIKE '%lic%' THEN 'lic' WHEN lower(text) LIKE '%@%' THEN 'mail' ELSE 'other' END AS bucket, count(DISTINCT source) AS n_sources, count(*) AS n FROM documents GROUP BY 1")
def distinct_docs_per_bucket(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", text.bucket("text", ((("lic",), "lic"), (("@",), "mail")), "other").alias("bucket"))
    return d.groupBy("bucket").agg(F.count_distinct("source").alias("n_sources"), F.count("*").alias("n"))


@query("SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY 1")
def year_histogram(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))


@query("SELECT greatest(1985, min(y) - 2)::INTEGER AS start, least(2030, greatest(max(y) + 2, greatest(1985, min(y) - 2) + 5))::INTEGER AS stop FROM (SELECT year(o_orderdate) AS y FROM orders)")
def view_range(spark, sf_dir):
    return relational.view_range(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")), "y", 2026)


@query(f"WITH r AS (SELECT greatest(1985, min(y) - 2) AS s0, least(2030, greatest(max(y) + 2, greatest(1985, min(y) - 2) + 5)) AS e0 FROM (SELECT year(o_orderdate) AS y FROM orders)) SELECT arc, greatest(s, s0)::INTEGER AS band_start, least(coalesce(e, e0), e0)::INTEGER AS band_end FROM {_ARCS}, r WHERE coalesce(e, e0) >= s0 AND s <= e0")
def timeline_bands(spark, sf_dir):
    v = relational.view_range(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")), "y", 2026)
    return relational.bands(v, ontology.arc_table(spark))


@query("SELECT l_suppkey, count(*) AS n, count(DISTINCT l_orderkey) AS n_distinct FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 15")
def multi_agg_topk(spark, sf_dir):
    return relational.top_with_distinct(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_orderkey", 15)


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def pricing_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT json_extract_string(props, '$.page')) AS n_pages, round(avg(value), 6) AS mean_value FROM events GROUP BY 1")
def json_props_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("page", F.get_json_object("props", "$.page"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("page").alias("n_pages"), F.round(F.avg("value"), 6).alias("mean_value"))


@query("SELECT count(*) AS n_rows, count(quality) AS n_quality, count(toxic) AS n_toxic FROM documents LEFT JOIN labels USING (doc_id)")
def field_coverage(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return relational.coverage(d, "quality", "toxic")


@query("SELECT c_nationkey AS court, c_mktsegment AS charge, count(*) AS n, round(avg((c_acctbal > 0)::INTEGER), 6) AS rate FROM customer GROUP BY ROLLUP (c_nationkey, c_mktsegment)")
def appeal_rates(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("court"), F.col("c_mktsegment").alias("charge"), (F.col("c_acctbal") > 0).alias("flag"))
    return relational.grouped_rates(c, ["court", "charge"], "flag")


@query("""
WITH c AS (SELECT c_mktsegment AS a, c_nationkey AS b, count(*) AS n FROM customer GROUP BY ALL), t AS (SELECT sum(n) AS t FROM c), ca AS (SELECT a, sum(n) AS na FROM c GROUP BY a), cb AS (SELECT b, sum(n) AS nb FROM c GROUP BY b)
SELECT round((SELECT sum(n / t * ln(n * t / (na * nb))) FROM c JOIN ca USING (a) JOIN cb USING (b), t) / sqrt((SELECT -sum(na / t * ln(na / t)) FROM ca, t) * (SELECT -sum(nb / t * ln(nb / t)) FROM cb, t)), 6) AS nmi
""")
def cluster_agreement(spark, sf_dir):
    return relational.mutual_information(table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey")


@query("SELECT lang, CASE WHEN label = -1 THEN 'noise' ELSE 'c' || label END AS cluster, count(*) AS n FROM (SELECT lang, CASE WHEN doc_id % 5 = 0 THEN -1 ELSE doc_id % 5 END AS label FROM documents) GROUP BY ALL")
def cluster_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("lang", F.when(F.col("doc_id") % 5 == 0, -1).otherwise(F.col("doc_id") % 5).alias("cluster_id"))
    return d.groupBy("lang", relational.cluster_label().alias("cluster")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, lang, NULL::INTEGER AS quality FROM documents UNION ALL SELECT doc_id, NULL, quality FROM labels")
def union_schema_drift(spark, sf_dir):
    return relational.union_all(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query("SELECT doc_id, 'left' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'right' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def inventory_parity(spark, sf_dir):
    return relational.parity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id FROM documents WHERE n_chars > 1000 INTERSECT SELECT doc_id FROM labels WHERE quality = 1")
def facet_intersection(spark, sf_dir):
    return relational.common(table(spark, sf_dir, "documents").where("n_chars > 1000").select("doc_id"), table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"))


@query("SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1")
def latest_version(spark, sf_dir):
    return relational.latest(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id"], "turn")


_TREE = "(VALUES ('verdict', 'legal_type'), ('precedent', 'legal_type'), ('ruling', 'legal_type')) t(label, parent)"


@query(f"SELECT label, parent, (SELECT count(*) FROM documents WHERE CASE doc_id % 4 WHEN 0 THEN 'verdict' WHEN 1 THEN 'precedent' ELSE 'x' END = label) AS value FROM {_TREE}")
def taxonomy_treemap(spark, sf_dir):
    k = F.col("doc_id") % 4
    d = table(spark, sf_dir, "documents").select(F.when(k == 0, "verdict").when(k == 1, "precedent").otherwise("x").alias("kind"))
    t = ontology.taxonomy_table(spark).where(F.col("node").isin("verdict", "precedent", "ruling"))
    return relational.treemap(d, "kind", t)


@query("SELECT * FROM (VALUES ('case_file', 'decided_by', 'verdict'), ('verdict', 'may_become', 'precedent')) v(source_kind, name, target_kind) WHERE (SELECT count(*) FROM documents) > 0")
def present_relations(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.lit("verdict").alias("kind"))
    return relational.present_relations(d, "kind", ontology.relation_table(spark)).select("source_kind", "name", "target_kind")


# ------------------------------------------------------------------ vectors


@query("""
WITH u AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings), m AS (SELECT label, pos, avg(v::DOUBLE) AS v FROM u GROUP BY ALL), n AS (SELECT label, sqrt(sum(v * v)) AS n FROM m GROUP BY label)
SELECT label, (pos - 1)::INTEGER AS pos, round(v / n, 6) AS v FROM m JOIN n USING (label)
""")
def mean_pool_by_label(spark, sf_dir):
    p = vectors.mean_pool(table(spark, sf_dir, "embeddings"), "label")
    return p.select("label", F.posexplode("embedding").alias("pos", "v")).withColumn("v", F.round("v", 6))


@query("""
WITH s AS (SELECT q.vec_id AS query, c.vec_id AS neighbour, list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS s FROM embeddings q JOIN embeddings c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query, neighbour, round(s, 5) AS similarity, row_number() OVER (PARTITION BY query ORDER BY round(s, 9) DESC, neighbour)::INTEGER AS rank FROM s QUALIFY rank <= 8
""")
def knn_topk(spark, sf_dir):
    e = spread(table(spark, sf_dir, "embeddings"))
    return knn.nearest(e, e.where("vec_id % 20 = 0"), 8).withColumn("similarity", F.round("similarity", 5))


@query("""
WITH s AS (SELECT q.vec_id AS query, c.vec_id AS neighbour, list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS s FROM embeddings q JOIN (SELECT * FROM embeddings WHERE label >= 5) c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query, neighbour, round(s, 5) AS similarity, row_number() OVER (PARTITION BY query ORDER BY round(s, 9) DESC, neighbour)::INTEGER AS rank FROM s QUALIFY rank <= 3
""")
def knn_filtered(spark, sf_dir):
    e = spread(table(spark, sf_dir, "embeddings"))
    return knn.nearest(e.where("label >= 5"), e.where("vec_id % 20 = 0"), 3).withColumn("similarity", F.round("similarity", 5))


@query("SELECT q.vec_id AS query, c.vec_id AS neighbour, round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 5) AS similarity FROM embeddings q JOIN embeddings c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) >= 0.35")
def similar_pairs(spark, sf_dir):
    e = spread(table(spark, sf_dir, "embeddings"))
    return knn.similar(e, e.where("vec_id % 20 = 0"), 0.35).withColumn("similarity", F.round("similarity", 5))


@query()
def pca_2d(spark, sf_dir):
    p = pca(table(spark, sf_dir, "embeddings"), 2)
    return p.select("vec_id", F.round("pca_x", 4).alias("pca_x"), F.round("pca_y", 4).alias("pca_y"))


@query()
def hdbscan(spark, sf_dir):
    """Clusters inside each label, since all pairs of a group are looked at."""
    e = table(spark, sf_dir, "embeddings")
    return whole_matrix(e, "vec_id", "embedding", ["cluster_id"], hdbscan_labels, -1, "int", "label").select("vec_id", "label", "cluster_id")


# ------------------------------------------------------------------ rules


@query("""
SELECT 'fk_customer' AS rule, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'unique_nation_segment', count(*) FROM (SELECT c_nationkey, c_mktsegment FROM customer GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'price_positive', count(*) FROM orders WHERE NOT o_totalprice > 1000
UNION ALL SELECT 'status_known', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
""")
def axiom_report(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    r = rules.report(
        rules.foreign(o, "fk_customer", "o_custkey", c.where("c_acctbal > 0"), "c_custkey", "o_orderkey"),
        rules.unique(c, "unique_nation_segment", "c_nationkey", "c_mktsegment"),
        rules.check(o, "price_positive", "o_totalprice > 1000", "o_orderkey"),
        rules.one_of(o, "status_known", "o_orderstatus", ("F", "O"), "o_orderkey"),
    )
    names = spark.createDataFrame([(n,) for n in ("fk_customer", "unique_nation_segment", "price_positive", "status_known")], "rule string")
    return names.join(r.groupBy("rule").agg(F.count("*").alias("n")), "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("n"))


#: Tables of cases made of orders and their lines, with violations of each axiom here and there.
_CASES = {
    "case_files": "SELECT o_orderkey AS case_id, CAST(o_orderdate AS DATE) AS incident_date, date_add(CAST(o_orderdate AS DATE), CASE WHEN o_custkey % 50 = 0 THEN -1 ELSE 5 END) AS acceptance_date, date_add(CAST(o_orderdate AS DATE), 30) AS judgment_date, CASE WHEN o_orderkey % 2 = 0 THEN 'Sơ thẩm' ELSE 'Phúc thẩm' END AS trial_level, CASE WHEN o_orderkey % 7 = 0 THEN 'Dân sự' ELSE 'Hình sự' END AS case_type, CASE WHEN o_orderkey % 3 = 0 THEN 'convicted' WHEN o_orderkey % 11 = 0 THEN 'remanded' ELSE 'acquitted' END AS outcome, o_orderstatus = 'F' AS closed, o_orderkey - 1 AS appeal_of FROM orders",
    "statute_articles": "SELECT p_partkey AS article_id, CASE WHEN p_partkey > 1 THEN p_partkey - 1 END AS replaces_id, date_add(DATE '1995-06-01', CAST(p_partkey % 400 AS INT)) AS effective_from, CASE WHEN p_partkey % 9 = 0 THEN date_add(DATE '1995-06-01', CAST(p_partkey % 400 AS INT) - 1) WHEN p_partkey % 2 = 0 THEN date_add(DATE '1995-06-01', CAST(p_partkey % 400 AS INT)) END AS effective_to FROM part",
    "codes": "SELECT s_suppkey AS code_id, DATE '2000-01-01' AS enacted_on, date_add(DATE '2000-01-01', CAST(s_suppkey % 3 AS INT) - 1) AS repealed_on FROM supplier",
    "charges": "SELECT l_orderkey * 100 + l_linenumber AS charge_id, l_orderkey AS case_id FROM lineitem",
    "charge_articles": "SELECT l_orderkey * 100 + l_linenumber AS charge_id, l_partkey AS article_id FROM lineitem",
    "indictments": "SELECT l_orderkey AS case_id, CASE WHEN l_linestatus = 'O' THEN 'issued' ELSE 'draft' END AS status FROM lineitem",
    "lawsuits": "SELECT l_orderkey AS case_id FROM lineitem WHERE l_linenumber <= 2",
    "verdicts": "SELECT o_orderkey AS verdict_id, o_orderkey AS case_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Sơ thẩm' ELSE 'Phúc thẩm' END AS trial_level, CASE WHEN o_orderkey % 6 = 0 THEN 'convicted' ELSE 'acquitted' END AS outcome FROM orders WHERE o_orderkey % 10 < 7",
    "sentences": "SELECT l_orderkey * 100 + l_linenumber AS sentence_id, l_orderkey * 100 + l_linenumber AS charge_id, l_orderkey - CASE WHEN l_partkey % 13 = 0 THEN 1 ELSE 0 END AS verdict_id FROM lineitem WHERE l_linenumber = 1",
    "defendants": "SELECT l_orderkey * 100 + l_linenumber AS defendant_id, l_orderkey AS case_id, CAST(l_quantity AS INT) AS age_determined, CASE WHEN l_quantity < 17 THEN 'pre-2026' END AS juvenile_regime FROM lineitem",
    "precedents": "SELECT p_partkey AS precedent_id, p_partkey * 9 AS source_case_id FROM part",
    "case_events": "SELECT l_orderkey AS case_id, CASE WHEN l_returnflag = 'R' THEN 'terminal' ELSE 'hearing' END AS event_kind FROM lineitem",
    "persons": "SELECT c_custkey AS person_id, CASE WHEN c_custkey % 20 = 0 THEN c_name ELSE repeat('0123456789abcdef', 4) END AS full_name_hash FROM customer",
    "evidence": "SELECT l_orderkey AS prediction_id, l_linenumber AS edge_id FROM lineitem",
    "retrieved": "SELECT l_orderkey AS prediction_id, l_linenumber AS edge_id FROM lineitem WHERE l_discount < 0.09",
    "courts": "SELECT n_nationkey AS court_id, n_regionkey AS court_code FROM nation",
    "courts_before": "SELECT n_nationkey AS court_id, CASE WHEN n_nationkey % 5 = 0 THEN n_regionkey + 1 ELSE n_regionkey END AS court_code FROM nation",
}
#: What breaks each axiom, as (key) rows.
_BROKEN = {
    "AX-01": "SELECT article_id::VARCHAR AS key FROM statute_articles WHERE effective_from > effective_to",
    "AX-02": "SELECT a.article_id::VARCHAR FROM statute_articles a JOIN statute_articles b ON a.replaces_id = b.article_id WHERE b.effective_to IS DISTINCT FROM a.effective_from - 1",
    "AX-03": "SELECT code_id::VARCHAR FROM codes WHERE enacted_on > repealed_on",
    "AX-04": "SELECT case_id::VARCHAR FROM case_files WHERE NOT (incident_date <= acceptance_date AND acceptance_date <= judgment_date)",
    "AX-05": "SELECT charge_id::VARCHAR FROM charges JOIN case_files USING (case_id) JOIN charge_articles USING (charge_id) JOIN statute_articles USING (article_id) GROUP BY charge_id HAVING NOT bool_or(effective_from <= incident_date AND (effective_to IS NULL OR effective_to >= incident_date))",
    "AX-06": "SELECT case_id::VARCHAR FROM indictments JOIN case_files USING (case_id) WHERE status = 'issued' GROUP BY case_id, trial_level HAVING count(*) > 1",
    "AX-07": "SELECT DISTINCT case_id::VARCHAR FROM indictments JOIN case_files USING (case_id) WHERE case_type <> 'Hình sự'",
    "AX-08": "SELECT case_id::VARCHAR FROM lawsuits JOIN case_files USING (case_id) WHERE case_type <> 'Hình sự' GROUP BY case_id HAVING count(*) > 1",
    "AX-09": "SELECT sentence_id::VARCHAR FROM sentences s JOIN charges c USING (charge_id) JOIN verdicts v USING (verdict_id) WHERE c.case_id <> v.case_id",
    "AX-10": "SELECT case_id::VARCHAR FROM case_files WHERE outcome = 'convicted' AND case_id NOT IN (SELECT case_id FROM verdicts WHERE outcome = 'convicted') AND case_id NOT IN (SELECT case_id FROM sentences JOIN charges USING (charge_id))",
    "AX-11": "SELECT verdict_id::VARCHAR FROM verdicts v JOIN case_files c USING (case_id) WHERE v.trial_level = 'Phúc thẩm' AND c.appeal_of NOT IN (SELECT case_id FROM verdicts WHERE trial_level = 'Sơ thẩm')",
    "AX-12": "SELECT defendant_id::VARCHAR FROM defendants JOIN case_files USING (case_id) WHERE case_type = 'Hình sự' AND age_determined < 14",
    "AX-13": "SELECT precedent_id::VARCHAR FROM precedents LEFT JOIN case_files ON case_id = source_case_id WHERE outcome IS NULL OR outcome = 'remanded'",
    "AX-14": "SELECT case_id::VARCHAR FROM case_files c WHERE closed AND (SELECT count(*) FROM case_events e WHERE e.case_id = c.case_id AND event_kind = 'terminal') <> 1",
    "AX-15": "SELECT person_id::VARCHAR FROM persons WHERE NOT regexp_full_match(full_name_hash, '[0-9a-f]{64}')",
    "AX-16": "SELECT prediction_id::VARCHAR || '|' || edge_id::VARCHAR FROM evidence ANTI JOIN retrieved USING (prediction_id, edge_id)",
    "AX-17": "SELECT defendant_id::VARCHAR FROM defendants JOIN case_files USING (case_id) WHERE (juvenile_regime IS NOT NULL OR age_determined < 18) AND juvenile_regime IS DISTINCT FROM CASE WHEN age_determined < 18 THEN CASE WHEN incident_date >= DATE '2026-01-01' THEN 'ltpctn-2024' ELSE 'pre-2026' END END",
    "AX-18": "SELECT court_code::VARCHAR FROM courts GROUP BY court_code HAVING count(*) > 1 UNION ALL SELECT court_id::VARCHAR FROM (SELECT * FROM courts_before EXCEPT ALL SELECT * FROM courts)",
}


@query("SELECT * FROM (WITH " + ", ".join(f"{k} AS ({re.sub(r'date_add[(](.*?), (CASE.*?END|CAST[(].*? AS INT[)](?: - 1)?|[0-9]+)[)]', r'(\1 + (\2)::INTEGER)', v)})" for k, v in _CASES.items()) + " " + " UNION ALL ".join(f"SELECT '{k}' AS rule, count(*) AS n, min(key) AS first_key FROM ({v.replace('::VARCHAR', '::VARCHAR AS key', 1) if ' AS key' not in v and k != 'AX-16' else v.replace('edge_id::VARCHAR', 'edge_id::VARCHAR AS key')}) x" for k, v in _BROKEN.items()) + ") WHERE n > 0")
def axioms_of_cases(spark, sf_dir):
    for t in ("orders", "lineitem", "part", "supplier", "customer", "nation"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    found = rules.axioms({k: spark.sql(v) for k, v in _CASES.items()})
    return found.groupBy("rule").agg(F.count("*").alias("n"), F.min("key").alias("first_key"))


@query("SELECT user_id, event_id, p AS from_state, event_type AS to_state FROM (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS NOT NULL AND NOT (p = event_type OR (p = 'view' AND event_type = 'click') OR (p = 'click' AND event_type = 'purchase'))")
def state_machine(spark, sf_dir):
    kinds = [r[0] for r in table(spark, sf_dir, "events").select("event_type").distinct().collect()]
    allowed = spark.createDataFrame([*((k, k) for k in kinds), ("view", "click"), ("click", "purchase")], "from_state string, to_state string").distinct()
    return rules.illegal_steps(table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type"), "user_id", "ts", "event_type", allowed, "event_id")


@query("SELECT o_orderkey, 'ECLI:VN:' || c_nationkey || ':' || year(o_orderdate) || ':' || lpad(row_number() OVER (PARTITION BY c_nationkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey)::VARCHAR, 6, '0') AS ecli FROM orders JOIN customer ON o_custkey = c_custkey")
def ecli_ordinal(spark, sf_dir):
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    return rules.ecli(o.withColumn("y", F.year("o_orderdate")), "c_nationkey", "y", "o_orderdate", "o_orderkey").select("o_orderkey", "ecli")


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 30 < 18 THEN CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2026-01-01' THEN 'ltpctn-2024' ELSE 'pre-2026' END END AS regime,
    CASE WHEN o_custkey % 30 < 14 THEN 'under_14' WHEN o_custkey % 30 < 16 THEN '14_16' WHEN o_custkey % 30 < 18 THEN '16_18' ELSE 'adult' END AS band,
    CASE WHEN CAST(o_orderdate AS DATE) < DATE '1986-01-01' THEN 'insufficient_coverage' ELSE 'ok' END AS guard FROM orders
""")
def regime_case(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", _day("o_orderdate").alias("d"), (F.col("o_custkey") % 30).alias("age"))
    return o.select("o_orderkey", rules.juvenile_regime(F.col("d"), F.col("age")).alias("regime"), rules.age_band(F.col("age")).alias("band"), rules.guard(o, "d").alias("guard"))


@query("""
SELECT o_orderkey, 'EX-' || lpad((o_orderkey % 11 + 1)::VARCHAR, 2, '0') AS code, CASE o_orderkey % 11 + 1 WHEN 5 THEN 'acquitted' WHEN 7 THEN 'convicted' WHEN 8 THEN 'settled' WHEN 9 THEN 'remanded' WHEN 11 THEN 'remanded' ELSE 'dismissed' END AS outcome, o_orderkey % 11 + 1 NOT IN (9, 11) AS terminal FROM orders
""")
def exit_codes(spark, sf_dir):
    code = F.concat(F.lit("EX-"), F.lpad((F.col("o_orderkey") % 11 + 1).cast("string"), 2, "0"))
    return table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code")).withColumn("x", rules.exit_outcome(F.col("code"))).select("o_orderkey", "code", "x.outcome", "x.terminal")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'D0>civil.root' ELSE 'D0>D1' || CASE WHEN o_orderkey % 2 = 0 THEN '>D1.a' ELSE '' END || '>D2>D3' || CASE WHEN o_custkey % 100 < 82 THEN '>D4.weak' ELSE '' END || '>D4>D5>'
    || CASE WHEN o_custkey % 30 < 14 THEN 'J0>J1>J1.exit.no-responsibility' WHEN o_custkey % 30 < 18 THEN 'J0>J1>J2>J3>D6>D7>D8>D9' WHEN o_custkey % 10 >= 7 AND o_orderkey % 3 = 0 THEN 'D9' ELSE 'D6>D7>D8>D9' END END AS path FROM orders
""")
def decision_paths(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    p = rules.decision_path(F.when(k % 5 == 0, "Dân sự").otherwise("Hình sự"), F.col("o_orderdate"), k % 2 != 0, F.lit(True), (c % 100) / 100, c % 30, (c % 10) / 10, k % 3 == 0, F.lit(True))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(p, ">").alias("path"))


@query("""
WITH f AS (SELECT DISTINCT l_orderkey, CASE l_linenumber % 3 WHEN 0 THEN 'MIT-01' WHEN 1 THEN 'AGG-01' ELSE 'X' END AS factor FROM lineitem), w AS (SELECT l_orderkey, sum(CASE factor WHEN 'MIT-01' THEN -0.25 WHEN 'AGG-01' THEN 0.5 ELSE 0 END) AS w FROM f GROUP BY 1)
SELECT l_orderkey, round(greatest(0, t.term * (1 + w.w)), 4)::DOUBLE AS adjusted FROM (SELECT l_orderkey, sum(l_quantity) AS term FROM lineitem GROUP BY 1) t JOIN w USING (l_orderkey)
""")
def factor_adjustment(spark, sf_dir):
    n = F.col("l_linenumber") % 3
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("term"), F.collect_set(F.when(n == 0, "MIT-01").when(n == 1, "AGG-01").otherwise("X")).alias("factors"))
    w = spark.createDataFrame([("MIT-01", -0.25), ("AGG-01", 0.5)], "factor string, weight double")
    return rules.apply_factors(li, "l_orderkey", "factors", "term", w).select("l_orderkey", F.round("adjusted", 4).alias("adjusted"))


@query("SELECT l_returnflag, l_linestatus, round(least(45, greatest(5, quantile_cont(l_quantity, 0.25))), 4)::DOUBLE AS band_low, round(greatest(5, least(45, quantile_cont(l_quantity, 0.75))), 4)::DOUBLE AS band_high FROM lineitem GROUP BY ALL")
def sentence_bands(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", F.lit(5.0).alias("lo"), F.lit(45.0).alias("hi"))
    b = rules.sentence_band(li, ["l_returnflag", "l_linestatus"], "l_quantity", "lo", "hi")
    return b.select("l_returnflag", "l_linestatus", F.round("band_low", 4).alias("band_low"), F.round("band_high", 4).alias("band_high"))


@query("SELECT p_partkey, CASE WHEN p_size <= 3 THEN 'ít nghiêm trọng' WHEN p_size <= 7 THEN 'nghiêm trọng' WHEN p_size <= 15 THEN 'rất nghiêm trọng' ELSE 'đặc biệt nghiêm trọng' END AS severity FROM part")
def severity_band(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", rules.severity(F.col("p_size")).alias("severity"))


@query("SELECT doc_id, CASE WHEN source = 'src1' THEN 'test' WHEN b < 10 THEN 'test' WHEN b < 20 THEN 'dev' ELSE 'train' END AS split FROM (SELECT doc_id, source, ('0x' || sha256(doc_id::VARCHAR)[1:8])::BIGINT % 100 AS b FROM documents)")
def split_assign(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", rules.split(F.col("doc_id"), F.col("source") == "src1").alias("split"))


@query("SELECT '1997-01-01' AS cutoff, (SELECT count(*) FROM orders WHERE o_orderkey % 10 <> 0 AND CAST(o_orderdate AS DATE) > DATE '1997-01-01') AS n_late, (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 10 <> 0 INTERSECT SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 10 = 0)) AS n_shared")
def leakage_audit(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("d", _day("o_orderdate"))
    return rules.leaks(o.where("o_orderkey % 10 <> 0"), o.where("o_orderkey % 10 = 0"), "o_custkey", "d", "1997-01-01")


@query("SELECT 'cardinality' AS rule, 'customer:' || c_custkey AS key FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE coalesce(n, 0) < 1 OR n > 10")
def relation_cardinality(spark, sf_dir):
    e = _order_edges(spark, sf_dir)
    v = table(spark, sf_dir, "customer").select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("vertex"))
    return rules.cardinality(e.where("type = 'places'"), v, "cardinality", 1, 10)


@query("SELECT doc_id, round(0.5 * k + 0.5 * s, 6) AS score FROM (SELECT doc_id, (lower(text) LIKE '%the%')::INTEGER + (lower(text) LIKE '%and%')::INTEGER AS k, (doc_id % 97) / 97.0 AS s FROM documents) ORDER BY score DESC, doc_id LIMIT 10")
def hybrid_search(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", rules.keyword_hits(F.col("text"), ("the", "and")).alias("k"), ((F.col("doc_id") % 97) / 97.0).alias("s"))
    return rules.hybrid(d, "doc_id", "k", "s", 0.5, 10).select("doc_id", F.round("score", 6).alias("score"))


@query("SELECT user_id, string_agg(event_type, '>' ORDER BY ts, event_type) AS lane FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1")
def case_lanes(spark, sf_dir):
    return temporal.events_per_case(table(spark, sf_dir, "events"), "user_id", "ts", "event_type", ("click", "purchase")).select("user_id", F.array_join("lane", ">").alias("lane"))


# ------------------------------------------------------------------ graphs


def _order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "supplier")}
    return graph.edges(t, [
        graph.EdgeRule("customer", "places", "order", "orders", "o_custkey", "o_orderkey", valid_from="o_orderdate"),
        graph.EdgeRule("nation", "has", "customer", "customer", "c_nationkey", "c_custkey", "c_acctbal > 0"),
        graph.EdgeRule("region", "has", "nation", "nation", "n_regionkey", "n_nationkey"),
        graph.EdgeRule("nation", "has", "supplier", "supplier", "s_nationkey", "s_suppkey"),
    ])


_EDGES = """SELECT 'customer:' || o_custkey AS src, 'order:' || o_orderkey AS dst, 'places' AS type FROM orders
UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey, 'has' FROM customer WHERE c_acctbal > 0
UNION ALL SELECT 'region:' || n_regionkey, 'nation:' || n_nationkey, 'has' FROM nation
UNION ALL SELECT 'nation:' || s_nationkey, 'supplier:' || s_suppkey, 'has' FROM supplier"""


@query(f"SELECT type, count(*) AS n, count(DISTINCT src) AS n_src FROM ({_EDGES}) GROUP BY type")
def edge_catalogue(spark, sf_dir):
    return _order_edges(spark, sf_dir).groupBy("type").agg(F.count("*").alias("n"), F.count_distinct("src").alias("n_src"))


@query(f"SELECT vertex, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree, sum(o + i)::BIGINT AS degree FROM (SELECT src AS vertex, 1 AS o, 0 AS i FROM ({_EDGES}) UNION ALL SELECT dst, 0, 1 FROM ({_EDGES})) GROUP BY vertex")
def degree(spark, sf_dir):
    return graph.degree(_order_edges(spark, sf_dir))


@query(f"WITH e AS ({_EDGES}), a AS (SELECT dst AS vertex FROM e WHERE src = 'region:1'), b AS (SELECT e.dst AS vertex FROM e JOIN a ON e.src = a.vertex) SELECT 'region:1' AS vertex, 0 AS distance UNION ALL SELECT DISTINCT vertex, 1 FROM a UNION ALL SELECT DISTINCT vertex, 2 FROM b")
def khop2(spark, sf_dir):
    return graph.hops(_order_edges(spark, sf_dir), spark.createDataFrame([("region:1",)], "vertex string"), 2)


@query(f"""
WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM ({_EDGES}) WHERE type = 'has'), n AS (SELECT src, count(*) AS n FROM e GROUP BY src), v AS (SELECT src AS vertex FROM e UNION SELECT dst FROM e),
r0 AS (SELECT vertex, 1.0::DOUBLE AS rank FROM v),
""" + ",\n".join(f"r{k} AS (SELECT v.vertex, 0.15 + 0.85 * coalesce(g.g, 0) AS rank FROM v LEFT JOIN (SELECT e.dst, sum(r.rank / n.n) AS g FROM e JOIN r{k - 1} r ON r.vertex = e.src JOIN n ON n.src = e.src GROUP BY e.dst) g ON g.dst = v.vertex)" for k in range(1, 6)) + "\nSELECT vertex, round(rank, 8) AS rank FROM r5")
def pagerank_k(spark, sf_dir):
    return graph.pagerank(_order_edges(spark, sf_dir).where("type = 'has'"), 5).select("vertex", F.round("rank", 8).alias("rank"))


@query(f"""
WITH e AS (SELECT DISTINCT src, dst FROM ({_EDGES}) WHERE type = 'has'), b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), r0 AS (SELECT DISTINCT src AS vertex, src AS community FROM b),
""" + ",\n".join(f"r{k} AS (SELECT src AS vertex, first(community ORDER BY n DESC, community) AS community FROM (SELECT b.src, l.community, count(*) AS n FROM b JOIN r{k - 1} l ON l.vertex = b.dst GROUP BY ALL) GROUP BY src)" for k in range(1, 5)) + "\nSELECT vertex, community FROM r4")
def communities(spark, sf_dir):
    return graph.communities(_order_edges(spark, sf_dir).where("type = 'has'"), 4)


@query(f"WITH e AS (SELECT * FROM ({_EDGES}) WHERE type = 'has'), v AS (SELECT 'customer:' || c_custkey AS vertex FROM customer), x AS (SELECT src AS vertex FROM e UNION SELECT dst FROM e) SELECT (SELECT count(*) FROM v) AS n_nodes, (SELECT count(*) FROM e) AS n_edges, (SELECT count(*) FROM v WHERE vertex NOT IN (SELECT vertex FROM x)) AS n_isolated, (SELECT count(*) FROM x WHERE vertex NOT IN (SELECT vertex FROM v)) AS n_unknown")
def graph_quality(spark, sf_dir):
    v = table(spark, sf_dir, "customer").select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("vertex"))
    return graph.quality(v, _order_edges(spark, sf_dir).where("type = 'has'"))


@query("SELECT * FROM (VALUES ('legal_type', 0), ('case_file', 1), ('indictment', 1), ('investigation_conclusion', 1), ('lawsuit', 1), ('legal_situation', 1), ('precedent', 1), ('ruling', 1), ('verdict', 1)) t(node, depth) WHERE (SELECT count(*) FROM region) > 0")
def taxonomy_descent(spark, sf_dir):
    return graph.descend(ontology.taxonomy_table(spark), "legal_type", 3)


@query(f"SELECT vertex, degree FROM (SELECT vertex, count(*) AS degree FROM (SELECT src AS vertex FROM ({_EDGES}) UNION ALL SELECT dst FROM ({_EDGES})) GROUP BY vertex) ORDER BY degree DESC, vertex LIMIT 200")
def subgraph_cap(spark, sf_dir):
    return graph.cap(graph.degree(_order_edges(spark, sf_dir)).select("vertex", "degree"), "degree")


@query("""
SELECT a.c_custkey AS child, b.c_custkey AS parent FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey - a.c_custkey % 10 WHERE a.c_custkey % 10 <> 0 AND a.c_acctbal < b.c_acctbal
""")
def supersession(spark, sf_dir):
    """A self join along a chain's key."""
    c = table(spark, sf_dir, "customer")
    a = c.where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("child"), (F.col("c_custkey") - F.col("c_custkey") % 10).alias("parent"), F.col("c_acctbal").alias("x"))
    return a.join(c.select(F.col("c_custkey").alias("parent"), "c_acctbal"), "parent").where("x < c_acctbal").select("child", "parent")


@query("SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id)::INTEGER AS place FROM documents QUALIFY place <= 3")
def longest_per_source(spark, sf_dir):
    w = Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.row_number().over(w).alias("place")).where("place <= 3")


#: Tables of a case graph made of orders and their lines.
_KG = {
    "case_files": "SELECT o_orderkey AS case_id, o_custkey AS case_code, CASE WHEN o_orderkey % 2 = 0 THEN 'Sơ thẩm' ELSE 'Phúc thẩm' END AS trial_level, CAST(o_orderdate AS DATE) AS judgment_date, o_custkey % 25 AS court_id, o_orderpriority AS legal_relation, o_orderstatus AS procedure_type FROM orders",
    "situation_cases": "SELECT o_custkey AS situation_id, o_orderkey AS case_id FROM orders WHERE o_orderkey % 3 = 0",
    "lawsuits": "SELECT l_orderkey AS case_id, l_orderkey * 100 + l_linenumber AS lawsuit_id FROM lineitem WHERE l_linenumber = 2",
    "indictments": "SELECT l_orderkey AS case_id, l_orderkey * 100 + l_linenumber AS indictment_id, CAST(l_shipdate AS DATE) AS issue_date, l_suppkey AS issuing_authority FROM lineitem WHERE l_linenumber <= 2",
    "investigation_conclusions": "SELECT l_orderkey AS case_id, l_orderkey * 100 + l_linenumber AS conclusion_id, CAST(l_shipdate AS DATE) AS issue_date, l_suppkey AS issuing_authority FROM lineitem WHERE l_linenumber IN (3, 4)",
    "verdicts": "SELECT l_orderkey AS case_id, l_orderkey * 100 + l_linenumber AS verdict_id, CAST(l_shipdate AS DATE) AS pronounced_date, l_suppkey % 25 AS court_id FROM lineitem WHERE l_linenumber IN (1, 3)",
    "rulings": "SELECT l_orderkey AS case_id, l_orderkey * 100 + l_linenumber AS ruling_id FROM lineitem WHERE l_returnflag = 'R'",
    "precedents": "SELECT p_partkey AS precedent_id, p_partkey * 3 AS source_case_id, CASE WHEN p_size > 5 THEN p_size END AS applied_article_id FROM part",
    "retrieved": "SELECT l_orderkey AS case_id, l_partkey AS precedent_id, l_discount * 10 AS score FROM lineitem",
    "defendants": "SELECT l_orderkey AS case_id, l_orderkey * 100 + l_linenumber AS defendant_id, l_suppkey AS person_id FROM lineitem WHERE l_quantity > 25",
    "charges": "SELECT l_orderkey AS case_id, l_orderkey * 100 + l_linenumber AS charge_id FROM lineitem WHERE l_linestatus = 'F'",
    "charge_articles": "SELECT l_orderkey * 100 + l_linenumber AS charge_id, l_partkey AS article_id FROM lineitem",
    "sentences": "SELECT l_orderkey * 100 + l_linenumber AS sentence_id, l_orderkey * 100 + l_linenumber AS charge_id, CASE WHEN l_linenumber IN (1, 3) THEN l_orderkey * 100 + l_linenumber END AS verdict_id FROM lineitem WHERE l_linestatus = 'F'",
    "evidence_items": "SELECT l_orderkey AS case_id, l_partkey AS evidence_id FROM lineitem WHERE l_tax > 0.05",
    "case_events": "SELECT l_orderkey AS case_id, l_orderkey * 100 + l_linenumber AS event_id FROM lineitem",
    "case_factors": "SELECT l_orderkey AS case_id, 'AGG-' || CAST(l_linenumber AS VARCHAR(9)) AS factor_code FROM lineitem WHERE l_quantity > 40",
    "statute_articles": "SELECT p_partkey AS article_id, p_size AS code_id, CASE WHEN p_partkey % 4 = 0 THEN p_partkey - 1 END AS replaces_id FROM part",
}
#: What ``casegraph.derived`` makes, in SQL.
_KG_DERIVED = {
    "appeals": "SELECT a.case_id, f.case_id AS first_case_id FROM case_files a JOIN (SELECT * FROM case_files WHERE trial_level = 'Sơ thẩm' QUALIFY row_number() OVER (PARTITION BY case_code ORDER BY judgment_date DESC, case_id DESC) = 1) f USING (case_code) WHERE a.trial_level = 'Phúc thẩm'",
    "preceding": "SELECT indictment_id, conclusion_id FROM indictments i JOIN investigation_conclusions c USING (case_id) WHERE c.issue_date <= i.issue_date QUALIFY row_number() OVER (PARTITION BY indictment_id ORDER BY c.issue_date DESC, conclusion_id DESC) = 1",
    "precedent_verdicts": "SELECT verdict_id, precedent_id FROM precedents JOIN verdicts ON case_id = source_case_id QUALIFY row_number() OVER (PARTITION BY precedent_id ORDER BY pronounced_date DESC, verdict_id DESC) = 1",
    "grounds": "SELECT * FROM retrieved WHERE score >= 0.82",
    "indictment_charges": "SELECT indictment_id, charge_id FROM indictments JOIN charges USING (case_id)",
    "verdict_charges": "SELECT verdict_id, charge_id FROM verdicts JOIN charges USING (case_id)",
}
_KINDS = ", ".join(f"('{leaf}', '{path[-1]}')" for path, leaves in ontology.TAXONOMY.items() for leaf in leaves)
_KG_EDGES = (
    "WITH " + ", ".join(f"{k} AS ({v})" for k, v in (_KG | _KG_DERIVED).items())
    + ", plain AS (" + " UNION ALL ".join(f"SELECT '{s}:' || {a} AS src, '{d}:' || {b} AS dst, '{n}' AS type, {'score' if t == 'grounds' else '1.0'}::DOUBLE AS weight FROM {t} WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for s, n, d, t, a, b in casegraph.RELATIONS)
    + f"), e AS (SELECT * FROM plain UNION ALL SELECT 'taxonomy_concept:' || parent, node, 'groups', 1.0 FROM (SELECT src AS node FROM plain UNION SELECT dst FROM plain) JOIN (VALUES {_KINDS}) v(kind, parent) ON kind = split_part(node, ':', 1)) "
)


def _case_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    for t in ("orders", "lineitem", "part"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    return casegraph.case_edges({k: spark.sql(v) for k, v in _KG.items()})


@query(f"SELECT * FROM ({_KG_EDGES} SELECT type, split_part(src, ':', 1) AS source_kind, split_part(dst, ':', 1) AS target_kind, count(*) AS n, count(DISTINCT src) AS n_src, count(DISTINCT dst) AS n_dst, min(weight) AS least, max(weight) AS most FROM e GROUP BY 1, 2, 3)")
def case_graph(spark, sf_dir):
    """All relations of cases, counted by kind."""
    e = _case_edges(spark, sf_dir)
    kinds = [F.substring_index(c, ":", 1).alias(k) for c, k in (("src", "source_kind"), ("dst", "target_kind"))]
    return e.groupBy("type", *kinds).agg(F.count("*").alias("n"), F.count_distinct("src").alias("n_src"), F.count_distinct("dst").alias("n_dst"), F.min("weight").alias("least"), F.max("weight").alias("most"))


@query(f"SELECT * FROM ({_KG_EDGES} SELECT DISTINCT dst AS article FROM e WHERE type = 'cites_article' AND src = 'charge:101')")
def charge_articles(spark, sf_dir):
    return casegraph.charge_articles(_case_edges(spark, sf_dir), "charge:101")


@query(f"SELECT * FROM ({_KG_EDGES} SELECT DISTINCT h.src AS case_file FROM e c JOIN e x ON x.dst = c.src AND x.type = 'has_charge' JOIN e h ON h.dst = x.src AND h.type IN ('decided_by', 'indicted_by') WHERE c.type = 'cites_article' AND c.dst = 'statute_article:7' ORDER BY 1 LIMIT 50)")
def article_cases(spark, sf_dir):
    return casegraph.article_cases(_case_edges(spark, sf_dir), "statute_article:7")


@query(f"SELECT * FROM ({_KG_EDGES} SELECT src AS case_file, max(weight) AS weight FROM e WHERE type = 'grounded_on' AND dst = 'precedent:7' GROUP BY 1)")
def precedent_cases(spark, sf_dir):
    return casegraph.precedent_cases(_case_edges(spark, sf_dir), "precedent:7")


# ------------------------------------------------------------------ lanes and the dashboard


@query("SELECT user_id, event_id % 3 AS defendant, string_agg(event_type, '>' ORDER BY ts, event_type) AS lane FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1, 2")
def defendant_lanes(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("defendant", F.col("event_id") % 3)
    return temporal.events_per_case(e, "user_id", "ts", "event_type", ("click", "purchase"), "defendant").select("user_id", "defendant", F.array_join("lane", ">").alias("lane"))


@query("""
SELECT 'year' AS panel, year(o_orderdate)::VARCHAR AS key, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'charge', o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) IN (1995, 1996) GROUP BY 2 ORDER BY n DESC, 2 LIMIT 3)
UNION ALL SELECT 'province', o_orderstatus, count(*) FROM orders WHERE year(o_orderdate) IN (1995, 1996) GROUP BY 2
""".replace("WHERE o_orderstatus = 'F' GROUP", "WHERE o_orderstatus IN ('F') GROUP"))
def dashboard(spark, sf_dir):
    """Panels that filter each other, one with its three most frequent keys."""
    o = table(spark, sf_dir, "orders")
    panels = {"year": F.year("o_orderdate"), "charge": F.col("o_orderpriority"), "province": F.col("o_orderstatus")}
    return report.dashboard(o, panels, {"year": [1995, 1996], "province": ["F"]}, {"charge": 3})


# ------------------------------------------------------------------ what is written and read again


def _folder(spark: SparkSession, name: str) -> str:
    path = new_path(spark, name)
    free_at_end(spark, path)
    return path


@query("SELECT doc_id, lang, length(text)::INTEGER AS n FROM documents")
def json_lines_again(spark, sf_dir):
    """Documents through JSON lines; only the fields asked for are parsed."""
    path = _folder(spark, "lines")
    sinks.write_json(table(spark, sf_dir, "documents"), path, drop=["source"])
    return readers.json_lines(spark, path, "doc_id bigint, lang string, source string, n_chars bigint, text string", ["doc_id", "lang", "text"]).select("doc_id", "lang", F.length("text").alias("n"))


@query(r"SELECT doc_id::VARCHAR AS doc_name, length(text)::INTEGER AS n, lang, source FROM documents WHERE regexp_matches(text, '\S')")
def markdown_again(spark, sf_dir):
    """Documents through the Markdown sink; everything but name and text is in meta."""
    path = _folder(spark, "markdown")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_name"), F.col("text").alias("markdown"), "lang", "source")
    sinks.write_markdown(d, path)
    meta = F.from_json("meta", "lang string, source string")
    return readers.parquet(spark, path, ["doc_name", "markdown", "meta"]).select("doc_name", F.length("markdown").alias("n"), meta["lang"].alias("lang"), meta["source"].alias("source"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def partitions_again(spark, sf_dir):
    """Events through Parquet in folders by type, which are columns again."""
    path = _folder(spark, "partitions")
    sinks.write_parquet(table(spark, sf_dir, "events").select("event_type", "event_id", "value"), path, partition_by=("event_type",))
    return readers.partitioned(spark, path).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT strftime(o_orderdate, '%Y') AS yyyy, strftime(o_orderdate, '%m') AS mm, count(*) AS n, max(o_orderkey) AS last FROM orders GROUP BY 1, 2")
def mirror_again(spark, sf_dir):
    """Orders through the daily mirror, under the first day of their month."""
    path = _folder(spark, "mirror")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("month"))
    sinks.write_mirror(o, path, "month")
    back = spark.read.schema("o_orderkey bigint, yyyy string, mm string, dd string").option("basePath", path).json(path)
    return back.groupBy("yyyy", "mm").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last"))


@query("SELECT doc_id::VARCHAR AS doc_name, sha256(text)[1:16] AS head, n_chars % 40 AS num_pages, 'local' AS parser_model FROM documents")
def parsed_again(spark, sf_dir):
    """The consolidated table of parsed documents: cast to its schema, missing columns null."""
    path = _folder(spark, "parsed")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_name"), F.col("text").alias("markdown"), (F.col("n_chars") % 40).alias("num_pages"), F.lit("local").alias("parser_model"))
    sinks.write_parquet(sinks.parsed_table(d), path)
    return readers.parquet(spark, path).where("adopted_date is null").select("doc_name", F.substring(F.sha2("text", 256), 1, 16).alias("head"), "num_pages", "parser_model")
