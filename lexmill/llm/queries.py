"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.base import documents, spread, table


def op1_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm.embedding_graph import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93).select("vec_id", "n_links", "component_id", "kept")


OP1_SQL = """
WITH RECURSIVE links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.93
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
    vec_id <= coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id) AS kept FROM embeddings
"""


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm.decontaminate import contamination

    found = contamination(documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    best = F.transform(F.array_sort(F.transform("matches", lambda m: F.struct(-m["score"], m["item_id"]))), lambda x: x["item_id"])
    return found.where(F.size("matches") > 0).select(
        "doc_id",
        F.try_element_at(best, F.lit(1)).alias("item_id"),
        F.array_max(F.transform("matches", lambda m: m["score"])).alias("score"),
        F.size("matches").alias("n_items"),
        F.array_sort(F.transform("matches", lambda m: m["item_id"])).alias("item_ids"),
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm.base import batches
    from lexmill.llm.html_text import main_text

    batches(spark)
    return main_text(spread(table(spark, sf_dir, "pages").select("page_id", "url", "html")))


#: The pages of these tables put the article into one element of that name; the operator does not rely on it.
OP3_SQL = r"""
WITH blocks AS (
    SELECT page_id, url, generate_subscripts(b, 1) AS k, unnest(b) AS x FROM (
        SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', ' ', 'g'), '</?(p|h1|h2|h3|ul|li|div)( [^>]*)?>', chr(1), 'g'), chr(1)) AS b FROM pages)
), plain AS (
    SELECT page_id, url, k, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS x FROM blocks
), joined AS (SELECT page_id, url, coalesce(string_agg(x, chr(10) ORDER BY k) FILTER (WHERE x <> ''), '') AS text FROM plain GROUP BY ALL)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined
"""


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm.warc import captures, read_archives, write_archives
    from lexmill.session import new_path

    path = new_path(spark, "warc")
    write_archives(spread(table(spark, sf_dir, "pages").select("page_id", "url", "html")), path, min_bytes=0)
    c = captures(read_archives(spark, path, with_payload=False)).where("response is not null")
    page = F.regexp_extract(F.try_element_at("metadata", F.lit(1))["fields"], r"pageId: (-?\d+)", 1)
    c = c.select("response.*", F.nullif(page, F.lit("")).cast("bigint").alias("page_id"))
    origin = c.where("type = 'response'").select(F.col("record_id").alias("origin"), F.col("page_id").alias("origin_page"))
    out = c.join(origin, c["refers_to"] == F.col("origin"), "left")
    return out.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("origin_page").alias("refers_to"))


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS origin FROM pages),
h AS (SELECT *, list_transform([1, 11, 21, 31], lambda k: ('0x' || substr(sha1(html), k::BIGINT, 10))::BIGINT) AS parts FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
    array_to_string(list_transform(parts, lambda v: array_to_string(list_transform(range(0, 8), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((v >> (35 - 5 * i)::INTEGER) & 31) + 1)::BIGINT, 1)), '')), '') AS payload_digest,
    CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> origin THEN origin END AS refers_to FROM h
"""


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm.preference import conversations, format_pairs, mask_text, sibling_pairs, stale_pairs

    c = conversations(table(spark, sf_dir, "conversations"))
    pairs = sibling_pairs(c).withColumn("kind", F.lit("sibling")).unionByName(stale_pairs(c).withColumn("kind", F.lit("stale")))
    return format_pairs(pairs).select("chosen_id", "rejected_id", "kind", "n_prompt_turns", "prompt", "chosen_text", "rejected_text", mask_text("chosen_mask").alias("chosen_mask"), mask_text("rejected_mask").alias("rejected_mask"))


OP5_SQL = """
WITH c AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, 'unknown'), t := coalesce(text, '')) ORDER BY turn NULLS LAST, coalesce(role, 'unknown'), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), best AS (
    SELECT turns[1] AS f, count(*) AS n, first(conv_id ORDER BY len(turns) DESC, list_sum(list_transform(turns, lambda x: length(x.t))) DESC, conv_id) AS id FROM c GROUP BY turns[1]
), pairs AS (
    SELECT b.id AS chosen_id, d.turns AS chosen, c.conv_id AS rejected_id, c.turns AS rejected, 'sibling' AS kind
    FROM c JOIN best b ON b.f = c.turns[1] AND b.n > 1 AND b.id <> c.conv_id JOIN c d ON d.conv_id = b.id
    UNION ALL
    SELECT conv_id, turns, conv_id, list_transform(turns, lambda x, i: struct_pack(r := x.r, t := CASE WHEN i = a[len(a)] THEN CASE WHEN len(a) > 1 THEN turns[a[len(a) - 1]].t ELSE '' END ELSE x.t END)), 'stale'
    FROM (SELECT *, list_filter(range(1, len(turns) + 1), lambda i: turns[i].r = 'assistant') AS a FROM c) WHERE len(a) > 0
), cut AS (
    SELECT *, list_filter(range(0, least(len(chosen), len(rejected)) + 1), lambda i: i = least(len(chosen), len(rejected)) OR chosen[i + 1] IS DISTINCT FROM rejected[i + 1])[1] AS k FROM pairs
), rest AS (
    SELECT chosen_id, rejected_id, kind, k, chosen[1:k] AS p, chosen[k + 1:] AS a, rejected[k + 1:] AS b FROM cut
), shown AS (
    SELECT *, list_transform(p, lambda x: '<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)) AS ps,
           list_transform(a, lambda x: '<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)) AS sa,
           list_transform(b, lambda x: '<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)) AS sb FROM rest
)
SELECT chosen_id, rejected_id, kind, k::INTEGER AS n_prompt_turns, array_to_string(ps, '') AS prompt, array_to_string(sa, '') AS chosen_text, array_to_string(sb, '') AS rejected_text,
    array_to_string(list_transform(list_filter(range(1, len(a) + 1), lambda i: a[i].r = 'assistant'), lambda i: (length(array_to_string(sa[1:i - 1], '')) + 22)::VARCHAR || '-' || (length(array_to_string(sa[1:i], '')) - 1)::VARCHAR), ',') AS chosen_mask,
    array_to_string(list_transform(list_filter(range(1, len(b) + 1), lambda i: b[i].r = 'assistant'), lambda i: (length(array_to_string(sb[1:i - 1], '')) + 22)::VARCHAR || '-' || (length(array_to_string(sb[1:i], '')) - 1)::VARCHAR), ',') AS rejected_mask
FROM shown
"""


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm.licenses import scan

    found = scan(documents(spark, sf_dir, "doc_id", "text"))
    found = found.where(F.size("licenses") > 0)
    return found.select("doc_id", F.size("licenses").alias("n_found"), F.array_join(F.transform("licenses", lambda x: x["license_id"]), " ").alias("license_ids"), F.array_join(F.transform("licenses", lambda x: x["start"].cast("string")), " ").alias("starts"))


#: Documents hold one-line notices of four licences.
OP6_SQL = """
WITH pieces AS (
    SELECT doc_id, generate_subscripts(p, 1) AS k, unnest(p) AS s FROM (SELECT doc_id, string_split(regexp_replace(text, '[.!?:;](\\s|$)', chr(1) || '\\1', 'g'), chr(1)) AS p FROM documents)
), lines AS (
    SELECT doc_id, k, generate_subscripts(l, 1) AS i, unnest(l) AS s FROM (SELECT doc_id, k, string_split(s, chr(10)) AS l FROM pieces)
), placed AS (
    SELECT *, sum(length(s) + 1) OVER (PARTITION BY doc_id ORDER BY k, i) - length(s) - 1 AS pos FROM lines
), named AS (
    SELECT doc_id, pos, CASE
        WHEN regexp_full_match(lower(trim(s)), 'released under the mit license') THEN 'MIT'
        WHEN regexp_full_match(lower(trim(s)), 'licensed under the apache license, version [0-9.]+') THEN 'Apache-' || regexp_extract(s, '[0-9.]+')
        WHEN regexp_full_match(lower(trim(s)), 'licensed under cc by-nc [0-9.]+') THEN 'CC-BY-NC-' || regexp_extract(s, '[0-9.]+')
        WHEN regexp_full_match(lower(trim(s)), 'this work is licensed under the gnu general public license, version [0-9]+') THEN 'GPL-' || regexp_extract(s, '[0-9]+') || '.0-only' END AS id
    FROM placed
)
SELECT doc_id, count(*)::INTEGER AS n_found, string_agg(id, ' ' ORDER BY pos) AS license_ids, string_agg(pos::BIGINT::VARCHAR, ' ' ORDER BY pos) AS starts
FROM named WHERE id IS NOT NULL GROUP BY doc_id
"""


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm.ngram_join import ngram_classes

    return ngram_classes(documents(spark, sf_dir, "doc_id", "text"), size=3, num=90, den=100)


OP7_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM words
), one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b), lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id FROM sets LEFT JOIN lowest ON a = doc_id
"""


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lexmill.llm.token_counts import token_counts

    return token_counts(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lexmill.llm.byte_bpe import byte_bpe

    return byte_bpe(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm.toxicity import fit, held_out, toxicity, training_rows

    d = documents(spark, sf_dir, "doc_id", "text")
    out = toxicity(d, fit(training_rows(d, table(spark, sf_dir, "labels"))))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_hits")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in sorted(globals().items()) if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embedding_graph": OP1_SQL,
        "op3_html_text": OP3_SQL,
        "op4_warc": OP4_SQL,
        "op5_preference_format": OP5_SQL,
        "op6_license_scan": OP6_SQL,
        "op7_ngram_jaccard": OP7_SQL,
    }
