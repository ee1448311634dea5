"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

from lexmill.llm import byte_bpe, decontaminate, embedding_graph, html_text, licenses, ngram_join, preference, token_counts, toxicity, warc
from lexmill.session import new_path

tokenizers = pytest.importorskip("public_tokenizers")
BPE = (tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
MODEL = tokenizers.path("piece_bpe_32k.model")
LONG = "dài lắm " * 30_000
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, "một hai ba bốn năm"), (4, "một hai ba bốn năm"), (5, "một hai ba bốn năm"), (None, "không tên"), (6, LONG), (7, "x" * 3000), (8, "y" * 200_000), (9, "ba " * 60_000)]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, "doc_id long, text string")
    clash = ("row", "first", "score", "predicted", "n", "id", "matches", "keys", "ids", "label", "component", "n_tokens", "__id", "lang")
    return d.withColumns({c: F.lit("extra") for c in clash})


OPERATORS = {
    "tokens": lambda d: token_counts.token_counts(d, MODEL),
    "bpe": lambda d: byte_bpe.byte_bpe(d, *BPE),
    "toxicity": lambda d: toxicity.toxicity(d, toxicity.Lexicon({" ba ": 5.0})),
    "licenses": lambda d: licenses.scan(d),
    "jaccard": lambda d: ngram_join.ngram_classes(d),
    "leaks": lambda d: decontaminate.contamination(d, d.sparkSession.createDataFrame([(1, "một hai ba bốn năm"), (2, None), (3, ""), (4, "một hai ba bốn năm")], "item_id long, text string")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_documents(docs, name):
    out = OPERATORS[name](docs).collect()
    assert len(out) == len(ROWS)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(tuple(r))
    assert len(by[4]) == 2 and by[4][0] == by[4][1]
    assert OPERATORS[name](docs.where("false")).count() == 0
    nulls = docs.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    assert OPERATORS[name](nulls).count() == len(ROWS)
    if name == "tokens":
        assert by[1][0][1:] == (0, 0, False) == by[2][0][1:] and by[6][0][3]
    if name == "bpe":
        assert by[1][0][1] == 0 and bytes(by[6][0][3]).decode() == LONG
    if name == "jaccard":
        assert [by[k][0][1:] for k in (1, 2, 3, 4, 5)] == [(0, 1), (0, 2), (0, 3), (3, 4), (3, 4)] and by[None][0][2] is None
    if name == "leaks":
        assert [m["item_id"] for m in by[5][0][1]] == [1, 4] and by[1][0][1] == []
        empty = decontaminate.contamination(docs, docs.sparkSession.createDataFrame([], "item_id long, text string"))
        assert empty.where(F.size("matches") > 0).count() == 0 and empty.count() == len(ROWS)
    if name == "toxicity":
        assert by[4][0][2] == 1 and by[1][0][2] == 0


@pytest.mark.parametrize("name", ["toxicity", "leaks"])
def test_whole_rows_come_through(docs, name):
    out = toxicity.toxicity(docs, toxicity.Lexicon(), whole=True) if name == "toxicity" else decontaminate.contamination(docs, docs.sparkSession.createDataFrame([(1, "a b c")], "item_id long, text string"), whole=True)
    assert sorted(map(repr, out.select("row.*").collect())) == sorted(map(repr, docs.collect()))


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [1.0, 0.0], None), (12, [1.0], 1), (None, [1.0, 0.0], 1), (13, [0.0, 1.0], 1)]
    d = spark.createDataFrame(v, "vec_id long, embedding array<float>, label int").withColumns({"id": F.lit("x"), "v": F.lit("y"), "rep": F.lit(3)})
    out = embedding_graph.near_duplicates(d).collect()
    assert len(out) == len(v)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False) and got[None] == (0, None, False)
    assert all(got[k] == (0, k, True) for k in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13))
    assert embedding_graph.near_duplicates(d.where("false")).count() == 0
    assert embedding_graph.near_duplicates(d.where("vec_id in (5, 6)")).count() == 2


def test_pages(spark):
    deep = "<div>" * 3000 + "<p>tief</p>"
    p = [(1, "http://a/", None), (2, None, ""), (3, "http://a/\r\nX: y", "<p>same</p>"), (4, "", "<p>same</p>"), (4, "", "<p>same</p>"), (None, "u", "<p>same</p>"), (5, "u", deep), (6, "u", "<article><h1>Titel</h1><p>" + "Ein langer Satz mit Wörtern. " * 4000 + "</p></article>"), (7, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb < > & <p")]
    d = spark.createDataFrame(p, "page_id long, url string, html string").withColumns({"text": F.lit("x"), "digest": F.lit("y"), "own": F.lit(1), "first": F.lit(2)})
    text = html_text.main_text(d)
    assert text.count() == len(p) and text.columns == ["page_id", "url", "text", "n_chars"]
    got = {r["page_id"]: r for r in text.collect()}
    assert got[1]["text"] == "" == got[2]["text"] and got[6]["n_chars"] > 100_000
    assert html_text.main_text(d.where("false")).count() == 0
    for name, rows in (("some", d), ("none", d.where("false"))):
        path = new_path(spark, "warc-" + name)
        warc.write_archives(rows, path)
        c = warc.captures(warc.read_archives(spark, path)).where("response is not null").collect()
        if name == "none":
            assert c == []
            continue
        by = {str(r["metadata"][0]["fields"]).strip(): r["response"] for r in c}
        assert len(c) == len(p)
        same = sorted((str(r["metadata"][0]["fields"]).strip(), r["response"]["type"]) for r in c)
        assert [x for x in same if x[0] in ("pageId: 3", "pageId: 4", "")] == [("", "revisit"), ("pageId: 3", "revisit"), ("pageId: 4", "response"), ("pageId: 4", "revisit")]
        first = next(r["response"]["record_id"] for r in c if r["response"]["type"] == "response" and "pageId: 4" in r["metadata"][0]["fields"])
        assert {r["response"]["refers_to"] for r in c if r["response"]["payload_digest"] == by["pageId: 3"]["payload_digest"]} == {None, first} and by["pageId: 1"]["type"] == "revisit" and by["pageId: 2"]["payload_bytes"] == 0
        assert bytes(by["pageId: 7"]["payload"]).decode() == p[8][2] and by["pageId: 3"]["payload_bytes"] == len("<p>same</p>")
        assert all(len(r["requests"]) == 1 for r in c)
    path = new_path(spark, "warc-large")
    warc.write_archives(d, path, min_bytes=1000)
    assert {r["response"]["type"] for r in warc.captures(warc.read_archives(spark, path)).collect()} == {"response"}


def test_conversations(spark):
    t = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (2, 0, "user", "hi"), (2, 1, "assistant", "z"), (3, None, None, None), (None, 0, "user", "x"), (4, 0, "assistant", "q"), (4, 0, "assistant", "q"), (5, 0, "user", "hi"), (5, 1, "assistant", "a")]
    d = spark.createDataFrame(t, "conv_id long, turn long, role string, text string").withColumns({"turns": F.lit(1), "chosen": F.lit(2), "at": F.lit(3)})
    c = preference.conversations(d)
    assert {r["conv_id"]: len(r["turns"]) for r in c.collect()} == {1: 4, 2: 2, 3: 1, 4: 2, 5: 2}
    f = preference.format_pairs(preference.sibling_pairs(c))
    got = {r["rejected_id"]: r for r in f.collect()}
    assert set(got) == {2, 5} and all(r["chosen_id"] == 1 for r in got.values())
    assert got[2]["n_prompt_turns"] == 1 and got[5]["n_prompt_turns"] == 2 and got[5]["rejected_text"] == ""
    r = got[2]
    assert r["prompt"] == "<|im_start|>user\nhi<|im_end|>\n"
    assert [r["chosen_text"][m["start"] : m["stop"]] for m in r["chosen_mask"]] == ["a<|im_end|>", "c<|im_end|>"]
    stale = {r["chosen_id"]: r for r in preference.format_pairs(preference.stale_pairs(c)).collect()}
    assert set(stale) == {1, 2, 4, 5} and stale[4]["n_prompt_turns"] == 2 and stale[1]["rejected_text"] == "<|im_start|>assistant\na<|im_end|>\n"
    assert stale[2]["rejected_text"] == "<|im_start|>assistant\n<|im_end|>\n"
    empty = preference.conversations(d.where("false"))
    assert preference.format_pairs(preference.sibling_pairs(empty).unionByName(preference.stale_pairs(empty))).count() == 0


def test_copies_do_not_make_keys_shared(spark):
    # (key, node, times): 1 has copies of one node, 2 two nodes with copies, 3 a row that stands for many, 4 a single one
    rows = spark.createDataFrame([(1, 5, 1)] * 4 + [(2, 6, 1)] * 40 + [(2, 7, 1)] * 40 + [(3, 1, 70), (3, 1, 1), (3, 9, 1), (4, 8, 1)], "key long, node long, times long")
    got = {(r["key"], r["node"]): (r["head"], r["times"]) for r in ngram_join.meeting(rows).collect()}
    assert got == {(2, 6): (6, 2), (2, 7): (6, 2), (3, 1): (1, 71), (3, 9): (1, 71)}


def test_copies_in_many_files_are_one_class(spark, tmp_path):
    base = [(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(6)]
    near = [(6, base[0][1] + " end")]
    for k in range(5):
        spark.createDataFrame([(i + 7 * k, t) for i, t in base + near], "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_classes(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got == {i + 7 * k: i % 6 for i in range(7) for k in range(5)}
