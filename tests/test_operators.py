import datetime as dt
import json
import time
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.operators import casegraph, embed, graph, knn, parse, reduce, relational, rules, temporal
from lexmill.operators.components import connected_components
from lexmill.plans import pipeline
from lexmill.plans.config import SiteConfig, load, typed
from lexmill.session import stored
from lexmill.sources import listing, readers, sinks
from lexmill.streaming import files


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_outer_join_right_wins(spark):
    a = spark.createDataFrame([("x", 1, "l"), ("y", 2, "l")], "doc_name string, a int, v string")
    b = spark.createDataFrame([("y", "r"), ("z", "r")], "doc_name string, v string")
    out = relational.outer_join(a, b, "doc_name")
    assert out.columns == ["doc_name", "a", "v_jsonl", "v"]
    assert {r["doc_name"]: r["v"] for r in out.collect()} == {"x": None, "y": "r", "z": "r"}


def test_as_of_edges(spark):
    d = dt.date
    v = spark.createDataFrame([("A", d(2000, 1, 1), d(2000, 12, 31), 1), ("A", d(2002, 1, 1), None, 2)], "k string, valid_from date, valid_to date, n int")
    f = spark.createDataFrame([(1, "A", d(2000, 12, 31)), (2, "A", d(2001, 6, 1)), (3, "A", d(2030, 1, 1)), (4, "B", d(2000, 5, 5)), (5, "A", None)], "row_id int, k string, at date")
    assert {r["row_id"]: r["n"] for r in temporal.as_of(f, v, ["k"], "at").collect()} == {1: 1, 2: None, 3: 2, 4: None, 5: None}
    assert temporal.gaps(v, ["k"]).count() == 1


def test_axioms_find_each_violation(spark):
    d = dt.date
    t = {
        "statute_articles": spark.createDataFrame([("a1", d(2000, 1, 1), d(1999, 1, 1), None), ("a2", d(2010, 1, 1), None, "a1"), ("a3", d(2000, 1, 1), d(2009, 12, 31), None)], "article_id string, effective_from date, effective_to date, replaces_id string"),
        "codes": spark.createDataFrame([("c", d(2000, 1, 1), d(1990, 1, 1))], "code_id string, enacted_on date, repealed_on date"),
        "case_files": spark.createDataFrame([("k1", "Hình sự", d(2020, 1, 1), d(2019, 1, 1), None, "Sơ thẩm", "convicted", None, True), ("k2", "Dân sự", d(2020, 1, 1), None, None, "Sơ thẩm", None, None, False)], "case_id string, case_type string, incident_date date, acceptance_date date, judgment_date date, trial_level string, outcome string, appeal_of string, closed boolean"),
        "charges": spark.createDataFrame([("h1", "k1")], "charge_id string, case_id string"),
        "charge_articles": spark.createDataFrame([("h1", "a3")], "charge_id string, article_id string"),
        "indictments": spark.createDataFrame([("i1", "k1", "issued"), ("i2", "k1", "issued"), ("i3", "k2", "draft")], "indictment_id string, case_id string, status string"),
        "lawsuits": spark.createDataFrame([("l1", "k2"), ("l2", "k2")], "lawsuit_id string, case_id string"),
        "verdicts": spark.createDataFrame([("v1", "k2", "Phúc thẩm", "acquitted")], "verdict_id string, case_id string, trial_level string, outcome string"),
        "sentences": spark.createDataFrame([("s1", "h1", "v1")], "sentence_id string, charge_id string, verdict_id string").where("sentence_id = 's1'"),
        "defendants": spark.createDataFrame([("d1", "k1", 12, "pre-2026"), ("d2", "k1", 17, "ltpctn-2024")], "defendant_id string, case_id string, age_determined int, juvenile_regime string"),
        "precedents": spark.createDataFrame([("p1", "k2")], "precedent_id string, source_case_id string"),
        "case_events": spark.createDataFrame([], "case_id string, event_kind string"),
        "persons": spark.createDataFrame([("n1", "Nguyễn")], "person_id string, full_name_hash string"),
        "evidence": spark.createDataFrame([("q", "e1"), ("q", "e2")], "prediction_id string, edge_id string"),
        "retrieved": spark.createDataFrame([("q", "e1")], "prediction_id string, edge_id string"),
        "courts": spark.createDataFrame([("1", "X"), ("2", "X")], "court_id string, court_code string"),
    }
    got = {r["rule"] for r in rules.axioms(t).collect()}
    assert got == {f"AX-{i:02d}" for i in range(1, 19)} - {"AX-10"}
    t["sentences"] = t["sentences"].where("false")
    assert "AX-10" in {r["rule"] for r in rules.axioms(t).collect()}


def test_state_machines_and_validation(spark):
    allowed = spark.createDataFrame([(a, c) for a, _, c in rules.MACHINES["verdict"]], "from_state string, to_state string")
    s = spark.createDataFrame([("v", 1, "pronounced"), ("v", 2, "in_force"), ("v", 3, "pronounced")], "k string, at int, state string").withColumn("row", F.col("at"))
    assert rows(rules.illegal_steps(s, "k", "at", "state", allowed, "row")) == [("v", 3, "in_force", "pronounced")]
    kept, out = rules.validate(s, [rules.Action("late", "at < 3", "quarantine"), rules.Action("first", "at > 1", "warn")])
    assert kept.count() == 2 and rows(out.select("at", F.concat_ws(",", "reasons"))) == [(3, "late")]


def test_graphs(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "vertex string")
    assert rows(graph.hops(e, seeds, 2)) == [("a", 0), ("b", 1), ("c", 2)]
    assert graph.shortest(e, "a", "d") == 3 and graph.shortest(e, "a", "y") is None
    assert {r["node"]: r["component"] for r in connected_components(e, "src", "dst").collect()} == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x"}
    assert connected_components(e.where("false"), "src", "dst").count() == 0
    assert len({r["community"] for r in graph.communities(e.where("src = 'x'"), 2).collect()}) <= 2


def test_search(spark):
    v = [(i, [float(np.cos(i)), float(np.sin(i))]) for i in range(20)] + [(20, None), (21, []), (22, [0.0, 0.0])]
    d = spark.createDataFrame(v, "vec_id long, embedding array<double>")
    got = rows(knn.nearest(d, d.where("vec_id = 0"), 2).select("neighbour", "rank"))
    x = np.array([e for _, e in v[:20]]) @ np.array(v[0][1])
    assert [n for n, _ in sorted(got, key=lambda r: r[1])] == [i for i in np.argsort(-x).tolist() if i][:2]
    assert knn.nearest(d.where("false"), d, 2).count() == 0


def test_reduction(spark):
    r = np.random.default_rng(0)
    x = np.concatenate([r.normal(0, 0.1, (30, 5)), r.normal(3, 0.1, (30, 5)), [[9.0] * 5]])
    d = spark.createDataFrame([(str(i), v.tolist()) for i, v in enumerate(x)] + [("e", [])], "doc_name string, embedding array<double>")
    out = reduce.reduce(d, ("pca", "tsne", "umap", "none"))
    got = {q["doc_name"]: q for q in out.collect()}
    c = x - x.mean(0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(np.abs([got[str(i)]["pca_x"] for i in range(61)]), np.abs(u[:, 0] * s[0]), atol=1e-6)
    assert np.isnan(got["e"]["pca_x"]) and got["e"]["cluster_id"] == -1 and np.isnan(got["0"]["umap_x"]) and not np.isnan(got["0"]["tsne_x"])
    a, b = ({got[str(i)]["cluster_id"] for i in k} for k in (range(30), range(30, 60)))
    assert len(a) == len(b) == 1 and a != b and -1 not in a | b and got["60"]["cluster_id"] == -1


def test_embedding_recovers_and_guards(spark):
    def small(texts):
        if any(len(t) > 300 for t in texts):
            raise embed.TooLong
        assert all(t.strip() for t in texts)
        return [[float(len(t)), 1.0] for t in texts]

    s = embed.Settings(batch=2)
    got = embed.guarded(small, ["", "abc", "x" * 900, " "], s)
    assert got[0] == [] == got[3] and got[1] == [3.0, 1.0] and abs(np.linalg.norm(got[2]) - 1) < 1e-9
    with pytest.raises(embed.TooLong):
        embed.guarded(small, ["x" * 900], embed.Settings(max_depth=0))
    d = spark.createDataFrame([("a", "một hai ba"), ("b", " "), ("c", None)], "doc_name string, markdown string")
    out = {r["doc_name"]: r for r in embed.embed(d).collect()}
    assert out["a"]["embedding_dim"] == 64 and out["a"]["embedding_chunking"] == "none"
    assert out["b"]["embedding_chunking"] == "empty" == out["c"]["embedding_chunking"] and out["b"]["embedding_dim"] == 0


def test_parsing(spark, tmp_path):
    p = tmp_path / "a.docx"
    with zipfile.ZipFile(p, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>Xin chào</w:t></w:r></w:p></w:body></w:document>')
    d = readers.binary_files(spark, str(tmp_path))
    out = parse.parse(d, parsed_at="2020-01-01T00:00:00Z").collect()
    assert [(r["doc_name"], r["markdown"], r["num_pages"]) for r in out] == [("a", "## Page 1\n\nXin chào", 1)]
    assert parse.flatten_text('{"a": [{"text": "x"}, {"b": {"text": "y"}}]}') == "x\ny" and parse.flatten_text("{") == ""
    fail = parse.hybrid(lambda b: {"pages": ["short"]}, lambda b: 1 / 0)
    assert fail(b"")["note"].startswith("ZeroDivisionError")
    assert parse.as_bytes("é") == b"\xe9"
    with pytest.raises(TypeError):
        parse.as_bytes(3)
    md = spark.createDataFrame([("# Vật chứng\nmột con dao\n## Khác\nx\n# Vật chứng\nhai",)], "m string")
    assert md.select(parse.sections(F.col("m")).alias("s")).first()["s"] == {"evidence": "một con dao"}
    assert parse.select_text('<div class="a b"><i> x </i></div>', ("h1", "div.b")) == "x"


def test_listing(spark):
    html = """<table class='table table-bordered'><tr><td>1</td><td><a href="/x?dDocName=T1&amp;a=b">Một</a></td><td>.</td><td>.</td></tr>
      <tr><td>2</td><td><a href="/x?dDocName=T2">Hai</a></td></tr><tr><td>3</td><td><a href="/x?dDocName=T1">Lại</a></td><td/><td></td><td></td></tr></table>"""
    d = spark.createDataFrame([(1, html), (2, '<a href="/y?dDocName=T9">Chín</a>')], "page int, html string")
    assert rows(listing.listing_rows(d, "https://h").select("doc_name", "url", "title")) == [("T1", "https://h/x?dDocName=T1&a=b", "Một"), ("T9", "https://h/y?dDocName=T9", "Chín")]
    assert listing.numbered(spark, 3, 5, "u/{}/").count() == 3
    with pytest.raises(ValueError):
        listing.numbered(spark, 5, 3, "{}")
    for last in (0, 1, 2, 7, 8, 100):
        assert listing.last_page(lambda p, last=last: p > last, cap=100) == last


def test_fetching():
    waits, calls = [], []

    def fetch(url):
        calls.append(url)
        return [(429, {"Retry-After": "7"}, b""), (503, {}, b""), (200, {"Content-Type": "text/html; x"}, b"abc")][len(calls) - 1]

    assert listing.with_retries(fetch, "u", sleep=waits.append, kinds=("text/html",)) == b"abc" and waits[0] == 7
    assert listing.with_retries(lambda u: (404, {}, b""), "u", sleep=waits.append) is None


def test_sinks_and_readers(spark, tmp_path):
    d = spark.createDataFrame([("a", "thân", 1, b"x"), ("", "b", 2, b"y"), (None, "c", 3, b"z"), ("d", " ", 4, b"w")], "doc_name string, markdown string, n int, raw binary")
    assert sinks.per_document(d, str(tmp_path / "md"), "md") == 1
    back = readers.markdown(spark, str(tmp_path / "md"), "doc_name string, n int").collect()
    assert [(r["doc_name"], r["markdown"], r["n"]) for r in back] == [("a", "thân", 1)]
    (tmp_path / "md" / "e.md").write_text("x")
    (tmp_path / "md" / "e.meta.json").write_text("{bad")
    assert {r["doc_name"] for r in readers.markdown(spark, str(tmp_path / "md"), "doc_name string, n int").collect()} == {"a", "e"}
    assert sinks.per_document(d, str(tmp_path / "j"), "jsonl") == 2
    assert json.loads((tmp_path / "j" / "a.jsonl").read_text())["n"] == 1
    assert sinks.per_document(d, str(tmp_path / "p"), "parquet") == 2
    assert spark.read.parquet(str(tmp_path / "p" / "a.parquet")).columns == d.columns
    sinks.write_parquet(d, str(tmp_path / "q"), ["n", "none", "doc_name"])
    assert spark.read.parquet(str(tmp_path / "q")).columns == ["n", "doc_name"]
    assert readers.parquet(spark, str(tmp_path / "missing"), schema="a int").count() == 0
    assert sinks.parsed_table(d).columns[5] == "text"


def test_config(tmp_path):
    (tmp_path / "base.yaml").write_text("host: a\nembed: {batch: 4, chunking: off}\nreduce: {methods: [pca, tsne]}\n")
    (tmp_path / "child.yaml").write_text("_base: base.yaml\nembed: {batch: 2}\nreduce: {methods: [pca]}\n")
    c = typed(SiteConfig, load(str(tmp_path / "child.yaml"), ["embed.max_seq=100"]))
    assert (c.host, c.embed.batch, c.embed.max_seq, c.reduce.methods) == ("a", 2, 100, ["pca"])
    with pytest.raises(ValueError):
        typed(SiteConfig, {"nothing": 1})


def test_site_pipeline(spark, tmp_path):
    c = SiteConfig(host="h", output_root=str(tmp_path))
    c.reduce.methods = ("pca",)
    pdf = tmp_path / "h" / "pdf"
    pdf.mkdir(parents=True)
    for i in range(3):
        with zipfile.ZipFile(pdf / f"{i}.docx", "w") as z:
            z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>Điều {i + 1} BLHS 2015 ngày 01/02/2020</w:t></w:p></w:document>')
    out = pipeline.run(spark, "all", c)
    assert set(out) == {"parse", "extract", "embed", "reduce"} and out["reduce"].count() == 3
    assert {r["applied_article_number"] for r in out["extract"].collect()} == {1, 2, 3}
    with pytest.raises(ValueError):
        pipeline.run(spark, "other", c)


def test_streaming_takes_each_file_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()
    for n in range(2):
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps({"doc": str(n)}) + "\n")
        files.run_stage(files.stream(spark, src, "doc string"), lambda d: d, out, cp).awaitTermination()
    assert rows(spark.read.parquet(out).select("doc")) == [("0",), ("1",)]


def test_report(spark, tmp_path):
    from lexmill.plans import report

    a = spark.createDataFrame([("a", "x y", "2020-02-03", "BLHS", 5), ("b", "z", "2020-02-31", None, None)], "doc_name string, markdown string, adopted_date string, applied_article_code string, applied_article_number int")
    b = spark.createDataFrame([("a", 0.5, 1.0, 0), ("c", 0.1, 0.2, -1)], "doc_name string, pca_x double, pca_y double, cluster_id int")
    d = report.dataset(spark, a, b)
    made = report.tables(d, 2026)
    assert set(made) == set(report.RENDERERS)
    assert rows(made["timeline"]) == [(2020, 1)] and rows(made["citations"])[0][:3] == ("BLHS", 5, 1)
    assert rows(made["clusters"].where("cluster is not null")) == [("c0", 1), ("noise", 1)]
    out = str(tmp_path / "r" / "index.html")
    assert report.page(made, out) == len(made) and report.page(made, out) == 0
    assert json.loads(report.snapshot(d))["coverage"]["n_rows"] == 3


def test_components_that_are_not_complete_are_not_returned(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        connected_components(e, max_rounds=1)
    assert {r["component"] for r in connected_components(e).collect()} == {0}


def test_as_of_keeps_repeated_facts(spark):
    d = dt.date
    v = spark.createDataFrame([("A", d(2000, 1, 1), None, 1), ("A", d(2001, 1, 1), None, 2)], "k string, valid_from date, valid_to date, n int")
    f = spark.createDataFrame([("A", d(2002, 1, 1))] * 3 + [("B", None)] * 2, "k string, at date")
    out = temporal.as_of(f, v, ["k"], "at")
    assert out.columns == ["k", "at", "valid_from", "valid_to", "n"]
    assert sorted((r["k"], r["n"]) for r in out.collect() if r["k"] == "A") == [("A", 2)] * 3 and [r["n"] for r in out.collect() if r["k"] == "B"] == [None] * 2


def test_citation_lookups(spark):
    rows = [("case_file:1", "indictment:1", "indicted_by"), ("case_file:2", "verdict:2", "decided_by"), ("case_file:3", "verdict:3", "decided_by"), ("indictment:1", "charge:a", "has_charge"), ("indictment:1", "charge:b", "has_charge"), ("verdict:2", "charge:b", "has_charge"), ("charge:a", "statute_article:7", "cites_article"), ("charge:b", "statute_article:7", "cites_article"), ("charge:b", "statute_article:9", "cites_article"), ("case_file:2", "precedent:5", "grounded_on"), ("case_file:2", "precedent:5", "grounded_on")]
    e = spark.createDataFrame([(*r, float(k), None, None) for k, r in enumerate(rows)], "src string, dst string, type string, weight double, valid_from date, valid_to date")
    assert sorted(r["article"] for r in casegraph.charge_articles(e, "charge:b").collect()) == ["statute_article:7", "statute_article:9"]
    assert sorted(r["case_file"] for r in casegraph.article_cases(e, "statute_article:7").collect()) == ["case_file:1", "case_file:2"]
    assert [r["case_file"] for r in casegraph.article_cases(e, "statute_article:7", 1).collect()] == ["case_file:1"]
    assert [(r["case_file"], r["weight"]) for r in casegraph.precedent_cases(e, "precedent:5").collect()] == [("case_file:2", 10.0)]


def test_case_edges_of_few_tables(spark):
    t = {"situation_cases": spark.createDataFrame([("s", "c"), (None, "c")], "situation_id string, case_id string"), "verdicts": spark.createDataFrame([("c", "v")], "case_id string, verdict_id string")}
    got = {(r["src"], r["type"], r["dst"]) for r in casegraph.case_edges(t).collect()}
    assert got == {("legal_situation:s", "may_spawn", "case_file:c"), ("case_file:c", "decided_by", "verdict:v"), *(("taxonomy_concept:legal_type", "groups", x) for x in ("legal_situation:s", "case_file:c", "verdict:v"))}


def test_jdbc(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string")
    sinks.write_jdbc(df, url, "docs", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    sinks.write_jdbc(df, url, "docs", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    back = spark.read.format("jdbc").options(url=url, dbtable="docs", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").load()
    assert sorted(tuple(r) for r in back.collect()) == [(1, "x"), (1, "x"), (2, None), (2, None)] or back.count() == 4

def test_what_goes_on_beyond_a_bound_raises(spark):
    tree = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c")], "node string, parent string")
    with pytest.raises(ValueError):
        graph.descend(tree, "a")
    with pytest.raises(ValueError):
        listing.last_page(lambda p: False, cap=50)


def test_equal_vectors_at_the_last_place_are_cut_by_id(spark):
    d = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(50)] + [(99, [0.0, 1.0])], "vec_id long, embedding array<double>").coalesce(1)
    got = [r["neighbour"] for r in knn.nearest(d, d.where("vec_id = 30"), 3).orderBy("rank").collect()]
    assert got == [0, 1, 2]


def test_latest_is_one_row_of_a_key(spark):
    d = spark.createDataFrame([(1, None, "x"), (1, 2, "y"), (1, 1, "z"), (2, None, "w")], "k long, version long, v string")
    assert sorted((r["k"], r["v"]) for r in relational.latest(d, ["k"], "version").collect()) == [(1, "y"), (2, "w")]


def test_stored_frees_shuffle_files(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: {f.toString() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles()) if "shuffle_" in f.toString()}
    # what earlier tests have left may go at any time; a collection now leaves none due while this waits
    spark._jvm.System.gc()
    before = shuffles()
    out = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    end = time.time() + 3
    while (left := shuffles() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left
    assert out.count() == 7 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_as_of_sends_no_table_to_the_driver(spark, tmp_path):
    d = dt.date
    spark.createDataFrame([(k, d(2000, 1, 1), None, k) for k in range(50)], "k int, valid_from date, valid_to date, n int").write.parquet(str(tmp_path / "v"))
    spark.createDataFrame([(k, k % 50, d(2001, 1, 1)) for k in range(200)], "row_id int, k int, at date").write.parquet(str(tmp_path / "f"))
    out = temporal.as_of(spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "v")), ["k"], "at")
    assert sorted((r["row_id"], r["n"]) for r in out.collect()) == [(k, k % 50) for k in range(200)]
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
