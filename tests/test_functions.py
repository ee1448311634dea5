import re

import pytest
from pyspark.sql import functions as F

from lexmill.functions import chunks, extract, ontology, text, vectors


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()["y"]


TEXTS = ["ĐIỀU 173 BLHS 2015", "theo khoản 1, điểm b, điều 5", "😀 khoản 2 Điều 20 BLDS 2015 và điều 7.", "điểm b khoản 2 điều 52", "không có gì", "", None, "Điều １２ BLHS"]


def python_statutes(t):
    p = re.compile(r"(?:khoản\s+(\d+)[,\s]+)?(?:điểm\s+([a-z])[,\s]+)?điều\s+(\d+)(?:\s*(" + extract.CODES + r")(?:\s*(19\d{2}|20\d{2}))?)?", re.IGNORECASE)
    return [(m.start(), m.end(), m[4], m[2]) for m in p.finditer(t or "")]


@pytest.mark.parametrize("t", TEXTS)
def test_statutes_agree_with_python(spark, t):
    got = [(r["span"][0], r["span"][1], r["code"], r["point"]) for r in one(spark, t, extract.statutes(F.col("x")))]
    assert got == python_statutes(t)


def test_entities_keep_group_order_and_raw_spans(spark):
    t = "Tòa án nhân dân tỉnh Y , ngày 15/06/2021 áp dụng khoản 1 Điều 173 BLHS 2015. Án lệ số 47/2021/AL"
    got = one(spark, t, extract.entities(F.col("x")))
    assert [e["tag"] for e in got] == ["DATE", "ORG-COURT", "ARTICLE", "PRECEDENT"]
    assert all(e["text"] == t[e["start"] : e["end"]].strip(",. ") for e in got)
    assert one(spark, None, extract.entities(F.col("x"))) == []


@pytest.mark.parametrize(("gap", "hit"), [(0, False), (1, True), (199, True), (200, False)])
def test_relation_window(spark, gap, hit):
    e = [("CHARGE", "trộm", 0, 4), ("ARTICLE", "Điều 1", 4 + gap, 10 + gap), ("ARTICLE", "Điều 2", 300, 306)]
    got = one(spark, [dict(zip(("tag", "text", "start", "end"), x, strict=True)) for x in e], extract.relations(F.col("x")), extract.ENTITY)
    assert [(r["src"], r["dst"], r["evidence_span"]) for r in got] == ([("trộm", "Điều 1", [0, 10 + gap])] if hit else [])


def test_precedent_fields(spark):
    d = spark.createDataFrame([("a", "Nội dung án lệ: Bên mua. Điều 5 BLDS và Điều 7 và Điều 7. 31/02/2020", None), ("b", "điều 9", "khoản 3 Điều 12 BLHS 2015"), ("c", None, None)], "doc_name string, markdown string, applied_article string")
    rows = {r["doc_name"]: r for r in extract.extract(d).collect()}
    assert rows["a"]["principle_text"].startswith("Bên mua")
    assert rows["a"]["adopted_date"] == "2020-02-31"
    assert (rows["a"]["applied_article_number"], rows["a"]["applied_article_code"]) == (7, None)
    assert (rows["b"]["applied_article_number"], rows["b"]["applied_article_code"], rows["b"]["applied_article_clause"]) == (12, "BLHS", 3)
    assert rows["c"]["char_len"] == 0 and rows["c"]["extracted"]["entities"] == []
    off = extract.extract(d, generic=False, site=False).first()
    assert off["extracted"]["statute_refs"] == [] and off["precedent_number"] is None


def test_year_of_no_such_day(spark):
    assert one(spark, "2020-02-31", text.year_of("x")) is None
    assert one(spark, "2020-02-29", text.year_of("x")) == 2020


@pytest.mark.parametrize(("w", "o", "n"), [(30, 10, 0), (30, 10, 29), (30, 10, 30), (30, 10, 31), (30, 10, 104), (10, 10, 25), (10, 20, 12)])
def test_sliding(spark, w, o, n):
    t = ("abcdefghijklmnopqrstuvwxyz" * 5)[:n]
    step = max(1, w - o)
    want = [t] if n <= w else [t[i : i + w] for i in range(0, n, step)]
    assert one(spark, t, chunks.sliding("x", w, o)) == want


def test_sentence_chunks_keep_everything(spark):
    t = " ".join(f"Câu số {i} kết thúc ở đây." for i in range(10))
    got = one(spark, t, chunks.sentence("x", 80, 0))
    assert " ".join(got) == t and all(len(c) <= 80 for c in got)


def test_mean_pool(spark):
    d = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [3.0, 0.0]), ("b", [0.6, 0.8]), ("c", [])], "k string, embedding array<double>")
    got = {r["k"]: r["embedding"] for r in vectors.mean_pool(d, "k").collect()}
    assert got == {"a": [1.0, 0.0], "b": [0.6, 0.8], "c": []}
    assert one(spark, [[1.0, 0.0], [3.0, 0.0]], vectors.mean_pool_rows("x"), "array<array<double>>") == [1.0, 0.0]
    assert one(spark, [], vectors.mean_pool_rows("x"), "array<array<double>>") == []


@pytest.mark.parametrize(("v", "want"), [("Hình sự", "Hình sự"), ("HÌNH SỰ", "Hình sự"), (None, "(unknown)"), ("khác", "(off-ontology: khác)")])
def test_normalise(spark, v, want):
    assert one(spark, v, ontology.normalise("x", ontology.ENUMS["LegalRelation"])) == want


@pytest.mark.parametrize(("y", "arc"), [(1482, None), (1483, "A1"), (1857, "A1"), (1858, "A2"), (1945, "A3"), (1985, "A5"), (2014, "A6"), (2023, "A7"), (2024, "A8"), (3000, "A8")])
def test_arcs(spark, y, arc):
    assert one(spark, y, ontology.arc_for_year("x"), "int") == arc
    assert one(spark, f"BLHS-{y}", ontology.arc_for_code("x")) == arc


def test_vocabulary_files(tmp_path):
    (tmp_path / "OutcomeCode.yaml").write_text("values: [A, B, C]")
    (tmp_path / "Bad.yaml").write_text("values: [1, 2")
    v = ontology.vocabularies(str(tmp_path))
    assert v["OutcomeCode"] == ("A", "B", "C") and "Bad" not in v


@pytest.mark.parametrize(("x", "want"), [("P1Y6M", (18, 0)), ("P2W3D", (0, 17)), ("P", None), ("1Y", None)])
def test_durations(spark, x, want):
    got = one(spark, x, text.duration("x"))
    assert (tuple(got) if got else None) == want


def test_urls_and_names(spark):
    assert one(spark, "https://a.b/c/d.html?x=1#y", text.url_document("x")) == "d.html"
    assert one(spark, "https://a.b/c?dDocName=TAND01&z=1", text.url_document("x")) == "TAND01"
    assert one(spark, "/2ta1234t1cvn/chi-tiet", text.url_case("x")) == "1234"
    assert one(spark, "Nguyễn Văn Đức", text.plain("x")) == "nguyen van duc"
    assert one(spark, "1,234 lượt", text.digits_int("x")) == 1234
    assert one(spark, "a\fb\fc", text.page_count("x")) == 3
