"""Documents to Markdown: backends, routing, HTML fields."""

from __future__ import annotations

import io
import json
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import absolute, blank, date_iso, digits_int, none_if_blank, page_count, squash, strip, strip_tags

#: bytes -> {"pages": [texts], "confidence": float or None}
Parser = Callable[[bytes], dict]
HYBRID_LEAST = 50


def as_bytes(value) -> bytes:
    """Binary content in whatever form it came; text is Latin-1."""
    if isinstance(value, (bytes, bytearray, memoryview)):
        return bytes(value)
    if isinstance(value, str):
        return value.encode("latin-1")
    if hasattr(value, "tobytes"):
        return value.tobytes()
    raise TypeError(f"no bytes: {type(value).__name__}")


def docx_pages(data: bytes) -> list[str]:
    """A DOCX file's paragraphs, as one page."""
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ET.fromstring(z.read("word/document.xml"))
    return ["\n\n".join(t for p in root.iter(f"{ns}p") if (t := "".join(x.text or "" for x in p.iter(f"{ns}t"))).strip())]


def pdf_pages(data: bytes) -> list[str]:
    """A PDF's text by page where the library for it is installed; a page that fails is empty."""
    import pypdf

    out = []
    for page in pypdf.PdfReader(io.BytesIO(data)).pages:
        try:
            out.append(page.extract_text() or "")
        except Exception:  # noqa: BLE001  whatever one page does, the others count
            out.append("")
    return out


def local(data: bytes) -> dict:
    """By the first bytes: PDF, a zip that holds DOCX, else nothing."""
    try:
        pages = pdf_pages(data) if data[:4] == b"%PDF" else docx_pages(data) if data[:4] == b"PK\x03\x04" else []
    except (ImportError, KeyError, zipfile.BadZipFile, ET.ParseError):
        pages = []
    return {"pages": pages, "confidence": None}


def flatten_text(value) -> str:
    """All "text" values of a JSON document of any nesting, in order; nothing for what is no JSON."""
    if isinstance(value, (str, bytes)):
        try:
            value = json.loads(value)
        except ValueError:
            return ""
    out: list[str] = []
    todo = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, list):
            todo.extend(reversed(v))
        elif isinstance(v, dict):
            if isinstance(v.get("text"), str):
                out.append(v["text"])
            todo.extend(x for k, x in reversed(v.items()) if k != "text" or not isinstance(x, str))
    return "\n".join(t for t in out if t)


def hybrid(first: Parser, second: Parser, least: int = HYBRID_LEAST) -> Parser:
    """The first parser's result if it has enough text, else the second's; where that fails, the first's with a note."""

    def parse(data: bytes) -> dict:
        a = first(data)
        if len("".join(a["pages"]).strip()) >= least:
            return a
        try:
            return second(data)
        except Exception as e:  # noqa: BLE001  a remote backend may fail in any way
            return a | {"note": f"{type(e).__name__}: {e}"}

    return parse


BACKENDS: dict[str, Parser] = {"local": local}


def parse(df: DataFrame, backend: Parser = local, model: str = "local", parsed_at: str | None = None, content: str = "pdf_bytes") -> DataFrame:
    """Adds markdown, pages, confidence, num_pages, parser_model and parsed_at, and drops the bytes; rows without any text are left out.

    Only the backend is Python; pages are stitched by expressions: a heading for each page that has text.
    """
    cols = [c for c in df.columns if c != content]
    packed = df.select(F.struct(*cols).alias("row"), F.col(content))
    row = packed.schema["row"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            got = [backend(as_bytes(v)) if v is not None else {"pages": [], "confidence": None} for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g["pages"] for g in got], pa.list_(pa.string())), pa.array([g.get("confidence") for g in got], pa.float64())], ["row", "texts", "confidence"])

    out = packed.mapInArrow(run, f"row {row}, texts array<string>, confidence double")
    pages = F.transform("texts", lambda t, i: F.struct((i + 1).alias("page_number"), t.alias("markdown"), F.array().cast("array<string>").alias("blocks")))
    shown = F.transform(F.filter("pages", lambda p: ~blank(p["markdown"])), lambda p: F.concat(F.lit("## Page "), p["page_number"].cast("string"), F.lit("\n\n"), p["markdown"]))
    out = out.withColumn("pages", pages).withColumn("markdown", F.array_join(shown, "\n\n"))
    n = F.when(F.size("pages") > 0, F.size("pages")).otherwise(page_count("markdown")).cast("int")
    at = F.lit(parsed_at) if parsed_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return out.where(~blank("markdown")).select(*(F.col(f"row.{c}").alias(c) for c in cols), "markdown", "pages", "confidence", n.alias("num_pages"), F.lit(model).alias("parser_model"), at.alias("parsed_at"))


def route(df: DataFrame, local_text: str, least: int = HYBRID_LEAST) -> tuple[DataFrame, DataFrame]:
    """(rows whose local text suffices, rows that the remote parser has to read)."""
    enough = F.length(strip(F.coalesce(local_text, F.lit("")))) >= least
    return df.where(enough), df.where(~enough)


def scanned(pages: Column, least: int = 200, first: int = 3) -> Column:
    """Whether the first pages hold so little text that they must be images."""
    p = F.slice(pages, 1, first)
    total = F.aggregate(p, F.lit(0), lambda s, x: s + F.length(x["markdown"]))
    return total / F.greatest(F.size(p), F.lit(1)) < least


# Headings of sections.
SECTIONS = {
    "general_info": ("Thông tin chung", "Thông tin về vụ án"),
    "defendants": ("Danh sách bị can", "Các bị can"),
    "facts": ("Tóm tắt vụ việc", "Nội dung vụ án"),
    "evolution": ("Diễn biến vụ việc",),
    "evidence": ("Vật chứng",),
    "legal_basis": ("Căn cứ pháp luật", "Các điều luật áp dụng"),
    "determination": ("Đoán định vụ việc",),
    "sentencing": ("Mức hình phạt", "Đề nghị mức hình phạt"),
}


def sections(markdown: Column, rules: dict[str, tuple[str, ...]] | None = None) -> Column:
    """A map from section to the Markdown below its heading, up to the next heading; the first of a kind counts."""
    parts = F.transform(F.split(markdown, r"(?m)^#+[ \t]+"), lambda p: F.struct(strip(F.substring_index(p, "\n", 1)).alias("head"), F.when(F.locate("\n", p) > 0, strip(p.substr(F.locate("\n", p) + 1, F.length(p)))).otherwise("").alias("body")))
    kind = lambda head: F.coalesce(*(F.when(F.lower(head).isin(*(h.lower() for h in heads)), k) for k, heads in (rules or SECTIONS).items()))
    tagged = F.filter(F.transform(parts, lambda p: F.struct(kind(p["head"]).alias("key"), p["body"].alias("value"))), lambda p: p["key"].isNotNull())
    once = F.filter(tagged, lambda p, i: ~F.exists(F.slice(tagged, F.lit(1), i), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(once)


# ---- fields of site pages, by expressions

# Labels of a case page's panel and the fields they fill.
LABELS = {"Loại vụ/việc": "loai_vu_viec", "Tên vụ/việc": "ten_vu_viec", "Tòa án": "toa_an", "Cấp xét xử": "cap_xet_xu", "Áp dụng án lệ": "ap_dung_an_le", "Đính chính": "dinh_chinh", "Thông tin về vụ/việc": "thong_tin"}


def labelled(panel: Column, label: str) -> Column:
    """The text of the span after a label."""
    return none_if_blank(strip_tags(F.regexp_extract(panel, rf"(?isU)<label[^>]*>\s*{re.escape(label)}\s*:?\s*</label>\s*<span[^>]*>(.*?)</span>", 1)))


def panel_fields(html: Column, begin: str, end: str, labels: dict[str, str] | None = None) -> dict[str, Column]:
    """Fields of the panel between two markers; of the whole page where a marker is missing."""
    a = F.locate(begin, html)
    b = F.when(a > 0, F.locate(end, html, 1))
    panel = F.when((a > 0) & (b > a), html.substr(a, b - a)).otherwise(html)
    head = strip_tags(F.regexp_extract(panel, r"(?is)<h[1-4][^>]*>(.*?)</h[1-4]>", 1))
    parts = F.split(head, "ngày", 2)
    number = F.nullif(F.regexp_extract(F.get(parts, F.lit(0)), r"(?U)số\s*:?\s*(\S+)", 1), F.lit(""))
    out = {"doc_type": none_if_blank(strip(F.regexp_replace(F.get(parts, F.lit(0)), r"(?U)\s*số\s*:?.*$", ""))), "doc_number": number, "doc_date": date_iso(F.get(parts, F.lit(1)))}
    out |= {c: labelled(panel, k) for k, c in (labels or LABELS).items()}
    counter = lambda k: digits_int(F.regexp_extract(panel, rf"(?isU){k}\s*:?\s*(?:<[^>]*>\s*)*([\d.,]+)", 1))
    return out | {"luot_xem": counter("Lượt xem"), "luot_tai": counter("Lượt tải")}


def page_fields(html: Column, base: str) -> dict[str, Column]:
    """title, heading, first PDF link and link counts of any page."""
    pdf = F.nullif(F.regexp_extract(html, r"(?is)<a[^>]+href=[\"']([^\"']+\.pdf(?:\?[^\"']*)?)[\"']", 1), F.lit(""))
    return {
        "title": none_if_blank(squash(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))),
        "heading": none_if_blank(strip_tags(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1))),
        "pdf_url": absolute(base, pdf),
        "n_links": F.regexp_count(html, F.lit(r"(?i)<a\s[^>]*href=")),
    }


def ghost(html: Column, a: str, b: str, c: str) -> Column:
    """Whether a page is the site's stand-in for a missing document."""
    return (html.contains(a) | html.contains(b)) & html.contains(c)


class Selector(HTMLParser):
    """The first non-empty text, or attribute, of the first of some simple selectors (tag, .class, #id, tag.class, tag[attr$=x])."""

    def __init__(self, selector: str):
        super().__init__()
        m = re.fullmatch(r"([a-z0-9]*)(?:\.([\w-]+))?(?:#([\w-]+))?(?:\[(\w+)(?:([$^*]?)=['\"]?([^'\"\]]*)['\"]?)?\])?", selector.strip())
        if not m:
            raise ValueError(f"unknown selector: {selector}")
        self.want, self.depth, self.found, self.attr, self.done = m.groups(), 0, [], None, False

    def handle_starttag(self, tag, attrs):
        if self.depth:
            self.depth += tag not in ("br", "img", "input", "hr", "meta", "link")
            return
        name, cls, ident, key, op, value = self.want
        a = {k: v or "" for k, v in attrs}
        ok = (not name or name == tag) and (not cls or cls in a.get("class", "").split()) and (not ident or a.get("id") == ident)
        if ok and key:
            v = a.get(key)
            ok = v is not None and {"$": v.endswith(value or ""), "^": v.startswith(value or ""), "*": (value or "") in v}.get(op, value is None or v == value)
        if ok and not self.done:
            self.depth, self.attr = 1, a

    def handle_endtag(self, tag):
        if self.depth:
            self.depth -= 1
            if not self.depth and "".join(self.found).strip():
                self.done = True

    def handle_data(self, data):
        if self.depth and not self.done:
            self.found.append(data)


def select_text(html: str, selectors: tuple[str, ...]) -> str | None:
    for s in selectors:
        p = Selector(s)
        p.feed(html or "")
        text = " ".join("".join(p.found).split())
        if text:
            return text
    return None
