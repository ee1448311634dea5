"""Text, date and URL functions on columns; all of them built-in expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: ColumnLike) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def squash(x: ColumnLike) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(_c(x), r"(?U)\s+", " "))


def blank(x: ColumnLike) -> Column:
    """Whether a text is null, empty or white space."""
    return F.coalesce(strip(x) == "", F.lit(True))


def none_if_blank(x: ColumnLike) -> Column:
    return F.when(~blank(x), _c(x))


def text_hash(x: ColumnLike) -> Column:
    """First 32 hex digits of the SHA-256 of the text in UTF-8; of nothing for null."""
    return F.substring(F.sha2(F.coalesce(_c(x), F.lit("")), 256), 1, 32)


def spans(x: ColumnLike, pattern: str) -> Column:
    """Every match as a struct (text, start, end), with offsets in code points.

    The gaps between matches are what splitting gives, so the offsets follow from lengths alone.
    """
    t = _c(x)
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<text:string,start:bigint,end:bigint>>").alias("out"))

    def walk(m: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            text = F.get(m["found"], i)
            start = acc["at"] + F.length(F.get(m["gaps"], i))
            end = start + F.length(text)
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(text.alias("text"), start.cast("long").alias("start"), end.cast("long").alias("end")))).alias("out"))

        places = F.when(F.size(m["found"]) > 0, F.sequence(F.lit(0), F.size(m["found"]) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(places, zero, step, lambda a: a["out"])

    matches = F.struct(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("found"), F.split(t, pattern, -1).alias("gaps"))
    return F.when(t.isNotNull(), once(matches, walk))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once; inside a lambda, an expression is computed anew for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def groups(x: ColumnLike, pattern: str, group: int) -> Column:
    """A group of every match; null where the group took no part."""
    return F.transform(F.regexp_extract_all(_c(x), F.lit(pattern), F.lit(group)), lambda g: F.nullif(g, F.lit("")))


def date_iso(x: ColumnLike) -> Column:
    """The first d/m/yyyy or d.m.yyyy of a text as yyyy-mm-dd; the calendar isn't checked."""
    p = r"(?U)\b(\d{1,2})[/.](\d{1,2})[/.](19\d{2}|20\d{2})\b"
    y, m, d = (F.regexp_extract(_c(x), p, k) for k in (3, 2, 1))
    return F.when(y != "", F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))


def year_of(x: ColumnLike) -> Column:
    """The year of an ISO date; null where there is no such day."""
    return F.year(F.try_to_date(_c(x), "yyyy-MM-dd"))


# Named character references that are read without a Python function.
_ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def strip_tags(html: ColumnLike) -> Column:
    """Tags as spaces, common character references decoded, white space squashed."""
    bare = F.regexp_replace(_c(html), "<[^>]*>", " ")
    return squash(reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), _ENTITIES.items(), bare))


def digits_int(x: ColumnLike) -> Column:
    """The digits of a text as an int; 0 where there are none or too many."""
    return F.coalesce(F.nullif(F.regexp_replace(_c(x), r"\D", ""), F.lit("")).try_cast("int"), F.lit(0))


def page_count(markdown: ColumnLike) -> Column:
    """Form feeds and one; 0 for an empty text."""
    m = F.coalesce(_c(markdown), F.lit(""))
    return F.when(m == "", 0).otherwise(F.length(m) - F.length(F.replace(m, F.lit("\f"), F.lit(""))) + 1).cast("int")


def url_document(url: ColumnLike) -> Column:
    """The document a URL names: its dDocName, or the last segment of its path."""
    u = _c(url)
    named = F.regexp_extract(u, r"[?&]dDocName=([^&#]+)", 1)
    path = F.regexp_replace(u, r"[?#].*$", "")
    return F.when(named != "", named).otherwise(F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1))


def url_case(url: ColumnLike) -> Column:
    """The number of a case page such as /2ta123t1cvn."""
    return F.nullif(F.regexp_extract(_c(url), r"/[235]ta(\d+)t1cvn", 1), F.lit(""))


def absolute(base: str, href: ColumnLike) -> Column:
    h = _c(href)
    return F.when(h.rlike("^https?://"), h).when(h.startswith("/"), F.concat(F.lit(base.rstrip("/")), h)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), h))


def slug(model: ColumnLike) -> Column:
    return F.translate(_c(model), "/:", "__")


def duration(x: ColumnLike) -> Column:
    """An ISO 8601 duration such as P1Y6M10D as a struct (total_months, days); null where it is none."""
    p = r"^P(?=\d)(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?$"
    y, m, w, d = (F.coalesce(F.nullif(F.regexp_extract(_c(x), p, k), F.lit("")).try_cast("int"), F.lit(0)) for k in (1, 2, 3, 4))
    return F.when(_c(x).rlike(p), F.struct((y * 12 + m).alias("total_months"), (w * 7 + d).alias("days")))


def label(code: ColumnLike, number: ColumnLike) -> Column:
    """A citation key; a missing part is a question mark."""
    return F.concat(F.coalesce(_c(code), F.lit("?")), F.lit(" / Điều "), F.coalesce(_c(number).cast("string"), F.lit("?")))


def sentence_features(x: ColumnLike) -> Column:
    """char_len, token_len, digit_ratio, uppercase_ratio and what a sentence contains."""
    t = _c(x)
    n = F.greatest(F.length(t), F.lit(1))
    return F.struct(
        F.length(t).alias("char_len"),
        F.when(blank(t), 0).otherwise(F.size(F.split(squash(t), " "))).alias("token_len"),
        (F.regexp_count(t, F.lit(r"\d")) / n).alias("digit_ratio"),
        (F.regexp_count(t, F.lit("[A-ZĐẪÁÀẢ]")) / n).alias("uppercase_ratio"),
        t.rlike(r"(?U)Điều\s+\d+").alias("contains_statute_ref"),
        t.rlike(r"(?U)\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b").alias("contains_date"),
        t.rlike(r"(?iU)\b\d[\d.,]*\s*(đồng|VND|vnđ)\b").alias("contains_money"),
    )


def redact(x: ColumnLike, names: list[str], mark: str = "[…]") -> Column:
    """A text with each of a few names replaced."""
    return F.regexp_replace(_c(x), "(?iU)" + "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True)), mark) if names else _c(x)


# Vietnamese and Latin letters with marks, by their plain letter.
_MARKED = {"a": "àáảãạăằắẳẵặâầấẩẫậäå", "e": "èéẻẽẹêềếểễệë", "i": "ìíỉĩịïî", "o": "òóỏõọôồốổỗộơờớởỡợö", "u": "ùúủũụưừứửữựüû", "y": "ỳýỷỹỵÿ", "d": "đ", "c": "ç", "n": "ñ"}


def plain(x: ColumnLike) -> Column:
    """Lower case without marks on letters, whether they are composed or combining."""
    low = F.regexp_replace(F.lower(_c(x)), r"[̀-ͯ]", "")
    return F.translate(low, "".join(_MARKED.values()), "".join(k * len(v) for k, v in _MARKED.items()))


def person_hash(salt: str, name: ColumnLike, birth_year: ColumnLike) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(salt), plain(squash(name)), F.coalesce(_c(birth_year).cast("string"), F.lit(""))), 256)


# Court buckets, in order, by what the lower-case text holds.
COURTS = (
    (("tối cao",), "Tòa án nhân dân tối cao"),
    (("cấp cao",), "Tòa án nhân dân cấp cao"),
    (("quân sự",), "Tòa án quân sự"),
    (("thành phố", "tỉnh ", "tỉnh.", "tp.", "tp "), "TAND tỉnh / thành phố"),
    (("quận", "huyện", "thị xã"), "TAND quận / huyện / thị xã"),
    (("tòa án",), "Tòa án (khác)"),
)


def bucket(x: ColumnLike, rules=COURTS, other: str = "non-court / other") -> Column:
    """The first rule one of whose keywords a text holds."""
    t = F.lower(F.coalesce(_c(x), F.lit("")))
    out = None
    for words, name in rules:
        hit = reduce(lambda a, b: a | b, (t.contains(w) for w in words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(other)


# Case-number codes.
PROCEDURES = ("TLPT", "TLST", "TLGĐT", "TLGDT", "TLTT")
SECTORS = {"DS": "Dân sự (civil)", "HS": "Hình sự (criminal)", "HNGĐ": "Hôn nhân & gia đình (family)", "HNGD": "Hôn nhân & gia đình (family)", "KDTM": "Kinh doanh thương mại (commercial)", "KT": "Kinh tế (economic)", "LĐ": "Lao động (labor)", "LD": "Lao động (labor)", "HC": "Hành chính (administrative)", "QĐ": "Quyết định khác (other)"}
LEVELS = {"PT": "Phúc thẩm (appellate)", "ST": "Sơ thẩm (first instance)", "GĐT": "Giám đốc thẩm (cassation)", "GDT": "Giám đốc thẩm (cassation)", "TT": "Tái thẩm (re-trial)"}


def case_labels(x: ColumnLike) -> Column:
    """(sector, level) of the first case number in a text's first 4000 characters."""
    head = F.substring(_c(x), 1, 4000)
    p = r"(?U)(\d+)/(\d{4})/([A-ZĐa-zđ]+)[-/]([A-ZĐa-zđ]+)"
    a, b = F.upper(F.regexp_extract(head, p, 3)), F.upper(F.regexp_extract(head, p, 4))
    swap = a.isin(*PROCEDURES)

    def named(code: Column, names: dict[str, str]) -> Column:
        return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), code), F.lit("Unknown / unparsed"))

    return F.struct(named(F.when(swap, b).otherwise(a), SECTORS).alias("sector"), named(F.when(swap, F.substring(a, 3, 10)).otherwise(b), LEVELS).alias("level"))
