"""Which documents there are: ranges of numbers, listing pages, and what is fetched from them."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import absolute, strip_tags, url_document
from lexmill.operators.relational import first_of, not_done


def numbered(spark: SparkSession, start: int, end: int, template: str) -> DataFrame:
    """(case_id, url) of every number of a closed range; ``{}`` is the number."""
    if end < start:
        raise ValueError(f"the range ends at {end}, before it starts at {start}")
    before, _, after = template.partition("{}")
    return spark.range(start, end + 1).select(F.col("id").cast("string").alias("case_id"), F.concat(F.lit(before), F.col("id").cast("string"), F.lit(after)).alias("url"))


def last_page(is_past: Callable[[int], bool], start: int = 1, cap: int = 10_000) -> int:
    """The last page that isn't past the end: probes at doubling distances, then halves. ``start - 1`` if there is none; raises where the pages go on beyond ``cap``."""
    if is_past(start):
        return start - 1
    low, step = start, 1
    while low + step <= cap and not is_past(low + step):
        low += step
        step *= 2
    high = min(low + step, cap + 1)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if is_past(mid) else (mid, high)
    if low == cap and not is_past(cap + 1):
        raise ValueError(f"the listing goes on beyond page {cap}")
    return low


def listing_rows(pages: DataFrame, base: str, html: str = "html", page: str = "page") -> DataFrame:
    """(doc_name, url, title, page, pos) of listing pages, each document once, where it comes first.

    Rows are those of the listing's table with four cells or more and a link that names a document in the second one; of pages without such a
    table, all links that name one.
    """
    table = F.regexp_extract(html, r"(?is)<table[^>]*class=['\"][^'\"]*table-bordered[^>]*>(.*?)</table>", 1)
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1)))
    second = F.transform(F.filter(cells, lambda c: F.size(c) >= 4), lambda c: F.get(c, F.lit(1)))
    links = F.filter(second, lambda c: c.contains("dDocName="))
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)(<a\s[^>]*href=[\"'][^\"']*dDocName=[^\"']*[\"'][^>]*>.*?</a>)"), F.lit(1))
    found = pages.select(page, F.posexplode(F.when(F.size(links) > 0, links).otherwise(anchors)).alias("pos", "a"))
    href = F.replace(F.regexp_extract("a", r"(?i)href=[\"']([^\"']+)[\"']", 1), F.lit("&amp;"), F.lit("&"))
    out = found.select(url_document(href).alias("doc_name"), absolute(base, href).alias("url"), strip_tags("a").alias("title"), page, "pos")
    return first_of(out.where("doc_name <> ''"), "doc_name", page, "pos")


@dataclass
class Pace:
    """A bucket of tokens: ``rate`` a second, ``burst`` at once."""

    rate: float
    burst: float = 1.0
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    level: float = field(init=False)
    at: float = field(init=False)

    def __post_init__(self):
        self.level, self.at = self.burst, self.clock()

    def take(self) -> None:
        now = self.clock()
        self.level = min(self.burst, self.level + (now - self.at) * self.rate)
        self.at = now
        if self.level < 1:
            self.sleep((1 - self.level) / self.rate)
            self.level, self.at = 1.0, self.clock()
        self.level -= 1


#: (status, headers, body) of a request; the one that is used comes from the caller.
Fetch = Callable[[str], tuple[int, dict, bytes]]


def with_retries(fetch: Fetch, url: str, tries: int = 5, base: float = 1.5, sleep: Callable[[float], None] = time.sleep, least: int = 0, kinds: tuple[str, ...] = ()) -> bytes | None:
    """A body, or None: other 4xx than 429 end it; 429 waits as long as it is told to; all else waits base**n seconds and some chance."""
    for n in range(tries):
        try:
            status, headers, body = fetch(url)
        except OSError:
            status, headers, body = 0, {}, b""
        kind = headers.get("Content-Type", "").partition(";")[0].strip()
        if status == 200 and len(body) >= least and (not kinds or kind in kinds):
            return body
        if 400 <= status < 500 and status != 429:
            return None
        wait = headers.get("Retry-After", "") if status == 429 else ""
        if n + 1 < tries:
            sleep(float(wait) if wait.isdigit() else base**n + random.random() * 0.1)
    return None


def fetched(urls: DataFrame, make_fetch: Callable[[], Fetch], done: DataFrame | None = None, qps: float = 1.0, key: str = "doc_name", least: int = 100) -> DataFrame:
    """(key, url, content) of what could be fetched, without what ``done`` has; a session and a pace for each partition.

    ``qps`` is for the whole job: each of n partitions gets its nth part.
    """
    todo = not_done(urls, done, key) if done is not None else urls
    parts = max(1, todo.rdd.getNumPartitions())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch, pace = make_fetch(), Pace(qps / parts)
        for b in batches:
            for k, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                pace.take()
                body = with_retries(fetch, u, least=least)
                if body is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([k], b.schema.field(0).type), pa.array([u]), pa.array([body], pa.binary())], [key, "url", "content"])

    return todo.select(key, "url").mapInArrow(run, f"{key} {todo.schema[key].dataType.simpleString()}, url string, content binary")
