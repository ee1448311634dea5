"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Texts are folded to lower-case words of ASCII letters, digits and what lies beyond ASCII. Each word n-gram of a test item is a seed; those
that the words' own rates make common are looked at as the rare ones are. Passages around seed hits that have enough words of the item
to reach the threshold are aligned with it; the score is a local alignment's as a share of
the item's own. Texts with a passage of at least ``threshold`` hold the item.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexmill.llm.base import ALNUM, carried, hash_words, ngrams, slices, text_or_empty, texts_of

_U = np.uint64
# Alignment: what equal words, other words and gaps add.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Items of so many words or fewer count only if they are there whole.
WHOLE = 8
#: Words of test items in one pass over the corpus; an index of this size is a few tens of MB and goes to every worker.
ITEM_WORDS = 400_000


def words_of(text: str) -> np.ndarray:
    """Hashes of a text's folded words."""
    return hash_words(text.lower().encode("utf-8", "surrogatepass"), ALNUM)


class Seeds:
    """Items as word hashes, and their n-grams in order of hash, each with its places (item, offset)."""

    def __init__(self, items: list[tuple[int, np.ndarray]], n: int):
        self.n = n
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        self.bags = [np.unique(w, return_counts=True) for w in self.words]
        hashes, item, offset = [], [], []
        for k, w in enumerate(self.words):
            size = min(n, len(w))
            if not size:
                continue
            hashes.append(ngrams(w, size))
            item.append(np.full(len(w) - size + 1, k))
            offset.append(np.arange(len(w) - size + 1))
        self.sizes = sorted({min(n, len(w)) for w in self.words if len(w)})
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        by = np.argsort(h, kind="stable")
        self.hash = h[by]
        self.item = np.concatenate(item)[by] if hashes else np.zeros(0, np.int64)
        self.offset = np.concatenate(offset)[by] if hashes else np.zeros(0, np.int64)
        self.some = np.zeros(1 << 20, bool)
        self.some[self.hash >> _U(44)] = True

    def common(self, k: int, passage: np.ndarray) -> int:
        """Words that item k and a passage have in common, repeated ones as often as in both; no alignment matches more."""
        words, times = self.bags[k]
        at = np.minimum(np.searchsorted(words, passage), len(words) - 1)
        return int(np.minimum(np.bincount(at[words[at] == passage], minlength=len(words)), times).sum())

    def passages(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, stop) of the passages of a text that may hold the item: hits of one item near each other, with as much room on either side as the item is long."""
        at, low, high = [], [], []
        for size in self.sizes:
            if len(words) >= size:
                g = ngrams(words, size)
                hit = np.flatnonzero(self.some[g >> _U(44)])
                lo = np.searchsorted(self.hash, g[hit])
                hi = np.searchsorted(self.hash, g[hit], side="right")
                at.append(hit[lo < hi])
                low.append(lo[lo < hi])
                high.append(hi[lo < hi])
        if not at:
            return []
        at, low, high = (np.concatenate(x) for x in (at, low, high))
        times = high - low
        row = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item, begin = self.item[row], np.repeat(at, times) - self.offset[row]
        out: list[tuple[int, int, int]] = []
        by = np.lexsort((begin, item))
        for k, b in zip(item[by].tolist(), begin[by].tolist(), strict=True):
            size = len(self.words[k])
            start, stop = max(0, b - size // 2 - 4), min(len(words), b + size + size // 2 + 4)
            if out and out[-1][0] == k and start <= out[-1][1] + size:
                out[-1] = k, out[-1][1], max(stop, out[-1][2])
            else:
                out.append((k, start, stop))
        return out


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """(score, start, stop) of the best local alignment of an item in a passage."""
    m = len(passage)
    index = np.arange(m + 1)
    h, since = np.zeros(m + 1, np.int64), index.copy()
    best = (0, 0, 0)
    for w in item:
        up = h + GAP
        diag = h[:-1] + np.where(passage == w, MATCH, MISMATCH)
        new, start = np.maximum(up, 0), np.where(up > 0, since, index)
        better = diag > new[1:]
        new[1:][better] = diag[better]
        start[1:][better] = since[:-1][better]
        # gaps in the passage: a running maximum of score less what the gaps on the way cost
        lifted = new - GAP * index
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, index, 0))
        h = top + GAP * index
        since = np.where(h == new, start, start[source])
        k = int(h.argmax())
        if h[k] > best[0]:
            best = int(h[k]), int(since[k]), k
    return best


def matches(seeds: Seeds, words: np.ndarray, threshold: float) -> list[tuple[int, float, int, int]]:
    """(item id, score, first word, end) of the best passage for each item that a text holds."""
    found: dict[int, tuple[float, int, int]] = {}
    for k, start, stop in seeds.passages(words):
        item = seeds.words[k]
        # what cannot reach the threshold even if all common words align
        most = seeds.common(k, words[start:stop])
        if most / len(item) < threshold or most < min(len(item), WHOLE):
            continue
        # in parts of bounded size, each as much over the next as a passage can be long
        step, reach = 4096, 2 * len(item) + 8
        for a in range(start, stop, step):
            value, s, e = align(item, words[a : min(stop, a + step + reach)])
            share = value / (MATCH * len(item))
            if share >= threshold and value >= MATCH * min(len(item), WHOLE) and share > found.get(k, (0.0,))[0]:
                found[k] = share, a + s, a + e
    return [(seeds.ids[k], *v) for k, v in sorted(found.items())]


@lru_cache(2)
def _seeds(items: tuple, n: int) -> Seeds:
    return Seeds([(i, np.frombuffer(w, np.uint64)) for i, w in items], n)


def contamination(df: DataFrame, items: DataFrame, n: int = 3, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", whole: bool = False) -> DataFrame:
    """(id, matches) of every row of ``df``; matches: an array of (item_id, score, first_word, end_word), one for each item that the text holds.

    Every n-gram of an item is a seed; a text that has no ``n`` words in a row in common with an item is not aligned with it.
    The array is empty for clean, null and empty texts. Items that are null or have no words match nothing; equal items all match. Repeated
    rows come out as often as they went in; empty tables give no rows, or rows without matches. Test items go to the workers as an index of at
    most ITEM_WORDS words (or one longer item); more items are taken in blocks, each a step of its own over the same rows, without a shuffle. With ``whole`` the first column is
    ``row``, a struct of all columns of ``df`` whatever they are called; else other columns are ignored.
    """
    source, kind, first = carried(df, id_col, text_col, whole)
    item_type = items.schema[item_id].dataType
    arrow = pa.list_(pa.struct([("item_id", to_arrow_type(item_type)), ("score", pa.float64()), ("first_word", pa.int32()), ("end_word", pa.int32())]))
    schema = f"first {kind}, text string, matches array<struct<item_id: {item_type.simpleString()}, score: double, first_word: int, end_word: int>>"
    blocks: list[list] = [[]]
    size = 0
    for r in items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null").orderBy("i", "t").toLocalIterator():
        w = words_of(r["t"])
        if len(w):
            if size + len(w) > ITEM_WORDS and blocks[-1]:
                blocks.append([])
                size = 0
            size += len(w)
            blocks[-1].append((r["i"], w.tobytes()))
    found = source
    for k, block in enumerate(blocks):
        key = tuple(block)

        def run(parts: Iterator[pa.RecordBatch], key=key, start=k == 0) -> Iterator[pa.RecordBatch]:
            seeds = _seeds(key, n)
            names = ("item_id", "score", "first_word", "end_word")
            for whole_batch in parts:
                for b in slices(whole_batch, 0 if whole else "text"):
                    rows = [[] for _ in range(len(b))] if start else b.column("matches").to_pylist()
                    for row, t in zip(rows, text_or_empty(texts_of(b, text_col, whole)), strict=True):
                        if len(seeds.hash):
                            row += [dict(zip(names, m, strict=True)) for m in matches(seeds, words_of(t), threshold)]
                    text = pa.nulls(len(b), pa.string()) if whole else b.column("text")
                    yield pa.RecordBatch.from_arrays([b.column(0), text, pa.array(rows, arrow)], ["first", "text", "matches"])

        found = found.mapInArrow(run, schema)
    return found.select(F.col("first").alias(first), "matches")
