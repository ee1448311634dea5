"""What the operators of this package share: batches, token hashes, column names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import spread, table

__all__ = ["batches", "documents", "hash_words", "mix", "shingles", "slices", "table", "spread", "text_or_empty", "ROWS"]

#: Rows of an Arrow batch that goes to Python. Texts are whole; a batch of so many average texts is a few MB.
ROWS = 500


def batches(spark: SparkSession, rows: int = ROWS) -> None:
    """Sets how many rows Python workers get at once; memory of a worker is in proportion."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    batches(spark)
    d = table(spark, sf_dir, "documents")
    return spread(d.select(*columns) if columns else d)


def slices(batch: pa.RecordBatch, column: str | int = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts together have about ``limit`` bytes; a longer text stands alone."""
    col = batch.column(column)
    if len(col) == 0:
        return
    if col.nbytes <= limit:
        yield batch
        return
    ends = np.cumsum([col.slice(i, 1).nbytes for i in range(len(col))])
    start = 0
    while start < len(col):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_or_empty(col: pa.Array) -> list[str]:
    return [x or "" for x in col.to_pylist()]


def carried(df: DataFrame, id_col: str, text_col: str, whole: bool) -> tuple[DataFrame, str, str]:
    """(what goes to Python, the type of its first column, that column's name): all of a row as the struct ``row``, or the id and the text."""
    source = df.select(F.struct(*(df[c] for c in df.columns)).alias("first")) if whole else df.select(df[id_col].alias("first"), df[text_col].alias("text"))
    return source, source.schema["first"].dataType.simpleString(), "row" if whole else id_col


def texts_of(batch: pa.RecordBatch, text_col: str, whole: bool) -> pa.Array:
    return batch.column(0).field(text_col) if whole else batch.column("text")


#: Symbols of a window of a long word and what it shares with the next one; longer words are merged in windows.
WINDOW, SHARED = 192, 64


def windows(n: int) -> list[tuple[int, int]]:
    """(start, stop) of the windows of a word of n symbols; a word of WINDOW symbols or fewer is one."""
    starts = range(0, max(1, n - SHARED), WINDOW - SHARED) if n > WINDOW else (0,)
    return [(a, min(n, a + WINDOW)) for a in starts]


def stitched(spans: list[tuple[int, int]], merge) -> list[tuple[int, object]]:
    """(start, token) of a whole word's tokens by pair merging, from those of its windows.

    ``merge(spans)`` gives the (start, token) pairs of each span, as if it were a word. A token that two windows have at one place is a joint: the tokens
    before it in the first and after it in the second are together the word's. For whenever each two neighbouring tokens are what their own
    symbols merge to, as they are in a window, the first merge of the whole that would cross between two of them would be the first in those two as well.
    Windows without a joint become one and are merged again, so that the result is exact for every word.
    """
    found = merge(spans)
    while len(spans) > 1:
        cuts, again = [], []
        for k in range(len(spans) - 1):
            both = set(found[k + 1])
            low = cuts[-1] if cuts and cuts[-1] is not None else 0
            inside = [i for i, t in enumerate(found[k]) if t[0] >= spans[k + 1][0] and t[0] > low and t in both]
            cuts.append(found[k][inside[len(inside) // 2]][0] if inside else None)
        if None not in cuts:
            edge = [0, *cuts, spans[-1][1]]
            return [t for k, tokens in enumerate(found) for t in tokens if edge[k] <= t[0] < edge[k + 1]]
        spans, old, k = [], list(zip(spans, found, strict=True)), 0
        found = []
        while k < len(old):
            (a, b), tokens = old[k]
            joined = False
            while k < len(cuts) and cuts[k] is None:
                k, joined = k + 1, True
                b = old[k][0][1]
            spans.append((a, b))
            found.append(None if joined else tokens)
            again += [(a, b)] * joined
            k += 1
        new = iter(merge(again))
        found = [x if x is not None else next(new) for x in found]
    return found[0]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; bijective."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_weights = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


def _weight(n: int) -> np.ndarray:
    """Odd multipliers of the first n byte places of a word."""
    global _weights
    if n > len(_weights):
        _weights = mix(np.arange(1, max(n, 2 * len(_weights)) + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
    return _weights


#: Bytes of letters and digits: those of ASCII and all beyond it.
ALNUM = np.array([chr(i).isalnum() or i > 127 for i in range(256)])
#: Bytes of a long text that are hashed at once.
PART = 1 << 21


def hash_words(data: bytes, inside: np.ndarray = ~_SPACE) -> np.ndarray:
    """64-bit hashes of the words of ``data``, in order; equal in every process. Words are runs of the bytes ``inside``: by default, of those that aren't ASCII white space."""
    if len(data) > PART and not inside[32]:
        parts, start = [], 0
        while start < len(data):
            stop = data.find(b" ", start + PART)
            stop = len(data) if stop < 0 else stop
            parts.append(_hash_words(data[start:stop], inside))
            start = stop
        return np.concatenate(parts)
    return _hash_words(data, inside)


def _hash_words(data: bytes, inside: np.ndarray) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    word = inside[a]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, stops = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = stops - starts
    place = np.arange(len(a), dtype=np.int32)
    place -= np.repeat(starts.astype(np.int32), np.diff(np.append(starts, len(a)))) if starts[0] == 0 else np.repeat(np.append(0, starts).astype(np.int32), np.diff(np.concatenate(([0], starts, [len(a)]))))
    np.minimum(place, np.int32(lengths.max()), out=place)
    part = _weight(int(lengths.max()) + 1)[place]
    part *= a.astype(np.uint64) + _U(1)
    part[~word] = 0
    return mix(np.add.reduceat(part, starts) + lengths.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; of fewer words, the whole sequence as one; of none, none."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    n = min(n, len(words))
    return np.unique(ngrams(words, n))


_spread = mix(np.arange(1, 65, dtype=np.uint64) * _U(0xC2B2AE3D27D4EB4F)) | _U(1)


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams in order, for n up to 64; the length counts in the hash."""
    m = max(0, len(words) - n + 1)
    out = np.full(m, n * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
    for i in range(n):
        out += words[i : i + m] * _spread[i]
    return mix(out)
