"""Byte-level BPE by recursive queries of an in-process DuckDB, one per Python worker.

Distinct pre-tokens become rows (word, place, next place, token). The recursive query joins neighbouring tokens with the merge table,
finds each word's leftmost pair of lowest rank, contracts it and goes on with the words it has changed until none has a pair; its state is keyed by
place, so that it holds each token once and not once a step. Words longer than a window are merged in windows that
overlap, so that the number of steps is bounded whatever a word's length. Ordered aggregation over the vocabulary turns a document's ids back into bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm.base import WINDOW, slices, stitched, text_or_empty, windows

#: Bytes of distinct words that a query takes at once, ids that one decodes at once; words whose ids a worker keeps.
AT_ONCE, IDS_AT_ONCE, KEPT = 400_000, 1_000_000, 400_000

#: Tokens are a linked list: g is a token's place, n that of the next one in its word; a token that went into the one before it is -1.
_CONTRACT = """
WITH RECURSIVE s(g, w, n, t) USING KEY (g) AS (
    SELECT g, w, n, t FROM waiting
    UNION
    SELECT y.g, x.w, CASE WHEN y.g = x.place THEN x.after ELSE -2 END, CASE WHEN y.g = x.place THEN x.made ELSE -1 END
    FROM (
        SELECT a.w, min((m.made::BIGINT << 32) | a.g) & 4294967295 AS place, (min((m.made::BIGINT << 32) | a.g) >> 32)::INTEGER AS made,
               arg_min(b.g, (m.made::BIGINT << 32) | a.g) AS gone, arg_min(b.n, (m.made::BIGINT << 32) | a.g) AS after
        FROM recurring.s a JOIN recurring.s b ON b.g = a.n JOIN merges m ON m.a = a.t AND m.b = b.t
        WHERE a.w IN (SELECT w FROM s)
        GROUP BY a.w
    ) x, LATERAL (SELECT unnest([x.place, x.gone]) AS g) y
)
SELECT w, t FROM s WHERE t >= 0 ORDER BY w, g
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class ByteBPE:
    """Encodes and decodes texts; the ranks are also the ids of what the pairs make."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.quick = quick_pattern(pattern)
        self.first = np.zeros(256, np.int32)
        for k, v in ranks.items():
            if len(k) == 1:
                self.first[k[0]] = v
        rows = [(ranks[v[:k]], ranks[v[k:]], made) for v, made in ranks.items() for k in range(1, len(v)) if v[:k] in ranks and v[k:] in ranks]
        self.db = duckdb.connect(":memory:")
        for setting in ("threads = 1", "memory_limit = '200MB'", "preserve_insertion_order = false", "temp_directory = ''"):
            self.db.execute(f"SET {setting}")
        a, b, made = (pa.array(x, pa.int32()) for x in zip(*rows, strict=True))
        self.load("merges", pa.table({"a": a, "b": b, "made": made}))
        self.load("vocabulary", pa.table({"t": pa.array(list(ranks.values()), pa.int32()), "hex": pa.array([k.hex() for k in ranks])}))
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size[list(ranks.values())] = [len(k) for k in ranks]
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def load(self, name: str, rows: pa.Table) -> None:
        self.db.register("rows_in", rows)
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM rows_in")
        self.db.unregister("rows_in")

    def split(self, text: str) -> list[str]:
        if self.quick and self.quick[0].search(text) is None:
            return self.quick[1].findall(text)
        return self.pattern.findall(text)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers; no word is empty."""
        long = [k for k, w in enumerate(words) if len(w) > WINDOW]
        out = self._contracted([w if len(w) <= WINDOW else w[:1] for w in words])
        for k in long:
            out[k] = self._long(words[k])
        return out

    def _long(self, word: bytes) -> bytes:
        def merge(spans):
            ids = []
            step = max(1, AT_ONCE // max(b - a for a, b in spans))
            for i in range(0, len(spans), step):
                ids += self._contracted([word[a:b] for a, b in spans[i : i + step]])
            out = []
            for (a, _), x in zip(spans, ids, strict=True):
                t = np.frombuffer(x, "<u4")
                out.append(list(zip((a + np.cumsum(self.size[t]) - self.size[t]).tolist(), t.tolist(), strict=True)))
            return out

        return np.array([t for _, t in stitched(windows(len(word)), merge)], "<u4").tobytes()

    def _contracted(self, words: list[bytes]) -> list[bytes]:
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        place = np.arange(len(flat))
        after = place + 1
        after[np.cumsum(lengths) - 1] = -1
        self.load("waiting", pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), lengths), "g": place, "n": after, "t": self.first[flat]}))
        got = self.db.execute(_CONTRACT).fetchnumpy()
        ids = np.asarray(got["t"]).astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(np.asarray(got["w"]), minlength=len(words))) * 4
        return [ids[i:j] for i, j in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True)]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each id list, by ordered aggregation over the vocabulary, in parts of bounded size."""
        lengths = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        if len(flat) and (flat.max() >= len(self.size) or not self.size[flat].all()):
            raise ValueError("an id is not in the vocabulary")
        own = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
        out = [[] for _ in ids]
        for a in range(0, len(flat), IDS_AT_ONCE):
            b = min(len(flat), a + IDS_AT_ONCE)
            self.load("ids", pa.table({"w": own[a:b], "p": np.arange(a, b), "t": flat[a:b].astype(np.int32)}))
            for w, x in self.db.execute("SELECT w, string_agg(hex, '' ORDER BY p) FROM ids JOIN vocabulary USING (t) GROUP BY w").fetchall():
                out[w].append(bytes.fromhex(x))
        return [b"".join(x) for x in out]

    def learn(self, words: set[str]) -> None:
        """Encodes the words that aren't known yet, in parts of bounded size."""
        if len(self.new) > KEPT:
            self.new, self.old = {}, self.new
        new, old = self.new, self.old
        todo = []
        for w in words:
            if w not in new:
                if w in old:
                    new[w] = old[w]
                else:
                    todo.append(w)
        start = 0
        while start < len(todo):
            part, size = [], 0
            while start < len(todo) and (not part or size < AT_ONCE):
                part.append(todo[start].encode("utf-8", "surrogatepass"))
                size += len(part[-1])
                start += 1
            new.update(zip(todo[start - len(part) : start], self.encode_words(part), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(t) for t in texts]
        self.learn({w for words in split for w in words})
        return [b"".join(map(self.new.__getitem__, words)) for words in split]

    def __call__(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids, what the ids decode to) of each text."""
        ids = self.encode(texts)
        return list(zip(ids, self.decode(ids), strict=True))


def quick_pattern(pattern: str):
    """For one known pattern, an equal one of the standard library, and what texts must not hold for it: characters beyond Latin letters and common marks, or those whose classes differ."""
    known = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    if pattern != known:
        return None
    odd = re.compile("[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧‰-‾€]")
    return odd, re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+""")


@lru_cache(2)
def coder(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


def byte_bpe(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """(id, n_tokens, ids, decoded) of every row: ``ids`` as little-endian unsigned 32-bit integers, ``decoded`` as bytes.

    ``decoded`` comes from the ids of the whole text, not from the text. With ``digests`` the two are replaced by ids_sha256 and decoded_sha256, in lowercase hex. A null text counts as an empty one and
    has no ids. Of pairs of one rank in a word the leftmost goes first. Words of any length are merged whole. Repeated rows come out as often as they went in; other columns are ignored; an empty table gives no rows.
    """
    source = df.select(df[id_col].alias("__id"), df[text_col].alias("text"))
    kind = source.schema["__id"].dataType.simpleString()
    names = ["__id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(ranks_path, pattern)
        for whole in parts:
            for batch in slices(whole):
                found = code(text_or_empty(batch.column("text")))
                count = pa.array([len(x) // 4 for x, _ in found], pa.int64())
                if digests:
                    cols = [pa.array([hashlib.sha256(x[i]).hexdigest() for x in found], pa.string()) for i in (0, 1)]
                else:
                    cols = [pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column("__id"), count, *cols], names)

    kinds = "string" if digests else "binary"
    return source.mapInArrow(run, f"__id {kind}, n_tokens bigint, {names[2]} {kinds}, {names[3]} {kinds}").withColumnRenamed("__id", id_col)


def decoded(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) of every row: the bytes that its ids (little-endian unsigned 32-bit integers) stand for.

    Null and empty id lists give no bytes; an id beyond the vocabulary raises. Repeated rows come out as often as they went in; other columns are
    ignored; an empty table gives no rows.
    """
    source = df.select(df[id_col].alias("__id"), df[ids_col].alias("ids"))
    kind = source.schema["__id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(ranks_path, pattern)
        for whole in parts:
            for b in slices(whole, "ids"):
                yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(code.decode([x or b"" for x in b.column("ids").to_pylist()]), pa.binary())], ["__id", "decoded"])

    return source.mapInArrow(run, f"__id {kind}, decoded binary").withColumnRenamed("__id", id_col)
