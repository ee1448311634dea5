"""Embedding texts: chunks, backends, recovery, pooling."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.chunks import budget, sentence, sliding
from lexmill.functions.text import blank, text_hash

Backend = Callable[[list[str]], list[list[float]]]


@dataclass(frozen=True)
class Settings:
    max_seq: int = 8192
    safety: int = 512
    chars_per_token: float = 2.0
    overlap_tokens: int = 256
    batch: int = 8
    chunking: str = "sentence"  # off, sentence or sliding
    max_depth: int = 6
    min_chars: int = 200


class TooLong(ValueError):
    """A backend raises this for a text beyond its window."""


def hashing_backend(dim: int = 64) -> Backend:
    """An offline backend: signed counts of hashed words, of length one; equal everywhere."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = np.zeros(dim)
            for w in re.findall(r"\w+", t.lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                v[h % dim] += 1 if h >> 63 else -1
            n = np.linalg.norm(v)
            out.append((v / n if n else v).tolist())
        return out

    return embed


def pool(vectors: list[list[float]]) -> list[float]:
    """The mean of vectors, of length one; a single one is copied, of none there is []."""
    kept = [v for v in vectors if len(v)]
    if not kept:
        return []
    if len(kept) == 1:
        return list(kept[0])
    if len({len(v) for v in kept}) > 1:
        raise ValueError("vectors of different lengths can't be pooled")
    m = np.mean(np.array(kept, np.float64), axis=0)
    n = float(np.linalg.norm(m))
    return (m / (n or 1.0)).tolist()


def guarded(backend: Backend, texts: list[str], s: Settings) -> list[list[float]]:
    """One vector for each text: blanks aren't sent and get []; a text that is too long is halved, again and again, and its halves are pooled."""
    out: list[list[float]] = [[] for _ in texts]
    send = [i for i, t in enumerate(texts) if t.strip()]
    for a in range(0, len(send), s.batch):
        part = send[a : a + s.batch]
        try:
            got = backend([texts[i] for i in part])
        except TooLong:
            got = [halved(backend, texts[i], s, 0) for i in part]
        for i, v in zip(part, got, strict=True):
            out[i] = list(v)
    return out


def halved(backend: Backend, text: str, s: Settings, depth: int) -> list[float]:
    try:
        return list(backend([text])[0])
    except TooLong:
        if depth >= s.max_depth or len(text) < s.min_chars:
            raise
        half = len(text) // 2
        return pool([halved(backend, t, s, depth + 1) for t in (text[:half], text[half:]) if t.strip()])


def embed(df: DataFrame, backend: Backend | None = None, model_id: str = "local/hashing-64", text: str = "markdown", s: Settings | None = None) -> DataFrame:
    """Adds text_hash, embedding, embedding_dim, embedding_model_id, embedding_text_hash, embedding_chunks_used and embedding_chunking.

    Blank texts get [], dimension 0, no chunks and "empty". Chunks are cut by built-in expressions, embedded in Arrow batches, and pooled in their row.
    """
    s = s or Settings()
    backend = backend or hashing_backend()
    window = budget(s.max_seq, s.safety, s.chars_per_token)
    overlap = int(s.overlap_tokens * s.chars_per_token)
    pieces = {"off": lambda c: F.array(c), "sentence": lambda c: sentence(c, window, overlap), "sliding": lambda c: sliding(c, window, overlap)}[s.chunking](F.col(text))
    cols = df.columns
    cut = df.withColumn("__chunks", F.when(blank(text), F.array().cast("array<string>")).otherwise(pieces))
    packed = cut.select(F.struct(*cols).alias("row"), "__chunks")
    row = packed.schema["row"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            lists = b.column(1).to_pylist()
            flat = [c for chunks in lists for c in chunks]
            vectors = iter(guarded(backend, flat, s))
            pooled = [pool([next(vectors) for _ in chunks]) for chunks in lists]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pooled, pa.list_(pa.float32())), pa.array([len(c) for c in lists], pa.int32())], ["row", "embedding", "n"])

    out = packed.mapInArrow(run, f"row {row}, embedding array<float>, n int")
    mode = F.when(F.col("n") == 0, "empty").when(F.col("n") > 1, s.chunking).otherwise("none")
    keep = [F.col(f"row.{c}").alias(c) for c in cols if c not in ("embedding", "text_hash")]
    return out.select(*keep, text_hash(F.col(f"row.{text}")).alias("text_hash"), "embedding", F.size("embedding").alias("embedding_dim"), F.lit(model_id).alias("embedding_model_id"), text_hash(F.col(f"row.{text}")).alias("embedding_text_hash"), F.col("n").alias("embedding_chunks_used"), mode.alias("embedding_chunking"))


def registry(path: str) -> dict[str, dict]:
    """Models of a YAML list by model_id; an unknown id is a KeyError at look-up."""
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or []
    return {m["model_id"]: m for m in (data.get("models", []) if isinstance(data, dict) else data)}
