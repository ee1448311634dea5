"""Chunking inside a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import ColumnLike, _c


def sliding(x: ColumnLike, window: int, overlap: int) -> Column:
    """The text if it fits, else windows that start ``window - overlap`` apart."""
    t = _c(x)
    step = max(1, window - overlap)
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.length(t) - 1, F.lit(0)), F.lit(step)), lambda i: t.substr(i + 1, F.lit(window)))
    return F.when(F.length(t) <= window, F.array(t)).otherwise(cut)


def sentence(x: ColumnLike, target: int, overlap: int) -> Column:
    """Whole sentences packed up to ``target`` characters; each chunk begins with the last ``overlap`` characters of the one before."""
    t = _c(x)
    zero = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, s: Column) -> Column:
        fits = (acc["open"] == "") | (F.length(acc["open"]) + 1 + F.length(s) <= target)
        tail = F.right(acc["open"], F.lit(overlap)) if overlap > 0 else F.lit("")
        joined = F.when(acc["open"] == "", s).otherwise(F.concat(acc["open"], F.lit(" "), s))
        fresh = F.when(tail == "", s).otherwise(F.concat(tail, F.lit(" "), s))
        return F.struct(F.when(fits, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))).alias("done"), F.when(fits, joined).otherwise(fresh).alias("open"))

    packed = F.aggregate(F.split(t, r"(?U)(?<=[.!?。])\s+"), zero, step, lambda a: F.when(a["open"] == "", a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))))
    return F.when(F.length(t) <= target, F.array(t)).otherwise(packed)


def budget(max_seq: int = 8192, safety: int = 512, chars_per_token: float = 2.0) -> int:
    """Characters of a chunk that fit a model's window."""
    return int(max(256, max_seq - safety) * chars_per_token)
