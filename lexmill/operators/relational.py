"""Joins, aggregations, sorts and set operations of the analytics layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outer_join(left: DataFrame, right: DataFrame, key: str, suffix: str = "_jsonl") -> DataFrame:
    """Full outer equi join; of columns that both sides have, the right one keeps its name and the left one gets the suffix. Without columns on a side, the other side."""
    if not left.columns:
        return right
    if not right.columns:
        return left
    both = {c: c + suffix for c in left.columns if c in right.columns and c != key}
    return left.withColumnsRenamed(both).join(right, key, "full_outer")


def left_lookup(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    return df.join(dimension, key, "left")


def not_done(todo: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """What a run that resumes still has to do."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")


def present(df: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_semi")


def first_of(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """One row for each key: the first in the order given. An aggregate, so that a key of many rows is reduced before the shuffle."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return best.select(key, *(F.col(f"__r.{c}").alias(c) for c in rest)).select(*df.columns)


def value_counts(df: DataFrame, column: str, vocabulary: tuple[str, ...] = ()) -> DataFrame:
    """(value, n, percent, ord) with nulls as "(null)"; ord: the place in the vocabulary, 10000 beyond it."""
    c = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("(null)")).alias("value")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    place = F.nullif(F.array_position(F.array(*(F.lit(v) for v in vocabulary)), F.col("value")), F.lit(0)) if vocabulary else F.lit(None).cast("long")
    return c.join(F.broadcast(total)).select("value", "n", F.round(F.col("n") * 100.0 / F.col("total"), 4).alias("percent"), F.coalesce(place - 1, F.lit(10_000)).cast("int").alias("ord"))


def top(df: DataFrame, keys: list[str], n: int, drop_null: bool = True) -> DataFrame:
    """The n most frequent keys; ties by key."""
    rows = df.dropna(subset=keys) if drop_null else df
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys).limit(n)


def top_with_distinct(df: DataFrame, key: str, distinct: str, n: int) -> DataFrame:
    """The n most frequent keys with how many distinct values of another column they come with."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(distinct).alias("n_distinct")).orderBy(F.desc("n"), key).limit(n)


def describe(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    """count, mean, sample deviation, least, median, 90th and 99th percentile (linear), most."""
    p = F.percentile(column, F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)))
    d = df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).cast("double").alias("least"), p.alias("p"), F.max(column).cast("double").alias("most"))
    r = lambda c: F.round(c, digits)
    return d.select("n", r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"), "least", *(r(F.col("p")[i]).alias(k) for i, k in enumerate(("p50", "p90", "p99"))), "most")


def clipped(df: DataFrame, column: str, share: float = 0.99) -> DataFrame:
    """Rows up to a percentile of a column."""
    bound = df.agg(F.percentile(column, F.lit(share)).alias("__bound"))
    return df.join(F.broadcast(bound)).where(F.col(column) <= F.col("__bound")).drop("__bound")


def view_range(df: DataFrame, year: str, this_year: int, floor: int = 1985, ceiling: int = 2030) -> DataFrame:
    """(start, stop) of a timeline: the years there are, two more on either side, between floor and ceiling, and five years at least."""
    top_ = max(ceiling, this_year + 2)
    r = df.agg(F.min(year).alias("lo"), F.max(year).alias("hi"))
    start = F.greatest(F.lit(floor), F.coalesce(F.col("lo") - 2, F.lit(floor)))
    return r.select(start.cast("int").alias("start"), F.least(F.lit(top_), F.greatest(F.coalesce(F.col("hi") + 2, F.lit(top_)), start + 5)).cast("int").alias("stop"))


def bands(view: DataFrame, eras: DataFrame) -> DataFrame:
    """Eras that a range of years meets, cut to it."""
    last = F.coalesce("end_year", "stop")
    return eras.join(F.broadcast(view), (last >= F.col("start")) & (F.col("start_year") <= F.col("stop"))).select("arc", F.greatest("start_year", "start").alias("band_start"), F.least(last, F.col("stop")).alias("band_end"))


def treemap(df: DataFrame, kind: str, taxonomy: DataFrame) -> DataFrame:
    """(label, parent, value): the tree's nodes with how many rows are of each kind."""
    c = df.groupBy(F.col(kind).alias("node")).agg(F.count("*").alias("value"))
    return taxonomy.join(c, "node", "left").select(F.col("node").alias("label"), "parent", F.coalesce("value", F.lit(0)).alias("value"))


def present_relations(df: DataFrame, kind: str, relations: DataFrame) -> DataFrame:
    """Relations one of whose ends is a kind that is there."""
    kinds = df.select(F.col(kind).alias("k")).distinct()
    s = relations.join(kinds, F.col("source_kind") == F.col("k"), "left_semi")
    t = relations.join(kinds, F.col("target_kind") == F.col("k"), "left_semi")
    return s.unionByName(t).distinct()


def scatter(df: DataFrame, dims: str, color: str, hover: tuple[str, ...] = ()) -> DataFrame | None:
    """x, y, color and the hover columns that exist; nothing where a needed column is missing."""
    if not {f"{dims}_x", f"{dims}_y", color} <= set(df.columns):
        return None
    return df.select(F.col(f"{dims}_x").alias("x"), F.col(f"{dims}_y").alias("y"), F.col(color).alias("color"), *(c for c in hover if c in df.columns))


def cluster_label(cluster: str = "cluster_id") -> Column:
    return F.when(F.col(cluster) == -1, "noise").otherwise(F.concat(F.lit("c"), F.col(cluster).cast("string")))


def coverage(df: DataFrame, *columns: str) -> DataFrame:
    """How many rows have a value, for each column."""
    return df.agg(F.count("*").alias("n_rows"), *(F.count(c).alias(f"n_{c}") for c in columns))


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def parity(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two stages has, with the side."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def common(*frames: DataFrame) -> DataFrame:
    """Rows that all frames have."""
    return reduce(lambda a, b: a.intersect(b), frames)


def latest(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row of the highest version for each natural key; a null version comes before all others. An aggregate, so that a key of many rows is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(version).isNotNull(), F.col(version))).alias("__r"))
    return best.select(*keys, *(F.col(f"__r.{c}").alias(c) for c in rest)).select(*df.columns)


def project(df: DataFrame, fields: list[str] | None = None, drop: list[str] | None = None) -> DataFrame:
    """The fields that exist, in the order given; or all but some."""
    return df.select(*(f for f in fields if f in df.columns)) if fields else df.drop(*(drop or []))


def deny(df: DataFrame, *patterns: str) -> DataFrame:
    """Without columns whose names match a pattern, such as anything about single judges."""
    import re

    return df.select(*(c for c in df.columns if not any(re.search(p, c) for p in patterns)))


def grouped_rates(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """(keys, n, rate) with subtotals of every prefix of the keys."""
    return df.rollup(*keys).agg(F.count("*").alias("n"), F.round(F.avg(F.col(flag).cast("double")), 6).alias("rate"))


def mutual_information(df: DataFrame, a: str, b: str) -> DataFrame:
    """Normalised mutual information of two columns, by their geometric mean entropy."""
    c = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    ca, cb = c.groupBy("a").agg(F.sum("n").alias("na")), c.groupBy("b").agg(F.sum("n").alias("nb"))
    t = c.agg(F.sum("n").alias("t"))
    ent = lambda x, k: x.join(F.broadcast(t)).agg((-F.sum(F.col(k) / F.col("t") * F.log(F.col(k) / F.col("t")))).alias(f"h_{k}"))
    mi = c.join(ca, "a").join(cb, "b").join(F.broadcast(t)).agg(F.sum(F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("na") * F.col("nb")))).alias("mi"))
    return mi.join(F.broadcast(ent(ca, "na"))).join(F.broadcast(ent(cb, "nb"))).select(F.round(F.try_divide("mi", F.sqrt(F.col("h_na") * F.col("h_nb"))), 6).alias("nmi"))
