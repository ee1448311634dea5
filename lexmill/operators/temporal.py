"""Validity intervals: lookups as of a day, intervals, proximity, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import small


def as_of(facts: DataFrame, versions: DataFrame, keys: list[str], at: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Each fact with the version in force at its day, or nulls where there is none; both ends count, a null end is open.

    Facts that are equal in all columns come out as often as they went in. Each key and day is looked up once, in one join on the keys with the days as a residual
    condition and one aggregate: of several versions the one that began last is taken. The facts then meet what was found for their key and day.
    Neither join is broadcast: what Spark reckons a table to have from its files says little of the versions made of it, and all of them would pass through the driver.
    """
    extra = [c for c in versions.columns if c not in keys]
    v = versions.select(*(F.col(k).alias(f"__{k}") for k in keys), F.struct(*extra).alias("__v"))
    first, last = F.col(f"__v.{start}"), F.col(f"__v.{end}")
    cond = [F.col(k) == F.col(f"__{k}") for k in keys] + [first <= F.col(at), last.isNull() | (last >= F.col(at))]
    hit = facts.select(*keys, at).distinct().join(v.hint("merge"), cond).groupBy(*keys, at).agg(F.max_by("__v", first).alias("__v"))
    return facts.join(hit.hint("merge"), [*keys, at], "left").select(*facts.columns, *(F.col(f"__v.{c}").alias(c) for c in extra))


def in_interval(df: DataFrame, value: str, intervals: DataFrame, start: str, end: str) -> DataFrame:
    """Each row with the interval that its value lies in. Few intervals go to every task; more are joined as Spark sees fit."""
    return df.join(small(intervals), (F.col(value) >= F.col(start)) & (F.col(end).isNull() | (F.col(value) <= F.col(end))), "left")


def next_within(df: DataFrame, key: str, at: str, kind: str, first: str, then: str, span: int, row: str) -> DataFrame:
    """Each row of kind ``first`` with the next row of kind ``then`` of its key that begins more than 0 and less than ``span`` after it.

    One window over each key's order instead of a join of pairs.
    """
    w = Window.partitionBy(key).orderBy(F.col(at)).rangeBetween(1, span - 1)
    hit = F.min(F.when(F.col(kind) == then, F.struct(at, row))).over(w)
    return df.withColumn("__h", hit).where((F.col(kind) == first) & F.col("__h").isNotNull()).select(key, F.col(row).alias("src"), F.col(f"__h.{row}").alias("dst"), (F.col(f"__h.{at}") - F.col(at)).alias("gap"))


def gaps(versions: DataFrame, keys: list[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions whose predecessor does not end the day before they begin."""
    w = Window.partitionBy(*keys).orderBy(start)
    return versions.withColumn("before", F.lag(end).over(w)).withColumn("__n", F.row_number().over(w)).where("__n > 1").where(F.col("before").isNull() | (F.col("before") != F.date_sub(F.col(start), 1))).drop("__n")


def events_per_case(df: DataFrame, case: str, at: str, kind: str, kinds: tuple[str, ...] = (), lane_of: str | None = None) -> DataFrame:
    """A case's events in order, as one lane, or as a lane for each value of ``lane_of`` (such as its defendants); events of nobody have a lane of their own."""
    rows = df.where(F.col(kind).isin(*kinds)) if kinds else df
    return rows.groupBy(case, *([lane_of] if lane_of else [])).agg(F.transform(F.array_sort(F.collect_list(F.struct(at, kind))), lambda e: e[kind]).alias("lane"))
