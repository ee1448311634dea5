"""Preference formatting, in DataFrame functions only: common prompt once, then paired completions with masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def conversations(df: DataFrame) -> DataFrame:
    """(conv_id, turns) of rows (conv_id, turn, role, text): turns in order, each a struct (role, text).

    A null role is "unknown", a null text is empty. Null turns come last; rows of one turn go by role and text, and repeated rows stay.
    Rows without a conv_id belong to no conversation. Other columns are ignored. A conversation is one row and fits in one task's memory.
    """
    turn = F.struct(F.col("turn").isNull().alias("last"), "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = df.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def sibling_pairs(convs: DataFrame) -> DataFrame:
    """(chosen_id, chosen, rejected_id, rejected): of conversations with one first turn, the longest is chosen against each other one.

    Longest: most turns, then most characters, then the smallest id. As many pairs as conversations, less one for each first turn; groups
    are reduced to their best before anything is joined, and the join's large side may be split.
    """
    c = convs.where(F.size("turns") > 0).select("conv_id", "turns", F.element_at("turns", 1).alias("first"))
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + F.length(t["text"]))
    best = c.groupBy("first").agg(F.count("*").alias("n"), F.min_by("conv_id", F.struct(-F.size("turns"), -chars, F.col("conv_id"))).alias("chosen_id")).where("n > 1")
    chosen = best.join(convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen")), "chosen_id").select("first", "chosen_id", "chosen")
    return c.join(chosen, "first").where("conv_id <> chosen_id").select("chosen_id", "chosen", F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))


def stale_pairs(convs: DataFrame) -> DataFrame:
    """(chosen_id, chosen, rejected_id, rejected): each conversation with an assistant turn against itself with its last one replaced by the one before, or by nothing."""
    at = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["role"] == "assistant")
    c = convs.where(F.size("turns") > 0).withColumn("at", at).where(F.size("at") > 0)
    c = c.withColumn("last", F.element_at("at", -1)).withColumn("before", F.try_element_at("at", F.lit(-2)))
    c = c.withColumn("old", F.coalesce(F.try_element_at("turns", "before")["text"], F.lit("")))
    stale = F.array(F.struct(F.lit("assistant").alias("role"), F.col("old").alias("text")))
    rejected = F.concat(F.slice("turns", F.lit(1), F.col("last") - 1), stale, F.slice("turns", F.col("last") + 1, F.size("turns")))
    return c.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"), F.col("conv_id").alias("rejected_id"), rejected.alias("rejected"))


def _one(t: Column) -> Column:
    return F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _one), "")


def _mask(turns: Column) -> Column:
    """[start, stop) of what is learned: each assistant turn's text and end mark, in characters of the rendered turns."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        begin = s["at"] + len(START) + F.length(t["role"]) + 1
        stop = begin + F.length(t["text"]) + len(END)
        span = F.array(F.struct(begin.alias("start"), stop.alias("stop")))
        return F.struct((stop + 1).alias("at"), F.when(t["role"] == "assistant", F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step, lambda s: s["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Adds n_prompt_turns, prompt, chosen_text, rejected_text, chosen_mask and rejected_mask to rows with turns ``chosen`` and ``rejected``.

    The prompt is the longest common prefix of turns (equal role and text). Equal conversations have empty completions; without a common
    turn the prompt is empty; a null conversation counts as one without turns. Ties and repeated rows come out as they went in.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    p = pairs.withColumns({c: F.coalesce(c, none) for c in ("chosen", "rejected")})
    n = F.least(F.size("chosen"), F.size("rejected"))
    unequal = F.filter(F.sequence(F.lit(0), n), lambda i: (i == n) | ~F.get("chosen", i).eqNullSafe(F.get("rejected", i)))
    p = p.withColumn("n_prompt_turns", F.element_at(unequal, 1))
    rest = {c: F.slice(c, F.col("n_prompt_turns") + 1, F.size(c)) for c in ("chosen", "rejected")}
    p = p.withColumns({"prompt": _render(F.slice("chosen", F.lit(1), F.col("n_prompt_turns"))), **{f"{c}_rest": x for c, x in rest.items()}})
    return p.withColumns({f"{c}_{k}": f(F.col(f"{c}_rest")) for c in rest for k, f in (("text", _render), ("mask", _mask))}).drop("chosen_rest", "rejected_rest", "chosen", "rejected")


def mask_text(column: str) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",")
