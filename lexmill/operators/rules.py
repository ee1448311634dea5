"""Constraints, axioms, state machines, routing, identifiers and splits."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import small

#: A violation: which rule, of which row.
SHAPE = "rule string, key string"


def _report(df: DataFrame, rule: str, key: str) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.expr(key).cast("string").alias("key"))


def check(df: DataFrame, rule: str, condition: str, key: str) -> DataFrame:
    """Rows for which a condition is false; null counts as kept."""
    return _report(df.where(~F.coalesce(F.expr(condition), F.lit(True))), rule, key)


def not_null(df: DataFrame, rule: str, column: str, key: str) -> DataFrame:
    return _report(df.where(F.col(column).isNull()), rule, key)


def unique(df: DataFrame, rule: str, *columns: str) -> DataFrame:
    """Keys that come more than once; nulls are equal to nothing."""
    rows = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")
    return rows.select(F.lit(rule).alias("rule"), F.concat_ws("|", *(F.col(c).cast("string") for c in columns)).alias("key"))


def foreign(df: DataFrame, rule: str, column: str, parent: DataFrame, parent_key: str, key: str) -> DataFrame:
    """Rows whose reference has no target."""
    p = parent.select(F.col(parent_key).alias("__p")).distinct()
    return _report(df.where(F.col(column).isNotNull()).join(p, F.col(column) == F.col("__p"), "left_anti"), rule, key)


def one_of(df: DataFrame, rule: str, column: str, values: tuple, key: str) -> DataFrame:
    return _report(df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values)), rule, key)


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def cardinality(e: DataFrame, sources: DataFrame, rule: str, least: int, most: int | None) -> DataFrame:
    """Sources (vertex) with fewer or more edges than they may have."""
    n = sources.join(e.groupBy(F.col("src").alias("vertex")).agg(F.count("*").alias("n")), "vertex", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    bad = F.col("n") < least
    return _report(n.where(bad if most is None else bad | (F.col("n") > most)), rule, "vertex")


def axioms(t: dict[str, DataFrame]) -> DataFrame:
    """(rule, key) of every violation of AX-01 to AX-18, for the tables that are given; keys are those of the rows that break a rule.

    AX-16 needs evidence (prediction_id, edge_id) and retrieved (prediction_id, edge_id); AX-18 across snapshots needs courts_before.
    """
    out = []
    has = lambda *names: all(n in t for n in names)
    if has("statute_articles"):
        a = t["statute_articles"]
        out.append(check(a, "AX-01", "effective_from <= effective_to", "article_id"))
        b = a.select(F.col("article_id").alias("old_id"), F.col("effective_to").alias("old_to"))
        chain = a.where("replaces_id is not null").join(b, F.col("replaces_id") == F.col("old_id"))
        out.append(_report(chain.where(~F.col("old_to").eqNullSafe(F.date_sub("effective_from", 1))), "AX-02", "article_id"))
    if has("codes"):
        out.append(check(t["codes"], "AX-03", "enacted_on <= repealed_on", "code_id"))
    if has("case_files"):
        c = t["case_files"]
        out.append(check(c, "AX-04", "incident_date <= acceptance_date and acceptance_date <= judgment_date", "case_id"))
        if has("charges", "charge_articles", "statute_articles"):
            day = c.select("case_id", F.coalesce("incident_date", "acceptance_date").alias("day"))
            cited = t["charges"].join(day, "case_id").join(t["charge_articles"], "charge_id").join(t["statute_articles"].select("article_id", "effective_from", "effective_to"), "article_id")
            covers = (F.col("effective_from") <= F.col("day")) & (F.col("effective_to").isNull() | (F.col("effective_to") >= F.col("day")))
            bad = cited.groupBy("charge_id").agg(F.max(covers.cast("int")).alias("ok")).where("ok = 0")
            if has("transitional_rules"):
                bad = bad.join(t["transitional_rules"].select("charge_id"), "charge_id", "left_anti")
            out.append(_report(bad, "AX-05", "charge_id"))
        if has("indictments"):
            i = t["indictments"]
            out.append(_report(i.where("status = 'issued'").join(c.select("case_id", "trial_level"), "case_id").groupBy("case_id", "trial_level").count().where("count > 1"), "AX-06", "case_id"))
            out.append(_report(i.select("case_id").distinct().join(c.where("case_type <> 'Hình sự'").select("case_id"), "case_id"), "AX-07", "case_id"))
        if has("lawsuits"):
            n = t["lawsuits"].join(c.where("case_type <> 'Hình sự'").select("case_id"), "case_id").groupBy("case_id").count().where("count > 1")
            out.append(_report(n, "AX-08", "case_id"))
        if has("verdicts"):
            v = t["verdicts"]
            level = F.when(F.col("trial_level") == "Sơ thẩm", 1).when(F.col("trial_level") == "Phúc thẩm", 2).when(F.col("trial_level") == "Giám đốc thẩm", 3).otherwise(4)
            lv = v.withColumn("l", level)
            low = lv.select(F.col("case_id").alias("low_case"), F.col("l").alias("low_l"))
            parent = lv.where("l > 1").join(c.select("case_id", "appeal_of"), "case_id", "left")
            missing = _without_lower(parent, low)
            out.append(_report(missing, "AX-11", "verdict_id"))
            if has("sentences", "charges"):
                s = t["sentences"].join(t["charges"].select("charge_id", F.col("case_id").alias("charge_case")), "charge_id").join(v.select("verdict_id", F.col("case_id").alias("verdict_case")), "verdict_id")
                out.append(_report(s.where("charge_case <> verdict_case"), "AX-09", "sentence_id"))
                proof = t["sentences"].join(t["charges"].select("charge_id", "case_id"), "charge_id").select("case_id").unionByName(v.where("outcome = 'convicted'").select("case_id")).distinct()
                out.append(_report(c.where("outcome = 'convicted'").join(proof, "case_id", "left_anti"), "AX-10", "case_id"))
        if has("defendants"):
            d = t["defendants"].join(c.select("case_id", "case_type", "incident_date"), "case_id")
            out.append(_report(d.where("case_type = 'Hình sự' and age_determined < 14"), "AX-12", "defendant_id"))
            out.append(_report(d.where(F.col("juvenile_regime").isNotNull() | (F.col("age_determined") < 18)).where(~F.col("juvenile_regime").eqNullSafe(juvenile_regime(F.col("incident_date"), F.col("age_determined")))), "AX-17", "defendant_id"))
        if has("precedents"):
            p = t["precedents"].where("source_case_id is not null").join(c.select(F.col("case_id").alias("source_case_id"), "outcome"), "source_case_id", "left")
            out.append(_report(p.where("outcome is null or outcome = 'remanded'"), "AX-13", "precedent_id"))
        if has("case_events"):
            closing = t["case_events"].where("event_kind = 'terminal'").groupBy("case_id").agg(F.count("*").alias("n"))
            out.append(_report(c.where("closed").join(closing, "case_id", "left").where("coalesce(n, 0) <> 1"), "AX-14", "case_id"))
    if has("persons"):
        out.append(check(t["persons"], "AX-15", "full_name_hash rlike '^[0-9a-f]{64}$'", "person_id"))
    if has("evidence", "retrieved"):
        out.append(_report(t["evidence"].join(t["retrieved"], ["prediction_id", "edge_id"], "left_anti"), "AX-16", "concat_ws('|', prediction_id, edge_id)"))
    if has("courts"):
        out.append(unique(t["courts"], "AX-18", "court_code"))
        if has("courts_before"):
            out.append(_report(t["courts_before"].select("court_id", "court_code").exceptAll(t["courts"].select("court_id", "court_code")), "AX-18", "court_id"))
    return report(*out)


def _without_lower(verdicts: DataFrame, low: DataFrame) -> DataFrame:
    """Verdicts of a higher level without one of a lower level on the case or the case it appeals; two equi joins instead of one with "or"."""
    own = verdicts.join(low, (F.col("low_case") == F.col("case_id")) & (F.col("low_l") < F.col("l")), "left_anti")
    return own.join(low, (F.col("low_case") == F.col("appeal_of")) & (F.col("low_l") < F.col("l")), "left_anti")


# Allowed transitions as (from, event, to).
MACHINES = {
    "case_file": (("created", "accepted", "active"), ("active", "appealed", "in_appeal"), ("active", "adjudicated", "decided"), ("in_appeal", "adjudicated", "terminal"), ("decided", "closed", "terminal"), ("decided", "suspended", "on_hold"), ("active", "suspended", "on_hold"), ("on_hold", "resumed", "active")),
    "indictment": (("draft", "issued", "issued"), ("issued", "withdrawn", "withdrawn"), ("issued", "superseded", "superseded")),
    "investigation_conclusion": (("draft", "issued", "issued"), ("issued", "followed_up", "closed")),
    "ruling": (("draft", "issued", "issued"), ("issued", "revoked", "revoked")),
    "verdict": (("pronounced", "effective", "in_force"), ("in_force", "appealed", "under_appeal"), ("in_force", "fully_served", "extinct"), ("in_force", "expired", "extinct")),
    "precedent": (("proposed", "adopted", "in_force"), ("in_force", "repealed", "repealed")),
}


def illegal_steps(df: DataFrame, key: str, at: str, state: str, allowed: DataFrame, row: str) -> DataFrame:
    """Steps from one state to another that ``allowed`` (from_state, to_state) does not have."""
    w = Window.partitionBy(key).orderBy(at, row)
    steps = df.withColumn("from_state", F.lag(state).over(w)).where("from_state is not null").withColumn("to_state", F.col(state))
    return steps.join(small(allowed), ["from_state", "to_state"], "left_anti").select(key, row, "from_state", "to_state")


def juvenile_regime(incident: Column, age: Column) -> Column:
    return F.when(age < 18, F.when(incident >= F.lit("2026-01-01").cast("date"), "ltpctn-2024").otherwise("pre-2026"))


def age_band(age: Column) -> Column:
    return F.when(age < 14, "under_14").when(age < 16, "14_16").when(age < 18, "16_18").otherwise("adult")


# Exit codes with (outcome, whether the case ends).
EXITS = {"EX-01": ("dismissed", True), "EX-02": ("dismissed", True), "EX-03": ("dismissed", True), "EX-04": ("dismissed", True), "EX-05": ("acquitted", True), "EX-06": ("dismissed", True), "EX-07": ("convicted", True), "EX-08": ("settled", True), "EX-09": ("remanded", False), "EX-10": ("dismissed", True), "EX-11": ("remanded", False)}


def exit_outcome(code: Column) -> Column:
    """(outcome, terminal) of an exit code."""
    out = F.lit(None).cast("struct<outcome:string,terminal:boolean>")
    for k, (o, end) in EXITS.items():
        out = F.when(code == k, F.struct(F.lit(o).alias("outcome"), F.lit(end).alias("terminal"))).otherwise(out)
    return out


def decision_path(case_type: Column, incident: Column, confident: Column, all_articles: Column, similarity: Column, age: Column, mitigating: Column, first_offence: Column, cooperative: Column, bar: float = 0.82, diversion: float = 0.7) -> Column:
    """The nodes that a prediction passes, in order."""
    juvenile = F.when(age < 14, F.array(F.lit("J0"), F.lit("J1"), F.lit("J1.exit.no-responsibility"))).otherwise(F.array(F.lit("J0"), F.lit("J1"), F.lit("J2"), F.lit("J3"), F.lit("D6"), F.lit("D7"), F.lit("D8"), F.lit("D9")))
    early = (mitigating >= diversion) & first_offence & cooperative
    adult = F.when(early, F.array(F.lit("D9"))).otherwise(F.array(*(F.lit(f"D{k}") for k in (6, 7, 8, 9))))
    opt = lambda c, name: F.when(c, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    main = F.concat(F.array(F.lit("D0"), F.lit("D1")), opt(~confident, "D1.a"), F.array(F.lit("D2")), opt(~all_articles, "D2.a"), F.array(F.lit("D3")), opt(similarity < bar, "D4.weak"), F.array(F.lit("D4"), F.lit("D5")), F.when(age < 18, juvenile).otherwise(adult))
    return F.when(case_type != "Hình sự", F.array(F.lit("D0"), F.lit("civil.root"))).when(incident.isNull(), F.array(F.lit("D0"), F.lit("request_clarification"))).otherwise(main)


# Factor codes by kind.
FACTORS = {**{f"MIT-{i:02d}": "mitigating" for i in range(1, 7)}, **{f"AGG-{i:02d}": "aggravating" for i in range(1, 6)}}


def apply_factors(df: DataFrame, key: str, factors: str, term: str, weights: DataFrame) -> DataFrame:
    """(key, adjusted): a term times one and the sum of its factors' weights (factor, weight), zero at least; unknown factors count nothing."""
    one = df.select(key, F.explode(F.array_distinct(factors)).alias("factor")).join(small(weights), "factor").groupBy(key).agg(F.sum("weight").alias("w"))
    return df.join(one, key, "left").select(key, F.greatest(F.lit(0.0), F.col(term) * (1 + F.coalesce("w", F.lit(0.0)))).alias("adjusted"))


def sentence_band(df: DataFrame, keys: list[str], term: str, low: str, high: str, cap: str | None = None) -> DataFrame:
    """(keys, band_low, band_high): the middle half of past terms inside the statute's range, under the juvenile cap."""
    p = df.groupBy(*keys).agg(F.percentile(term, F.array(F.lit(0.25), F.lit(0.75))).alias("p"), F.max(low).alias("lo"), F.min(high).alias("hi"), *([F.min(cap).alias("cap")] if cap else []))
    top = F.least("hi", "cap") if cap else F.col("hi")
    return p.select(*keys, F.least(top, F.greatest(F.col("lo"), F.col("p")[0])).alias("band_low"), F.greatest(F.col("lo"), F.least(top, F.col("p")[1])).alias("band_high"))


def severity(max_years: Column) -> Column:
    return F.when(max_years <= 3, "ít nghiêm trọng").when(max_years <= 7, "nghiêm trọng").when(max_years <= 15, "rất nghiêm trọng").when(max_years > 15, "đặc biệt nghiêm trọng")


@dataclass(frozen=True)
class Action:
    """A named validation rule with what happens to rows that break it: quarantine, warn or fail."""

    name: str
    condition: str
    action: str


def validate(df: DataFrame, rules: list[Action]) -> tuple[DataFrame, DataFrame]:
    """(kept with their warnings, quarantined with reasons); a row that breaks a "fail" rule stops the job when it is read."""
    broken = lambda kind: F.filter(F.array(*(F.when(~F.coalesce(F.expr(r.condition), F.lit(False)), r.name) for r in rules if r.action == kind) or F.array().cast("array<string>"), F.lit(None).cast("string")), lambda x: x.isNotNull())
    for r in rules:
        if r.action == "fail":
            df = df.where(F.when(~F.coalesce(F.expr(r.condition), F.lit(False)), F.raise_error(F.lit(f"rule {r.name} is broken")).cast("boolean")).otherwise(True))
    marked = df.withColumns({"warnings": broken("warn"), "reasons": broken("quarantine")})
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


def ecli(df: DataFrame, court: str, year: str, *order: str) -> DataFrame:
    """Adds an identifier with a six-digit ordinal inside court and year."""
    w = Window.partitionBy(court, year).orderBy(*order)
    return df.withColumn("ecli", F.concat_ws(":", F.lit("ECLI:VN"), F.col(court).cast("string"), F.col(year).cast("string"), F.lpad(F.row_number().over(w).cast("string"), 6, "0")))


def eli(code_id: Column, article: Column, clause: Column | None = None, point: Column | None = None) -> Column:
    parts = [F.lit("eli:vn:law"), code_id, F.lit("article"), article.cast("string")]
    tail = [F.concat(F.lit("clause:"), clause.cast("string"))] if clause is not None else []
    tail += [F.concat(F.lit("point:"), point)] if point is not None else []
    return F.concat_ws(":", *parts, *tail)


def precedent_slug(number: Column) -> Column:
    g = [F.regexp_extract(number, r"(?U)(\d+)\s*/\s*(\d{4})\s*/\s*([A-Z]+)", k) for k in (1, 2, 3)]
    return F.when(g[0] != "", F.concat_ws("-", F.lit("eli:vn:precedent:AL"), g[0], g[1]))


def split(key: Column, held: Column | None = None, buckets: int = 100, test: int = 10, dev: int = 10) -> Column:
    """train, dev or test by the first hex digits of a key's SHA-256; rows that ``held`` names are test."""
    b = F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, 8), 16, 10).cast("long") % buckets
    s = F.when(b < test, "test").when(b < test + dev, "dev").otherwise("train")
    return s if held is None else F.when(held, "test").otherwise(s)


def leaks(train: DataFrame, test: DataFrame, key: str, day: str, cutoff: str) -> DataFrame:
    """(cutoff, n_late, n_shared): training rows after the cutoff, and keys that both sides have."""
    late = train.agg(F.count_if(F.col(day) > F.lit(cutoff).cast("date")).alias("n_late"))
    shared = train.select(key).distinct().join(test.select(key).distinct(), key, "left_semi").agg(F.count("*").alias("n_shared"))
    return late.join(F.broadcast(shared)).select(F.lit(cutoff).alias("cutoff"), "n_late", "n_shared")


def guard(df: DataFrame, day: str) -> Column:
    """What may be said about a case of that day: nothing before 1986-01-01."""
    return F.when(F.col(day).isNull(), "missing_date").when(F.col(day) < F.lit("1986-01-01").cast("date"), "insufficient_coverage").otherwise("ok")


def keyword_hits(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a + b, (F.lower(text).contains(w.lower()).cast("int") for w in words))


def hybrid(df: DataFrame, key: str, keyword: str, similarity: str, weight: float, k: int) -> DataFrame:
    """The k best by a weighted sum of keyword and vector scores; ties by key."""
    return df.withColumn("score", weight * F.col(keyword) + (1 - weight) * F.col(similarity)).orderBy(F.desc("score"), key).limit(k)


def json_ld(df: DataFrame, kind: str, key: Column, *columns: str) -> DataFrame:
    """One JSON-LD object for each row."""
    return df.select(F.to_json(F.struct(F.lit("https://schema.org/Legislation").alias("@context"), F.lit(kind).alias("@type"), key.alias("@id"), *columns)).alias("json_ld"))
