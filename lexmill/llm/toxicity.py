"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text and normalised by length.

Folding lowers case, takes accents and look-alike letters of other scripts to Latin ones, reads digits and signs inside
words as the letters they stand for, and drops invisible characters. The lexicon holds word beginnings and whole words with
log-odds weights; exception phrases cancel the hits inside them. A logistic curve over summed weight, weight for each
hundred words and the largest weight gives the score.
"""

from __future__ import annotations

import bisect
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.base import carried, slices, text_or_empty, texts_of
from lexmill.session import stored

# Look-alike letters of Greek and Cyrillic, and letters without a decomposition.
_ALIKE = dict(zip("абвгдеёзийкмнорстухчьіїјѕԁԛԝһӏαβγδεζηικμνορστυχωοа", "abbrdeeзийkmhopctyxчbiijsdqwhlabydeznikuvopctuxwoa", strict=True))
_PLAIN = {"ı": "i", "ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ß": "ss", "æ": "ae", "œ": "oe", "ɑ": "a", "ɡ": "g"}
# Digits and signs that stand for letters inside words.
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
_SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "+": "t"}
_ONE = str.maketrans(_ALIKE | _PLAIN)
_INVISIBLE = re.compile("[­̀-ͯ͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯︀-️﻿]+")
_SIGN = re.compile(r"(?<=[^\W_])[@$!|€+]+(?=[^\W_])")
_DIGIT = re.compile(r"\d+[^\W\d_]+(?:\d+(?![^\W_]))?|(?<=[^\W\d_])\d+(?=[^\W\d_])")
_GAP = re.compile(r"[\W_]+")
#: Letters of a learned word beginning.
SHORTEST, LONGEST = 4, 7


def fold(text: str) -> str:
    """The words of a text in folded form, with one space before, between and after them."""
    t = text.lower()
    if not t.isascii():
        t = _INVISIBLE.sub("", unicodedata.normalize("NFKD", t)).translate(_ONE)
    t = _SIGN.sub(lambda m: "".join(_SIGNS[c] for c in m[0]), t)
    t = _DIGIT.sub(lambda m: "".join(_DIGITS.get(c, c) for c in m[0]), t)
    return f" {_GAP.sub(' ', t).strip()} "


@dataclass
class Lexicon:
    """terms: folded word beginnings (" lose") or whole words (" loser ") with weights; phrases: folded exceptions (" not a loser "); curve: of the score."""

    terms: dict[str, float] = field(default_factory=dict)
    phrases: tuple[str, ...] = ()
    curve: tuple[float, float, float, float] = (-4.0, 1.5, 0.5, 0.5)

    def matcher(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for t, w in self.terms.items():
            a.add_word(t, (len(t), w))
        for p in self.phrases:
            a.add_word(p, (len(p), None))
        a.make_automaton()
        return a


def hits(matcher, folded: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) in a folded text: the longest term at each word, without those that an exception phrase covers."""
    best: dict[int, tuple[int, float]] = {}
    clear = []
    if not len(matcher):
        return []
    for end, (size, weight) in matcher.iter(folded):
        start = end - size + 1
        if weight is None:
            clear.append((start, end + 1))
        elif start not in best or size > best[start][0]:
            best[start] = size, weight
    # of the phrases that begin at a place or before it, the one that reaches furthest
    clear.sort()
    starts, reach = [a for a, _ in clear], list(accumulate((b for _, b in clear), max))
    out = []
    for s, (n, w) in best.items():
        k = bisect.bisect_right(starts, s)
        if not k or reach[k - 1] < s + n:
            out.append((s, s + n, w))
    return out


def features(matcher, text: str) -> tuple[float, float, float, int]:
    """Logarithm of the summed weight, weight for each hundred words, largest weight, number of hits."""
    folded = fold(text)
    spans = hits(matcher, folded)
    if not spans:
        return 0.0, 0.0, 0.0, 0
    found = Counter((folded[s:e], w) for s, e, w in spans)
    # a term's weight counts in full once, then by the logarithm of how often it comes again
    total = sum(w * (1 + math.log(n)) for (_, w), n in found.items())
    return math.log1p(max(0.0, total)), min(10.0, 100 * total / max(1, folded.count(" ") - 1)), max(w for _, w in found), len(spans)


def score(curve, f) -> float:
    z = curve[0] + curve[1] * f[0] + curve[2] * f[1] + curve[3] * f[2]
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _beginnings(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        if len(w) >= SHORTEST - 1:
            out.add(f" {w} ")
            out.update(f" {w[:n]}" for n in range(SHORTEST, min(LONGEST, len(w)) + 1))
    return out


def _counted(rows: DataFrame, count, schema: str = "term string, bad long, good long") -> DataFrame:
    """Sums (term, bad, good) that ``count(texts, toxic)`` gives for each batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good = Counter(), Counter()
        for whole in parts:
            for b in slices(whole):
                count(text_or_empty(b.column("text")), b.column("toxic").to_pylist(), bad, good)
        terms = sorted(bad.keys() | good.keys())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([bad[t] for t in terms], pa.int64()), pa.array([good[t] for t in terms], pa.int64())], ["term", "bad", "good"])

    return rows.mapInArrow(run, schema).groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def fit(rows: DataFrame, max_terms: int = 40_000, least: int = 4, phrases: tuple[str, ...] = (), max_phrases: int = 2_000) -> Lexicon:
    """A lexicon of training rows (id, text, toxic), as ``training_rows`` gives them.

    Three passes: beginnings and words of toxic texts (the ``max_terms`` most frequent ones found in ``least`` texts or
    more), their counts in the other texts, and the features and exception phrases (``phrases`` and the ``max_phrases`` most frequent ones of clean texts). Both
    bounds hold the model, which goes to every worker, to a few MB. Terms and phrases of one frequency are taken in alphabetical order. Rows of a null text count as
    empty ones. Without rows of both classes the lexicon is empty.
    """
    sizes = {int(r["toxic"]): r["count"] for r in rows.groupBy(F.col("toxic").cast("int").alias("toxic")).count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Lexicon(curve=(math.log((n1 + 0.5) / (n0 + 0.5)) if n1 + n0 else -4.0, 0.0, 0.0, 0.0))

    def of_toxic(texts, toxic, bad, good):
        for t, y in zip(texts, toxic, strict=True):
            if y == 1:
                bad.update(_beginnings(fold(t)))

    found = _counted(rows.where("toxic = 1"), of_toxic).where(F.col("bad") >= least).orderBy(F.desc("bad"), "term").limit(max_terms).collect()
    bad = {r["term"]: r["bad"] for r in found}

    def of_rest(texts, toxic, bad_, good):
        for t, y in zip(texts, toxic, strict=True):
            if y == 0:
                good.update(x for x in _beginnings(fold(t)) if x in bad)

    good = {r["term"]: r["good"] for r in _counted(rows.where("toxic = 0"), of_rest).collect()}
    odds = {t: math.log((b + 0.5) / (n1 + 1)) - math.log((good.get(t, 0) + 0.5) / (n0 + 1)) for t, b in bad.items()}
    terms: dict[str, float] = {}
    base, bar = n1 / (n1 + n0), math.log(max(2, len(bad)) / 0.02)

    def sure(t: str) -> bool:
        """Whether chance alone would hardly put any of the candidates in so many toxic texts and so few others."""
        b, g = bad[t], good.get(t, 0)
        return odds[t] >= 2.5 and b * math.log(b / (b + g) / base) + (g * math.log(g / (b + g) / (1 - base)) if g else 0) >= bar

    for t in sorted(filter(sure, odds), key=lambda t: (len(t), t)):
        stem = next((t[:k] for k in range(SHORTEST + 1, len(t)) if t[:k] in terms), None)
        if stem is None or (bad[t] >= 0.8 * bad[stem] and odds[t] > odds[stem] + 0.3):
            # a longer one that keeps the toxic texts and leaves clean ones replaces its beginning
            terms.pop(stem, None)
            terms[t] = min(6.0, odds[t])
    lex = Lexicon(terms, tuple(fold(p) for p in phrases))
    first = lex.matcher

    def of_phrases(texts, toxic, bad_, good_):
        m = first()
        for t, y in zip(texts, toxic, strict=True):
            f = fold(t)
            seen = set()
            for s, e, _ in hits(m, f):
                stop = f.index(" ", s + 1)
                before = f.rfind(" ", 0, s) if s else -1
                after = f.find(" ", stop + 1)
                seen.add(f[s : stop + 1])
                if before >= 0:
                    seen.add(f[before : stop + 1])
                if after >= 0:
                    seen.add(f[s : after + 1])
            (bad_ if y == 1 else good_).update(seen)

    learned = _counted(rows, of_phrases).where("good >= 3 and bad = 0").orderBy(F.desc("good"), "term").limit(max_phrases).collect()
    lex.phrases += tuple(r["term"] for r in learned)
    every = lex.matcher

    def run(parts):
        m = every()
        for whole in parts:
            for b in slices(whole):
                f = [features(m, t) for t in text_or_empty(b.column("text"))]
                cols = [pa.array([x[i] for x in f], pa.float64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*cols, b.column("toxic").cast(pa.int32())], ["a", "b", "c", "y"])

    got = rows.mapInArrow(run, "a double, b double, c double, y int").groupBy(*(F.round(c, 2).alias(c) for c in "abc"), "y").count().toPandas()
    lex.curve = _logistic(got[["a", "b", "c"]].to_numpy(), got["y"].to_numpy(float), got["count"].to_numpy(float))
    return lex


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.05) -> tuple[float, float, float, float]:
    """Newton steps for a ridge logistic curve whose slopes stay at zero or above."""
    x = np.column_stack([np.ones(len(x)), x])
    live = np.ones(4, bool)
    for _ in range(4):
        w = np.zeros(4)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x[:, live] @ w[live], -40, 40)))
            g = x[:, live].T @ (n * (y - p)) - ridge * w[live]
            h = (x[:, live] * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x[:, live] + ridge * np.eye(live.sum())
            step = np.linalg.solve(h, g)
            w[live] += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        down = (w < 0) & live
        down[0] = False
        if not down.any():
            break
        live &= ~down
    return tuple(float(v) for v in np.where(live, w, 0.0))


@lru_cache(4)
def _automaton(key: tuple):
    return Lexicon(dict(key[0]), key[1]).matcher()


def toxicity(df: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """(id, score, predicted, n_hits) of every row: score in [0, 1], predicted 1 where it is 0.5 or more.

    Only the text counts. Null and empty texts have no hits and the score that the curve gives for none. Repeated rows come out as
    often as they went in, equal texts score alike, an empty table gives no rows. Of terms that begin at one place the longest counts. With ``whole`` the first column is ``row``, a struct of all columns of ``df``
    whatever they are called; else other columns are ignored.
    """
    source, kind, first = carried(df, id_col, text_col, whole)
    key, curve = (tuple(sorted(lexicon.terms.items())), tuple(lexicon.phrases)), lexicon.curve

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _automaton(key)
        for batch in parts:
            for b in slices(batch, 0 if whole else "text"):
                found = [features(m, t) for t in text_or_empty(texts_of(b, text_col, whole))]
                scores, counts = [score(curve, f) for f in found], [f[3] for f in found]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(counts, pa.int32())], ["first", "score", "predicted", "n_hits"])

    return source.mapInArrow(run, f"first {kind}, score double, predicted int, n_hits int").withColumnRenamed("first", first)


def held_out(id_col: str = "doc_id"):
    """Whether an id's crc32 leaves no remainder by 5; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = 30_000) -> DataFrame:
    """Rows (id, text, toxic) that aren't held out: all of them, or the ``max_rows`` whose ids have the smallest hashes.

    Labels are reduced to that bound before they meet texts, so that they go to the workers (two numbers a row) and no text is shuffled.
    """
    y = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null and id is not null").where(~held_out("id"))
    y = y.orderBy(F.xxhash64(F.lit(9), "id"), "id", "toxic").limit(max_rows)
    return stored(docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(y), "id"), "labelled")
