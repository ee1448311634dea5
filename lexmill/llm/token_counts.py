"""Token counts by rank-synchronous merging of ragged arrays.

A piece model's text form starts with a word mark and has it for every space; no piece holds a mark after another
character, so runs between those places (pre-tokens) merge on their own. Distinct pre-tokens of a batch stand one after
another in flat numpy arrays (symbol, owner). In each round every pre-token merges the leftmost of its pairs of lowest
rank, all pre-tokens at once; pre-tokens without a pair leave the arrays. Survivors are counted, characters without a
piece as their UTF-8 bytes. Pre-tokens longer than a window are merged in windows that overlap, so that the rounds are bounded
whatever a pre-token's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm.base import WINDOW, slices, stitched, text_or_empty, windows

MARK = "▁"
_PRE = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Pre-tokens whose counts a Python worker keeps; at twice as many the older ones go.
KEPT = 250_000


class PieceModel:
    """The merge table of a sentencepiece BPE model: every way to cut a piece into two symbols."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        if any(MARK in p[1:] and p.strip(MARK) for p in pieces):
            raise ValueError("a piece of this model crosses words")
        if sp.normalize("é a") != f"{MARK}é{MARK}a":
            raise ValueError("this model changes texts before it encodes them")
        self.fallback = any(sp.is_byte(i) for i in range(sp.vocab_size()))
        symbols = dict.fromkeys(pieces) | dict.fromkeys(c for p in pieces for c in p)
        self.ids = {s: i for i, s in enumerate(symbols)}
        # Equal scores are one rank: among them the leftmost pair goes first.
        order = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        rows = [(self.ids[p[:k]], self.ids[p[k:]], order[s], self.ids[p]) for p, s in pieces.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        n = len(self.ids)
        self.width = n + 1
        left, right, rank, made = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        key = left * self.width + right
        by = np.argsort(key)
        self.keys, self.rank, self.made = key[by], rank[by], made[by]
        self.piece = np.zeros(n + 1, bool)
        self.piece[[self.ids[p] for p in pieces]] = True
        self.char = {c: i for c, i in self.ids.items() if len(c) == 1}
        self.none = n

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = self._merged([w if len(w) <= WINDOW else w[:1] for w in words])[0]
        for k, w in enumerate(words):
            if len(w) > WINDOW:
                out[k] = self._long(w)
        return out

    def _long(self, word: str) -> int:
        def merge(spans):
            out = [[] for _ in spans]
            for i in range(0, len(spans), 2_000):
                part = spans[i : i + 2_000]
                _, own, start, sym, weight = self._merged([word[a:b] for a, b in part], True)
                for o, x, s, w in zip(own.tolist(), start.tolist(), sym.tolist(), weight.tolist(), strict=True):
                    out[i + o].append((part[o][0] + x, (s, w)))
            return out

        return sum(w for _, (_, w) in stitched(windows(len(word)), merge))

    def _merged(self, words: list[str], survivors: bool = False) -> tuple[np.ndarray, ...]:
        """(tokens of each pre-token); with ``survivors`` also (pre-token, place in it, symbol, tokens) of all symbols that are left, in order."""
        lengths = np.array([len(w) for w in words], np.int64)
        flat = "".join(words)
        points = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
        distinct, inverse = np.unique(points, return_inverse=True)
        sym = np.array([self.char.get(chr(c), self.none) for c in distinct], np.int64)[inverse]
        size = np.where(distinct < 0x80, 1, np.where(distinct < 0x800, 2, np.where(distinct < 0x10000, 3, 4)))[inverse]
        own = np.repeat(np.arange(len(words)), lengths)
        total = np.zeros(len(words), np.int64)
        place_in = np.arange(len(sym)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left: list[tuple[np.ndarray, ...]] = []
        far = np.int64(1) << 62
        while len(sym):
            key = sym[:-1] * self.width + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = (self.keys[at] == key) & (own[:-1] == own[1:])
            # rank first, then place: its minimum in a pre-token is the leftmost pair of lowest rank
            cost = np.full(len(sym), far)
            cost[:-1][ok] = self.rank[at[ok]] * len(sym) + np.flatnonzero(ok)
            firsts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            best = np.minimum.reduceat(cost, firsts)
            ended = np.repeat(best == far, np.diff(np.append(firsts, len(sym))))
            if ended.any():
                weight = np.where(self.piece[sym[ended]], 1, size[ended] if self.fallback else 1)
                total += np.bincount(own[ended], weight, len(words)).astype(np.int64)
                if survivors:
                    left.append((own[ended], place_in[ended], sym[ended], weight))
            place = best[best != far] % len(sym)
            sym[place] = self.made[at[place]]
            keep = ~ended
            keep[place + 1] = False
            sym, own, size, place_in = sym[keep], own[keep], size[keep], place_in[keep]
        if not survivors:
            return (total,)
        cols = [np.concatenate(x) for x in zip(*left, strict=True)]
        by = np.lexsort((cols[1], cols[0]))
        return total, *(c[by] for c in cols)


@lru_cache(2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


class Counter:
    """Counts texts; keeps the counts of pre-tokens it has seen, in two generations of bounded size."""

    def __init__(self, m: PieceModel):
        self.m, self.new, self.old = m, {}, {}

    def __call__(self, texts: list[str]) -> list[int]:
        split = [_PRE.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.new) > KEPT:
            self.new, self.old = {}, self.new
        new, missing = self.new, set()
        for words in split:
            missing.update(words)
        missing = [w for w in missing if w not in new]
        if self.old:
            old, rest = self.old, []
            for w in missing:
                if w in old:
                    new[w] = old[w]
                else:
                    rest.append(w)
            missing = rest
        for i in range(0, len(missing), 50_000):
            part = missing[i : i + 50_000]
            new.update(zip(part, self.m.counts(part).tolist(), strict=True))
        return [sum(map(new.__getitem__, words)) for words in split]


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(model(path))


def token_counts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of ``df``, as the model's own library counts it, without begin or end tokens.

    A null text counts as an empty one: 0 bytes, 0 tokens. Repeated rows come out as often as they went in, other columns are
    ignored, an empty table gives no rows. Of pairs of one rank in a pre-token the leftmost goes first. Texts are taken whole; a pre-token of any length is merged to its end.
    """
    source = df.select(df[id_col].alias("__id"), df[text_col].alias("text"))
    kind = source.schema["__id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_path)
        for whole in parts:
            for batch in slices(whole):
                texts = text_or_empty(batch.column("text"))
                n = np.array(count(texts), np.int64)
                sizes = pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("__id"), sizes, pa.array(n), pa.array(n > limit)], ["__id", "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(run, f"__id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("__id", id_col)
