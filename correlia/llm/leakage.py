"""Evaluation texts leaking into training text (problem 8): a BM25 index of the test items, block-max WAND, then alignment.

The items are the index, every passage of every document is a query. Terms are pairs of adjacent words (for items in Chinese,
trigrams of characters) with case, marks, markup and character forms looked aside. An item's threshold is a
fixed share of the least BM25 score of any stretch of half its words: what is left of it after more than one
word in ten is gone.

A passage is answered by block-max WAND over blocks of BLOCK items, many passages at a time. Passages whose terms cannot
reach any block's need with their greatest scores are dropped first. A block is a pivot if the maxima of the passage's
terms in it together reach the least that any item of it asks for; the terms' lists are read at the pivots alone, and what they
hold between is skipped. Every item that reaches its threshold is verified by the best local alignment in order, over
all matching words.

Passages overlap by half and are as long as twice the longest stretch asked for, so every such stretch lies whole in
one. Documents are handled whole, without a shuffle. An index holds about ITEMS items at most, and one pass over the documents
carries TOGETHER indexes, so what is broadcast is bounded whatever the number of items.

The items of this project are running text without a marked question or answer: the opening half stands for the one and the
closing half for the other, and their coverage is reported apart.

Defined cases: null and empty documents or items match nothing; items of fewer than LEAST words, which have no stretch to
tell them by, are found where all their words stand together in order; repeated rows of a doc_id or item_id give one
result; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HALF, LOST, K1, B, BLOCK, ITEMS, TOGETHER, LEAST = 0.5, 0.12, 1.2, 0.75, 4, 4000, 16, 6
#: Share of the score of half an item that a leak keeps at least: a word lost costs two pairs, a character three trigrams.
KEPT = 0.42
#: Alignment: price of an unmatched step; share of the stretch that must match, on the item's and on the document's side.
STEP, DENSE, DENSE_HERE = 1.5, 0.8, 0.72

_TAG = re.compile(r"</?[A-Za-z][^<>]{0,80}>")
_GONE = re.compile("[​‌‍⁠﻿­]")
_WORD = re.compile(r"[^\W_]+")
_HAN = re.compile("[㐀-鿿]")


def plain(text: str) -> str:
    if "<" in text:
        text = _TAG.sub("", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _GONE.sub("", text))
    return text.lower()


def words(text: str) -> list[str]:
    return _WORD.findall(text)


def characters(text: str) -> list[str]:
    return [c for c in text if c.isalnum()]


def trigrams(chars: list[str]) -> list[str]:
    joined = "".join(chars)
    return [joined[i : i + 3] for i in range(len(joined) - 2)] if len(joined) == len(chars) else ["".join(chars[i : i + 3]) for i in range(len(chars) - 2)]


def pairs(tokens: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


class Index:
    """BM25 impacts of one kind of item (words or characters), with postings by item and by block of items."""

    def __init__(self, items: list[tuple[int, list[str]]], by_character: bool):
        self.by_character = by_character
        terms = [trigrams(t) if by_character else pairs(t) for _, t in items]
        # Items that share terms come together, so that blocks are coherent.
        order = sorted(range(len(items)), key=lambda i: sorted(terms[i])[:1])
        self.ids = [items[i][0] for i in order]
        self.tokens = [items[i][1] for i in order]
        terms = [terms[i] for i in order]
        n = len(terms)
        df: dict[str, int] = {}
        for t in terms:
            for x in set(t):
                df[x] = df.get(x, 0) + 1
        mean = sum(map(len, terms)) / max(1, n)
        self.vocabulary: dict[str, int] = {}
        cells: dict[int, list[tuple[int, float]]] = {}
        self.threshold = np.zeros(n)
        for i, t in enumerate(terms):
            tf: dict[str, int] = {}
            for x in t:
                tf[x] = tf.get(x, 0) + 1
            impact = {x: np.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(t) / mean)) for x, f in tf.items()}
            span = max(1, ceil(HALF * len(t)) - 1)
            least = np.inf
            for a in range(max(1, len(t) - span + 1)):
                least = min(least, sum(impact[x] for x in set(t[a : a + span])))
            self.threshold[i] = KEPT * least
            for x, s in sorted(impact.items()):
                k = self.vocabulary.setdefault(x, len(self.vocabulary))
                cells.setdefault(k, []).append((i, s))
        m = len(self.vocabulary)
        self.blocks = ceil(n / BLOCK)
        full = [(k, i, s) for k in range(m) for i, s in cells[k]]
        # By term: its items and scores, and its blocks with their maxima; all lists end to end.
        key, self.post_item, self.post_score = np.array([k for k, _, _ in full], dtype=np.int64), np.array([i for _, i, _ in full], dtype=np.int64), np.array([s for *_, s in full])
        self.post_begin, self.post_end = np.searchsorted(key, np.arange(m)), np.searchsorted(key, np.arange(m), side="right")
        cell, place = np.unique(key * self.blocks + self.post_item // BLOCK, return_inverse=True)
        self.list_most = np.zeros(len(cell))
        np.maximum.at(self.list_most, place, self.post_score)
        self.list_block = cell % self.blocks
        self.list_begin, self.list_end = np.searchsorted(cell // self.blocks, np.arange(m)), np.searchsorted(cell // self.blocks, np.arange(m), side="right")
        self.most = np.zeros(m)
        np.maximum.at(self.most, key, self.post_score)
        # What a block asks for at least; a little less, as sums are rounded.
        self.threshold -= 1e-9
        self.block_need = np.array([self.threshold[b * BLOCK : (b + 1) * BLOCK].min() for b in range(self.blocks)])
        self.need = self.block_need.min() if self.blocks else 0.0
        longest = max((len(t) for t in terms), default=2)
        self.half = ceil(longest * HALF * (1 + LOST)) + 2

    def candidates(self, streams: list[list[str]]) -> list[tuple[int, int, int]]:
        """(stream, item, first position of the passage) of the passages that reach an item's threshold."""
        get = self.vocabulary.get
        ids = [np.fromiter((get(x, -1) for x in s), dtype=np.int64, count=len(s)) for s in streams]
        lengths = np.array([len(x) for x in ids])
        if not lengths.sum():
            return []
        flat = np.concatenate(ids)
        stream = np.repeat(np.arange(len(ids)), lengths)
        position = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        # Passage k of a stream covers the positions [k * half, (k + 2) * half).
        most = int(lengths.max()) // self.half + 2
        home = stream * most + position // self.half
        first = flat >= 0
        passage, term = self._passages(flat[first], home[first], position[first])
        # Passages whose terms cannot reach any block's need together have no pivot.
        seen, dense = np.unique(passage, return_inverse=True)
        hopeful = np.bincount(dense, weights=self.most[term], minlength=len(seen)) >= self.need
        # The pivots: blocks whose maxima reach their need.
        sure = hopeful[dense]
        passage, term = passage[sure], term[sure]
        row, owner = self._spread(self.list_begin, self.list_end, term)
        cell, place = np.unique(passage[owner] * self.blocks + self.list_block[row], return_inverse=True)
        reach = np.bincount(place, weights=self.list_most[row], minlength=len(cell))
        held = cell[reach >= self.block_need[cell % self.blocks]]
        if not len(held):
            return []
        # The lists of those passages, read at their pivots alone; what a list holds between pivots is skipped.
        mine = np.isin(passage, held // self.blocks)
        row, owner = self._spread(self.post_begin, self.post_end, term[mine])
        passage = passage[mine][owner]
        where = passage * self.blocks + self.post_item[row] // BLOCK
        at = np.minimum(np.searchsorted(held, where), len(held) - 1)
        right = held[at] == where
        n = len(self.ids)
        pair, place = np.unique(passage[right] * n + self.post_item[row[right]], return_inverse=True)
        score = np.bincount(place, weights=self.post_score[row[right]], minlength=len(pair))
        won = pair[score >= self.threshold[pair % n]].tolist()
        return [(w // n // most, w % n, w // n % most * self.half) for w in won]

    @staticmethod
    def _spread(begin: np.ndarray, end: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the lists of each term, and which term each row is for."""
        count = end[term] - begin[term]
        owner = np.repeat(np.arange(len(term)), count)
        return np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + begin[term][owner], owner

    def _passages(self, term: np.ndarray, home: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (passage, term): every word counts in the passage it opens and in the one before."""
        inner = position >= self.half
        both = np.unique(np.concatenate([home, home[inner] - 1]) * len(self.vocabulary) + np.concatenate([term, term[inner]]))
        return both // len(self.vocabulary), both % len(self.vocabulary)


def align(item: list[str], stream: list[str], begin: int, end: int) -> tuple[int, int, int, int, int] | None:
    """(matched, item start, item end, start, end) of the best local alignment in order within stream[begin:end].

    A match counts 1, a step over unmatched words STEP for each (on the side that skips more). All pairs of equal words take
    part. None if too few of the item's words stand there for a leak.
    """
    at: dict[str, list[int]] = {}
    asked = set(item)
    for p in range(max(0, begin), min(end, len(stream))):
        if (x := stream[p]) in asked:
            at.setdefault(x, []).append(p)
    if sum(x in at for x in item) < DENSE * (HALF * len(item) - 1):
        return None
    rows = [(k, at[x]) for k, x in enumerate(item) if x in at]
    ks = np.repeat([k for k, _ in rows], [len(p) for _, p in rows])
    ps = np.concatenate([p for _, p in rows])
    score, back = np.ones(len(ks)), np.full(len(ks), -1)
    end = 0
    for k, here in rows:
        # All matches of one word of the item at once; a chain comes from matches of a smaller k and p.
        begin, end = end, end + len(here)
        if begin:
            dp = ps[begin:end, None] - ps[None, :begin]
            gain = score[:begin] - STEP * (np.maximum(k - ks[:begin], dp) - 1)
            gain[dp <= 0] = 0.0
            m = gain.argmax(axis=1)
            most = gain[np.arange(end - begin), m]
            score[begin:end] += np.maximum(most, 0.0)
            back[begin:end] = np.where(most > 0, m, -1)
    j = int(score.argmax())
    k1, p1, matched = int(ks[j]) + 1, int(ps[j]) + 1, 1
    while back[j] >= 0:
        j, matched = int(back[j]), matched + 1
    return matched, int(ks[j]), k1, int(ps[j]), p1


def leaked(item: list[str], found: tuple[int, int, int, int, int] | None) -> bool:
    if found is None:
        return False
    matched, a, b, c, d = found
    return b - a >= HALF * len(item) - 1 and matched >= DENSE * (b - a) and matched >= DENSE_HERE * (d - c)


class Phrases:
    """Items too short for a stretch: found where all their words (characters) stand together in order."""

    def __init__(self, items: list[tuple[int, list[str]]], by_character: bool):
        self.by_character = by_character
        self.ids, self.tokens = [i for i, _ in items], [t for _, t in items]
        self.first: dict[str, list[int]] = {}
        for j, t in enumerate(self.tokens):
            self.first.setdefault(t[0], []).append(j)

    def candidates(self, stream: list[str]) -> set[int]:
        return {j for p, x in enumerate(stream) for j in self.first.get(x, ()) if stream[p : p + len(self.tokens[j])] == self.tokens[j]}


def covered(a: int, b: int, lo: float, hi: float) -> float:
    """Share of [lo, hi) that lies in [a, b)."""
    return max(0.0, min(b, hi) - max(a, lo)) / (hi - lo)


def find_leaks(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", item_lang: str = "lang") -> DataFrame:
    """(id_col, item_id, proporcion, coinciden, inicio, final): the documents that hold at least half of an item in one stretch.

    Share of the item covered, words matched, and the shares covered of its opening and of its closing half.
    """
    spark = documents.sparkSession
    kind, item_kind = dict(documents.dtypes)[id_col], dict(items.dtypes)[item_id]
    schema = f"{id_col} {kind}, {item_id} {item_kind}, proporcion double, coinciden int, inicio double, final double"
    keyed = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t"), F.col(item_lang).alias("l")).where("i is not null and t is not null").groupBy("i").agg(F.min(F.struct("t", "l")).alias("m"))
    parts = max(1, ceil(keyed.count() / (ITEMS / 2)))
    keyed = keyed.select("i", "m.t", "m.l", F.pmod(F.xxhash64("i"), F.lit(parts)).alias("part"))
    out = None
    for begin in range(0, parts, TOGETHER):
        rows = keyed.where(F.col("part").between(begin, begin + TOGETHER - 1)).orderBy("i").collect()
        indexes: list[Index | Phrases] = []
        for part in range(begin, min(begin + TOGETHER, parts)):
            mine = [(r["i"], (r["l"] or "").lower() == "zh", plain(r["t"])) for r in rows if r["part"] == part]
            for by_character, cut in ((False, words), (True, characters)):
                tokens = [(i, cut(t)) for i, zh, t in mine if zh == by_character]
                if long := [x for x in tokens if len(x[1]) >= LEAST]:
                    indexes.append(Index(long, by_character))
                if short := [x for x in tokens if 0 < len(x[1]) < LEAST]:
                    indexes.append(Phrases(short, by_character))
        known = spark.sparkContext.broadcast(indexes)

        def search(batches: Iterator[pd.DataFrame], known=known) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                texts = [plain(t) if t else "" for t in pdf[text]]
                ids = pdf[id_col].tolist()
                found: dict[tuple, tuple] = {}
                for index in known.value:
                    some = [j for j, t in enumerate(texts) if not index.by_character or _HAN.search(t)]
                    for at in range(0, len(some), 500):
                        mine = some[at : at + 500]
                        streams = [characters(texts[j]) if index.by_character else words(texts[j]) for j in mine]
                        if isinstance(index, Phrases):
                            found.update({(ids[j], index.ids[i]): (1.0, len(index.tokens[i]), 1.0, 1.0) for j, s in zip(mine, streams) for i in index.candidates(s)})
                            continue
                        asked = [trigrams(s) if index.by_character else pairs(s) for s in streams]
                        for s, i, begin in index.candidates(asked):
                            item = index.tokens[i]
                            key = (ids[mine[s]], index.ids[i])
                            if key in found:
                                continue
                            hit = align(item, streams[s], begin - len(item) // 2, begin + 2 * index.half + len(item) // 2 + 3)
                            if leaked(item, hit):
                                n, (matched, a, b, *_) = len(item), hit
                                found[key] = ((b - a) / n, matched, covered(a, b, 0, n / 2), covered(a, b, n / 2, n))
                out = pd.DataFrame([(*k, *v) for k, v in found.items()], columns=[id_col, item_id, "proporcion", "coinciden", "inicio", "final"])
                yield out.round({"proporcion": 6, "inicio": 6, "final": 6})

        got = documents.select(id_col, text).where(F.col(id_col).isNotNull() & F.col(text).isNotNull()).mapInPandas(search, schema)
        out = got if out is None else out.unionByName(got)
    # A doc_id that recurs gives one row per item.
    return out.groupBy(id_col, item_id).agg(*[F.max(c).alias(c) for c in ("proporcion", "coinciden", "inicio", "final")])
