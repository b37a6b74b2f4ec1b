"""Sentence boundaries across languages and scripts (problem 2), by document-centred disambiguation.

A mark that may end a sentence is judged by the word before it and the word after it. For both, unambiguous
occurrences elsewhere in the same document decide first (weight DOCUMENT), those of the whole corpus fall
back: how often a word stands at a sure sentence start (start of a text, after ? or !, after a line that ends)
against a sure inner place; how often a word stands with a period before a lower-case word, with a period at
the end of a text, or without one. From these follow abbreviations, proper names and sentence openers; no list
of abbreviations is built in.

Script rules: the marks of CJK text end a sentence without a blank; in Devanagari a period only abbreviates; in
Thai text blanks and line breaks part sentences; a period between digits is a decimal mark. Closing quotes and
brackets go to the sentence they enclose; a quotation or bracket that opened within a sentence does not end
it. A line break ends a sentence that lacks its mark; in text wrapped by a page (`wrapped`) only where
the words around it say so.

The corpus statistics count every text and keep every word. Words of at least SHARE of all tokens (at most 1 / SHARE of
them) are broadcast; the rarer words that a text's own marks ask about are joined to it by a shuffle, so what is known
of a word does not depend on the size of the corpus. Time is linear in the length of a text.

Defined cases: null and blank texts have no sentence; texts of any length are cut whole; offsets count code
points of the stored text, without blanks around; repeated rows give the same sentences (once per key).
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from correlia.runtime import durable

SHARE, COMMON, DOCUMENT, SHAPE, FLUSH, MEMO = 1e-5, 5e-4, 5, 3, 200_000, 300_000
#: Marks, closers and openers by script.
PLAIN, WIDE, ENDS = ".!?…؟۔।॥", "。！？．｡", "?!؟"
CLOSERS, OPENERS = "\"'”’»)]}）」』】›", "\"'“‘«([{（「『【‹¿¡„"
QUOTES = {"”": "“", "’": "‘", "»": "«", ")": "(", "]": "[", "}": "{", "）": "（", "」": "「", "』": "『", "】": "【", "›": "‹"}

_TOKEN = re.compile(r"\S+")
_DIGITS = re.compile(r"\d+(?:[.,]\d+)*")
_DECIMAL, _INTEGER = re.compile(r"\d+(?:[.,]\d+)+"), re.compile(r"\d+")
_THAI, _DEVA, _WIDE_LETTER = re.compile(r"[฀-๿]"), re.compile(r"[ऀ-ॣ०-ॿ]"), re.compile(r"[぀-ヿ一-鿿]")
_LETTER = re.compile(r"[^\W\d_]")
_STRIPPED = OPENERS + CLOSERS + PLAIN + WIDE + ",;:"
#: Places that may end a sentence. Possessive repeats and the look behind keep long runs of marks or blanks linear.
_MARKED = re.compile(
    rf"(?<![{re.escape(PLAIN + WIDE)}])[{re.escape(PLAIN + WIDE)}]++[{re.escape(CLOSERS)}]*+(?=\s|$)"
    rf"|[{WIDE}]++[{re.escape(CLOSERS)}]*+"
    rf"|(?:(?<=[\w)\]%][\w)\]%])|(?<=\d [^\W\d_]))[{re.escape(PLAIN)}]++[{re.escape(CLOSERS)}]*+(?=[{re.escape(OPENERS)}]*+[^\W\d_])"
    r"|(?<!\s)\s*\n\s*"
)
_OPENED = re.compile(f"[{re.escape(''.join(sorted(set(CLOSERS + OPENERS))))}]")
_GOES_ON = re.compile(r"[即とのはがを，、,]")

_INITIAL = re.compile(r"[^\W\d_]\.")
_LABEL = re.compile(r"[^\W\d_]+(?: [^\W\d_]+){0,3}:\s*")


def _bare(token: str) -> str:
    """Key of a word: without brackets, quotes and marks around, numbers as 9."""
    return _DIGITS.sub("9", token.strip(OPENERS + CLOSERS + PLAIN + WIDE + ",;:"))


def _shape(key: str) -> str:
    return "/" + re.sub(r"(.)\1+", r"\1", "".join("A" if c.isupper() else "a" if c.islower() else "9" if c.isdigit() else c for c in key))


def _lower_word(token: str) -> bool:
    """An ordinary word in small letters (no capital or digit within, as names of genes have)."""
    word = token.strip(OPENERS + CLOSERS + PLAIN + WIDE + ",;:")
    return bool(word) and word[0].islower() and not any(c.isupper() or c.isdigit() for c in word)


def _before(tokens: list[str], i: int) -> str:
    """Key of the word that a period follows; # before it says that a number precedes it."""
    bare = tokens[i].rstrip(CLOSERS).rstrip(PLAIN + WIDE)
    if bare[-1:] and bare[-1] in CLOSERS and bare != tokens[i]:
        return ")"
    key = _INTEGER.sub("9", _DECIMAL.sub("9.9", tokens[i].lstrip(OPENERS).rstrip(CLOSERS).rstrip(PLAIN + WIDE).rstrip(CLOSERS + ",;:")))
    return ("#" if i and tokens[i - 1][-1:].isdigit() else "") + key


class Word(NamedTuple):
    """What a token contributes to the evidence, worked out once."""

    bare: str
    shape: str
    left: str
    lower: bool
    mark: str
    closed: bool
    digit_end: bool
    digit_first: bool


_WORDS: dict[str, Word] = {}


def word_of(token: str) -> Word:
    got = _WORDS.get(token)
    if got is None:
        bare, closed = _bare(token), token.rstrip(CLOSERS)
        got = Word(bare, _shape(bare), _before([token], 0), _lower_word(token), closed[-1:], closed == token, token[-1:].isdigit(), token[0].isdigit())
        if len(_WORDS) >= MEMO:
            _WORDS.clear()
        if len(token) <= 64:
            _WORDS[token] = got
    return got


class Parsed:
    """A text with its tokens and what is asked of them."""

    def __init__(self, text: str, wrapped: bool):
        self.text, self.wrapped = text, wrapped
        self.starts: list[int] = []
        self.ends: list[int] = []
        for m in _TOKEN.finditer(text):
            a, b = m.span()
            self.starts.append(a)
            self.ends.append(b)
        self.tokens = text.split()
        self.lines = "\n" in text
        self._places: dict[str, list[int]] | None = None
        self._opener: dict[int, int] = {}

    def broken(self, i: int) -> bool:
        """Is there a line break after token i?"""
        return self.lines and self.text.find("\n", self.ends[i], self.starts[i + 1]) >= 0

    def left(self, i: int) -> str:
        """Key of token i as the word before a mark; # before it says that a number precedes it."""
        key = word_of(self.tokens[i]).left
        return "#" + key if key != ")" and i and self.tokens[i - 1][-1].isdigit() else key

    def lower_from(self, at: int, end: int, last: dict[int, int]) -> bool:
        """`_lower_word` of what is left of a token from `at`; `last` holds, per token end, its last capital or digit."""
        text = self.text
        if (k := last.get(end)) is None:
            k = end - 1
            while k >= at and not (text[k].isupper() or text[k].isdigit()):
                k -= 1
            last[end] = k
        if k >= at:
            return False
        while at < end and text[at] in _STRIPPED:
            at += 1
        return at < end and text[at].islower()

    def opened_at(self, start: int, at: int, closer: str) -> int | None:
        """Where the bracket or quote that closes at `at` was opened, if not before `start`."""
        if self._places is None:
            places: dict[str, list[int]] = {}
            stacks: dict[str, list[int]] = {}
            for m in _OPENED.finditer(self.text):
                i, c = m.start(), m[0]
                places.setdefault(c, []).append(i)
                if (o := QUOTES.get(c)) is not None and stacks.get(o):
                    self._opener[i] = stacks[o].pop()
                stacks.setdefault(c, []).append(i)
            self._places = places
        opener = QUOTES.get(closer, closer)
        if opener == closer:
            here = self._places.get(closer, [])
            lo, hi = bisect_left(here, start), bisect_left(here, at)
            return here[hi - 1] if (hi - lo) % 2 else None
        i = self._opener.get(at)
        return i if i is not None and i >= start else None


def clues(p: Parsed) -> list[tuple[str, str]]:
    """(kind, key) of every unambiguous occurrence in a text."""
    out: list[tuple[str, str]] = []
    add, tokens, wrapped, last = out.append, p.tokens, p.wrapped, len(p.tokens) - 1
    if not tokens:
        return out
    word = word_of(tokens[0])
    out += [("start", word.bare), ("start", word.shape)]
    number = False
    for i in range(last + 1):
        left = "#" + word.left if number and word.left != ")" else word.left
        mark = word.mark
        number = word.digit_end
        if i < last:
            after = word_of(tokens[i + 1])
            broken = p.lines and p.broken(i)
            sure = None
            if mark in ENDS and word.closed or broken and not wrapped:
                sure = "start"
            elif mark not in PLAIN + WIDE and not broken:
                sure = "mid"
            if sure and after.bare:
                add((sure, after.bare))
                add((sure, after.shape))
            if mark != ".":
                add(("plain", left))
                if broken and not wrapped or mark in "?!":
                    add(("close", left))
            else:
                add(("dot", left))
                if after.lower or after.digit_first:
                    add(("low", left))
            word = after
        elif mark != ".":
            out += [("plain", left), ("close", left)]
        else:
            add(("end", left))
    return out


def evidence(text: str, wrapped: bool) -> Counter:
    """Counts of the unambiguous occurrences in one text: (kind, key)."""
    return Counter(clues(Parsed(text, wrapped)))


def asked_keys(p: Parsed) -> set[str]:
    """Keys of the words around every place of the text that may end a sentence."""
    out: set[str] = set()
    for i in range(len(p.tokens) - 1):
        word = word_of(p.tokens[i])
        if word.mark in PLAIN + WIDE or not word.closed or p.lines and p.broken(i):
            after = word_of(p.tokens[i + 1])
            out.update((p.left(i), after.bare, after.shape))
    return out


class Judge:
    """Corpus evidence, asked together with that of one document."""

    def __init__(self, corpus: dict[tuple[str, str], int]):
        self.corpus = corpus
        self.begin(None)

    def begin(self, parsed: Parsed | None, rare: dict[tuple[str, str], int] | None = None) -> None:
        """Take up a document; rare: the corpus counts of those of its words that the corpus at hand lacks."""
        self.parsed, self.rare, self.document = parsed, rare or {}, None

    def count(self, kind: str, key: str) -> float:
        if self.document is None:
            self.document = Counter(clues(self.parsed)) if self.parsed is not None else Counter()
        got = self.corpus.get((kind, key))
        return (self.rare.get((kind, key), 0) if got is None else got) + DOCUMENT * self.document.get((kind, key), 0)

    def opens(self, token: str) -> float:
        """How likely the word stands at a sentence start, given that it stands in a sure place."""
        word = word_of(token)
        key, shape = word.bare, word.shape
        start, mid = self.count("start", key), self.count("mid", key)
        shape_start, shape_mid = self.count("start", shape), self.count("mid", shape)
        likely = (shape_start + 0.1) / (shape_start + shape_mid + 1)
        return (start + SHAPE * likely) / (start + mid + SHAPE)

    def ends(self, left: str, right: str) -> bool:
        """Does the period between the two words end a sentence? left: key of the word before."""
        opens = self.opens(right)
        word = left.lstrip("#")
        initial = _INITIAL.fullmatch(right.lstrip(OPENERS)) is not None
        if word_of(right).lower:
            return opens > 0.5
        if right[0].isdigit() and opens < 0.05:
            return False
        if len(word) == 1 and word.isalpha() and word.isupper():
            return opens > 0.9 and not initial
        dot, low, end, plain = (self.count(k, left) for k in ("dot", "low", "end", "plain"))
        if word == "9":
            return opens > 0.02 and self.count("start", word_of(right).bare) > 0
        abbreviates = low >= 0.3 * (dot + end) if dot + end else False
        if "." in word and any(c.isalpha() for c in word) and not any(c.isdigit() for c in word):
            abbreviates = True
        rarely = end < 0.1 * (dot + end)
        if not abbreviates and dot >= 3 and rarely and plain < 0.1 * dot and word.isalpha():
            abbreviates = True
        if not abbreviates:
            # A word that hardly ever stands without a period may abbreviate as well as end a sentence.
            return not (any(c.isdigit() for c in right) and plain < 0.1 * (dot + end) and opens < 0.02)
        if initial:
            return False
        if any(c.isdigit() for c in right):
            return opens > (0.9 if rarely else 0.08)
        # A long capitalised word that is followed by capitals only is a name rather than an abbreviation.
        if rarely and len(word) > 5 and low < 0.3 * (dot + end) and any(c.isupper() for c in right.lstrip(OPENERS)[1:]):
            return True
        return opens > (0.03 if not rarely else 0.9 if len(word) < 5 or low >= 0.3 * (dot + end) else 0.02)

    def breaks(self, left: str, right: str) -> bool:
        """Does a line break of a wrapped page, without a mark before it, end a sentence?"""
        if word_of(right).lower:
            return False
        opens, closes = self.opens(right), self.count("end", left) + self.count("close", left)
        inner = self.count("plain", left) - self.count("close", left)
        likely = (closes + 0.05) / (closes + inner + 1.0)
        if not (right.lstrip(OPENERS) or right)[0].isupper():
            return opens > 0.05 and likely > 0.5
        return opens > 0.6 or opens > 0.03 and likely > 0.15


def boundaries(text: str, wrapped: bool, judge: Judge, rare: dict[tuple[str, str], int] | None = None) -> list[tuple[int, int]]:
    """(start, end) of every sentence."""
    p = Parsed(text, wrapped)
    judge.begin(p, rare)
    if text.isascii():
        thai = deva = wide = False
    else:
        letters = len(_LETTER.findall(text)) or 1
        thai = len(_THAI.findall(text)) > 0.3 * letters
        deva = not thai and len(_DEVA.findall(text)) > 0.3 * letters
        wide = bool(_WIDE_LETTER.search(text))
    if not p.tokens:
        return []
    if thai:
        return list(zip(p.starts, p.ends))
    return _trimmed(p, _cuts(p, judge, deva, wide))


def _trimmed(p: Parsed, cuts: list[int]) -> list[tuple[int, int]]:
    """The pieces between cuts without the blanks around them."""
    out, begin = [], p.starts[0]
    for cut in [*cuts, p.ends[-1]]:
        if cut <= begin:
            continue
        k = bisect_left(p.starts, cut) - 1
        out.append((begin, min(cut, p.ends[k])))
        k = bisect_right(p.ends, cut)
        if k == len(p.ends):
            break
        begin = max(cut, p.starts[k])
    return out


def _cuts(p: Parsed, judge: Judge, deva: bool, wide: bool) -> list[int]:
    text, wrapped, tokens, ends = p.text, p.wrapped, p.tokens, p.ends
    cuts: list[int] = []
    last: dict[int, int] = {}
    first, following = p.starts[0], 0
    for m in _MARKED.finditer(text):
        here = m.end()
        # The first token that goes on beyond the mark, and the first letter there.
        while following < len(ends) and ends[following] <= here:
            following += 1
        if following == len(ends):
            break
        if first >= m.start():
            continue
        piece, rest = m[0], max(here, p.starts[following])
        spaced = rest > here
        # The token that ends at the mark, if one does.
        i = following - 1 if following and ends[following - 1] == here else None
        after = tokens[following] if i is not None else None
        if piece.isspace():
            k = bisect_right(ends, m.start()) - 1
            cut = not wrapped or k >= 0 and text[ends[k] - 1] not in ",;:" and judge.breaks(p.left(k), tokens[k + 1])
        else:
            marks = piece.rstrip(CLOSERS)
            closers = piece[len(marks) :]
            broken = spaced and p.lines and text.find("\n", here, rest) >= 0
            cut = True
            if not spaced and marks[-1] in PLAIN and not (deva and marks[-1] in "।॥"):
                lower = p.lower_from(here, ends[following], last)
                cut = (not lower or marks[-1] in ENDS) and (not closers or not (o := p.opened_at(first, here - 1, closers[-1])) or o <= first)
            elif closers:
                opened = p.opened_at(first, here - 1, closers[-1])
                within = opened is not None and opened > first and not _LABEL.fullmatch(text, first, opened)
                if within:
                    cut = spaced and closers[-1] not in ")]}）】" and after is not None and not word_of(after).lower and judge.opens(after) > 0.3
                elif not spaced:
                    cut = opened is not None and wide and not _GOES_ON.match(text, here)
                elif after is not None:
                    cut = not word_of(after).lower or judge.opens(after) > 0.5
            elif deva and marks == ".":
                cut = False
            elif marks == "." and after is not None:
                cut = judge.ends(p.left(i), after)
            elif marks[-1] in "…." and after is not None:
                cut = not word_of(after).lower
            elif marks in ENDS and after is not None:
                cut = not word_of(after).lower or judge.opens(after) > 0.5
            if broken and not wrapped:
                cut = True
        if cut:
            cuts.append(here)
            first = rest
    return cuts


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(key, total, kinds) over all texts (text, wrapped): how often every key occurs, and in each kind."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def out() -> pd.DataFrame:
            rows = pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["kind", "key", "n"]).astype({"n": "int64"})
            seen.clear()
            return rows

        for pdf in batches:
            for text, wrapped in zip(pdf["text"], pdf["wrapped"]):
                seen.update(clues(Parsed(text, bool(wrapped))))
                if len(seen) > FLUSH:
                    yield out()
        yield out()

    counts = texts.select("text", "wrapped").mapInPandas(count, "kind string, key string, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    # A key has at most as many kinds as there are.
    return durable(counts.groupBy("key").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("kind", "n"))).alias("kinds")))


def shapes_of_the_rest(model: dict[tuple[str, str], int], tokens: int) -> dict[tuple[str, str], int]:
    """Take the words that make COMMON of all tokens out of the counts of their shapes: a shape speaks for rare words."""
    out = dict(model)
    for (kind, key), n in model.items():
        if kind in ("start", "mid") and key[:1] != "/" and n >= tokens * COMMON and (kind, _shape(key)) in out:
            out[kind, _shape(key)] = max(0, out[kind, _shape(key)] - n)
    return out


def cut_sentences(texts: DataFrame) -> DataFrame:
    """(origen, clave, num_oracion, offset_ini, offset_fin, texto) of the rows (origen, clave, text, wrapped)."""
    rows = texts.where(F.col("text").isNotNull() & (F.regexp_replace("text", r"(?U)\s+", "") != ""))
    rows = rows.select("origen", "clave", "text", F.coalesce("wrapped", F.lit(False)).alias("wrapped"))
    counts = corpus_counts(rows)
    kinds = F.map_values(F.map_filter("kinds", lambda k, _: k.isin("plain", "dot", "end")))
    tokens = counts.agg(F.sum(F.aggregate(kinds, F.lit(0).cast("long"), lambda a, n: a + n))).first()[0] or 0
    least = max(1, tokens * SHARE)
    frequent = {(kind, r["key"]): n for r in counts.where(F.col("total") >= least).collect() for kind, n in r["kinds"].items()}
    sc = rows.sparkSession.sparkContext
    model = sc.broadcast((shapes_of_the_rest(frequent, tokens), frozenset(key for _, key in frequent)))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = model.value[1]
        for pdf in batches:
            out = [(r, k) for r, t, w in zip(pdf["rid"], pdf["text"], pdf["wrapped"]) for k in asked_keys(Parsed(t, bool(w))) - known]
            yield pd.DataFrame(out, columns=["rid", "key"])

    # Every row is asked for once: the id is a digest of the whole row.
    keyed = rows.withColumn("rid", F.md5(F.concat_ws("\x00", "origen", "clave", F.col("wrapped").cast("string"), "text").cast("binary")))
    asked = keyed.select("rid", "text", "wrapped").mapInPandas(ask, "rid string, key string")
    told = asked.join(counts.where(F.col("total") < least).select("key", "kinds"), "key")
    # As many entries as the text has rare words around its marks.
    told = told.groupBy("rid").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("key", "kinds")))).alias("rare"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Judge(model.value[0])
        for pdf in batches:
            out = []
            for o, c, t, w, rare in zip(pdf["origen"], pdf["clave"], pdf["text"], pdf["wrapped"], pdf["rare"]):
                own = {(kind, key): n for key, kinds in json.loads(rare).items() for kind, n in kinds.items()} if rare else None
                out += [(o, c, k, a, b, t[a:b]) for k, (a, b) in enumerate(boundaries(t, bool(w), judge, own))]
            yield pd.DataFrame(out, columns=["origen", "clave", "num_oracion", "offset_ini", "offset_fin", "texto"])

    return keyed.join(told, "rid", "left").drop("rid").mapInPandas(cut, "origen string, clave string, num_oracion int, offset_ini int, offset_fin int, texto string")


def project_texts(documents: DataFrame, units: DataFrame) -> DataFrame:
    """The abstracts (once per article) and the units (once per id) as rows for cut_sentences; units from pdf are wrapped."""
    a = documents.select(F.lit("abstract").alias("origen"), F.col("pmid").alias("clave"), F.col("abstract").alias("text"), F.lit(False).alias("wrapped"))
    u = units.select(F.lit("unidad").alias("origen"), F.col("id").cast("string").alias("clave"), F.col("texto").alias("text"), F.coalesce(F.col("fuente_texto") == "pdf", F.lit(False)).alias("wrapped"))
    return durable(a.unionByName(u).where("clave is not null and text is not null").distinct())
