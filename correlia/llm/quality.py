"""Per-document text quality statistics (problem 9): ratios per block, tables and lists by their layout.

A text is read as blocks between blank lines. A block is a table if its lines carry the same number of the same
delimiter at every line (or at the same columns), a list if bullets or numbers open its lines, if indentation or line length
repeats with a period (autocorrelation), or if separators stand between nearly all its words. What is left is
judged by its words, without a list of any language's words: `learn` reads the whole corpus and takes as common the
words that, in the running blocks they stand in, make at least RATE of all tokens (for scripts without blanks, the
characters). That rate is taken within the blocks, so the words of a language that is a small part of the corpus count like
those of a large one. Running sentences hold common words among the others; word salad, dumps of sequence, code
or numbers hold hardly any. If most words of a block are unknown to the corpus (a language it does not hold), its rhythm
decides: words of letters only, short ones among long ones, or sentences that open and end as such.
Garbled text is full of characters that stand inside words and belong to no word. The kind of most
characters is the kind of the text.

Two passes over whole texts; only (word, counts) is shuffled, partially summed. Words of less than SHARE of all tokens
are not asked of the model, so it has at most 1 / SHARE entries and may be broadcast; they are unknown, at every size.

Defined cases: null and blank texts have zero statistics and the class
`vacio`, and are no junk; a block too short to judge goes with the larger of its neighbours; repeated rows
give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from correlia.runtime import durable

#: Shares: of all tokens, below which the model does not hold a word; of the tokens around it, from which a word is common.
SHARE, RATE = 1e-5, 0.0022
#: Occurrences from which a rate is believed; entries after which a task passes on its counts.
LEAST_SEEN, FLUSH = 20, 200_000
#: Shares: of common words below which a block is no prose; of separators per word, of odd characters, of lines that must agree.
LEAST_WORDS, SEPARATED, ODD, AGREE, FEW_WORDS = 0.055, 0.6, 0.06, 0.8, 6
#: Shares in a block whose language is not known: of known words, of tokens that are plain words, of short words among these.
KNOWN, PURE, SHORT = 0.5, 0.6, 0.1

_BLANK = re.compile(r"\n[ \t\r\xa0]*\n")
_LINE_END = re.compile(r"\r\n?|[\x0b\x0c\x85\u2028\u2029]")
_GONE = re.compile("[\u200b\u200c\u200d\u2060\ufeff\u00ad]")
#: Combining marks, which belong to the letter before them.
_MARKS = "".join(map(chr, (c for c in range(0x300, 0x3000) if unicodedata.category(chr(c))[0] == "M")))
_WORD = re.compile(rf"[^\W\d_]+(?:[{_MARKS}]+[^\W\d_]*)*")
_BULLET = re.compile(r"[ \t]*(?:[-*+•‣◦·▪–—]|\(?\d{1,3}[.)]|\[\d+\]|[a-z][.)])[ \t]+\S")
_ENDED = re.compile(r"[.!?…。！？।؟．:;][\"'”’»)\]」）]*\s*$")
_SEPARATOR = re.compile(r"[,;/|·、，；•\t]")
_ODD = re.compile(r"[�¤¶¿Ã¦¬±§Â](?=\S)|(?<=\S)[�¤¶¿ÃÂ]")
_DELIMITERS = ("\t", ",", ";", "|", "=", ":", "<", "  ")
#: Scripts without blanks between words, and the marks that end their sentences.
_SCRIPTS, _STOPS = re.compile("[\u0e00-\u0e7f\u3400-\u9fff\u3040-\u30ff]"), re.compile("[。！？．｡!?]")
#: What stands around a word.
_AROUND = ".,;:!?…؟।॥。，、！？()[]{}«»“”\"'‘’„¿¡-–—·•/|;；"


class Words(NamedTuple):
    """What the corpus tells: its known words, and those of them that are common where they stand."""

    known: frozenset[str]
    common: frozenset[str]


UNTAUGHT = Words(frozenset(), frozenset())


class Tokens(NamedTuple):
    """The words of a text as its kind of script has them, with the shares that judge them."""

    share: float
    n: int
    blankless: bool
    known: float
    pure: float
    short: float


def tokens_of(text: str) -> tuple[list[str], bool]:
    """Words between blanks in small letters without marks around (single characters for scripts without blanks), and which of the two."""
    scripts = _SCRIPTS.findall(text)
    if scripts and len(scripts) > 0.15 * len(text):
        return scripts, True
    return [w for t in text.lower().replace("'", " ").replace("’", " ").split() if (w := t.strip(_AROUND))], False


def read_tokens(text: str, words: Words) -> Tokens:
    found, blankless = tokens_of(text)
    if not found:
        return Tokens(0.0, 0, blankless, 0.0, 0.0, 0.0)
    n, common = len(found), words.common
    hits = [w for w in found if w in common]
    share = len(hits) / n
    if blankless:
        return Tokens(share, n // 2, True, 1.0, 1.0, 1.0)
    if share >= 3 * LEAST_WORDS and n >= FEW_WORDS or share >= LEAST_WORDS and any(len(w) <= 3 for w in hits):
        return Tokens(share, n, False, 1.0, sum(map(str.isalpha, found)) / n if share < 3 * LEAST_WORDS else 1.0, 1.0)
    # Of few common words one must be short, as those that bind a sentence are.
    share = min(share, 0.9 * LEAST_WORDS)
    known = sum(map(words.known.__contains__, found)) / n
    plain = [w for w in found if w.isalpha() or _WORD.fullmatch(w)]
    return Tokens(share, len(plain), False, known, len(plain) / n, sum(len(w) <= 3 for w in plain) / (len(plain) or 1))


def sentence_like(block: str, t: Tokens) -> bool:
    """Does a block of a language that the corpus does not hold run in sentences?"""
    ended = sum(map(block.count, ".!?…؟।"))
    if t.pure < PURE or not ended:
        return False
    first = block.lstrip()[:1]
    opened = not first.islower() or block == block.lower()
    return t.short >= SHORT or opened and _ENDED.search(block) is not None and t.n <= 40 * ended


def periodic(values: list[int]) -> float:
    """Largest autocorrelation at lags 1 to 4 of a series of at least 8 numbers; 1 for a constant one."""
    if len(values) < 8:
        return 0.0
    x = np.asarray(values, dtype=float)
    x -= x.mean()
    power = float(x @ x)
    return 1.0 if power < 1e-9 else max(float(x[:-k] @ x[k:]) / power for k in range(1, 5))


def layout(lines: list[str], share: float) -> str:
    """`tabla`, `lista` or nothing, from bullets, aligned delimiters, indentation and line lengths."""
    n = len(lines)
    if sum(bool(_BULLET.match(x)) for x in lines) >= AGREE * n and n > 1:
        return "lista"
    if n < 3:
        return ""
    closed = sum(bool(_ENDED.search(x)) for x in lines) >= 0.5 * n
    for d in _DELIMITERS:
        most, times = Counter(x.count(d) for x in lines).most_common(1)[0]
        if most and times >= AGREE * n and (d in "\t|<" or most > 1 and not closed and share < 0.15):
            return "tabla"
    columns = Counter(m.start() for x in lines for m in re.finditer(r"(?<=\S)\s{2,}(?=\S)", x))
    if columns and columns.most_common(1)[0][1] >= AGREE * n:
        return "tabla"
    longest = 12 if _SCRIPTS.search("".join(lines[:4])) else 200
    if sum(len(x.split()) <= 4 and len(x) <= longest and not _ENDED.search(x) for x in lines) >= AGREE * n:
        return "lista"
    if share >= 2 * LEAST_WORDS:
        return ""
    indents = [len(x) - len(x.lstrip()) for x in lines]
    if len(set(indents)) > 1 and periodic(indents) > 0.6:
        return "lista"
    return "tabla" if periodic([len(x) for x in lines[:-1]]) > 0.6 else ""


def block_kind(block: str, words: Words = UNTAUGHT) -> tuple[str, float]:
    """(`prosa`, `tabla`, `lista`, `basura`, or `corto` if there is too little to judge; share of common words)."""
    lines = [x for x in block.split("\n") if x.strip()]
    t = read_tokens(block, words)
    full = len(block)
    return _kind(block, lines, t, full), t.share


def _kind(block: str, lines: list[str], t: Tokens, full: int) -> str:
    share, n = t.share, t.n
    if len(_ODD.findall(block)) > ODD * full:
        return "basura"
    if not t.blankless and n >= FEW_WORDS and t.pure < 0.5:
        return shape if (shape := layout(lines, share)) else "basura"
    # A language that is not known counts as prose as far as its rhythm says so.
    strange = not t.blankless and share < LEAST_WORDS and t.known < KNOWN and n >= FEW_WORDS and sentence_like(block, t)
    shape = layout(lines, 3 * LEAST_WORDS if strange else share)
    if shape and (share < 0.4 or n <= 2 * len(lines)):
        return shape
    separators = len(_SEPARATOR.findall(block))
    if t.blankless:
        if separators >= 4 and 12 * separators >= 2 * n and not _STOPS.search(block):
            return "lista"
        return "prosa" if n >= FEW_WORDS else "corto"
    if separators >= 4 and separators >= SEPARATED * n:
        return "lista"
    if n >= FEW_WORDS and share >= 3 * LEAST_WORDS:
        return "prosa"
    if sum(not c.isalpha() and not c.isspace() and c not in _MARKS for c in block) > 0.45 * full:
        return shape or "basura"
    if n < FEW_WORDS:
        return "corto" if full < 60 else shape or "basura"
    if share < LEAST_WORDS and not strange:
        # One short sentence may do without common words; a salad has many words and no syntax.
        return "basura" if n >= 12 or shape else "corto"
    return "prosa"


def mixed(block: str, words: Words = UNTAUGHT) -> tuple[list[tuple[str, int]], float]:
    """(kind, characters) of a block, and its share of common words; lines set as a table or list within a block of prose count by themselves."""
    kind, share = block_kind(block, words)
    lines = block.split("\n")
    if kind != "prosa" or len(lines) < 6 or share < LEAST_WORDS:
        return [(kind, len(block))], share
    out, run = [], []
    for x in [*lines, None]:
        if x is not None and x.strip() and read_tokens(x, words).share < LEAST_WORDS:
            run.append(x)
            continue
        if len(run) >= 4 and (shape := layout(run, 0.0)):
            out.append((shape, sum(map(len, run)) + len(run)))
        run = []
    taken = sum(n for _, n in out)
    return [*out, ("prosa", max(0, len(block) - taken))], share


def plain_text(text: str) -> str:
    return unicodedata.normalize("NFKC", _GONE.sub("", _LINE_END.sub("\n", text))) if not text.isascii() or "\r" in text else text


def measure(text: str | None, words: Words = UNTAUGHT) -> tuple:
    """The statistics of one text, in the order of FIELDS."""
    if text is None or not text.strip():
        return (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0, 0.0, 0.0, 0.0, "vacio")
    plain = plain_text(text)
    blocks = [b for b in _BLANK.split(plain) if b.strip()]
    size: Counter = Counter()
    common = 0.0
    for b in blocks:
        parts, share = mixed(b, words)
        common += share * len(b)
        for kind, n in parts:
            size[kind] += n
    common /= sum(map(len, blocks))
    short = size.pop("corto", 0)
    if size:
        size[size.most_common(1)[0][0]] += short
    else:
        size["prosa" if _ENDED.search(plain) or common > 0 else "basura"] = short
    total = sum(size.values())
    junk = 1 - size["prosa"] / total
    found = _WORD.findall(plain)
    lines = [x for x in plain.split("\n") if x.strip()]
    full = len(plain)
    spaces = sum(map(plain.count, " \n\t\xa0"))
    letters = sum(map(len, found))
    digits = sum(map(plain.count, "0123456789"))
    kind = "prosa" if junk <= 0.5 else max(("tabla", "lista", "basura"), key=lambda k: (size[k], k))
    return (
        len(found), letters / (len(found) or 1), max(0, full - spaces - letters - digits) / full, digits / full,
        sum(bool(_ENDED.search(x)) for x in lines) / len(lines), common, len(lines),
        size["tabla"] / total, size["lista"] / total, junk, kind,
    )


FIELDS = ["n_palabras", "largo_medio", "simbolos", "digitos", "lineas_cerradas", "comunes", "n_lineas", "tabla", "lista", "no_prosa", "clase"]


def running(block: str) -> bool:
    """A block that ends as a sentence does and whose separators are few: its words may tell how a language runs."""
    return _ENDED.search(block) is not None and not _BULLET.match(block) and 3 * len(_SEPARATOR.findall(block)) < len(block.split()) + len(_SCRIPTS.findall(block)) // 2


def add_evidence(text: str, seen: dict[str, list[int]]) -> None:
    """Per word: occurrences, how many of them come after another in the same running block, and the other tokens of those blocks."""
    for block in _BLANK.split(plain_text(text)):
        if not running(block):
            continue
        # Names and what opens a sentence have capitals; they are left as they are and so never common.
        found, blankless = tokens_of(block) if _SCRIPTS.search(block) else (block.replace("'", " ").replace("’", " ").split(), False)
        n = len(found)
        if n < 2 * FEW_WORDS:
            continue
        for w, k in Counter(found).items():
            if (have := seen.get(w)) is None:
                seen[w] = [k, k - 1, n - 1]
            else:
                have[0] += k
                have[1] += k - 1
                have[2] += n - 1


def may_be_common(word: str) -> bool:
    """Digits and marks are no words."""
    return not any(c.isdigit() or c.isascii() and not c.isalpha() for c in word)


def learn(df: DataFrame, text: str = "text") -> Words:
    """The words of at least SHARE of all tokens, and those of them that, where they stand once, make at least RATE of the other tokens."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = {}

        def out() -> pd.DataFrame:
            rows: dict[str, list[int]] = {}
            for w, (k, again, around) in seen.items():
                key = w.strip(_AROUND).lower()
                if key:
                    have = rows.setdefault(key, [0, 0, 0])
                    have[0] += k
                    # Only what stands in small letters, or in a script without them, may be a common word.
                    if w[:1] in key and w == w.lower():
                        have[1] += again
                        have[2] += around
            seen.clear()
            return pd.DataFrame([(w, *x) for w, x in rows.items()], columns=["w", "n", "again", "around"]).astype({"n": "int64", "again": "int64", "around": "int64"})

        for pdf in batches:
            for t in pdf["t"]:
                add_evidence(t, seen)
            if len(seen) > FLUSH:
                yield out()
        yield out()

    sums = [F.sum(c).alias(c) for c in ("n", "again", "around")]
    counts = durable(df.select(F.col(text).alias("t")).where("t is not null").mapInPandas(count, "w string, n long, again long, around long").groupBy("w").agg(*sums))
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where((F.col("n") >= total * SHARE) & (F.col("n") >= LEAST_SEEN)).collect()
    return Words(frozenset(r["w"] for r in rows), frozenset(r["w"] for r in rows if r["again"] > 0 and r["again"] >= RATE * r["around"] and may_be_common(r["w"])))


def text_statistics(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: (id_col, FIELDS); `no_prosa` is the share of characters outside running sentences, `clase` the kind of most."""
    kind = dict(df.dtypes)[id_col]
    model = df.sparkSession.sparkContext.broadcast(learn(df, text))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = model.value
        for pdf in batches:
            out = pd.DataFrame([measure(t, words) for t in pdf[text]], columns=FIELDS, index=pdf.index)
            out.insert(0, id_col, pdf[id_col])
            yield out.round({c: 6 for c in FIELDS if c not in ("n_palabras", "n_lineas", "clase")})

    schema = f"{id_col} {kind}, n_palabras long, largo_medio double, simbolos double, digitos double, lineas_cerradas double, comunes double, n_lineas long, tabla double, lista double, no_prosa double, clase string"
    return df.where(F.col(id_col).isNotNull()).select(id_col, text).mapInPandas(run, schema)
