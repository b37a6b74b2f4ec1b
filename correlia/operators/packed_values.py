"""Several values packed in one field (problem 3): EM segmentation with Viterbi lattices.

Every place where a cell might be cut (marks, runs of blanks, a linking word) is an edge of a lattice whose
paths are the possible lists. A path costs the values on it and the decision at each place:

* a value has the frequency it is seen with in the whole column, backed off to the frequency of its shape
  (letter cases and marks) times the frequencies of its words;
* a place has the column's rate of cutting at its kind of mark, kept apart for blanks and linking words by
  whether the cell has other marks.

Expectation-maximisation learns both from all distinct cells: forward-backward gives expected counts, summed per
partition before the shuffle; the first round counts words everywhere, and values in the cells whose notation leaves no choice (JSON lists, fully quoted
lists, cells cut by hard marks only). Viterbi then gives the likeliest list. Quoted spans and round brackets are atomic.
The model keeps values and shapes that make at least SHARE of the column's mass, so it has at most 1 / SHARE of
each and may be broadcast; rarer values are judged by shape.

Defined cases: null, blank, `[]`, `-` and `NA` cells hold none; empty pieces are dropped; repeated values are kept;
a key that recurs counts once, with the notation that leaves the least choice; cells of any length are cut whole
(in windows of WINDOW places where no hard mark or quote divides them).
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from correlia.runtime import durable

SHARE, ROUNDS, MERGE, WINDOW, FLUSH = 1e-5, 3, 9, 400, 200_000
#: What a cell may add to the counts of a value by itself is taken off: no value supports itself.
OWN, NEW_SHAPE = 1.0, 0.3
#: Log-probability of a kind's cutting below which it is passed over, and of a value's inner marks below which it is given up.
IDLE, HOPELESS = -8.0, -16.0
#: Log-probability of a value's inner marks above which it may grow beyond MERGE pieces though none like it was seen.
LIKELY = -3.0
#: Places that the first guess for hard marks weighs as.
FIRM = 200.0
#: Cells that hold nothing, quotes, marks that nearly always cut, and the first guess of each kind's rate.
NOTHING = {"", "[]", "{}", "()", "-", "NA"}
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "«": "»", "`": "`"}
HARD = set("|;\t\n~·、；，•¦")
FIRST = {"hard": 0.9995, ",": 0.7, "&": 0.7, "and": 0.5, "->": 0.9, ">": 0.9, "→": 0.9, "–": 0.6, "+": 0.8, "/": 0.5, ":": 0.5, "-": 0.3, " ": 0.3}
_WORD = re.compile(r"[^\W_]+")
_PLACE = re.compile(r"\s*[,;&]\s*(?:and|y|et|und)\s+|\s*(?:->|[|;\t\n~·、；，•¦,&>→–+/:\-])\s*|\s+(?:and|y|et|und|e)\s+|\s+")
#: Where something other than a letter may matter: a quote, a bracket or the begin of a place.
_NEXT = re.compile(r"[\"'“‘«`(|;\t\n~·、；，•¦,&>→–+/:\-]|\s")


@lru_cache(maxsize=200_000)
def shape(value: str) -> str:
    out = re.sub(r"[^\W\d_]+", lambda m: re.sub(r"(.)\1+", r"\1", "".join("A" if c.isupper() else "a" for c in m[0])), value)
    return re.sub(r"(\S+)(?: \1){3,}", r"\1 \1 \1+", re.sub(r"\d+", "9", out))


def _unquote(text: str) -> str:
    q = text[0]
    return text[1:-1].replace(q + q, q).strip()


def _json_list(cell: str) -> list[str] | None:
    if not cell.startswith("["):
        return None
    try:
        got = json.loads(cell)
    except ValueError:
        return None
    return [str(x).strip() for x in got if x is not None and str(x).strip()] if isinstance(got, list) else None


def _kind(mark: str) -> str:
    bare = mark.strip(" \xa0")
    if bare in HARD or mark.strip() == "" and set(mark) & {"\t", "\n"}:
        return "hard"
    if not bare.strip():
        return " "
    return "and" if bare.isalpha() else bare[:1] if bare[-1:].isalpha() else bare


def lattice(cell: str) -> tuple[list[tuple[str, bool]], list[tuple[str, str]]]:
    """Pieces (text, atomic) and, between them, places (kind, mark). Kind `!` is cut for sure: it stands beside a quoted span or an empty piece."""
    if len(cell) > 1 and (cell[0], cell[-1]) in {("[", "]"), ("{", "}")}:
        cell = cell[1:-1].strip()
    pieces: list[tuple[str, bool]] = []
    places: list[tuple[str, str]] = []
    i, start, n = 0, 0, len(cell)
    # Quotes and brackets of which it is known that nothing closes them further on.
    open_ended: set[str] = set()

    def close(upto: int, mark: str, kind: str, atomic: bool = False) -> None:
        text = cell[start:upto]
        if text.strip():
            pieces.append((text.strip(), atomic))
            places.append((kind, mark))
        elif places:
            places[-1] = ("!", places[-1][1] + mark)

    while m := _NEXT.search(cell, i):
        i = m.start()
        c = cell[i]
        if c in QUOTES:
            if c not in open_ended and (start == i or not cell[start:i].strip()):
                j, q = i + 1, QUOTES[c]
                while (j := cell.find(q, j)) >= 0:
                    if q == c and cell[j + 1 : j + 2] == q:
                        j += 2
                        continue
                    k = j + 1
                    while k < n and cell[k] in " \xa0":
                        k += 1
                    if k == n or (m := _PLACE.match(cell, k)) and not m[0].isspace() or cell[j + 1 : j + 2] in "\t\n":
                        break
                    j += 1
                if j < 0:
                    open_ended.add(c)
                if j > 0:
                    m = _PLACE.match(cell, j + 1)
                    end = m.end() if m else j + 1
                    if places:
                        places[-1] = ("!", places[-1][1])
                    pieces.append((_unquote(cell[i : j + 1]), True))
                    places.append(("!", m[0] if m else ""))
                    i = start = end
                    continue
            i += 1
            continue
        if c == "(":
            j = -1 if c in open_ended else cell.find(")", i)
            if j < 0:
                open_ended.add(c)
            i = j + 1 if j > 0 else i + 1
            continue
        m = _PLACE.match(cell, i)
        if m and m.end() > i:
            if m[0].isspace() and not set(m[0]) & {"\t", "\n"} and cell[m.end() : m.end() + 1] == "(":
                i = m.end()
                continue
            close(i, m[0], _kind(m[0]))
            i = start = m.end()
            continue
        i += 1
    close(n, "", "!")
    pieces = [p for p in pieces if p[0]] if all(p[0] for p in pieces) else pieces
    places = places[: len(pieces)]
    other = any(k not in ("!", " ", "-", ":", "/") for k, _ in places[:-1])
    hard = any(k == "hard" for k, _ in places[:-1])
    places = [(f"{k}*" if k == "," and hard or k in (" ", "and", "-", ":", "/") and other else k, m) for k, m in places]
    return pieces, places


class Model:
    """values, shapes and words: counts; cuts: kind -> (cut, not cut)."""

    def __init__(self, values: dict[str, float], shapes: dict[str, float], words: dict[str, float], cuts: dict[str, tuple[float, float]]):
        self.values, self.shapes, self.words, self.cuts = values, shapes, words, cuts
        self.forms: Counter = Counter()
        for w, n in words.items():
            if " " not in w:
                self.forms[shape(w)] += n
        self.n = sum(shapes.values()) or 1.0
        # The mass of values not seen before is as large as the share of values seen once or so.
        self.new = min(0.95, max(0.02, len(values) / self.n))
        self.idle = {k for k in cuts if k != "hard" and self.cut(k)[0] < IDLE}
        #: Hard marks cut so surely here that cells with no other places have no choice.
        self.firm = self.cut("hard")[0] > math.log(0.98)
        self.memo: dict[str, float] = {}
        #: How the values that have more than MERGE pieces begin, from the first MERGE pieces on.
        self.begun = {v[: m.start()] for v in values for k, m in enumerate(_PLACE.finditer(v), 1) if k >= MERGE}

    def value(self, text: str) -> float:
        got = self.memo.get(text)
        if got is None:
            seen = (1 - self.new) * max(self.values.get(text, 0.0) - OWN, 0.0) / self.n
            # A shape not seen before is the less likely the longer it is, so it costs no more than its parts.
            kind = shape(text)
            form = (max(self.shapes.get(kind, 0.0) - OWN, 0.0) + NEW_SHAPE * math.exp(-min(len(kind), 600) / 2)) / (self.n + 1.0)
            words = _WORD.findall(text)
            got = math.log(self.new * form) + sum(map(self.word, [None, *words], words))
            if seen:
                got = max(got, math.log(seen)) + math.log1p(math.exp(-abs(got - math.log(seen))))
            if len(self.memo) < 200_000:
                self.memo[text] = got
        return got

    def word(self, before: str | None, word: str) -> float:
        """Of a word, given its shape and the word before it in the value."""
        form = self.forms.get(shape(word), 0.0)
        alone = (self.words.get(word, 0.0) + 0.1) / (form + 1.0)
        pair = self.words.get(f"{before} {word}", 0.0) / self.words[before] if before in self.words else 0.0
        return math.log(0.7 * min(pair, 1.0) + 0.3 * min(alone, 1.0))

    def cut(self, kind: str) -> tuple[float, float]:
        if kind == "!":
            return 0.0, -1e9
        yes, no = self.cuts.get(kind, (0.0, 0.0))
        weight = FIRM if kind == "hard" else 1.0
        rate = (yes + weight * FIRST.get(kind.rstrip("*"), 0.5) * (0.2 if kind == " *" else 1) + 1e-4) / (yes + no + weight + 3e-4)
        if rate < 0.02:
            # A kind of mark that hardly ever cuts in this column does not cut in it.
            rate **= 2
        return math.log(rate), math.log(1 - rate)


def _contract(pieces: list, places: list, model: Model) -> tuple[list, list, list[str]]:
    """Pieces run together over places of a kind that does not cut in this column, and the kinds so passed over."""
    if not model.idle:
        return pieces, places, []
    out: list[tuple[str, bool]] = []
    left: list[tuple[str, str]] = []
    passed: list[str] = []
    for (text, atomic), place in zip(pieces, places):
        if out and left[-1][0] in model.idle and not atomic and not out[-1][1]:
            passed.append(left[-1][0])
            out[-1] = (out[-1][0] + left[-1][1] + text, False)
            left[-1] = place
        else:
            out.append((text, atomic))
            left.append(place)
    return out, left, passed


def _windows(pieces: list, places: list) -> Iterator[tuple[list, list]]:
    """Parts between sure cuts (hard marks count as such only in very long cells)."""
    begin = 0
    for i, (kind, _) in enumerate(places):
        if kind == "!" or i + 1 - begin >= WINDOW and kind == "hard" or i + 1 == len(places):
            yield pieces[begin : i + 1], places[begin : i + 1]
            begin = i + 1


def _edges(pieces: list, places: list, model: Model) -> list[list[tuple[int, str, float]]]:
    """For each end, (begin, value, score) of the values that may end there."""
    out: list[list[tuple[int, str, float]]] = [[] for _ in range(len(pieces) + 1)]
    for a in range(len(pieces)):
        text, inner = "", 0.0
        for b in range(a, len(pieces)):
            # Long values: as far as one that was seen begins like this, or as the marks within hardly ever cut.
            if b - a >= MERGE and inner < LIKELY and text not in model.begun:
                break
            if b > a:
                if pieces[b][1] or pieces[a][1]:
                    break
                kind, mark = places[b - 1]
                keep = model.cut(kind)[1]
                if keep < -1e8:
                    break
                inner += keep
                if inner < HOPELESS:
                    break
                text += mark
            text += pieces[b][0]
            yes = model.cut(places[b][0])[0]
            out[b + 1].append((a, text, model.value(text) + inner + yes))
    return out


def best_values(cell: str | None, model: Model) -> list[str]:
    """The likeliest list of values of a cell."""
    bare = (cell or "").strip()
    if bare in NOTHING:
        return []
    if (got := _json_list(bare)) is not None:
        return got
    out: list[str] = []
    pieces, places = lattice(bare)
    pieces, places, _ = _contract(pieces, places, model)
    for pieces, places in _windows(pieces, places):
        edges = _edges(pieces, places, model)
        score, back = [0.0] + [-math.inf] * len(pieces), [None] * (len(pieces) + 1)
        for b in range(1, len(pieces) + 1):
            for a, text, s in edges[b]:
                if score[a] + s > score[b]:
                    score[b], back[b] = score[a] + s, (a, text)
        path, b = [], len(pieces)
        while b:
            b, text = back[b]
            path.append(text)
        out += reversed(path)
    return [x for x in (_plain(v) for v in out) if x]


def _plain(value: str) -> str:
    value = value.strip()
    while len(value) > 1 and ((value[0], value[-1]) in {("[", "]"), ("{", "}"), ("(", ")")} or QUOTES.get(value[0]) == value[-1] and value[0] != "'"):
        value = value[1:-1].strip()
    return value


def _sure(pieces: list, places: list) -> bool:
    return all(k in ("!", "hard") for k, _ in places)


def _sure_value(value: str, counts: Counter, pairs: bool) -> None:
    counts["v", value] += 1
    counts["s", shape(value)] += 1
    if pairs:
        words = _WORD.findall(value)
        counts.update(("w", f"{a} {b}") for a, b in zip(words, words[1:]))


def _expect(cell: str, model: Model | None, counts: Counter) -> None:
    """Add the expected counts of a cell: ('v', value), ('s', shape), ('+', kind), ('-', kind). Without a model only cells without choice count."""
    bare = cell.strip()
    if bare in NOTHING:
        return
    got = _json_list(bare)
    if model is None:
        counts.update(("w", w) for w in _WORD.findall(bare if got is None else " ".join(got)))
    if got is not None:
        for v in got:
            _sure_value(v, counts, model is None)
        return
    pieces, places = lattice(bare)
    if _sure(pieces, places) and (model is None or model.firm):
        for p, _ in pieces:
            _sure_value(p, counts, model is None)
        if model is not None:
            counts["+", "hard"] += sum(k == "hard" for k, _ in places[:-1])
        return
    if model is None:
        return
    pieces, places, passed = _contract(pieces, places, model)
    for kind in passed:
        counts["-", kind] += 1
    for ps, ks in _windows(pieces, places):
        edges = _edges(ps, ks, model)
        n = len(ps)
        fore, back = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
        for b in range(1, n + 1):
            xs = [fore[a] + s for a, _, s in edges[b]]
            m = max(xs)
            fore[b] = m + math.log(sum(math.exp(x - m) for x in xs))
        ends: list[list[float]] = [[] for _ in range(n + 1)]
        for b in range(n, 0, -1):
            if b < n:
                m = max(ends[b])
                back[b] = m + math.log(sum(math.exp(x - m) for x in ends[b]))
            for a, _, s in edges[b]:
                ends[a].append(s + back[b])
        cut = [0.0] * n
        for b in range(1, n + 1):
            for a, text, s in edges[b]:
                p = math.exp(fore[a] + s + back[b] - fore[n])
                if p > 1e-4:
                    cut[b - 1] += p
                    counts["v", text] += p
                    counts["s", shape(text)] += p
        for (kind, _), c in zip(ks[:-1] if ks[-1][0] == "!" else ks, cut):
            if kind != "!":
                counts["+", kind] += c
                counts["-", kind] += 1 - c


def _learn(cells: DataFrame, models: dict[str, Model] | None) -> dict[str, Model]:
    known = cells.sparkSession.sparkContext.broadcast(models)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = {}

        def out() -> pd.DataFrame:
            rows = [(f, *k, float(n)) for f, c in seen.items() for k, n in c.items()]
            seen.clear()
            return pd.DataFrame(rows, columns=["campo", "kind", "key", "n"]).astype({"n": "float64"})

        for pdf in batches:
            for field, cell in zip(pdf["campo"], pdf["cell"]):
                _expect(cell, known.value and known.value[field], seen.setdefault(field, Counter()))
            if sum(map(len, seen.values())) > FLUSH:
                yield out()
        yield out()

    counts = durable(cells.select("campo", "cell").mapInPandas(count, "campo string, kind string, key string, n double").groupBy("campo", "kind", "key").agg(F.sum("n").alias("n")))
    mass = counts.where("kind in ('s', 'w')").groupBy("campo").agg(F.sum("n").alias("mass"))
    kept = counts.join(F.broadcast(mass), "campo").where("kind in ('+', '-') or n >= mass * " + str(SHARE)).collect()
    parts: dict[str, dict[str, dict[str, float]]] = {r["campo"]: {"v": {}, "s": {}, "w": {}, "+": {}, "-": {}} for r in mass.collect()}
    for r in kept:
        parts[r["campo"]][r["kind"]][r["key"]] = r["n"]
    return {f: Model(p["v"], p["s"], p["w"] or models[f].words, {k: (p["+"].get(k, 0.0), p["-"].get(k, 0.0)) for k in {*p["+"], *p["-"]}}) for f, p in parts.items()}


def split_values(cells: DataFrame) -> DataFrame:
    """(campo, clave, posicion, valor) of the rows (campo, clave, cell); few fields, any number of rows."""
    # Of a key's repeated cells: a JSON list first, then quoted ones, then hard marks, then the rest.
    bare = F.trim("cell")
    choice = F.when(bare.startswith("["), 0).when(bare.contains('"'), 1).when(bare.rlike(r"[|;\t\n~·、；，]"), 2).otherwise(3)
    nothing = F.regexp_replace("cell", r"(?U)^\s+|\s+$", "").isin(*NOTHING)
    rows = cells.where(F.col("campo").isNotNull() & F.col("clave").isNotNull() & F.col("cell").isNotNull() & ~nothing)
    rows = durable(rows.groupBy("campo", "clave").agg(F.min(F.struct(choice.alias("choice"), F.col("cell"))).alias("m")).select("campo", "clave", F.col("m.cell").alias("cell")))
    # Fields whose cells leave no first count at all start from the first guesses.
    distinct = durable(rows.select("campo", "cell").distinct())
    fields = [r[0] for r in distinct.select("campo").distinct().collect()]
    empty = {f: Model({}, {}, {}, {}) for f in fields}
    models = {**empty, **_learn(distinct, None)}
    for _ in range(ROUNDS):
        models = {**empty, **_learn(distinct, models)}
    final = cells.sparkSession.sparkContext.broadcast(models)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(f, k, i, v) for f, k, c in zip(pdf["campo"], pdf["clave"], pdf["cell"]) for i, v in enumerate(best_values(c, final.value[f]), 1)]
            yield pd.DataFrame(out, columns=["campo", "clave", "posicion", "valor"]).astype({"posicion": "int32"})

    return rows.mapInPandas(cut, "campo string, clave string, posicion int, valor string")


def project_cells(documents: DataFrame, operons: DataFrame) -> DataFrame:
    doc = [documents.select(F.lit(f"documentos.{c}").alias("campo"), F.col("pmid").alias("clave"), F.col(c).alias("cell")) for c in ("autores", "mesh_terms")]
    op = [operons.select(F.lit(f"operones_bronze.{c}").alias("campo"), F.col("id").cast("string").alias("clave"), F.col(c).alias("cell")) for c in ("genes_raw", "locus_tags")]
    return doc[0].unionByName(doc[1]).unionByName(op[0]).unionByName(op[1])
