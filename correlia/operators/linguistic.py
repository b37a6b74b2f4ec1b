"""Text structure and matching that go beyond single expressions: sections, vocabularies, spans, dependency paths, joins by priority.

Nulls and empty texts give no rows (or null). Vocabularies are stated dictionaries; one beyond MOST_WORDS entries is refused
rather than broadcast.
"""

from __future__ import annotations

import difflib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from correlia.functions.text import word_groups

MOST_WORDS = 50_000


def markdown_sections(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, titulo, cuerpo): the parts between headings of one to six #; what stands before the first has a null heading."""
    parts = df.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, r"(?m)^#{1,6} ")).alias("pos", "part"))
    head = F.when(F.col("pos") > 0, F.trim(F.split_part("part", F.lit("\n"), F.lit(1))))
    body = F.when(F.col("pos") > 0, F.substr("part", F.length(F.split_part("part", F.lit("\n"), F.lit(1))) + 2)).otherwise(F.col("part"))
    return parts.select(key, "pos", head.alias("titulo"), F.trim(F.regexp_replace(body, r"^\s+|\s+$", "")).alias("cuerpo")).where("pos > 0 or cuerpo <> ''")


def member_names(token: Column) -> Column:
    """`pqsABC` as `pqsA, pqsB, pqsC`; anything else as an empty array."""
    stem, letters = F.substring(token, 1, 3), F.regexp_extract(token, r"^[a-z]{3}([A-Z]{2,})$", 1)
    return F.when(token.rlike(r"^[a-z]{3}[A-Z]{2,}$"), F.transform(F.sequence(F.lit(1), F.greatest(F.length(letters), F.lit(1))), lambda i: F.concat(stem, F.substr(letters, i, F.lit(1))))).otherwise(F.array().cast("array<string>"))


def hyphen_parts(token: Column) -> Column:
    """Segments of a hyphenated token that could each be a name."""
    return F.filter(F.split(token, "-"), lambda x: F.length(x) > 2)


def organisms(text: Column) -> Column:
    """Species names: an abbreviated genus or one of the listed ones, with the epithet."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"((?:[A-Z]\.|Pseudomonas|Escherichia|Bacillus|Salmonella) [a-z]{4,})"), 1))


def tag_vocabulary(df: DataFrame, key: str, text: str, vocabulary: dict[str, str]) -> DataFrame:
    """(key, tipo, texto, ini, fin) of the words and phrases of a vocabulary (phrase -> kind): the longest first, blanks and hyphens alike, no overlaps."""
    if len(vocabulary) > MOST_WORDS:
        raise ValueError(f"a vocabulary of {len(vocabulary)} entries is more than {MOST_WORDS}")
    flat = {" ".join(re.split(r"[-\s]+", p.lower())): k for p, k in vocabulary.items()}
    ways = sorted(flat, key=lambda p: (-len(p), p))
    pattern = r"(?<!\w)(?:" + "|".join(r"[-\s]+".join(map(re.escape, p.split(" "))) for p in ways) + r")(?!\w)"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = re.compile(pattern, re.IGNORECASE).finditer
        for pdf in batches:
            rows = [(k, flat[" ".join(re.split(r"[-\s]+", m[0].lower()))], m[0], m.start(), m.end()) for k, t in zip(pdf[key], pdf[text]) if t for m in find(t)]
            yield pd.DataFrame(rows, columns=[key, "tipo", "texto", "ini", "fin"])

    return df.select(key, text).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, tipo string, texto string, ini int, fin int")


@F.pandas_udf(T.StructType([T.StructField("texto", T.StringType()), T.StructField("mapa", T.ArrayType(T.IntegerType()))]))
def squeeze_with_map(texts: pd.Series) -> pd.DataFrame:
    """Text with white space collapsed, and for every character of it the place it came from."""
    out = []
    for t in texts:
        if t is None:
            out.append((None, None))
            continue
        chars: list[str] = []
        places: list[int] = []
        for i, c in enumerate(t):
            if not c.isspace():
                chars.append(c)
                places.append(i)
            elif chars and chars[-1] != " ":
                chars.append(" ")
                places.append(i)
        if chars and chars[-1] == " ":
            chars.pop()
            places.pop()
        out.append(("".join(chars), places))
    return pd.DataFrame(out, columns=["texto", "mapa"])


@F.pandas_udf(T.StringType())
def first_json(texts: pd.Series) -> pd.Series:
    """First JSON object of a text that may go on after it, reasoning blocks taken out first; null if there is none."""
    decode = json.JSONDecoder().raw_decode

    def one(t: str | None) -> str | None:
        t = re.sub(r"(?s)<think>.*?</think>", "", t or "")
        at = t.find("{")
        while at >= 0:
            try:
                return json.dumps(decode(t, at)[0], ensure_ascii=False, sort_keys=True)
            except ValueError:
                at = t.find("{", at + 1)
        return None

    return texts.map(one)


_TREE = T.ArrayType(T.StructType([T.StructField(n, k) for n, k in (("i", T.IntegerType()), ("lemma", T.StringType()), ("dep", T.StringType()), ("head", T.IntegerType()))]))
_PATH = T.StructType([T.StructField("ancestro", T.IntegerType()), T.StructField("camino", T.StringType()), T.StructField("sentido", T.StringType())])


def dependency_path(tree: list[dict], a: int, b: int) -> tuple[int | None, str | None, str | None]:
    """(lowest common ancestor, path, orientation) of two tokens of a parsed sentence (i, lemma, dep, head; a root is its own head).

    Oriented only if one side governs as subject (or agent of a passive) and the other as object (or passive subject).
    """
    by = {t["i"]: t for t in tree}

    def chain(x: int) -> list[int]:
        out = [x]
        while x in by and by[x]["head"] != x and by[x]["head"] in by and by[x]["head"] not in out:
            x = by[x]["head"]
            out.append(x)
        return out

    if a not in by or b not in by:
        return None, None, None
    up, down = chain(a), chain(b)
    common = next((x for x in up if x in down), None)
    if common is None:
        return None, None, None
    left, right = up[: up.index(common)], down[: down.index(common)]
    path = "".join(f"<{by[x]['dep']}" for x in left) + f"[{by[common]['lemma']}]" + "".join(f">{by[x]['dep']}" for x in reversed(right))

    def role(side: list[int]) -> str:
        deps = [by[x]["dep"] for x in side]
        if "agent" in deps:
            return "agente"
        if "nsubjpass" in deps:
            return "paciente"
        if "nsubj" in deps:
            return "sujeto"
        return "objeto" if {"dobj", "pobj", "obj"} & set(deps) else ""

    roles = (role(left), role(right))
    forward = roles in {("sujeto", "objeto"), ("agente", "paciente")}
    backward = roles in {("objeto", "sujeto"), ("paciente", "agente")}
    return common, path, "1>2" if forward else "2>1" if backward else None


def dependency_paths(df: DataFrame, tree: str, a: str, b: str) -> DataFrame:
    """With struct column `sintaxis` (ancestro, camino, sentido) of tokens a and b in the parse `tree`."""

    @F.pandas_udf(_PATH)
    def run(trees: pd.Series, xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
        got = [dependency_path([dict(t) for t in tr] if tr is not None else [], x, y) for tr, x, y in zip(trees, xs, ys)]
        return pd.DataFrame(got, columns=["ancestro", "camino", "sentido"]).astype({"ancestro": "Int32"})

    return df.withColumn("sintaxis", run(F.col(tree), F.col(a), F.col(b)))


#: Characters by which texts of few words meet.
CHARACTERS = 8


def _containing(pairs: DataFrame, d: DataFrame, r: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id_col, rid) of those pairs of which one text contains the other."""
    both = pairs.distinct().join(d, id_col).join(r, "rid")
    return both.where(F.contains(text, F.col("reservada")) | F.contains("reservada", F.col(text))).select(id_col, "rid")


def contained_texts(rows: DataFrame, reserved: DataFrame, id_col: str, text: str, words: int = 5) -> DataFrame:
    """Ids of rows whose text equals, holds, or lies within a reserved text (column `reservada`), without comparing all with all.

    If one text lies in another, the first `words` words of the shorter stand somewhere in the longer: only pairs that
    meet in such a group are compared.
    """

    def cut(c: str) -> Column:
        return F.filter(F.split(F.lower(F.col(c)), r"\W+"), lambda x: x != "")

    def grams(c: str) -> Column:
        return F.array_distinct(word_groups(cut(c), words))

    def first(c: str) -> Column:
        # The first and last word of a text may be cut pieces of longer ones, so the group starts at the second.
        w = cut(c)
        return F.xxhash64(F.array_join(F.slice(w, 2, words), " "))

    r = reserved.select("reservada").where(F.length("reservada") > 0).distinct().withColumn("rid", F.xxhash64("reservada"))
    d = rows.select(id_col, text).where(F.length(text) > 0)
    long_enough = lambda c: F.size(cut(c)) >= words + 2
    holds = d.select(id_col, grams(text).alias("g")).select(id_col, F.explode("g").alias("g")).join(r.where(long_enough("reservada")).select("rid", first("reservada").alias("g")), "g").select(id_col, "rid")
    within = d.where(long_enough(text)).select(id_col, first(text).alias("g")).join(r.select("rid", grams("reservada").alias("g")).select("rid", F.explode("g").alias("g")), "g").select(id_col, "rid")
    pairs = _containing(holds.unionByName(within), d, r, id_col, text)
    # Shorter texts meet by the characters they open with: as many as they have, CHARACTERS at most.
    sizes = lambda df, c: [x[0] for x in df.where(~long_enough(c)).select(F.least(F.length(c), F.lit(CHARACTERS))).distinct().collect()]

    def cuts(c: str, k: int) -> Column:
        places = F.sequence(F.lit(1), F.length(c) - (k - 1))
        return F.when(F.length(c) >= k, F.transform(places, lambda i: F.xxhash64(F.substr(F.col(c), i, F.lit(k))))).otherwise(F.array().cast("array<bigint>"))

    def pieces(df: DataFrame, keep: str, c: str, some: list[int]) -> DataFrame:
        return df.select(keep, F.explode(F.array_distinct(F.concat(*[cuts(c, k) for k in some]))).alias("g"))

    opening = lambda df, keep, c: df.where(~long_enough(c)).select(keep, F.xxhash64(F.substring(c, 1, CHARACTERS)).alias("g"))
    if some := sizes(r, "reservada"):
        pairs = pairs.unionByName(_containing(pieces(d, id_col, text, some).join(opening(r, "rid", "reservada"), "g").select(id_col, "rid"), d, r, id_col, text))
    if some := sizes(d, text):
        pairs = pairs.unionByName(_containing(opening(d, id_col, text).join(pieces(r, "rid", "reservada", some), "g").select(id_col, "rid"), d, r, id_col, text))
    equal = d.join(r.select(F.col("reservada").alias(text)), text, "left_semi").select(id_col)
    return pairs.select(id_col).unionByName(equal).distinct()


def first_match(left: DataFrame, right: DataFrame, keys: list[list[tuple[str, str]]], id_col: str, found: str) -> DataFrame:
    """`left` with the `found` of the first key list under which `right` has a match (its smallest), and which one (`regla`, from 1)."""
    out = left
    for n, pairs in enumerate(keys, 1):
        table = right.groupBy(*[F.col(r).alias(f"__k{i}") for i, (_, r) in enumerate(pairs)]).agg(F.min(found).alias(f"__f{n}"))
        cond = [F.col(a) == F.col(f"__k{i}") for i, (a, _) in enumerate(pairs)]
        out = out.join(table, cond, "left").drop(*[f"__k{i}" for i in range(len(pairs))])
    some = [F.col(f"__f{n}") for n in range(1, len(keys) + 1)]
    rule = F.coalesce(*[F.when(c.isNotNull(), n) for n, c in enumerate(some, 1)])
    return out.withColumns({found: F.coalesce(*some), "regla": rule}).drop(*[f"__f{n}" for n in range(1, len(keys) + 1)])


def fuzzy_sentences(left: DataFrame, right: DataFrame, group: str, threshold: float = 0.85, candidates: int = 6) -> DataFrame:
    """(group, lid, rid, parecido): of each left sentence (group, lid, texto) the likest right one of its document by matching blocks.

    Sentences meet by the words they share; the operator is defined to compare, for each left sentence, the `candidates`
    that share most.
    """
    w = lambda df, i: df.select(group, i, F.explode(F.array_distinct(F.regexp_extract_all(F.lower("texto"), F.lit(r"(\w{4,})"), 1))).alias("w"))
    votes = w(left, "lid").join(w(right, "rid"), [group, "w"]).groupBy(group, "lid", "rid").agg(F.count(F.lit(1)).alias("v"))
    top = votes.withColumn("k", F.row_number().over(W.partitionBy(group, "lid").orderBy(F.desc("v"), "rid"))).where(F.col("k") <= candidates)
    texts = top.join(left.select(group, "lid", F.col("texto").alias("a")), [group, "lid"]).join(right.select(group, "rid", F.col("texto").alias("b")), [group, "rid"])

    @F.pandas_udf(T.DoubleType())
    def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([1.0 if x in y else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b)], dtype="float64")

    best = texts.withColumn("s", likeness("a", "b")).groupBy(group, "lid").agg(F.max(F.struct("s", (-F.col("rid")).alias("o"), "rid")).alias("m"))
    return best.where(F.col("m.s") >= threshold).select(group, "lid", F.col("m.rid").alias("rid"), F.round("m.s", 6).alias("parecido"))


def within_cap(df: DataFrame, group: list[str], order: list[str], cost: str, cap: float) -> DataFrame:
    """Rows whose running cost within the group stays at or below the cap."""
    w = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("gastado", F.round(F.sum(cost).over(w), 6)).where(F.col("gastado") <= cap)


def field_scores(df: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """(campo, n, iguales, no_aplica) of pairs of columns (said, expected): a null expectation does not apply."""
    out = None
    for said, expected in fields:
        row = df.agg(F.count(F.col(expected)).alias("n"), F.count_if(F.col(said) == F.col(expected)).alias("iguales"), F.count_if(F.col(expected).isNull()).alias("no_aplica")).select(F.lit(said).alias("campo"), "n", "iguales", "no_aplica")
        out = row if out is None else out.unionByName(row)
    return out
