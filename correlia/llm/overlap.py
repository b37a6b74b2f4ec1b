"""Same or near-same records across splits (problem 5): edit-distance segment join over words.

Two texts of n and m words match if their longest common subsequence has at least 0.8 * max(n, m) words.
Then at most k(n, m) = n + m - 2 * ceil(0.8 * max(n, m)) word edits part them, so of any k + 1 segments
of the evaluation text at least one stands unbroken in the training text, moved by no more words than the
lengths allow. The cut into k + 1 segments is free: a dynamic programme chooses the one whose segments are
rarest in the training side. Training substrings are matched at the allowed positions only, 128-bit word
signatures drop pairs that miss too many words (never a true one), and a banded dynamic programme, run
bit-parallel, verifies the rest.

Equal texts are one class before the join, so copies cost nothing; `classes_of` gives the classes,
`near_links` the pairs of class representatives, `row_pairs` the pairs of rows.

Spark takes a text for 20 bytes and the sixty substrings of one for less than the text, so by its estimates it would
broadcast, through the driver, what is hundreds of times the session's limit. Joins whose sides are known by such estimates
alone are merge joins, and texts are joined by their digest, so that no text reaches the driver.

Defined cases: null texts and texts without a word match nothing; a null split is neither training nor
evaluation; repeated rows of an id count once; an empty side gives an empty result; texts of any length
are compared whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from correlia.llm.splits import MARKS
from correlia.runtime import durable, lookup_join

SHARE = 0.8
#: Words and word groups that make at least this share of all words are frequent: at most 25,000 words (and as many groups of each length).
FREQUENT = 4e-5
#: Longest word group that serves as key, longest segment, and estimated shares of what is not frequent.
GRAM, SEGMENT, RARE_WORD, RARE_GRAM = 4, 12, 1e-5, 2e-5
#: Texts beyond this many words are cut evenly: any cut into k + 1 segments finds every match, a chosen one costs less in the
#: join, but to choose takes time as the square of the length.
CHOSEN_UPTO = 96
#: Width of a position bucket; index rows of a key, and rows of a class of equal texts, that one task is to hold.
BUCKET, PART_ROWS = 8, 20_000

_MARK = re.compile(MARKS)
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Words of letters and digits, without marks, compatibility characters unified, in lower case."""
    return _WORD.findall(unicodedata.normalize("NFKC", _MARK.sub(" ", text or "")).lower())


def needed(n: int, m: int) -> int:
    return ceil(SHARE * max(n, m) - 1e-9)


def lengths(n: int) -> range:
    """Lengths m that can match n."""
    return range(needed(n, 1), int(n / SHARE + 1e-9) + 1)


def max_edits(n: int) -> int:
    return max(n + m - 2 * needed(n, m) for m in lengths(n)) if n else 0


def banded_lcs(a: list, b: list, left: int, right: int) -> int:
    """Longest common subsequence whose matches a[i] = b[j] have -left <= j - i <= right; one machine word row per b[j]."""
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    n = len(a)
    full = (1 << n) - 1
    v = full
    for j, y in enumerate(b):
        lo, hi = max(0, j - right), min(n, j + left + 1)
        if (m := at.get(y, 0)) and hi > lo and (m := m & ((1 << hi) - (1 << lo))):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def similar(a: list, b: list) -> bool:
    need = needed(len(a), len(b))
    return min(len(a), len(b)) >= need > 0 and banded_lcs(a, b, len(a) - need, len(b) - need) >= need


def _key(words: list[str]) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(words)) - (1 << 63)


def _signature(words: list[str]) -> tuple[int, int]:
    one = two = 0
    for w in set(words):
        h = xxhash.xxh32_intdigest(w)
        if h & 64:
            one |= 1 << (h & 63)
        else:
            two |= 1 << (h & 63)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return signed(one), signed(two)


def _grams(words: list[str], frequent: set[str]) -> Iterator[tuple[int, int, int]]:
    """(position, length, key) of every word and of every group of up to GRAM frequent words."""
    run = 0
    for end, w in enumerate(words, 1):
        run = run + 1 if w in frequent else 0
        yield end - 1, 1, _key(words[end - 1 : end])
        for size in range(2, min(run, GRAM) + 1):
            yield end - size, size, _key(words[end - size : end])


def choose_segments(words: list[str], frequent: set[str], shares: dict[int, float]) -> list[tuple[int, int]]:
    """The keys (position, key) of k + 1 disjoint segments that cover the text, of least total share."""
    n = len(words)
    parts = max_edits(n) + 1
    own = {(i, g): (shares.get(key, RARE_GRAM if g > 1 else RARE_WORD), i, key) for i, g, key in _grams(words, frequent)}
    if n > CHOSEN_UPTO:
        cuts = [round(n * p / parts) for p in range(parts + 1)]
        return [min(own[i, g] for i in range(a, b) for g in range(1, min(GRAM, b - i) + 1) if (i, g) in own)[1:] for a, b in zip(cuts, cuts[1:])]
    best: dict[tuple[int, int], tuple] = {}
    cost = np.full((SEGMENT + 1, n + 1), np.inf)
    for size in range(1, min(SEGMENT, n) + 1):
        for i in range(n - size + 1):
            options = [x for x in (own.get((i, size)), best.get((i, size - 1)), best.get((i + 1, size - 1))) if x]
            best[i, size] = min(options)
            cost[size, i + size] = best[i, size][0]
    total = np.full(n + 1, np.inf)
    total[0] = 0.0
    back = []
    for _ in range(parts):
        table = np.full((SEGMENT + 1, n + 1), np.inf)
        for size in range(1, min(SEGMENT, n) + 1):
            table[size, size:] = total[:-size] + cost[size, size:]
        back.append(table.argmin(axis=0))
        total = table.min(axis=0)
    out, end = [], n
    for sizes in reversed(back):
        size = int(sizes[end])
        out.append(best[end - size, size][1:])
        end -= size
    return out


@F.pandas_udf(T.StringType())
def _canon(text: pd.Series) -> pd.Series:
    return text.map(lambda t: " ".join(words_of(t)))


def sided_rows(df: DataFrame, id_col: str = "ejemplo_id", text: str = "text", split: str = "particion", train: tuple = ("train",), held: tuple = ("dev", "test")) -> DataFrame:
    """One row per record of either side: (id, side, canon)."""
    part = F.lower(F.trim(split))
    rows = df.select(F.col(id_col).alias("id"), F.when(part.isin(*train), "train").when(part.isin(*held), "held").alias("side"), _canon(F.col(text)).alias("canon"))
    return durable(rows.where("canon <> '' and side is not null and id is not null").dropDuplicates(["id"]))


def _frequent_words(texts: DataFrame) -> set[str]:
    words = texts.select(F.explode(F.split("canon", " ")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    words = durable(words)
    total = words.agg(F.sum("n")).first()[0] or 0
    return {r["w"] for r in words.where(F.col("n") >= max(2, total * FREQUENT)).select("w").collect()}


def _frequent_keys(texts: DataFrame, frequent) -> tuple[dict[int, float], int]:
    """Share of the training words at which a key stands, for keys that reach FREQUENT; and the number of these words."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common, seen = frequent.value, Counter()
        for pdf in batches:
            for canon in pdf["canon"]:
                words = canon.split(" ")
                seen.update(key for at, size, key in _grams(words, common) if size > 1 or words[at] in common)
            if len(seen) > 200_000:
                yield pd.DataFrame({"key": list(seen), "n": list(seen.values())})
                seen.clear()
        yield pd.DataFrame({"key": list(seen), "n": list(seen.values())}, dtype="int64")

    counts = durable(texts.select("canon").mapInPandas(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))
    total = texts.agg(F.sum(F.size(F.split("canon", " ")))).first()[0] or 1
    return {r["key"]: r["n"] / total for r in counts.where(F.col("n") >= max(2, total * FREQUENT)).collect()}, total


def near_links(classes: DataFrame) -> DataFrame:
    """Pairs (held, train) of class ids whose texts differ and match, from one row per class (clase, canon, in_train, in_held)."""
    spark = classes.sparkSession
    train, held = classes.where("in_train").select("clase", "canon"), classes.where("in_held").select("clase", "canon")
    common = spark.sparkContext.broadcast(_frequent_words(train))
    found, total = _frequent_keys(train, common)
    shares = spark.sparkContext.broadcast(found)
    schema = "clase long, n int, one long, two long, pos int, key long, parts int"

    def rows(batches: Iterator[pd.DataFrame], keys) -> Iterator[pd.DataFrame]:
        frequent, share = common.value, shares.value
        for pdf in batches:
            out = []
            for clase, canon in zip(pdf["clase"], pdf["canon"]):
                words = canon.split(" ")
                sig = _signature(words)
                out += [(clase, len(words), *sig, pos, key, ceil(share.get(key, 0) * total / PART_ROWS) or 1) for pos, key in keys(words, frequent, share)]
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=["clase", "n", "one", "two", "pos", "key", "parts"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=["clase", "n", "one", "two", "pos", "key", "parts"])

    def substrings(words, frequent, share):
        return [(pos, key) for pos, _, key in _grams(words, frequent)]

    index = train.mapInPandas(lambda b: rows(b, substrings), schema)
    index = index.withColumn("bucket", F.floor(F.col("pos") / BUCKET)).withColumn("salt", F.pmod(F.xxhash64("clase"), F.col("parts")))
    probes = held.mapInPandas(lambda b: rows(b, choose_segments), schema)
    # A segment moves left by the words the held text may lose, right by those the training text may add.
    left = F.col("n") - F.ceil(F.col("n") * SHARE - 1e-9)
    right = F.floor(F.col("n") / SHARE + 1e-9) - F.ceil(F.floor(F.col("n") / SHARE + 1e-9) * SHARE - 1e-9)
    probes = probes.withColumns({"lo": F.greatest(F.lit(0), F.col("pos") - left), "hi": F.col("pos") + right})
    probes = probes.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("lo") / BUCKET), F.floor(F.col("hi") / BUCKET))))
    probes = probes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    p, t = probes.alias("p"), index.hint("merge").alias("t")
    need = F.ceil(F.greatest("p.n", "t.n") * SHARE - 1e-9)
    missing = lambda a, b: F.bit_count(F.col(f"{a}.one").bitwiseAND(F.bitwise_not(f"{b}.one"))) + F.bit_count(F.col(f"{a}.two").bitwiseAND(F.bitwise_not(f"{b}.two")))
    found = p.join(
        t,
        (F.col("p.key") == F.col("t.key")) & (F.col("p.bucket") == F.col("t.bucket")) & (F.col("p.salt") == F.col("t.salt"))
        & F.col("t.pos").between(F.col("p.lo"), F.col("p.hi")) & (F.least("p.n", "t.n") >= need) & (F.col("p.clase") != F.col("t.clase"))
        & (missing("p", "t") <= F.col("p.n") - need) & (missing("t", "p") <= F.col("t.n") - need),
    )
    pairs = durable(found.select(F.col("p.clase").alias("held"), F.col("t.clase").alias("train")).distinct())

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [similar(a.split(" "), b.split(" ")) for a, b in zip(pdf["a"], pdf["b"])]
            yield pdf.loc[keep, ["held", "train"]]

    text_of = lambda side, key, name: side.select(F.col("clase").alias(key), F.col("canon").alias(name)).hint("merge")
    texts = pairs.join(text_of(held, "held", "a"), "held").join(text_of(train, "train", "b"), "train")
    return texts.mapInPandas(verify, "held long, train long")


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per distinct text; its class id is the smallest row id. Partial aggregates, no group is gathered."""
    return durable(rows.groupBy("canon").agg(F.min("id").alias("clase"), F.max(F.col("side") == "train").alias("in_train"), F.max(F.col("side") == "held").alias("in_held")))


def links(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Linked classes (held, train): near ones, and classes with rows on both sides to themselves."""
    both = classes.where("in_train and in_held").select(F.col("clase").alias("held"), F.col("clase").alias("train"))
    return durable(near_links(classes).unionByName(both))


def members(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, side, clase) of every row; the classes with many rows go through `lookup_join`."""
    digest = F.sha2("canon", 256).alias("digest")
    return lookup_join(rows.select("id", "side", digest), classes.select(digest, "clase").hint("merge"), "digest", "inner").select("id", "side", "clase")


def row_pairs(rows: DataFrame, classes: DataFrame, linked: DataFrame) -> DataFrame:
    """Row pairs (ejemplo_a, ejemplo_b), smaller id first; the rows of a class are dealt into parts of about PART_ROWS on both sides.

    A class with m training and n evaluation rows gives m * n pairs, as the result asks for row pairs; `links` and
    `members` say the same without them.
    """
    member = durable(members(rows, classes))
    sizes = durable(member.groupBy("clase", "side").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("parts")))
    parts_of = lambda side, key: sizes.where(F.col("side") == side).select(F.col("clase").alias(key), "parts")

    def dealt(side: str, key: str, id_to: str) -> DataFrame:
        mine = member.where(F.col("side") == side).select(F.col("id").alias(id_to), F.col("clase").alias(key))
        return lookup_join(mine, parts_of(side, key), key, "inner").withColumn("part", F.pmod(F.xxhash64(id_to), F.col("parts"))).drop("parts")

    def spread(df: DataFrame, side: str, key: str) -> DataFrame:
        return lookup_join(df, parts_of(side, key), key, "inner").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")

    half = durable(spread(linked, "held", "held").join(dealt("held", "held", "x"), ["held", "part"]).select("x", "train"))
    pairs = spread(half, "train", "train").join(dealt("train", "train", "y"), ["train", "part"])
    return pairs.select(F.least("x", "y").alias("ejemplo_a"), F.greatest("x", "y").alias("ejemplo_b"))
