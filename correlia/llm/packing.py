"""Filling fixed-capacity containers (problem 7): pattern packing by non-negative least squares.

Texts are measured in tokens of a public tokenizer; those longer than a container are cut into full pieces and
a rest. All planning is done on the histogram of piece sizes, at most CAPACITY numbers whatever the input:
patterns of at most FEW sizes that fill a container (nearly) have their repeat counts fitted to the histogram by
non-negative least squares, are rounded to what is there, and the residual histogram is packed by best fit, again
pattern by pattern. Which of the many millions of such patterns take part is not cut off: each round of the fit prices all
of them at what the histogram still lacks, by a dynamic programme over (number of sizes, tokens), and takes in the best one
for every size; it ends when no pattern left out would lessen the misfit by GAIN of it. The plan says which ranks of each size go to which containers; it is bounded by the
patterns and broadcast. The rank of a piece among those of its size is counted in RANK_BLOCKS blocks per size, so
that a size that many pieces share is not ranked in one task.

Defined cases: null and empty texts have no tokens and get one row without container; a doc_id counts once;
an empty table gives an empty result; texts of any length are measured whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from correlia.runtime import durable

CAPACITY, RANK_BLOCKS = 2048, 256
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how the byte-level BPE vocabularies cut text before merging.
PRETOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Patterns: documents of one, tokens that may stay empty; steps of a fit; share of the misfit that another round must win.
FEW, SLACK, STEPS, GAIN = 4, 4, 40, 0.3
#: Shares of the fitted repeats that are tried; 1 rounds to the nearest, the others down.
ROUNDINGS = (1, 0.999, 0.8, 0.5)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})


def token_sizes(df: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """(id_col, n_tokens); null texts have 0."""
    kind = dict(df.dtypes)[id_col]

    def size(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(path).encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({id_col: pdf[id_col], "n_tokens": np.array([len(encode(t)) if t else 0 for t in pdf[text]], dtype="int64")})

    sized = df.select(id_col, text).where(F.col(id_col).isNotNull()).mapInPandas(size, f"{id_col} {kind}, n_tokens long")
    return durable(sized.groupBy(id_col).agg(F.max("n_tokens").alias("n_tokens")))


def fit_patterns(hist: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(sizes of a container, repeats) that use up hist[size] exactly; hist[0] is ignored."""
    capacity = len(hist) - 1
    whole = hist.astype(np.int64).copy()
    whole[0] = 0
    patterns, x = _fitted(whole)
    if not patterns:
        return _best_fit(whole)
    index = np.zeros((len(patterns), FEW), dtype=np.int64)
    for i, p in enumerate(patterns):
        index[i, : len(p)] = p
    used = index > 0
    order = np.lexsort((-x, capacity - index.sum(axis=1)))
    best: list[tuple[tuple[int, ...], int]] = []
    # Small pieces are worth keeping for the residual: of the ways to round the repeats the best is kept.
    for share in ROUNDINGS:
        left, plan = whole.copy(), []
        counts = np.round(x) if share == 1 else np.floor(x * share)
        for i in order[counts[order] >= 1]:
            sizes, need = np.unique(index[i][used[i]], return_counts=True)
            repeats = int(min(counts[i], (left[sizes] // need).min()))
            if repeats > 0:
                left[sizes] -= need * repeats
                plan.append((patterns[i], repeats))
        plan += _best_fit(left)
        if not best or sum(r for _, r in plan) < sum(r for _, r in best):
            best = plan
    return best


def _priced(price: np.ndarray, present: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], float]]:
    """For every present size the dearest pattern with it, of at most FEW sizes, that leaves at most SLACK empty; and what it is worth."""
    # best[k][c]: worth of k sizes that make exactly c tokens; last[k][c]: one of them.
    best, last = [np.full(capacity + 1, -np.inf)], [np.zeros(capacity + 1, dtype=np.int64)]
    best[0][0] = 0.0
    pay = price[present]
    for _ in range(FEW - 1):
        now, came = np.full(capacity + 1, -np.inf), np.zeros(capacity + 1, dtype=np.int64)
        for s, v in zip(present.tolist(), pay.tolist()):
            got = best[-1][: capacity + 1 - s] + v
            better = got > now[s:]
            now[s:][better], came[s:][better] = got[better], s
        best.append(now)
        last.append(came)
    out = []
    table = np.array(best)
    for a, v in zip(present.tolist(), pay.tolist()):
        low = max(0, capacity - SLACK - a)
        room = table[:, low : capacity - a + 1]
        k, c = divmod(int(room.argmax()), room.shape[1])
        if room[k, c] == -np.inf:
            continue
        c += low
        sizes = [a]
        worth = v + table[k, c]
        while k:
            s = int(last[k][c])
            sizes.append(s)
            k, c = k - 1, c - s
        out.append((tuple(sorted(sizes, reverse=True)), float(worth)))
    return out


def _fitted(whole: np.ndarray) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """Patterns and their fitted repeats: those taken in are, up to GAIN, as good as all patterns together."""
    capacity = len(whole) - 1
    target = whole.astype(float)
    present = np.flatnonzero(whole)
    patterns: dict[tuple[int, ...], None] = {}
    x, lack = np.zeros(0), target
    misfit = float(target @ target)
    while True:
        new = [p for p, worth in _priced(lack, present, capacity) if worth > 0.5 and p not in patterns]
        if not new:
            break
        patterns.update(dict.fromkeys(sorted(set(new))))
        index = np.zeros((len(patterns), FEW), dtype=np.int64)
        for i, p in enumerate(patterns):
            index[i, : len(p)] = p
        used = index > 0
        x = _nnls(index, used, target, np.concatenate([x, np.zeros(len(patterns) - len(x))]))
        lack = target - np.bincount(index[used], weights=x[np.nonzero(used)[0]], minlength=capacity + 1)
        now = float(lack @ lack)
        if now > (1 - GAIN) * misfit:
            break
        misfit = now
    return list(patterns), x


def _nnls(index: np.ndarray, used: np.ndarray, target: np.ndarray, start: np.ndarray) -> np.ndarray:
    """min |A x - target|, x >= 0, by accelerated projected gradient from `start`; A has a 1 for each size of a pattern."""
    n = len(target)
    flat, rows = index[used], np.nonzero(used)[0]

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, weights=x[rows], minlength=n)

    def back(r: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=r[flat], minlength=len(index))

    v = np.ones(len(index))
    for _ in range(20):
        v = back(forward(v))
        v /= np.linalg.norm(v) or 1.0
    bound = float(np.linalg.norm(back(forward(v)))) * 1.01 or 1.0
    x = y = start
    t = 1.0
    for _ in range(STEPS):
        z = np.maximum(0.0, y - back(forward(y) - target) / bound)
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = z + (t - 1) / s * (z - x)
        x, t = z, s
    return x


def _best_fit(left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Largest size first, the room filled by the largest sizes that fit; a pattern repeats as often as its sizes last."""
    capacity = len(left) - 1
    plan = []
    sizes = np.flatnonzero(left).tolist()
    while sizes:
        if not left[sizes[-1]]:
            sizes.pop()
            continue
        pattern, room, take = [], capacity, {}
        at = len(sizes) - 1
        while room and at >= 0:
            s = sizes[at]
            if s <= room and (n := min(room // s, int(left[s]))):
                pattern += [s] * n
                take[s] = n
                room -= s * n
            at = min(at - 1, int(np.searchsorted(sizes, room, side="right")) - 1)
        repeats = min(int(left[s]) // n for s, n in take.items())
        for s, n in take.items():
            left[s] -= n * repeats
        plan.append((tuple(pattern), repeats))
    return plan


def allotments(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per size, rows (first rank, first container, places per container, first place, first token)."""
    ranks: dict[int, int] = {}
    rows: dict[int, list] = {}
    container = 0
    for pattern, repeats in plan:
        place = token = 0
        for size, n in sorted(((s, pattern.count(s)) for s in set(pattern)), reverse=True):
            first = ranks.get(size, 0)
            rows.setdefault(size, []).append((first, container, n, place, token))
            ranks[size] = first + n * repeats
            place += n
            token += n * size
        container += repeats
    return {s: np.array(r, dtype=np.int64) for s, r in rows.items()}


def pack(df: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str = TOKENIZER) -> DataFrame:
    """(id_col, pieza, n_tokens, desde, contenedor, lugar, inicio): every piece with its first token in the text, its container, place and first token there."""
    sizes = token_sizes(df, id_col, text, path)
    pieces = sizes.where("n_tokens > 0").select(
        id_col, F.col("n_tokens").alias("all"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / capacity))).alias("pieza")
    )
    pieces = pieces.select(id_col, "pieza", F.least(F.lit(capacity).cast("long"), F.col("all") - F.col("pieza") * capacity).alias("size"), F.pmod(F.xxhash64(id_col, "pieza"), F.lit(RANK_BLOCKS)).alias("block"))
    pieces = durable(pieces)
    blocks = pieces.groupBy("size", "block").agg(F.count(F.lit(1)).alias("n"))
    by = W.partitionBy("size").orderBy("block")
    offsets = durable(blocks.select("size", "block", "n", (F.sum("n").over(by) - F.col("n")).alias("before")))
    hist = np.zeros(capacity + 1, dtype=np.int64)
    for r in offsets.groupBy("size").agg(F.sum("n").alias("n")).collect():
        hist[r["size"]] = r["n"]
    table = df.sparkSession.sparkContext.broadcast(allotments(fit_patterns(hist)))
    kind = dict(df.dtypes)[id_col]
    numbered = pieces.withColumn("rank", F.row_number().over(W.partitionBy("size", "block").orderBy(id_col, "pieza")))
    ranked = numbered.join(offsets.select("size", "block", "before"), ["size", "block"]).select(id_col, "pieza", "size", (F.col("before") + F.col("rank") - 1).alias("rank"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size, rank = pdf["size"].to_numpy(), pdf["rank"].to_numpy()
            container, spot, token = (np.zeros(len(pdf), dtype=np.int64) for _ in range(3))
            for s in np.unique(size):
                mine, rows = size == s, table.value[int(s)]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], side="right") - 1]
                turn = rank[mine] - row[:, 0]
                container[mine] = row[:, 1] + turn // row[:, 2]
                spot[mine] = row[:, 3] + turn % row[:, 2]
                token[mine] = row[:, 4] + turn % row[:, 2] * s
            yield pd.DataFrame({id_col: pdf[id_col], "pieza": pdf["pieza"], "n_tokens": size, "desde": pdf["pieza"] * capacity, "contenedor": container, "lugar": spot, "inicio": token})

    schema = f"{id_col} {kind}, pieza long, n_tokens long, desde long, contenedor long, lugar long, inicio long"
    nothing = [F.lit(0).cast("long").alias(c) for c in ("pieza", "n_tokens", "desde")] + [F.lit(None).cast("long").alias(c) for c in ("contenedor", "lugar", "inicio")]
    return ranked.mapInPandas(place, schema).unionByName(sizes.where("n_tokens = 0").select(id_col, *nothing))


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, tokens, the least number of containers that could hold them, and the filled share."""
    used = packed.where("contenedor is not null").agg(F.countDistinct("contenedor").alias("contenedores"), F.sum("n_tokens").alias("n_tokens"))
    return used.select("contenedores", "n_tokens", F.ceil(F.col("n_tokens") / capacity).alias("minimo"), F.round(F.col("n_tokens") / (F.col("contenedores") * capacity), 6).alias("llenado"))
