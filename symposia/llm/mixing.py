"""Mixing sources to target weights (problem 9) by the cube method.

The total is the largest one that every source can reach within its repeats (or the one asked for, if smaller):
with ``D`` tokens and at most ``m`` uses of a document, a source supports ``m * D / share``. A source then needs
``c = share * total / D`` copies of each of its documents: ``floor(c)`` are certain, the fraction is an inclusion
probability. Fractions are settled by balanced sampling: three undecided documents at a time are moved along the
direction that changes neither their expected number nor their expected tokens (the null space of the two
constraints) until one of them is decided. This flight runs per block of a source, blocks being bounded whatever a
source's size; at most a handful of undecided documents are left per block and fly again together in the next, much
smaller round, until each source has one block. The landing then decides the last few by trying every outcome and
keeping the one with the least deviation in tokens.

Shares are relative to the sources that have tokens: a target whose source has none cannot be reached, is reported
with 0, and the other targets keep their proportions. Sources without a target take no part. Documents without
tokens (null or empty text) cannot change a share and are left out. Repeated target rows of one source: the greatest
share counts. Ties are settled by a seeded hash of the document id. No targets or documents: empty results.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.llm.tokens import encode_column
from symposia.runtime import cut, lookup, read

BLOCK_ROWS = 50_000
LEAST_BLOCK = 2_000
SEED = 20_240_101
EPS = 1e-9


def flight(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Move undecided chances to 0 or 1, keeping their sum and the sum of chance * size; leaves at most two undecided."""
    p = chance.astype(float).copy()
    undecided = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    coins = np.random.default_rng(len(p) + SEED).random(2 * len(undecided) + 8).tolist()
    # plain numbers: a step moves three of them
    waiting = iter(zip(undecided.tolist(), p[undecided].tolist(), size[undecided].astype(float).tolist(), strict=True))
    hand: list[tuple[int, float, float]] = []
    turn = 0
    while True:
        while len(hand) < 3 and (nxt := next(waiting, None)) is not None:
            hand.append(nxt)
        if len(hand) < 3:
            for i, x, _ in hand:
                p[i] = x
            return p
        (i, a, s), (j, b, t), (k, c, r) = hand
        u = (r - t, s - r, t - s)
        most = max(abs(u[0]), abs(u[1]), abs(u[2]))
        u = (u[0] / most, u[1] / most, u[2] / most) if most else (1.0, -1.0, 0.0)
        up = min((1 - x) / d if d > 0 else -x / d for x, d in ((a, u[0]), (b, u[1]), (c, u[2])) if d)
        down = min(x / d if d > 0 else (x - 1) / d for x, d in ((a, u[0]), (b, u[1]), (c, u[2])) if d)
        go = up if coins[turn % len(coins)] * (up + down) < down else -down
        turn += 1
        hand = []
        for at, x, d, n in ((i, a, u[0], s), (j, b, u[1], t), (k, c, u[2], r)):
            x += d * go
            if x < EPS:
                p[at] = 0.0
            elif x > 1 - EPS:
                p[at] = 1.0
            else:
                hand.append((at, x, n))


def landing(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decide the few chances a flight leaves, with the least change of the expected tokens."""
    p = chance.copy()
    left = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    if len(left):
        want = float((p[left] * size[left]).sum())
        best = min(product((0.0, 1.0), repeat=len(left)), key=lambda o: (abs(float(np.dot(o, size[left])) - want), sum(o), o))
        p[left] = best
    return np.round(p)


def balanced_copies(units: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(unit, source, tokens, copies) of (unit, source, tokens, certain, chance): every chance settled to 0 or 1."""
    shape = "unit bigint, source string, tokens bigint, certain bigint, chance double"

    def fly(last: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("order").reset_index(drop=True)
            p = flight(pdf["chance"].to_numpy(), pdf["tokens"].to_numpy())
            pdf["chance"] = landing(p, pdf["tokens"].to_numpy()) if last else p
            return pdf.drop(columns=["order", "block"])

        return run

    decided, open_units, before = [], units, None
    tasks = units.sparkSession.sparkContext.defaultParallelism
    while True:
        sizes = cut(open_units.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
        largest = sizes.agg(F.max("n")).first()[0] or 0
        # the first round has a block a core at least, though none of fewer than LEAST_BLOCK documents
        rows = min(block_rows, max(LEAST_BLOCK, -(-largest // tasks))) if before is None else block_rows
        before = largest
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / rows)).cast("int")
        order = F.xxhash64("unit", F.lit(SEED))
        placed = lookup(open_units, sizes, ["source"], "inner").select(*[F.col(c) for c in units.columns], order.alias("order"), F.pmod(F.shiftright(order, 7), blocks).cast("int").alias("block"))
        last = largest <= rows
        done = cut(placed.groupBy("source", "block").applyInPandas(fly(last), shape))
        if last:
            decided.append(done)
            break
        undecided = (F.col("chance") > EPS) & (F.col("chance") < 1 - EPS)
        decided.append(done.where(~undecided))
        open_units = done.where(undecided)
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return out.select("unit", "source", "tokens", (F.col("certain") + F.round("chance").cast("bigint")).alias("copies"))


def plan_shares(sizes: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """Per target source: share among sources with tokens, tokens there, copies of each document wanted."""
    goal = (
        targets.where("trim(source) <> '' and target_share > 0 and not isnan(target_share)")
        .groupBy(F.trim("source").alias("source"))
        .agg(F.max("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    )
    both = goal.join(sizes, "source", "left").withColumns({"available": F.coalesce("available", F.lit(0)), "documents": F.coalesce("documents", F.lit(0))})
    able = both.where("available > 0 and max_repeats > 0")
    sums = able.agg(F.sum("target_share").alias("s"), F.min(F.col("max_repeats") * F.col("available") / F.col("target_share")).alias("per_share"))
    most = F.col("s") * F.col("per_share")
    wanted = F.least(most, F.lit(float(total_tokens))) if total_tokens else most
    can = (F.col("available") > 0) & (F.col("max_repeats") > 0)
    # one aggregate row meets the targets, a table of one row per source
    return both.join(F.broadcast(sums), how="left", on=F.lit(True)).select(
        "source",
        "target_share",
        "max_repeats",
        "available",
        "documents",
        F.when(can, F.col("target_share") / F.col("s")).otherwise(F.lit(0.0)).alias("share"),
        F.when(can, F.col("target_share") / F.col("s") * wanted / F.col("available")).otherwise(F.lit(0.0)).alias("copies_wanted"),
    )


def mix(docs: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(mixture, plan) of docs (unit, source, tokens). The mixture has one row per document used, with its copies."""
    docs = docs.where("tokens > 0 and source is not null").select("unit", F.trim("source").alias("source"), F.col("tokens").cast("bigint").alias("tokens"))
    sizes = docs.groupBy("source").agg(F.sum("tokens").alias("available"), F.count(F.lit(1)).alias("documents"))
    plan = cut(plan_shares(sizes, targets, total_tokens))
    wanted = F.least(F.col("copies_wanted"), F.col("max_repeats").cast("double"))
    # rounding noise just under a whole number is that whole number
    whole = F.floor(wanted + 1e-9)
    units = lookup(docs, plan.where("copies_wanted > 0").select("source", "copies_wanted", "max_repeats"), ["source"], "inner").select(
        "unit", "source", "tokens", whole.cast("bigint").alias("certain"), F.greatest(F.lit(0.0), wanted - whole).alias("chance")
    )
    return balanced_copies(units).where("copies > 0"), plan


def _corpus(spark: SparkSession, base: str) -> DataFrame:
    docs = read(spark, base, "documents")
    sized = encode_column(docs.select(F.struct("doc_id", "source").alias("doc"), "text"), "doc", "text", counts_only=True)
    return cut(sized.select(F.col("doc.doc_id").alias("unit"), "doc.source", "tokens"))


def p9_shares(spark: SparkSession, base: str) -> DataFrame:
    """Per source of mix_targets: target share, share among reachable sources, tokens and share actually reached."""
    mixture, plan = mix(_corpus(spark, base), read(spark, base, "mix_targets"))
    got = mixture.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("copies")).alias("reached"), F.count(F.lit(1)).alias("used"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies")
    )
    total = got.agg(F.sum("reached").alias("total"))
    rows = lookup(plan, cut(got), ["source"]).join(F.broadcast(total), how="left", on=F.lit(True))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return rows.select(
        "source", "target_share", "share", "max_repeats", "documents", zero("used"), zero("copies"), zero("most_copies"), "available", zero("reached"),
        F.coalesce(F.col("reached") / F.col("total"), F.lit(0.0)).alias("actual_share"),
    )


def p9_mixture(spark: SparkSession, base: str) -> DataFrame:
    """One row per document used: doc_id, source, tokens, copies."""
    mixture, _ = mix(_corpus(spark, base), read(spark, base, "mix_targets"))
    return mixture.select(F.col("unit").alias("doc_id"), "source", "tokens", "copies")


ORACLE: dict[str, str] = {}
