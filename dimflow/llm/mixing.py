"""Mixing sources to target weights by balanced (cube-method) sampling.

Every document of a source is to be taken ``rate = target / source size`` times,
a number between 0 and 2: its whole part for certain, the rest as an inclusion
probability. The cube method rounds these probabilities to 0 or 1 while keeping
both the number of documents and the number of words of the source as expected:
the flight phase moves the probabilities of a few documents at a time along the
null space of the two constraints until one of them is decided.

The flight runs level by level over blocks of at most ``BLOCK`` documents of one
source, so a source of any size is spread over many tasks. A block leaves at
most two documents undecided; these form the blocks of the next level. Once
every source fits in one block, its last few documents (the landing problem) are
rounded to whatever leaves the fewest words astray.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.llm.common import WORD, bitmap_of, filter_bits, flag_members, ship_package, staged, text_of

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2  # times a document, or a source, may be taken
BLOCK = 4096
SEED = 20260728
EDGE = 1e-9


def word_count(text: Column) -> Column:
    return F.size(F.split(text, WORD, -1)).cast("long") - 1


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
            most: int = MOST) -> DataFrame:
    """``source, source_size, n_docs, target`` from the same columns without the target, one row per source.

    Sources in code-point order, null last, get ``weights`` in turn. The target of
    a source is its weight times a common level, at most ``most`` times its size;
    the level is where the targets sum to ``budget`` times all sizes, which is
    what resharing every excess by weight ends in. The windows run over one row
    per source, the totals of the corpus by then.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), rank)
    # The first sources to reach their limit as the level rises are those of the smallest limit per weight.
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(most))
            .withColumn("goal", F.sum("source_size").over(everything.orderBy()) * budget))
    # Level at which this source and all later ones share what the earlier ones, at their limits, leave.
    share = ((F.col("goal") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    rows = rows.withColumn("share", share)
    open_share = F.min(F.when(F.col("share") * F.col("weight") <= F.col("limit"), F.struct(
        F.col("limit") / F.col("weight"), F.col("source").isNull(), "source", "share"))).over(everything.orderBy())
    level = open_share["share"]
    target = F.when(level.isNull(), F.col("limit")).otherwise(F.least("limit", level * F.col("weight")))
    return rows.select("source", "source_size", "n_docs", target.cast("double").alias("target"))


def flight(units: list[list[float]], dice: random.Random) -> list[int]:
    """Round the probabilities of ``units`` ([probability, size]) in place, all but at most two; the indices left.

    Each step takes three undecided units, moves their probabilities along the
    direction that keeps both their sum and the sum of sizes, and stops where the
    first one reaches 0 or 1. Which of the two ends is a fair draw: the expected
    probability does not change.
    """
    waiting = iter(range(len(units)))
    held: list[int] = []
    while True:
        held = [i for i in held if EDGE < units[i][0] < 1 - EDGE]
        while len(held) < 3:
            nxt = next(waiting, None)
            if nxt is None:
                break
            if EDGE < units[nxt][0] < 1 - EDGE:
                held.append(nxt)
        if len(held) < 2:
            return held
        a, b = units[held[0]], units[held[1]]
        if len(held) == 3:
            c = units[held[2]]
            move = [b[1] - c[1], c[1] - a[1], a[1] - b[1]]
        else:
            move = [0.0, 0.0]
        if not any(move):
            if len(held) == 2 and a[1] != b[1]:
                return held
            move = [1.0, -1.0] + [0.0] * (len(held) - 2)
        moved = [(units[i], m) for i, m in zip(held, move) if m]
        ahead = min((1 - u[0]) / m if m > 0 else u[0] / -m for u, m in moved)
        back = min(u[0] / m if m > 0 else (1 - u[0]) / -m for u, m in moved)
        step = ahead if dice.random() * (ahead + back) < back else -back
        for u, m in moved:
            u[0] = min(1.0, max(0.0, u[0] + step * m))
            if u[0] < EDGE:
                u[0] = 0.0
            elif u[0] > 1 - EDGE:
                u[0] = 1.0


def land(units: list[list[float]], left: list[int]) -> None:
    """Round the last units to the choice that leaves the fewest words, then documents, astray."""
    words = sum(units[i][0] * units[i][1] for i in left)
    docs = sum(units[i][0] for i in left)
    best = min(itertools.product((0.0, 1.0), repeat=len(left)),
               key=lambda pick: (abs(sum(p * units[i][1] for p, i in zip(pick, left)) - words), abs(sum(pick) - docs)))
    for p, i in zip(best, left):
        units[i][0] = p


def _round_block(last: bool):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        # Largest first: the documents still undecided at the end are then small ones, and little is left to land.
        block = block.sort_values(["size", "dice", "part"], ascending=[False, True, True], kind="stable")
        block = block.reset_index(drop=True)
        units = [[float(p), float(s)] for p, s in zip(block["part"], block["size"])]
        left = flight(units, random.Random(f"{SEED} {block['dice'].iloc[0]} {len(block)}"))
        if last:
            land(units, left)
        block["part"] = [u[0] for u in units]
        return block
    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``id, size, source, source_size, target, copies, unit``.

    ``copies`` (0 to ``most``) is how often the mix takes the document. ``unit`` is
    a hash of id, source and text, the seed of the row's draw: results depend on
    the rows alone, not on their order or partitions. Null texts have size 0, null
    sources form a source of their own, repeated rows are drawn one by one.
    """
    ship_package(docs.sparkSession)
    unit = F.xxhash64(id_col, source_col, text_of(text_col))
    rows = staged(docs.select(F.col(id_col).alias("id"), word_count(text_of(text_col)).alias("size"),
                              F.col(source_col).alias("source"), unit.alias("unit")), "mix_sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    # Small tables are written first: the joins then know their size, and a hot source is not shuffled by its name.
    goals = staged(targets(totals, weights, budget, most).drop("n_docs").withColumnRenamed("source", "__s"),
                   "mix_targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = rows.join(goals, F.col("source").eqNullSafe(F.col("__s"))).select(
        "id", "size", "source", "source_size", "target", "unit",
        F.floor(rate).cast("int").alias("whole"), (rate - F.floor(rate)).alias("part"),
        F.xxhash64("unit", F.lit(SEED)).alias("dice"))
    open_rows, done = staged(joined, "mix_units"), []
    while True:
        blocks = staged(open_rows.groupBy("source").agg(F.count(F.lit(1)).alias("open")), "mix_open")
        largest = blocks.agg(F.max("open")).first()[0]
        if largest is None:
            break
        last = largest <= block
        # Every level redeals its units; the number of blocks follows the units still open in the source.
        n_blocks = F.ceil(F.col("open") / F.lit(block / 2)) if not last else F.lit(1)
        dealt = open_rows.join(blocks.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("dice"), n_blocks.cast("long"))).drop("__s", "open")
        rounded = staged(dealt.groupBy("source", "block").applyInPandas(_round_block(last), dealt.schema)
                         .drop("block"), "mix_level")
        undecided = F.col("part").between(EDGE, 1 - EDGE)
        done.append(rounded.where(~undecided) if not last else rounded)
        if last:
            break
        open_rows = rounded.where(undecided).withColumn("dice", F.xxhash64("dice"))
    everything = open_rows if not done else done[0]
    for more in done[1:]:
        everything = everything.unionByName(more)
    return everything.select("id", "size", "source", "source_size", "target",
                             (F.col("whole") + F.round("part").cast("int")).alias("copies"), "unit")


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mix` takes it (rows that agree in id, source and
    text are taken alike).

    A bitmap for each number of copies tells most rows theirs where they are
    read. Rows that more than one bitmap may hold are joined with their number;
    only these are shuffled with their text.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    copies = staged(mix(docs, id_col, text_col, source_col, **options).groupBy("unit").agg(F.max("copies").alias("__n"))
                    .withColumnRenamed("unit", "__key"), "mix_copies")
    counted = {r["__n"]: r["keys"] for r in copies.groupBy("__n").agg(F.count(F.lit(1)).alias("keys")).collect()}
    rows, maybe = docs.withColumn("__unit", F.xxhash64(id_col, source_col, text_of(text_col))), []
    for n, keys in sorted(counted.items()):  # 0 to ``most``
        bits, maybe = filter_bits(keys), [*maybe, (n, F.col(f"__copies_{n}"))]
        held = bitmap_of(copies.where(F.col("__n") == n).select(F.col("__key").alias("key")), bits)
        rows = flag_members(rows, F.col("__unit"), held, bits, f"__copies_{n}")
    if not counted:
        return docs.limit(0)
    sure = sum((flag.cast("int") for _, flag in maybe), F.lit(0)) == 1
    own = F.coalesce(*[F.when(flag, F.lit(n)) for n, flag in maybe])
    read = rows.where(sure).withColumn("__n", own)
    doubtful = rows.where(~sure).join(copies, F.col("__unit") == F.col("__key")).select(*read.columns)
    taken = read.unionByName(doubtful).where("__n > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__n"))).select(*columns)
