"""Mixing sources to target weights by balanced sampling with the cube method.

Each source has a target size. A document of a source whose target is r times its size is taken floor(r) times, and
once more with probability r - floor(r). The cube method settles those fractions: it moves the inclusion
probabilities within the null space of two constraints, the number of documents and the number of words taken from
the source, so both totals stay as they are while one document after the other becomes settled.

The flight runs over blocks of a source side by side. Each block leaves at most two documents open; those go
through further flights, block by block, until one block a source is left, whose last documents are landed.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.operators.running import running_totals
from docketry.sources.workspace import new_folder, ship_package, stored

WORD = r"[^\x20\x09-\x0D]+"
# Documents of a block of the flight, and how many of its longest are settled against all others of the block.
BLOCK = 1_024
LONGEST = 48
OPEN = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Iterable[int], cap: float) -> DataFrame:
    """(number, source, documents, source_size, target) of each source of (source, size).

    Sources by code point, null last, weigh `weights` again and again and share the sum of all sizes. A target stops at
    `cap` times the size of its source; what is above is shared by weight among the others until none is above.
    """
    weights = list(weights)
    sums = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("size").alias("source_size"))
    sums = sums.withColumns({"last": F.col("source").isNull(), "one": F.lit(1)})
    numbered = running_totals(sums, ["last", "source"], {"one": "number"}).drop("last", "one")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights)).cast("int"))
    shares = stored(
        numbered.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * float(cap))
        .withColumn("level", F.col("most") / F.col("weight")),
        new_folder(numbered.sparkSession, "sources"),
    )
    total, all_weights = shares.agg(F.sum("source_size"), F.sum("weight")).head()
    if not total:
        return shares.select("number", "source", "documents", "source_size", F.lit(0.0).alias("target"))
    # Sources are full in order of most / weight. The first one that need not be full sets the level for the rest.
    before = running_totals(shares, ["level", "number"], {"most": "full", "weight": "used"})
    level = (F.lit(float(total)) - F.col("full")) / (F.lit(float(all_weights)) - F.col("used"))
    fits = before.withColumn("common", level).filter("common <= level")
    common = fits.orderBy("level", "number").limit(1).collect()
    target = F.least("most", F.col("weight") * common[0].common) if common else F.col("most")
    return shares.select("number", "source", "documents", "source_size", target.alias("target"))


def spread(pi: np.ndarray, size: np.ndarray, units: Iterable[int], chance: np.random.Generator) -> np.ndarray:
    """Settle the given documents, each against all other open ones of the block, keeping both totals.

    The direction gives the document 1 and the others what balances it, most to those with room on both sides. Long
    documents go this way and first: three at a time the short ones would settle around a long one, and it would
    be left to the landing.
    """
    out, size = pi.astype(float).copy(), size.astype(float)
    for unit in units:
        for _ in range(16):
            if not 0 < out[unit] < 1:
                break
            room = out * (1 - out)
            room[unit] = 0
            s0, s1, s2 = room.sum(), (room * size).sum(), (room * size * size).sum()
            det = s0 * s2 - s1 * s1
            if (room > 0).sum() < 2 or det <= 1e-12 * s0 * s2:
                break
            alpha = (-s2 + s1 * size[unit]) / det
            beta = (s1 - s0 * size[unit]) / det
            u = room * (alpha + beta * size)
            u[unit] = 1.0
            with np.errstate(divide="ignore", invalid="ignore"):
                up = np.where(u > 0, (1 - out) / u, np.where(u < 0, -out / u, np.inf)).min()
                down = np.where(u > 0, out / u, np.where(u < 0, -(1 - out) / u, np.inf)).min()
            out += u * (up if chance.random() * (up + down) < down else -down)
            out[out < OPEN] = 0.0
            out[out > 1 - OPEN] = 1.0
    return out


def flight(pi: np.ndarray, size: np.ndarray, chance: np.random.Generator) -> np.ndarray:
    """Move the probabilities until at most two are open, keeping their sum and their sum weighted by size.

    Three documents at a time: of their probabilities one direction keeps both sums.
    """
    out = pi.astype(float).tolist()
    sizes = size.astype(float).tolist()
    draws = iter(chance.random(2 * len(out) + 8).tolist())
    held: list[int] = []
    for unit in [k for k, p in enumerate(out) if 0 < p < 1]:
        held.append(unit)
        if len(held) < 3:
            continue
        i, j, k = held
        u = (sizes[k] - sizes[j], sizes[i] - sizes[k], sizes[j] - sizes[i])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for p, v in zip((out[i], out[j], out[k]), u, strict=True):
            if v > 0:
                up, down = min(up, (1 - p) / v), min(down, p / v)
            elif v < 0:
                up, down = min(up, -p / v), min(down, -(1 - p) / v)
        step = up if next(draws) * (up + down) < down else -down
        left = []
        for unit_, v in zip((i, j, k), u, strict=True):
            p = out[unit_] + step * v
            p = 0.0 if p < OPEN else 1.0 if p > 1 - OPEN else p
            out[unit_] = p
            if 0 < p < 1:
                left.append(unit_)
        held = left
    return np.array(out)


def landing(pi: np.ndarray, size: np.ndarray, chance: np.random.Generator) -> np.ndarray:
    """Settle at most two open documents: their probabilities hold, and the joint draw strays least from both totals."""
    out = pi.copy()
    rest = np.flatnonzero((pi > 0) & (pi < 1))
    draw = chance.random()
    if len(rest) == 1:
        out[rest[0]] = float(draw < pi[rest[0]])
    elif len(rest) == 2:
        (a, b), (s, t) = pi[rest], size[rest].astype(float)
        scale = max(1.0, (s + t) / 2)

        def stray(x: int, y: int) -> float:
            return ((x - a) + (y - b)) ** 2 + (((x - a) * s + (y - b) * t) / scale) ** 2

        low, high = max(0.0, a + b - 1), min(a, b)
        both = high if stray(1, 1) + stray(0, 0) < stray(1, 0) + stray(0, 1) else low
        edges = np.cumsum([both, a - both, b - both])
        out[rest] = [(1, 1), (1, 0), (0, 1), (0, 0)][int(np.searchsorted(edges, draw, "right"))]
    return out


def _settle(last: bool):
    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["mark", "row", "size"], kind="stable")
        chance = np.random.default_rng(abs(int(rows["mark"].iloc[0])))
        size = rows["size"].to_numpy()
        longest = np.argsort(-size, kind="stable")
        pi = spread(rows["pi"].to_numpy(), size, (longest if last else longest[:LONGEST]).tolist(), chance)
        pi = flight(pi, size, chance)
        if last:
            pi = landing(pi, size, chance)
        return rows.assign(pi=pi).drop(columns="block")

    return settle


def mixed(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(row, size, number, copies) of each row of (row, source, size): how often the mix takes it.

    `row` is a value that names a row; equal rows are settled one by one. Chance comes from digests, so reruns agree.
    """
    spark = rows.sparkSession
    ship_package(spark)
    columns = ["row", "size", "number", "mark", "fixed", "pi"]
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Rounded so that a share that is whole but for its last bits leaves nothing open.
    ratio = F.round(ratio, 12)
    # One row a source; not hinted, so that Spark's size limit decides on a broadcast.
    joined = rows.join(targets, rows["source"].eqNullSafe(targets["source"]))
    start = joined.select(
        "row", "size", "number", F.xxhash64("row", "size", "number").alias("mark"),
        F.floor(ratio).alias("fixed"), (ratio - F.floor(ratio)).alias("pi"),
    )
    start = stored(start, new_folder(spark, "mix"))
    open_ = (F.col("pi") > 0) & (F.col("pi") < 1)
    done, waiting = [start.filter(~open_)], start.filter(open_)
    ddl = "row string, size long, number long, mark long, fixed long, pi double"
    while True:
        counts = stored(waiting.groupBy("number").agg(F.count(F.lit(1)).alias("n")), new_folder(spark, "mix-open"))
        largest = counts.agg(F.max("n")).head()[0]
        if largest is None:
            break
        last = largest <= BLOCK
        blocks = waiting.join(counts, "number").withColumn(
            "block", F.pmod(F.xxhash64("mark", F.lit(len(done))), F.ceil(F.col("n") / BLOCK))
        )
        settled = stored(
            blocks.select(*columns, "block").groupBy("number", "block").applyInPandas(_settle(last), ddl),
            new_folder(spark, "mix"),
        )
        done.append(settled if last else settled.filter(~open_))
        if last:
            break
        waiting = settled.filter(open_)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select("row", "size", "number", (F.col("fixed") + F.col("pi").cast("long")).alias("copies"))


def plan(
    docs: DataFrame, weights: Iterable[int] = (1, 2, 3), cap: float = 3.0,
    id_column: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """(id, size, source_size, target, taken) of each row: the words the mix takes from it, repeats counted.

    Size is the number of words of the whole text, 0 for a null or empty one, which is taken without effect. A null
    source is a source. Rows with a null id and equal rows are documents like others. No rows give no rows; other columns
    do not matter. A document is taken at most ceil(cap) times.
    """
    kind = docs.schema[id_column].dataType
    sizes = stored(
        docs.select(
            F.col(id_column).cast("string").alias("row"), F.col(source).cast("string").alias("source"),
            word_count(F.col(text)).alias("size"),
        ),
        new_folder(docs.sparkSession, "sizes"),
    )
    targets = stored(source_targets(sizes, weights, cap), new_folder(docs.sparkSession, "targets"))
    taken = mixed(sizes, targets).join(targets, "number")
    return taken.select(
        F.col("row").cast(kind).alias(id_column), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mix(
    docs: DataFrame, weights: Iterable[int] = (1, 2, 3), cap: float = 3.0, source: str = "source", text: str = "text"
) -> DataFrame:
    """The rows of the mix itself: every row of `docs` as often as it is taken, with all its columns as they were."""
    spark = docs.sparkSession
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    digest = F.concat_ws("-", whole.cast("string"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    rows = stored(
        docs.select(digest.alias("row"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size")),
        new_folder(spark, "sizes"),
    )
    targets = stored(source_targets(rows, weights, cap), new_folder(spark, "targets"))
    # Equal rows are alike: their copies are added up and made from one of them.
    copies = mixed(rows, targets).groupBy("row").agg(F.sum("copies").cast("int").alias("_copies")).filter("_copies > 0")
    copies = stored(copies, new_folder(spark, "copies")).withColumnRenamed("row", "_row")
    one_each = docs.withColumn("_row", digest).dropDuplicates(["_row"])
    repeated = one_each.join(copies, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
