"""Key tables: one name per code, and joins that pick their strategy by checked size."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry import model
from docketry.functions.columns import code_to_int
from docketry.sources.workspace import stored

BROADCAST_BYTES = 64 << 20
# Codes that hold this share of a fact are joined apart from the others.
HEAVY_SHARE = 1 / 256
# Rows that match nothing in a shuffled join are spread over so many places.
PLACES = 1 << 16


@dataclass(frozen=True)
class Lookup:
    """A frame with one row per `on` value. `small` is only set from a measured size."""

    frame: DataFrame
    on: tuple[str, ...]
    small: bool = False


def dedupe_keys(raw: DataFrame, codes: list[str], name: str) -> DataFrame:
    """One name per code: the first in text order, so that a rerun picks the same one."""
    typed = raw.select(*[code_to_int(F.col(c).cast("string")).alias(c) for c in codes], name)
    return typed.groupBy(*codes).agg(F.min(name).alias(name))


def court_key_latest(raw: DataFrame) -> DataFrame:
    """The name each court had in its latest year; equal years go to the first in text order.

    A min over (descending year, name) needs no sort and combines before the
    shuffle, so a court with very many rows does not end up in one task.
    """
    _, codes, name, _ = model.KEY_TABLES["court"]
    year = code_to_int(F.col("year").cast("string"))
    newest_first = F.coalesce(-year, F.lit(2147483647))
    typed = raw.select(
        *[code_to_int(F.col(c).cast("string")).alias(c) for c in codes],
        F.struct(newest_first.alias("age"), F.col(name)).alias("pick"),
    )
    return typed.groupBy(*codes).agg(F.min("pick").alias("pick")).select(
        *codes, F.col(f"pick.{name}").alias(name)
    )


def build_keys(raw: dict[str, DataFrame]) -> dict[str, Lookup]:
    """The six unique key tables from their raw rows, sizes checked."""
    keys = {}
    for table, (_, codes, name, _) in model.KEY_TABLES.items():
        frame = court_key_latest(raw[table]) if table == "court" else dedupe_keys(raw[table], codes, name)
        keys[table] = Lookup(frame, tuple(codes))
    return check_sizes(keys)


def stored_keys(keys: dict[str, Lookup], folder: str) -> dict[str, Lookup]:
    """The same keys read from files, for callers that join them many times."""
    return {name: replace(lk, frame=stored(lk.frame, f"{folder}/{name}")) for name, lk in keys.items()}


def _row_bytes(frame: DataFrame) -> Column:
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in frame.dtypes if t == "string"]
    return reduce(lambda a, b: a + b, text, F.lit(32 + 16 * len(frame.columns)))


def check_sizes(lookups: dict[str, Lookup], limit: int = BROADCAST_BYTES) -> dict[str, Lookup]:
    """Measure all lookups in one job and mark those that fit a broadcast."""
    sizes = [
        lk.frame.agg(F.lit(name).alias("name"), F.sum(_row_bytes(lk.frame)).alias("bytes"))
        for name, lk in lookups.items()
    ]
    found = {r["name"]: r["bytes"] or 0 for r in reduce(DataFrame.unionByName, sizes).collect()}
    return {name: replace(lk, small=found[name] <= limit) for name, lk in lookups.items()}


def heavy_codes(fact: DataFrame, on: list[str], share: float = HEAVY_SHARE) -> list[int]:
    """The hashes of the codes that hold at least about `share` of the fact.

    A sketch of frequent items is filled within the tasks and merged; of a code with twice the sketch's error it is certain, and
    its error is far below `share`. At most 1 / `share` codes come back, whatever the fact holds.
    """
    code = F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on]), F.xxhash64(*on)).alias("code")
    kept = int(16 / share)
    found = fact.select(code).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(code, {int(1 / share)}, {kept}) FILTER (WHERE code IS NOT NULL)").alias("top")
    ).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= share * found["n"]]


def lookup_join(fact: DataFrame, lookup: Lookup, share: float = HEAVY_SHARE) -> DataFrame:
    """Left join a unique lookup onto a fact; the row count never changes.

    Within the checked bound the lookup is broadcast and the fact is not moved. Beyond it the codes that hold `share` of the
    fact are found first, by reading the fact's codes once; their few rows of the lookup are broadcast. All
    other codes are joined once, by a shuffle of both sides, in which rows of the heavy codes, and those without a code, go to
    any task by a hash of the whole row: no code has more than about `share` of the rows of the shuffle.
    """
    on = list(lookup.on)
    if lookup.small:
        return fact.join(F.broadcast(lookup.frame), on, "left")
    names = [c for c in lookup.frame.columns if c not in on]
    heavy = heavy_codes(fact, on, share)
    is_heavy = F.xxhash64(*on).isin(heavy) if heavy else F.lit(False)
    known = F.struct(*names)
    few = lookup.frame.filter(is_heavy).select(*on, known.alias("_few"))
    # Always 0, but not a literal: with one the optimizer would take the place out of the keys of the join.
    nowhere = F.pmod(F.xxhash64(*on), F.lit(1)).cast("int")
    rest = lookup.frame.filter(~is_heavy).select(*on, nowhere.alias("_place"), known.alias("_rest"))
    alone = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on], is_heavy)
    place = F.when(alone, F.pmod(F.xxhash64(*fact.columns), F.lit(PLACES)) + 1).otherwise(0).cast("int")
    joined = fact.withColumn("_place", place).join(F.broadcast(few), on, "left").join(rest, [*on, "_place"], "left")
    found = [F.coalesce(f"_few.{c}", f"_rest.{c}").alias(c) for c in names]
    return joined.select(*on, *[c for c in fact.columns if c not in on], *found)
