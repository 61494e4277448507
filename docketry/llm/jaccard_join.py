"""Links between documents whose sets of word shingles have a Jaccard similarity of 0.75 or more.

Equal sets are one class, so copies cost one comparison in all. Classes are dealt into shards, within which the method
is a count-vector R-tree: the shingles of a set are hashed into GROUPS groups, the counts by group are a point, and
the overlap of two sets is at most the sum over the groups of the smaller count. Against a box of points the sum of
the smaller of a point's counts and the box's greatest counts is a bound for all of them. What the bounds let pass is
verified on the sets themselves.

Boxes over count vectors of unrelated texts of one length hardly differ, so a tree over all documents would visit nearly
all of it for each. Shards come from min-hashing instead: BANDS keys of ROWS minima each. Two sets that are
similar enough share no key with a probability of (1 - 0.75^4)^40 = 2.5e-7 at the threshold and less above it.

A shard may hold thousands of near copies. It is not expanded into pairs: all its classes are first verified
against one of them; what that links needs no further comparison. Only shards that still hold several components
are searched, by their trees, for links between different components, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.bitmap import bit_map, is_set, position
from docketry.llm.components import components
from docketry.llm.text import mixed as mixed_bits
from docketry.llm.text import odd_numbers, runs_of_words, text_slices, with_text, words_of
from docketry.sources.workspace import new_folder, stored

SHINGLE = 5
BANDS, ROWS = 40, 4
GROUPS = 64
LEAF = 16
# Classes of a block of a shard.
BLOCK = 512

_FACTORS = odd_numbers(SHINGLE, 11)
_BAND_FACTORS = odd_numbers(ROWS, 13)
_PERMUTATIONS = (odd_numbers(BANDS * ROWS, 17) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (odd_numbers(BANDS * ROWS, 19) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted hashes of the different shingles of each document of a slice."""
    words = words_of(data, offsets)
    hashes = words.hashes()
    runs, place = runs_of_words(words, hashes, SHINGLE, _FACTORS)
    begin = np.searchsorted(place, words.first)
    for doc in range(len(offsets) - 1):
        a, b = words.first[doc], words.first[doc + 1]
        if b - a >= SHINGLE:
            yield np.unique(runs[begin[doc] : begin[doc + 1]])
        elif b > a:
            # The whole sequence as one; its length keeps it apart from longer shingles.
            few = hashes[a:b] * _FACTORS[: b - a]
            yield mixed_bits(np.array([few.sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    once = mixed_bits(shingles + np.uint64(0x51ED270B))
    first = int(shingles.sum(dtype=np.uint64)) ^ len(shingles)
    second = int(once.sum(dtype=np.uint64)) ^ int(np.bitwise_xor.reduce(once, initial=np.uint64(0)))
    return tuple(int(np.uint64(x & 0xFFFFFFFFFFFFFFFF).astype(np.int64)) for x in (first, second))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, from the minima of ROWS permutations of the shingles."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 512):
        block = _PERMUTATIONS[:, None] * short[None, at : at + 512]
        block += _SHIFTS[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    minima = mixed_bits(least.astype(np.uint64) + (np.arange(BANDS * ROWS, dtype=np.uint64) << np.uint64(32)))
    return mixed_bits((minima.reshape(BANDS, ROWS) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n, d1, d2, keys) of (doc_id, text): size and digest of the set, and the band keys of non-empty sets.

    A column `mark`, if there is one, is handed on.
    """
    marked = "mark" in docs.columns

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column("text")):
                sets = list(shingle_sets(data, offsets))
                digests = [digest(s) for s in sets]
                keys = [band_keys(s).view(np.int64) if len(s) else [] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, end - row), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([d for d, _ in digests], pa.int64()), pa.array([d for _, d in digests], pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())), *([batch.column("mark").slice(row, end - row)] if marked else []),
                    ],
                    ["doc_id", "n", "d1", "d2", "keys", *(["mark"] if marked else [])],
                )

    return docs.mapInArrow(sign, "doc_id long, n long, d1 long, d2 long, keys array<long>" + (", mark long" if marked else ""))


def similar(size_a: Column, size_b: Column, both: Column) -> Column:
    return both * 100 >= (size_a + size_b - both) * 75


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) for the classes (node, d1, d2, label): their sets, made again from the texts.

    A map of bits, of fixed size, says which documents to look at; the digests then say which sets are right.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bit_map(wanted, position(F.col("label"))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("position").to_numpy()
            batch = batch.filter(pa.array(is_set(shared.value, at)))
            for _, _, data, offsets in text_slices(batch.column("text")):
                sets = [s for s in shingle_sets(data, offsets) if len(s)]
                digests = [digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _ in digests], pa.int64()), pa.array([d for _, d in digests], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["d1", "d2", "shingles"],
                )

    sets = docs.select("text", position(F.col("doc_id")).alias("position")).mapInArrow(cut, "d1 long, d2 long, shingles binary")
    return sets.join(wanted.select("node", "d1", "d2"), ["d1", "d2"]).dropDuplicates(["node"]).select("node", "shingles")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def enough(both: int, size_a: int, size_b: int) -> bool:
    return both * 100 >= (size_a + size_b - both) * 75


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = batch.column("one"), batch.column("two")
            good = []
            for x, y in zip(one, two, strict=True):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                good.append(enough(overlap(a, b), len(a), len(b)))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("two"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "one", "two").mapInArrow(verify, "a long, b long")


class CountTree:
    """An R-tree over the count vectors of some sets, in two levels of boxes."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray) -> None:
        # Neighbours in size and then in the counts of their fullest differing groups share leaves.
        order = np.lexsort([*counts[:, np.argsort(counts.var(axis=0))[-3:]].T, sizes]) if len(counts) else np.zeros(0, int)
        self.members = [order[at : at + LEAF] for at in range(0, len(order), LEAF)]
        self.counts, self.sizes = counts, sizes
        self.most = np.array([counts[m].max(axis=0) for m in self.members]).reshape(-1, GROUPS)
        self.least = np.array([sizes[m].min() for m in self.members])
        self.upper = [np.arange(at, min(at + LEAF, len(self.members))) for at in range(0, len(self.members), LEAF)]
        self.upper_most = np.array([self.most[u].max(axis=0) for u in self.upper]).reshape(-1, GROUPS)
        self.upper_least = np.array([self.least[u].min() for u in self.upper])

    def candidates(self, point: np.ndarray, size: int) -> np.ndarray:
        """The members that the bounds do not rule out: an overlap of 3/7 of both sizes is needed."""
        found = []
        for k in self._open(point, size, self.upper_most, self.upper_least):
            boxes = self.upper[k]
            for leaf in boxes[self._open(point, size, self.most[boxes], self.least[boxes])]:
                members = self.members[leaf]
                found.append(members[self._open(point, size, self.counts[members], self.sizes[members])])
        return np.concatenate(found) if found else np.zeros(0, int)

    @staticmethod
    def _open(point: np.ndarray, size: int, most: np.ndarray, least: np.ndarray) -> np.ndarray:
        return np.flatnonzero(7 * np.minimum(point, most).sum(axis=1) >= 3 * (size + least))


def count_vector(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)


def tree_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between different components among the classes of one block of a shard.

    Asked are the rows marked so, against all others. Two components are linked once: a later pair of them is skipped.
    """
    asked = rows[rows["asked"]].reset_index(drop=True)
    held = rows[~rows["asked"]].reset_index(drop=True)
    sets = [np.frombuffer(s, np.uint64) for s in held["shingles"]]
    sizes = np.array([len(s) for s in sets], np.int64)
    tree = CountTree(np.array([count_vector(s) for s in sets]).reshape(-1, GROUPS), sizes)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    group, node = held["component"].to_numpy(), held["node"].to_numpy()
    for mine, name, raw in zip(asked["component"], asked["node"], asked["shingles"], strict=True):
        shingles = np.frombuffer(raw, np.uint64)
        for k in tree.candidates(count_vector(shingles), len(shingles)):
            a, b = root(int(mine)), root(int(group[k]))
            if a != b and enough(overlap(shingles, sets[k]), len(shingles), len(sets[k])):
                parent[max(a, b)] = min(a, b)
                links.append((int(name), int(node[k])))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def other_links(shards: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between classes that share a shard but no component yet.

    In each such shard the members outside its largest component are asked against all its members. Both sides are cut
    into blocks, so a task holds two blocks whatever the shard holds.
    """
    spark = shards.sparkSession
    placed = shards.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stored(placed.select("key", "node", "component"), new_folder(spark, "placed"))
    by_component = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("who"))
    by_shard = by_component.groupBy("key").agg(
        F.count(F.lit(1)).alias("components"), F.sum("n").alias("members"), F.bit_xor("who").alias("who"),
        F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("most"),
    )
    # Two members have been compared already. Of shards with the same members one is enough.
    left = by_shard.filter("components > 1 AND members > 2").dropDuplicates(["members", "who"])
    left = stored(left, new_folder(spark, "left"))
    rows = placed.join(left, "key")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    asking = F.ceil((F.col("members") - F.col("most")) / BLOCK).cast("int")
    mine, mark = F.pmod(F.hash("node"), blocks), F.pmod(F.hash("node", F.lit(1)), asking)
    held = rows.select(
        "key", "node", "component", mine.alias("i"), F.explode(F.sequence(F.lit(0), asking - 1)).alias("j"),
        F.lit(False).alias("asked"),
    )
    asked = rows.filter("component <> main").select(
        "key", "node", "component", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"), mark.alias("j"),
        F.lit(True).alias("asked"),
    )
    both = held.union(asked).join(sets, "node")
    return both.groupBy("key", "i", "j").applyInPandas(tree_links, "a long, b long")


def classes_of(signed: DataFrame) -> DataFrame:
    """(node, label, n, d1, d2) of each class of equal, non-empty sets; its label is its smallest document."""
    grouped = signed.filter("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("label"))
    return stored(grouped.withColumn("node", F.monotonically_increasing_id()), new_folder(signed.sparkSession, "classes"))


def linked(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row.

    Words are runs of bytes other than space and 0x09-0x0D with A-Z lower-cased. A set holds the different shingles of
    SHINGLE words; a text with fewer words has one shingle, all of it. A null, empty or blank text has none: it is linked with nothing and
    its component is its own id. `component_id` is the smallest id that links reach. Rows of one id are told apart by
    their sets. Null ids stay; a class of null ids only has a null component. Equal rows stay; no rows give no rows;
    other columns do not matter.
    """
    out = _with_components(with_text(docs, F.col(id_column).cast("long").alias("doc_id"), text=text))
    return out.select(F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), "component_id")


def _with_components(rows: DataFrame) -> DataFrame:
    """(doc_id, n, d1, d2, component_id) of each row of (doc_id, text), and its `mark` if there is one."""
    spark = rows.sparkSession
    signed = stored(signatures(rows), new_folder(spark, "signed"))
    classes = classes_of(signed)
    # Only one document of a class carries its keys on.
    first = signed.select("d1", "d2", F.col("doc_id").alias("label"), "keys")
    keyed = classes.join(first, ["d1", "d2", "label"]).dropDuplicates(["node"])
    shards = stored(keyed.select(F.explode("keys").alias("key"), "node"), new_folder(spark, "shards"))
    pivots = shards.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("members"))
    pivots = stored(pivots.filter("members > 1"), new_folder(spark, "pivots"))
    shared = stored(shards.join(pivots, "key"), new_folder(spark, "shared"))
    sizes = classes.select("node", "n")
    pairs = shared.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    pairs = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    pairs = stored(pairs.filter("100 * least(na, nb) >= 75 * greatest(na, nb)").select("a", "b"), new_folder(spark, "pairs"))
    # A member of a shard of more than two may be asked for again.
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(shared.filter("members > 2").select("node"))
    wanted = stored(classes.join(wanted.distinct(), "node"), new_folder(spark, "wanted"))
    sets = stored(sets_of(rows, wanted), new_folder(spark, "sets"))
    star = stored(verified(pairs, sets), new_folder(spark, "star"))
    labels = components(star)
    more = other_links(shared.filter("members > 2").select("key", "node"), labels, sets)
    links = stored(star.union(more).distinct(), new_folder(spark, "links"))
    final = stored(components(links), new_folder(spark, "components"))
    named = classes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named, new_folder(spark, "named"))
    smallest = named.groupBy("component").agg(F.min("label").alias("component_id"))
    by_class = stored(named.join(smallest, "component").select("d1", "d2", "component_id"), new_folder(spark, "by-class"))
    out = signed.drop("keys").join(by_class, ["d1", "d2"], "left")
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that are the smallest id of their component, with all columns as they were.

    Rows without words and rows with a null id are kept. Rows of one id are told apart by their sets: of those with one set
    one is kept, the smallest by a hash of the row, so that reruns agree; texts of their own are all kept.
    """
    named = docs.filter(F.col(id_column).isNotNull())
    mark = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    rows = with_text(named, F.col(id_column).cast("long").alias("doc_id"), mark.alias("mark"), text=text)
    found = _with_components(rows).filter("doc_id = component_id").groupBy("doc_id", "d1", "d2").agg(F.min("mark").alias("_mark"))
    kept = stored(found.select(F.col("doc_id").alias("_kept"), "_mark"), new_folder(docs.sparkSession, "kept"))
    same = (F.col(id_column).cast("long") == F.col("_kept")) & (mark == F.col("_mark"))
    first = named.withColumn("_row", mark).join(kept, same).dropDuplicates([id_column, "_row"]).drop("_kept", "_mark", "_row")
    return first.union(docs.filter(F.col(id_column).isNull()))
