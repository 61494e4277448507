"""How filters of documents act on each other, over a sparse document-term matrix.

Words get their numbers from one dictionary of all documents, and the matrix (documents by words, counts) is kept as
shards in compressed rows. Its row sums and the numbers of its entries in a row decide the filters of words; the others
are decided where the text is. What is left of a document are five bits, so that all orders of the filters are
counted from a few groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.text import in_small_batches
from docketry.sources.workspace import new_folder, stored

# Fixed values of the five filters: what fails.
FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
MARKS = "#$%&*|"

# A shard of the matrix holds documents with about this many bytes of text; a longer document is a shard of its own.
SHARD_BYTES = 8 << 20
# A task that numbers words hands them on in groups of about this many.
FLUSH_ROWS = 1 << 20


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts one after the other, and the place of each text's first, with the end as a last entry.

    The white space of ASCII is 0x20 and 0x09-0x0D; the split leaves empty strings at the ends, which are no words.
    """
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    del lists
    solid = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.zeros(len(solid) + 1, np.int32)
    np.cumsum(solid, out=before[1:])
    return (flat if solid.all() else flat.filter(pa.array(solid))), before[offsets - offsets[0]].astype(np.int64)


def compressed_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row starts, word places, counts, words) of the documents of one shard.

    Places are those in the shard's own list of words, the most frequent first, so that most places are small numbers.
    """
    words, first = _words(texts)
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    del words
    found = coded.indices.to_numpy(zero_copy_only=False)
    size = max(1, len(coded.dictionary))
    order = np.argsort(-np.bincount(found, minlength=size), kind="stable")[: len(coded.dictionary)]
    place = np.empty(size, np.int64)
    place[order] = np.arange(len(order))
    words = coded.dictionary.take(pa.array(order))
    cells = place[found]
    del coded, found
    cells += np.repeat(np.arange(len(first) - 1), np.diff(first)) * size
    cells, counts = np.unique(cells, return_counts=True)
    starts = np.searchsorted(cells, np.arange(len(first)) * size)
    return starts, (cells % size).astype(np.int32), counts.astype(np.int32), words


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed: their first bytes, their second bytes and so on, as the higher ones are mostly zero."""
    return zlib.compress(np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<i4").ravel()


def _list(values: pa.Array) -> pa.ListArray:
    """All values as the list of one row."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _shards(rows: DataFrame, keep: list[str], found: dict[str, Callable[[pa.Array], np.ndarray]]) -> DataFrame:
    """One row a shard: its own words, its matrix, and as lists the other columns of its documents and what is `found` in texts."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # The number of a shard comes from its task and place, so a task that is run again gives the same ones.
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal number, size
            table = pa.Table.from_batches(held).combine_chunks()
            texts = table.column("text").combine_chunks()
            starts, places, counts, words = compressed_rows(texts)
            made = [pa.array([number], pa.int64()), *(pa.array([packed(x)], pa.binary()) for x in (np.diff(starts), places, counts))]
            made += [_list(words.cast(pa.string())), *(_list(table.column(c)) for c in keep)]
            made += [_list(pa.array(of_texts(texts), pa.int32())) for of_texts in found.values()]
            number += 1
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays(made, ["shard", "sizes", "places", "counts", "words", *keep, *found])

        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            row = 0
            while row < len(sizes):
                done = sizes[row - 1] if row else 0
                end = int(np.searchsorted(sizes, done + max(0, SHARD_BYTES - size), "right"))
                end = min(len(sizes), max(end, row + (not held)))
                if end > row:
                    held.append(batch.slice(row, end - row))
                    size += int(sizes[end - 1] - done)
                row = end
                if row < len(sizes) or size >= SHARD_BYTES:
                    yield shard()
                    pa.default_memory_pool().release_unused()
        if held:
            yield shard()
        # A worker stays for other tasks; what this one needed at its peak goes back to the system.
        pa.default_memory_pool().release_unused()

    schema = "shard long, sizes binary, places binary, counts binary, words array<string>"
    lists = [*[f"{c} array<{kinds[c]}>" for c in keep], *[f"{c} array<int>" for c in found]]
    return rows.select("text", *keep).mapInArrow(cut, ", ".join([schema, *lists]))


def _numbered(words: DataFrame) -> DataFrame:
    """The words (shard, place, word), dealt and sorted by word, with the distinct words of each task numbered from 0.

    Rows of two kinds: with `shard` null, `words` are the next words of the task's part of the dictionary, from number `start`;
    else the words of a shard at `places` have the `numbers`. Order and so numbers do not change when a task is run again.
    """
    names = ["part", "start", "words", "shard", "places", "numbers"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, total, last = TaskContext.get().partitionId(), 0, None
        held: list[tuple[np.ndarray, ...]] = []
        new: list[pa.Array] = []
        start = rows_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal start
            fresh = pa.concat_arrays(new) if new else pa.array([], pa.string())
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.binary(), pa.binary()]
            row = [part, start, None, None, None, None]
            made = [pa.array([v], k) for v, k in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*made[:2], _list(fresh), *made[3:]], names)
            start += len(fresh)
            shard, place, numbers = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((place, shard))
            ends = np.flatnonzero(np.diff(shard[order], append=shard[order[-1]] + 1)) + 1
            rows = [order[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)]
            columns = [[part] * len(rows), [start] * len(rows), [None] * len(rows), [int(shard[r[0]]) for r in rows],
                       [packed(place[r]) for r in rows], [packed(numbers[r]) for r in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], names)
            held.clear()
            new.clear()

        for batch in batches:
            if not len(batch):
                continue
            word = batch.column("word")
            changes = np.empty(len(word), bool)
            changes[0] = last is None or word[0].as_py() != last
            changes[1:] = pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
            numbers = total + np.cumsum(changes) - 1
            total, last = int(numbers[-1]) + 1, word[-1].as_py()
            new.append(word.filter(pa.array(changes)).cast(pa.string()))
            held.append((batch.column("shard").to_numpy(), batch.column("place").to_numpy(), numbers))
            rows_held += len(word)
            if rows_held >= FLUSH_ROWS:
                yield from flush()
                rows_held = 0
        if held:
            yield from flush()
        pa.default_memory_pool().release_unused()

    dealt = words.repartition("word").sortWithinPartitions("word", "shard")
    return dealt.mapInArrow(number, "part long, start long, words array<string>, shard long, places binary, numbers binary")


def term_matrix(
    docs: DataFrame, text: Column, keep: dict[str, Column], found: dict[str, Callable[[pa.Array], np.ndarray]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(dictionary, matrix): (word, id) of all words, and the document-term counts in shards of compressed rows.

    Ids count on from 0 without holes. A row of the matrix is a shard: `starts`, `ids` and `counts` as in any CSR matrix, with ids
    that ascend within a document, and as lists with one entry a document the columns of `keep` and whole numbers that the functions
    of `found` give for texts. Words are runs of characters other than space and 0x09-0x0D, case-sensitive; a null text has none. Words meet the dictionary once a
    shard, not once a document, so that a frequent word has as many rows as there are shards.
    """
    spark = docs.sparkSession
    found = found or {}
    names = {c: f"_{i}" for i, c in enumerate([*keep, *found])}
    listed = list(names.values())
    rows = in_small_batches(docs).select(text.alias("text"), *[e.alias(names[c]) for c, e in keep.items()])
    in_texts = {names[c]: of_texts for c, of_texts in found.items()}
    shards = stored(_shards(rows, [names[c] for c in keep], in_texts), new_folder(spark, "shards"))
    words = shards.select("shard", F.posexplode("words").alias("place", "word"))
    numbered = stored(_numbered(words), new_folder(spark, "numbered"))
    # One row for each task that numbered words, small whatever the words are.
    sizes = numbered.filter("shard IS NULL").groupBy("part").agg(F.sum(F.size("words")).alias("n")).collect()
    firsts, total = {}, 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        firsts[row["part"]] = total
        total += row["n"]
    first = F.broadcast(spark.createDataFrame(list(firsts.items()), "part long, first long"))
    in_parts = numbered.filter("shard IS NULL").select("part", "start", F.posexplode("words").alias("place", "word"))
    dictionary = in_parts.join(first, "part").select("word", (F.col("first") + F.col("start") + F.col("place")).alias("id"))

    known = numbered.filter("shard IS NOT NULL").groupBy("shard").agg(
        F.collect_list(F.struct("part", "places", "numbers")).alias("numbered")
    )
    joined = shards.drop("words").join(known, "shard", "left")
    kinds = {f.name: f.dataType.simpleString() for f in shards.schema}

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                sizes, places, counts = (unpacked(one.column(c)[0].as_py()) for c in ("sizes", "places", "counts"))
                ids = np.zeros(int(places.max()) + 1 if len(places) else 0, np.int64)
                for group in one.column("numbered")[0].as_py() or []:
                    ids[unpacked(group["places"])] = firsts[group["part"]] + unpacked(group["numbers"])
                of_cells = ids[places]
                order = np.lexsort((of_cells, np.repeat(np.arange(len(sizes)), sizes)))
                starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                made = [one.column("shard"), *(_list(pa.array(x)) for x in (starts, of_cells[order], counts[order].astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(made + [one.column(c) for c in listed], ["shard", "starts", "ids", "counts", *listed])

    schema = ["shard long", "starts array<long>", "ids array<long>", "counts array<int>", *[f"{c} {kinds[c]}" for c in listed]]
    matrix = joined.mapInArrow(renumber, ", ".join(schema))
    return dictionary, matrix.withColumnsRenamed({n: c for c, n in names.items()})


def row_totals(matrix: DataFrame, keep: list[str]) -> DataFrame:
    """One row a document: `n_words`, the sum of its row, `n_distinct`, the entries in it, and the columns of `keep`."""
    kinds = {f.name: f.dataType.elementType.simpleString() for f in matrix.select(*keep).schema}

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                starts = one.column("starts").flatten().to_numpy()
                run = np.concatenate([[0], np.cumsum(one.column("counts").flatten().to_numpy(), dtype=np.int64)])
                made = [one.column(c).flatten() for c in keep]
                made += [pa.array(run[starts[1:]] - run[starts[:-1]]), pa.array(np.diff(starts))]
                yield pa.RecordBatch.from_arrays(made, [*keep, "n_words", "n_distinct"])

    schema = ", ".join([*[f"`{c}` {k}" for c, k in kinds.items()], "n_words long", "n_distinct long"])
    return matrix.select("starts", "counts", *keep).mapInArrow(total, schema)


def _bit(name: str, failed: Column) -> Column:
    return F.when(failed, 1 << FILTERS.index(name)).otherwise(0)


_KIND = np.zeros(256, np.uint8)
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[[ord(c) for c in MARKS]] = 2
_KIND[0x80:0xC0] = 4


def plain_failures(texts: pa.Array) -> np.ndarray:
    """The bits of the filters C and D, from the bytes of the texts: a code point begins at any byte but 0x80-0xBF."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    kind = _KIND[np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]] if raw is not None else _KIND[:0]
    at = offsets - offsets[0]

    def count(value: int) -> np.ndarray:
        places = np.flatnonzero(kind == value)
        return np.diff(np.searchsorted(places, at))

    points = np.diff(at) - count(4)
    capitals = 100 * count(1) > MOST_CAPITALS_PERCENT * points
    return (capitals << FILTERS.index("C") | (count(2) > 0) << FILTERS.index("D")).astype(np.int32)


def failures(docs: DataFrame) -> DataFrame:
    """(part, doc_id, digest, mask) of each document: which of the filters A to D it fails, as bits, A the lowest."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keep = {
        "part": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        "doc_id": F.col("doc_id"),
        "digest": F.unhex(F.sha2(text, 256)),
    }
    _, matrix = term_matrix(docs, text, keep, {"plain": plain_failures})
    totals = row_totals(matrix, [*keep, "plain"])
    words, distinct = F.col("n_words"), F.col("n_distinct")
    mask = F.col("plain") + _bit("A", words < LEAST_WORDS) + _bit("B", 100 * distinct < LEAST_DISTINCT_PERCENT * words)
    return totals.select("part", "doc_id", "digest", mask.alias("mask"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """`good` and `toxic` of each row: whether any label of its document says so. No id, no label."""
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    known = rows.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    unknown = rows.filter("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    return known.unionByName(unknown)


def counted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by the filters that they fail, E among them.

    Copies of one text are never gathered: they are summed by id, then by part and label, with the smallest id on the way.
    """
    spark = docs.sparkSession
    rows = failures(docs).groupBy("digest", "mask", "part", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    rows = stored(with_labels(rows, labels), new_folder(spark, "failures"))
    one = ["digest", "mask", "part", "good", "toxic"]
    by_text = rows.groupBy(*one).agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_unknown"),
    )
    # The groups of one text are as many as parts and labels.
    firsts = by_text.groupBy("digest").agg(
        F.min("first").alias("smallest"), F.collect_list(F.struct("mask", "part", "good", "toxic", "n", "first", "n_first", "n_unknown")).alias("groups")
    )
    groups = firsts.select("smallest", F.explode("groups").alias("g")).select("smallest", "g.*")
    # A row without an id, or with the smallest one, is no copy of a smaller one.
    kept = F.col("n_unknown") + F.when(F.col("first") == F.col("smallest"), F.col("n_first")).otherwise(0)
    split = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), kept.alias("n")),
            F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - kept).alias("n")),
        )
    )
    halves = groups.select("part", "good", "toxic", split.alias("s")).select("part", "good", "toxic", "s.*")
    return halves.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def fates(spark) -> DataFrame:
    """What each step of each order does to a document that fails the filters of `mask`: 120 x 5 x 32 rows."""
    rows = []
    for order in permutations(FILTERS):
        earlier = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            for mask in range(1 << len(FILTERS)):
                fails, gone = bool(mask & bit), bool(mask & earlier)
                fate = (not fails and not gone, fails and not gone, fails and gone, mask == bit)
                rows.append(("".join(order), step, mask, *fate))
            earlier |= bit
    return spark.createDataFrame(
        rows, "filter_order string, step int, mask int, is_kept boolean, is_removed boolean, is_redundant boolean, is_unique boolean"
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (the languages; null as an empty string), order of the filters A to E, and step.

    A: under 100 words. B: under 80 % of the words are distinct. C: over 10 % of the code points are A-Z. D: holds one of
    `#$%&*|`. E: the same text has a smaller doc_id. Of the part's documents: `kept` after the step; `removed` by it;
    `redundant`, which fail its filter but went earlier; `unique_fails`, which fail this filter only; `good_lost` and
    `toxic_lost`, removed here and labelled so; `shapley`, removed by its filter summed over all orders.

    A null text is an empty one: no words (fails A, not B), no capitals. Without a doc_id a row has no labels and is
    neither a copy nor an original; equal rows count each, and rows of one id are not smaller than each other. Other
    columns do not matter. No documents give no rows.
    """
    spark = docs.sparkSession
    groups = stored(counted(docs, labels), new_folder(spark, "counts"))
    # 19,200 rows; the groups of a part are at most 128.
    fate = F.broadcast(stored(fates(spark), new_folder(spark, "fates")))

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long").alias(name)

    removed = F.col("is_removed")
    found = groups.join(fate, "mask").groupBy("part", "filter_order", "step").agg(
        total(F.col("is_kept"), "kept"), total(removed, "removed"), total(F.col("is_redundant"), "redundant"),
        total(F.col("is_unique"), "unique_fails"), total(removed & F.col("good"), "good_lost"),
        total(removed & F.col("toxic"), "toxic_lost"),
    )
    found = stored(found, new_folder(spark, "steps")).withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    shapley = found.groupBy(F.col("part").alias("_part"), F.col("filter").alias("_filter")).agg(F.sum("removed").alias("shapley"))
    joined = found.join(shapley, (F.col("part") == F.col("_part")) & (F.col("filter") == F.col("_filter")))
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return joined.select("part", "filter_order", "step", *columns)
