"""Scores of whole texts under a small causal self-attention model that is trained on the corpus itself.

All training text gives the counts: of words (for the base score), of ids, and of neighbouring ids, which are the
model's starting point. The layers are then trained side by side on all windows of all training documents, each id in one
of them, and their weights averaged after each round. Scoring cuts each text into windows that overlap, and scores
each id once.

Ids are those of a public tokenizer for the lower-cased text, with one end id. Words are runs of bytes other than space
and 0x09-0x0D, with A-Z lower-cased; a text's words are followed by one end.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm import attention as net
from docketry.llm.text import mixed, text_slices, with_text, words_of
from docketry.llm.token_files import encoder
from docketry.sources.workspace import new_folder, stored

# Words whose counts are broadcast; the others meet theirs in a join.
FREQUENT = 200_000
# Different words a task sums up before it hands them on.
SUMMED = 400_000
# A part has windows for STEPS steps in each round, or up to twice as many; each of its windows is in one round.
ROUNDS, STEPS, WINDOWS_PER_STEP, RATE = 4, 120, 96, 0.01
# Ids that are scored, and counted, together.
TOGETHER, COUNTED = 1 << 15, 1 << 20


def held_out(id_column: str) -> Column:
    """The fifth of the rows that nothing is learnt from, by a checksum of the id as text."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n): how often each word, named by a 64-bit hash, occurs in (text); summed in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        fresh: list[np.ndarray] = []
        waiting = 0

        def merge() -> None:
            nonlocal words, counts, fresh, waiting
            some, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *fresh]), return_counts=True)
            words, at = np.unique(np.concatenate([words, some]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(words)).astype(np.int64)
            fresh, waiting = [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])

        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                fresh.append(words_of(data, offsets).hashes())
                waiting += len(fresh[-1])
                if waiting > SUMMED:
                    merge()
                if len(words) > SUMMED:
                    yield out()
                    words, counts = words[:0], counts[:0]
        merge()
        yield out()

    return rows.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Base:
    """Counts of the training tokens: all, different, ends, and those of the frequent words by hash."""

    tokens: int
    different: int
    ends: int
    words: np.ndarray
    counts: np.ndarray

    def log10(self, count):
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.different + 1)))


def read_texts(rows: DataFrame, base: Base, definition: str) -> DataFrame:
    """Ids and base parts of (doc_id, held_out, text).

    (doc_id, held_out, ids, n_tokens, n_known, base_score, rare, rare_counts): known words and score count the end and the
    frequent words; the other different words are listed with their counts in the text.
    """
    context = rows.sparkSession.sparkContext
    shared, counts = context.broadcast(definition), context.broadcast(base)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, known = encoder(shared.value), counts.value
        end = np.array([tool.size], tool.kind).tobytes()
        logs, end_log = known.log10(known.counts), float(known.log10(known.ends))
        for batch in batches:
            for row, stop, data, offsets in text_slices(batch.column("text")):
                n = stop - row
                words = words_of(data, offsets)
                hashes = words.hashes()
                at = np.minimum(np.searchsorted(known.words, hashes), max(0, len(known.words) - 1))
                hit = known.words[at] == hashes if len(known.words) else np.zeros(len(hashes), bool)
                score = np.bincount(words.doc[hit], logs[at[hit]] if hit.any() else None, n) + end_log
                frequent = np.bincount(words.doc[hit], minlength=n) + int(known.ends > 0)
                rare, doc = hashes[~hit], words.doc[~hit]
                order = np.lexsort((rare, doc))
                rare, doc = rare[order], doc[order]
                new = np.ones(len(rare), bool)
                new[1:] = (rare[1:] != rare[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                lists = np.searchsorted(doc[first], np.arange(n + 1)).astype(np.int32)
                rare_counts = np.diff(np.append(first, len(rare))).astype(np.int32)
                ids = [x + end for x in tool.encode_bytes(data, offsets)]
                columns = [
                    *[batch.column(k).slice(row, n) for k in (0, 1)], pa.array(ids, pa.binary()),
                    pa.array(np.diff(words.first) + 1), pa.array(frequent), pa.array(score),
                    pa.ListArray.from_arrays(pa.array(lists), pa.array(rare[first].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(lists), pa.array(rare_counts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "held_out", "ids", "n_tokens", "n_known", "base_score", "rare", "rare_counts"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    ddl = (
        f"doc_id {kind}, held_out boolean, ids binary, n_tokens long, n_known long, base_score double, "
        "rare array<long>, rare_counts array<int>"
    )
    return rows.select("doc_id", "held_out", "text").mapInArrow(read, ddl)


def _id_lists(batches: Iterable[pa.RecordBatch], kind: np.dtype, most: int) -> Iterator[list[np.ndarray]]:
    """The ids of each row, some rows at a time."""
    part: list[np.ndarray] = []
    size = 0
    for raw in itertools.chain.from_iterable(batch.column("ids") for batch in batches):
        part.append(np.frombuffer(raw.as_buffer(), kind))
        size += len(part[-1])
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def _summed(frame: DataFrame, kind: np.dtype, cells, size: int) -> np.ndarray:
    """How often each of `size` cells is named by `cells` of some rows' ids: at most `size` rows, summed on the executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for part in _id_lists(batches, kind, COUNTED):
            total += np.bincount(cells(part), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["cell", "n"])

    table = frame.select("ids").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return out


@dataclass
class Model:
    params: net.Params
    base: np.ndarray
    vocabulary: net.Vocabulary
    tail: np.ndarray
    kind: np.dtype


def train(texts: DataFrame, kind: np.dtype, size: int) -> Model:
    """Learn from the ids of all of `texts`; `size` ids are possible, the end among them."""
    spark = texts.sparkSession
    counts = _summed(texts, kind, np.concatenate, size)
    vocabulary = net.Vocabulary.from_counts(counts.astype(float))
    shared = spark.sparkContext.broadcast(vocabulary)

    pairs = (net.INPUTS + 1) * net.CLASSES

    def cells(part: list[np.ndarray]) -> np.ndarray:
        """Pairs of an input place and the class behind it, and behind all pairs the cells of the tail."""
        v, size, y = shared.value, np.array([len(y) for y in part]), np.concatenate(part)
        begins = (np.cumsum(size) - size)[size > 0]
        before = np.empty(len(y), np.int64)
        before[1:] = v.of_input[y[:-1]]
        before[begins] = net.INPUTS
        return np.concatenate([before * net.CLASSES + v.of_class[y], pairs + v.tail_cells(y, begins)[1]])

    seen = _summed(texts, kind, cells, pairs + (net.CLASSES + 1) * net.TAIL)
    tail = vocabulary.tail_logs(seen[pairs:])
    seen = seen[:pairs].reshape(-1, net.CLASSES).astype(float)
    base = net.neighbour_shares(seen, seen.sum(axis=0))
    params = net.first_params()
    wide = F.lit(np.dtype(kind).itemsize * net.WINDOW)
    total = texts.agg(F.sum(F.ceil(F.length("ids") / wide)).alias("n")).head().n or 0
    parts = max(1, total // (ROUNDS * STEPS * WINDOWS_PER_STEP))
    for number in range(ROUNDS if total else 0):
        params = _round(_windows(texts, kind, parts, number), params, base, shared, kind, parts, number)
    return Model(params, base, vocabulary, tail, kind)


def _marks(seeds: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number without order for each window of some texts, other ones for other texts and other seeds; also the number
    of the text of each window and that of the window in its text. The texts lie one behind the other in `ids`."""
    place = np.arange(1, len(ids) + 1) - np.repeat(begin, size)
    digest = np.concatenate([[0], np.cumsum(ids * place)])
    n = -(-size // net.WINDOW)
    text = np.repeat(np.arange(len(size)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    first = mixed((seeds + digest[begin + size] - digest[begin]).view(np.uint64))
    marks = mixed(first[text] + (number + 1).astype(np.uint64)) >> np.uint64(1)
    return marks.astype(np.int64), text, number


def _windows(texts: DataFrame, kind: np.dtype, parts: int, number: int) -> DataFrame:
    """(mark, part, opens, window) of the training windows of a round: their ids and, but at the beginning of a text, the
    one before them. Together the rounds have all windows, each in one."""

    wide = np.dtype(kind).itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids").cast(pa.large_binary())
            _, offsets, raw = column.buffers()
            ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] // wide if len(column) else np.zeros(1, np.int64)
            data = np.frombuffer(raw, kind, ends[-1])[ends[0] :] if ends[-1] else np.zeros(0, kind)
            size, begin = np.diff(ends), ends[:-1] - ends[0]
            marks, text, k = _marks(batch.column("seed").to_numpy(), data.astype(np.int64), begin, size)
            here = np.flatnonzero(marks // parts % ROUNDS == number)
            mark, text, k = marks[here], text[here], k[here]
            first = np.maximum(k * net.WINDOW - 1, 0)
            length = np.minimum((k + 1) * net.WINDOW, size[text]) - first
            until = np.cumsum(length)
            found = data[np.repeat(begin[text] + first - (until - length), length) + np.arange(until[-1] if len(until) else 0)]
            offsets = np.concatenate([[0], until * wide]).astype(np.int32)
            window = pa.Array.from_buffers(pa.binary(), len(mark), [None, pa.py_buffer(offsets), pa.py_buffer(found)])
            columns = [pa.array(mark), pa.array(mark % parts), pa.array(k == 0), window]
            yield pa.RecordBatch.from_arrays(columns, ["mark", "part", "opens", "window"])

    return texts.select("seed", "ids").mapInArrow(cut, "mark long, part long, opens boolean, window binary")


def _unpacked(raw: list[bytes], opens: np.ndarray, kind: np.dtype, vocabulary: net.Vocabulary):
    """Input places, classes and wanted places of windows as `_windows` gives them."""
    size = np.array([len(w) for w in raw], np.int64) // np.dtype(kind).itemsize
    end = np.cumsum(size)
    ids = np.frombuffer(b"".join(raw), kind).astype(np.int64)
    place = (end - size + ~opens)[:, None] + np.arange(net.WINDOW)
    inside = place < end[:, None]
    target = vocabulary.of_class[ids].take(place, mode="clip")
    place -= 1
    x = vocabulary.of_input[ids].take(place, mode="clip")
    x[opens, 0] = net.INPUTS
    x *= inside
    target *= inside
    return x, target, inside.astype(np.float32)


def _round(windows: DataFrame, params: net.Params, base: np.ndarray, vocabulary, kind: np.dtype, parts: int, number: int) -> net.Params:
    """Train from `params` on all windows of each part by itself, and average what comes out."""
    spark = windows.sparkSession
    shared = spark.sparkContext.broadcast((params, base))

    def fit(table: pa.Table) -> pa.RecordBatch:
        table = table.sort_by([("mark", "ascending"), ("window", "ascending")])
        opens = table.column("opens").to_numpy()
        x, target, wanted = _unpacked(table.column("window").to_pylist(), opens, kind, vocabulary.value)
        start, known = shared.value
        rate = RATE * 0.6**number
        steps = -(-len(x) // WINDOWS_PER_STEP)
        found = net.train(start, known, x, target, wanted, steps, rate, number, WINDOWS_PER_STEP)
        values = np.concatenate([found[name].reshape(-1) for name in sorted(found)]).astype(np.float64)
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    def fit_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [batch for batch in batches if batch.num_rows]
        if found:
            table = pa.Table.from_batches(found)
            for part in pc.unique(table.column("part")).sort():
                yield fit(table.filter(pc.equal(table.column("part"), part)))

    # A part is a task.
    trained = windows.repartitionById(parts, F.col("part").cast("int")).mapInArrow(fit_parts, "at long, value double")
    # One row a weight.
    table = trained.groupBy("at").agg(F.avg("value").alias("value")).toArrow()
    if not table.num_rows:
        return params
    flat = np.empty(table.num_rows, np.float32)
    flat[table.column("at").to_numpy()] = table.column("value").to_numpy()
    out, place = {}, 0
    for name in sorted(params):
        size = params[name].size
        out[name] = flat[place : place + size].reshape(params[name].shape)
        place += size
    return out


def scored(texts: DataFrame, model: Model) -> DataFrame:
    """`texts` without its ids, with `score`: the model's log10 probability of each row's ids."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in texts.columns if c != "ids"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        table = net.output_table(m.base)
        for batch in batches:
            found = [net.score(m.params, m.base, m.vocabulary, m.tail, part, table) for part in _id_lists([batch], m.kind, TOGETHER)]
            score = pa.array(np.concatenate([np.zeros(0), *found]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], score], [*kept, "score"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields if f.name != "ids")
    return texts.mapInArrow(score, f"{ddl}, score double")


def score_documents(docs: DataFrame, definition: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Learns from the rows that are not held out. `base_score` is the sum over the tokens of log10((c + 0.5) / (N + 0.5 (V + 1)))
    with the counts of the training tokens; `score` is the model's log10 probability. A null or empty text is its end
    alone. A null id is not held out; equal rows stay and count as often as they are there; without rows to learn from
    all counts are 0 and the model is even. No rows give no rows; other columns do not matter.
    """
    spark = docs.sparkSession
    rows = with_text(docs, F.col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"), text=text)
    counts = stored(word_counts(rows.filter("NOT held_out")), new_folder(spark, "words"))
    ends = rows.filter("NOT held_out").count()
    all_words, different = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).head()
    # FREQUENT rows at most.
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    words, numbers = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(words)
    base = Base(all_words + ends, different + int(ends > 0), ends, words[order], numbers[order])

    texts = stored(read_texts(rows, base, definition).withColumn("row", F.monotonically_increasing_id()), new_folder(spark, "texts"))
    tool = encoder(definition)
    seed = F.xxhash64(F.col("doc_id").cast("string")).alias("seed")
    model = train(texts.filter("NOT held_out").select(seed, "ids"), tool.kind, tool.size + 1)

    listed = texts.select("row", F.explode(F.arrays_zip("rare", "rare_counts")).alias("z"))
    listed = listed.select("row", F.col("z.rare").alias("word"), F.col("z.rare_counts").alias("m"))
    count = F.coalesce("n", F.lit(0))
    weight = F.log10((count + 0.5) / F.lit(float(base.tokens + 0.5 * (base.different + 1))))
    rare = listed.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("m") * weight).alias("rare_score"), F.sum(F.when(count > 0, F.col("m")).otherwise(0)).alias("rare_known")
    )
    found = scored(texts.drop("rare", "rare_counts"), model).join(rare, "row", "left")
    return found.select(
        F.col("doc_id").alias(id_column), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(base.tokens)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"), "score",
    )
