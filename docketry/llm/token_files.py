"""Token ids of a corpus as compact binary blocks, and back.

A folder of this format has three parts, all written by Spark and so on any storage it reaches:

* `code`: one row, the code lengths of a canonical length-limited Huffman code of the ids, made from the counts of
  all ids. Lengths alone say the code.
* `blocks`: rows in the order of the corpus. A block holds whole documents: their ids, their token counts, the packed
  bits, and the bit at which every CHECKPOINT-th token begins. It can be decoded without any other block.
* `parts`: documents and tokens of each part before it, one row a part, which turns places in a part into places in
  the whole corpus.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Iterator
from itertools import chain
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.llm.huffman import CHECKPOINT, WIDEST, Code, code_lengths
from docketry.llm.text import Words, in_small_batches, text_slices, with_text
from docketry.llm.token_counts import NOT_PLAIN, Encoder

BLOCK_TOKENS = 1 << 17
# Blocks that are decoded side by side.
TOGETHER = 8
KEPT_PIECES = 100_000
# Of these about 50 bytes each are kept.
KEPT_HASHES = 700_000
# How the tokenizer cuts lower-cased text of the characters that NOT_PLAIN lets pass.
PIECES = re.compile(r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\s\w]|_)+")

BLOCKS_DDL = "part int, block int, doc_ids binary, doc_tokens binary, bits binary, checkpoints binary"

_ENCODERS: dict[str, WordEncoder] = {}
_CODES: dict[bytes, Code] = {}


class WordEncoder(Encoder):
    """Ids of whole texts, pre-token by pre-token where the tokenizer's cut is known here."""

    def __init__(self, definition: str) -> None:
        super().__init__(definition)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        # Only for tokenizers that drop white space, lower-case, and mark the end of each pre-token.
        self.by_piece = '"end_of_word_suffix":"</w>"' in definition.replace('": ', '":') and "Lowercase" in definition
        self.ends = np.zeros(self.size, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.ids_of: dict[str, bytes] = {}
        # Known pre-tokens by hash, sorted: where their ids begin in the pool and how many there are.
        self.known = np.zeros(0, np.uint64)
        self.begin, self.length = np.zeros((2, 0), np.int64)
        self.pool = np.zeros(0, self.kind)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pre-tokens, each once, in one call of the library; marks of their ends tell them apart."""
        if len(self.ids_of) > KEPT_PIECES:
            self.ids_of = {}
        missing = sorted(pieces - self.ids_of.keys())
        if not missing:
            return
        ids = self._ids([" ".join(missing)])[0]
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(missing):
            raw, width = ids.tobytes(), self.kind.itemsize
            places = [0, *(stops * width).tolist()]
            self.ids_of.update((p, raw[a:b]) for p, a, b in zip(missing, places, places[1:], strict=False))
        else:
            self.ids_of.update((p, x.tobytes()) for p, x in zip(missing, self._ids(missing), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian numbers of this tokenizer's width."""
        if not self.by_piece:
            return [x.tobytes() for x in self._ids(texts)]
        plain = [NOT_PLAIN.search(t) is None and not (self.special and self.special.search(t)) for t in texts]
        # Many small strings and no cycles: the collector would only walk over them.
        collects = gc.isenabled()
        gc.disable()
        try:
            cut = [PIECES.findall(t.lower()) if p else None for t, p in zip(texts, plain, strict=True)]
            self._learn(set(chain.from_iterable(c for c in cut if c is not None)))
            by_library = iter(self._ids([t for t, p in zip(texts, plain, strict=True) if not p]))
            get = self.ids_of.__getitem__
            return [next(by_library).tobytes() if c is None else b"".join(map(get, c)) for c in cut]
        finally:
            if collects:
                gc.enable()


    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """As `encode`, for texts that lie one after the other in `data`.

        Texts of ASCII and Latin-1 letters without apostrophes are cut as arrays, and of their pre-tokens only the
        different ones are looked up; the others go the way of `encode`.
        """
        plain = _plain_texts(data, offsets, self.added) if self.by_piece else np.zeros(len(offsets) - 1, bool)
        out: list[bytes] = [b""] * len(plain)
        other = np.flatnonzero(~plain)
        if len(other):
            base = offsets[0]
            texts = [data[offsets[k] - base : offsets[k + 1] - base].tobytes().decode() for k in other]
            for k, ids in zip(other.tolist(), self.encode(texts), strict=True):
                out[k] = ids
        if plain.any():
            sizes = np.diff(offsets)
            pieces = _pieces(data[np.repeat(plain, sizes)], np.concatenate([[0], np.cumsum(sizes[plain])]))
            different, first, which = np.unique(pieces.hashes(), return_index=True, return_inverse=True)
            self._know(different, first, pieces)
            slots = np.searchsorted(self.known, different)[which]
            sizes = self.length[slots]
            ends = np.cumsum(sizes)
            ids = self.pool[np.repeat(self.begin[slots] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
            raw, bounds = ids.tobytes(), np.concatenate([[0], ends])[pieces.first] * self.kind.itemsize
            for j, k in enumerate(np.flatnonzero(plain).tolist()):
                out[k] = raw[bounds[j] : bounds[j + 1]]
        return out

    def _know(self, hashes: np.ndarray, first: np.ndarray, pieces: Words) -> None:
        """Encode the pre-tokens that are new; hashes are sorted, first is where each occurs."""
        if len(self.known) > KEPT_HASHES:
            self.known, self.begin, self.length, self.pool = (x[:0] for x in (self.known, self.begin, self.length, self.pool))
        at = np.searchsorted(self.known, hashes)
        there = np.zeros(len(hashes), bool)
        inside = at < len(self.known)
        there[inside] = self.known[at[inside]] == hashes[inside]
        new = np.flatnonzero(~there)
        if not len(new):
            return
        raw, place = pieces.data.tobytes(), first[new]
        texts = [raw[a:b].decode() for a, b in zip(pieces.starts[place].tolist(), pieces.ends[place].tolist(), strict=True)]
        ids = self._ids([" ".join(texts)])[0]
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(texts):
            each = self._ids(texts)
            ids, stops = np.concatenate(each), np.cumsum([len(x) for x in each])
        begin = np.concatenate([[0], stops[:-1]])
        self.begin = np.insert(self.begin, at[new], begin + len(self.pool))
        self.length = np.insert(self.length, at[new], stops - begin)
        self.known = np.insert(self.known, at[new], hashes[new])
        self.pool = np.concatenate([self.pool, ids])


SPACE, LETTER, DIGIT, MARK, ELSE = range(5)
_KINDS = np.full(256, ELSE, np.uint8)
_KINDS[[9, 10, 13, 32]] = SPACE
_KINDS[33:127] = MARK
_KINDS[48:58] = DIGIT
_KINDS[[*range(65, 91), *range(97, 123), 195, *range(128, 192)]] = LETTER
_KINDS[39] = ELSE


def _plain_texts(data: np.ndarray, offsets: np.ndarray, added: list[bytes]) -> np.ndarray:
    """Which texts hold only ASCII without apostrophes and controls, Latin-1 letters, and no special token."""
    kinds = _KINDS[data]
    high = data >= 128
    lead = data == 195
    # A lead byte C3 and one byte behind it that is a letter of Latin-1, nothing else.
    bad = kinds == ELSE
    bad[1:] |= high[1:] & ~lead[1:] & ~lead[:-1]
    bad[1:] |= lead[:-1] & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    bad[:1] |= high[:1] & ~lead[:1]
    count = np.concatenate([[0], np.cumsum(bad)])[offsets - offsets[0]]
    plain = np.diff(count) == 0
    raw = data.tobytes()
    for token in added:
        at = raw.find(token)
        while at >= 0:
            plain[np.searchsorted(offsets - offsets[0], at, "right") - 1] = False
            at = raw.find(token, at + 1)
    return plain


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The pre-tokens of plain texts, lower-cased: runs of letters, single digits, runs of other marks."""
    offsets = offsets - offsets[0]
    kinds = _KINDS[data]
    begin = np.ones(len(data), bool)
    begin[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begin[edges] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(data))
    solid = kinds[starts] != SPACE
    starts, ends = starts[solid], ends[solid]
    lowered = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
    lead = np.flatnonzero(data[:-1] == 195) + 1
    upper = lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E)]
    lowered[upper] |= 32
    return Words(lowered, starts, ends, starts, np.searchsorted(starts, offsets), offsets)


def encoder(definition: str) -> WordEncoder:
    if definition not in _ENCODERS:
        _ENCODERS[definition] = WordEncoder(definition)
    return _ENCODERS[definition]


def code_of(lengths: bytes) -> Code:
    if lengths not in _CODES:
        _CODES[lengths] = Code(np.frombuffer(lengths, np.uint8))
    return _CODES[lengths]


def encoded(docs: DataFrame, definition: str, end_id: int | None, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the ids of each text with the end id behind them, as little-endian numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(shared.value)
        end = b"" if end_id is None else np.array([end_id], tool.kind).tobytes()
        for batch in batches:
            for row, stop, data, offsets in text_slices(batch.column("text")):
                ids = [x + end for x in tool.encode_bytes(data, offsets)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, stop - row), pa.array(ids, pa.binary())], ["doc_id", "ids"]
                )

    rows = with_text(docs, F.col(id_column).cast("long").alias("doc_id"))
    return rows.mapInArrow(encode, "doc_id long, ids binary")


def id_counts(ids: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    """How often each id occurs in all documents: one list of at most `size` numbers, summed on the executors first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])

    summed = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, np.int64)
    for row in summed.toLocalIterator():
        counts[row.id] = row.n
    return counts


def write(docs: DataFrame, folder: str, definition: str, end_id: int | None, id_column: str = "doc_id") -> None:
    """Encode the whole texts of `docs` and write them under `folder` in ascending order of the id column.

    A null or empty text has only the end id. Rows with a null id come first. Rows of equal id follow each
    other by a digest of their ids, so that only equal rows may change places. No rows give an empty corpus.
    Other columns do not matter. `end_id` None appends none. Existing content of `folder` is replaced.
    """
    spark = docs.sparkSession
    encoded(docs, definition, end_id, id_column).write.mode("overwrite").option("compression", "zstd").parquet(
        f"{folder}/encoded"
    )
    ids = spark.read.parquet(f"{folder}/encoded")
    tool = WordEncoder(definition)
    kind, size = tool.kind, max(tool.size, (end_id or 0) + 1)
    counts = id_counts(ids, kind, size)
    limit = min(WIDEST, max(16, ceil(np.log2(max(2, size))) + 1))
    lengths = code_lengths(counts, limit).tobytes()
    spark.createDataFrame([(bytearray(lengths),)], "lengths binary").coalesce(1).write.mode("overwrite").parquet(
        f"{folder}/code"
    )
    shared = spark.sparkContext.broadcast(lengths)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part, block = code_of(shared.value), TaskContext.get().partitionId(), 0
        docs_held: list[int | None] = []
        held: list[bytes] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            bits, checkpoints = code.pack(np.frombuffer(b"".join(held), kind))
            sizes = np.array([len(x) // kind.itemsize for x in held], "<i8")
            names = pa.array(docs_held, pa.int64())
            present = np.array([d is not None for d in docs_held], "<i8")
            numbers = np.concatenate([present, np.asarray(names.fill_null(0))]).astype("<i8")
            columns = [[part], [block], [numbers.tobytes()], [sizes.tobytes()], [bits], [checkpoints.astype("<i8").tobytes()]]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
            names_of = ["part", "block", "doc_ids", "doc_tokens", "bits", "checkpoints"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names_of)

        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                docs_held.append(doc)
                held.append(raw)
                tokens += len(raw) // kind.itemsize
                if tokens >= BLOCK_TOKENS:
                    yield flush()
                    docs_held, held, tokens, block = [], [], 0, block + 1
        if held:
            yield flush()

    # Ranges by id, and by a digest where many rows share one id.
    order = ["doc_id", F.xxhash64("ids"), "ids"]
    ordered = ids.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(pack, BLOCKS_DDL).write.mode("overwrite").parquet(f"{folder}/blocks")
    totals = (
        spark.read.parquet(f"{folder}/blocks")
        .select("part", "doc_tokens")
        .mapInArrow(_block_totals, "part int, docs long, tokens long")
        .groupBy("part")
        .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    )
    # One row a part of the writing job, so this window is as small as that job's list of tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        "part",
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_before"),
    )
    shifts.write.mode("overwrite").parquet(f"{folder}/parts")
    _remove(spark, f"{folder}/encoded")


def _block_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [np.frombuffer(raw, "<i8") for raw in batch.column("doc_tokens").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("part"),
                pa.array([len(s) for s in sizes], pa.int64()),
                pa.array([int(s.sum()) for s in sizes], pa.int64()),
            ],
            ["part", "docs", "tokens"],
        )


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job made, on whatever storage it is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _blocks(spark: SparkSession, folder: str) -> tuple[DataFrame, object]:
    lengths = bytes(spark.read.parquet(f"{folder}/code").head().lengths)
    return spark.read.parquet(f"{folder}/blocks"), spark.sparkContext.broadcast(lengths)


def _decoded(batches: Iterator[pa.RecordBatch], lengths: bytes) -> Iterator[tuple]:
    """(part, block, doc ids, tokens of each document, first places, ids) of each block."""
    code = code_of(lengths)
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            rows = batch.slice(at, TOGETHER).to_pylist()
            sizes = [np.frombuffer(r["doc_tokens"], "<i8") for r in rows]
            ids = code.unpack(
                [r["bits"] for r in rows],
                [np.frombuffer(r["checkpoints"], "<i8") for r in rows],
                [int(s.sum()) for s in sizes],
            )
            for r, s, found in zip(rows, sizes, ids, strict=True):
                present, numbers = np.frombuffer(r["doc_ids"], "<i8").reshape(2, -1)
                docs = pa.array(numbers, pa.int64(), mask=present == 0)
                yield r["part"], r["block"], docs, s, np.cumsum(s) - s, found


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids array<long>) of every document of a corpus; ids as they were written."""
    blocks, lengths = _blocks(spark, folder)
    in_small_batches(blocks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, docs, sizes, _, ids in _decoded(batches, lengths.value):
            places = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(places, pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([docs, lists], ["doc_id", "ids"])

    return blocks.mapInArrow(decode, "doc_id long, ids array<long>")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, all from the decoded files.

    `start` is the number of ids of all documents before it; the checksum is that of the ids as little-endian
    unsigned 32-bit numbers.
    """
    blocks, lengths = _blocks(spark, folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block, docs, sizes, starts, ids in _decoded(batches, lengths.value):
            raw = memoryview(ids.astype("<u4").tobytes())
            sums = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
            n = len(sizes)
            columns = [
                pa.array([part] * n, pa.int32()), pa.array([block] * n, pa.int32()), docs, pa.array(starts, pa.int64()),
                pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
            ]
            names = ["part", "block", "doc_id", "within", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns, names)

    docs = blocks.mapInArrow(
        decode, "part int, block int, doc_id long, within long, n_tokens long, ids_crc32 long"
    )
    sizes = blocks.select("part", "block", "doc_tokens").mapInArrow(_block_sizes, "part int, block int, tokens long")
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.join(spark.read.parquet(f"{folder}/parts"), "part").select(
        "part",
        "block",
        (F.coalesce(F.sum("tokens").over(before), F.lit(0)) + F.col("tokens_before")).alias("shift"),
    )
    return docs.join(shifts, ["part", "block"]).select(
        "doc_id", (F.col("within") + F.col("shift")).alias("start"), "n_tokens", "ids_crc32"
    )


def _block_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = [int(np.frombuffer(raw, "<i8").sum()) for raw in batch.column("doc_tokens").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("block"), pa.array(sums, pa.int64())], ["part", "block", "tokens"]
        )
