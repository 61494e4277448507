"""Token counts of whole texts by a map-side lookup in two tiers.

Tier one is a broadcast table of the lengths (in tokens) of the most frequent pre-tokens of all texts; its size
is fixed. Tier two is a cache in each worker: a pre-token that is not in the table is encoded once there. Pre-tokens
are never shuffled; only a bounded summary of each task is, to choose the table.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.text import with_text

TABLE_SIZE = 65_536
# A task sums its pre-tokens exactly up to so many different ones, then keeps the more frequent half.
SUMMARY_SIZE = 100_000
SUMMARY_SENT = 8_192
CACHE_SIZE = 200_000
LONGEST_KEPT = 64
SLICE_CHARS = 1 << 21

# How byte-level BPE cuts a text, written for the characters in PLAIN, where re's classes
# and the Unicode categories of the library agree.
PIECES = re.compile(r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
PLAIN = r"\t\n\r\x20-\x7e¡-±´-¸º»¿-ɏ‘’“”…"
NOT_PLAIN = re.compile(f"[^{PLAIN}]")

_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """A tokenizer of the library, with the cut into pre-tokens done here where that is safe."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        added = parts.get("added_tokens") or []
        cut = parts.get("pre_tokenizer") or {}
        self.safe = (
            cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
            and not parts.get("normalizer")
            and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        self.added = [t["content"].encode() for t in added]
        names = sorted((re.escape(t["content"]) for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(names)) if names else None
        self.known: dict[str, int] = {}

    def cut(self, text: str) -> tuple[list[str] | None, int]:
        """The pre-tokens of a text and how many special tokens it holds; None where the library must cut."""
        if not self.safe or NOT_PLAIN.search(text):
            return None, 0
        if self.special is None or not self.special.search(text):
            return PIECES.findall(text), 0
        parts = self.special.split(text)
        return list(chain.from_iterable(map(PIECES.findall, parts))), len(parts) - 1

    def lengths(self, pieces: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def learn(self, pieces: set[str], table: dict[str, int]) -> None:
        if len(self.known) > CACHE_SIZE + len(table):
            self.known = {}
        if not self.known:
            self.known.update(table)
        missing = [p for p in pieces if p not in self.known]
        if missing:
            self.known.update(zip(missing, self.lengths(missing), strict=True))

    def count(self, texts: list[str], table: dict[str, int]) -> list[int]:
        cuts = [self.cut(t) for t in texts]
        self.learn(set().union(*[c for c, _ in cuts if c is not None]), table)
        length = self.known.__getitem__
        whole = [t for t, (c, _) in zip(texts, cuts, strict=True) if c is None]
        by_library = iter(self.lengths(whole))
        return [next(by_library) if c is None else sum(map(length, c)) + s for c, s in cuts]


def encoder(definition: str) -> Encoder:
    """One encoder, with its cache, for each worker and tokenizer."""
    if definition not in _ENCODERS:
        _ENCODERS[definition] = Encoder(definition)
    return _ENCODERS[definition]


def slices(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, about SLICE_CHARS characters at a time."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def frequent_pieces(docs: DataFrame, definition, table_size: int = TABLE_SIZE) -> DataFrame:
    """(piece, n) of the most frequent pre-tokens of all texts; near the end of the table about the most frequent."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = encoder(definition.value).cut
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(cut(text)[0] or ())
                if len(counts) > SUMMARY_SIZE:
                    counts = Counter(dict(counts.most_common(SUMMARY_SIZE // 2)))
        best = [(p, n) for p, n in counts.most_common(SUMMARY_SENT) if n > 1 and len(p) <= LONGEST_KEPT]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], ["piece", "n"]
        )

    summed = with_text(docs).mapInArrow(summary, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return summed.orderBy(F.desc("n"), "piece").limit(table_size)


def count_tokens(docs: DataFrame, definition: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of each row of `docs`.

    `definition` is the JSON text of a tokenizers file. Counts are those of the library for the whole text, without
    begin, end or added special tokens, with special strings in a text taken as it takes them, and without truncation.
    A null or empty text has 0 bytes and 0 tokens; a null id stays null; equal rows stay; other columns, also such
    as have the names of the new ones, do not matter; no rows give no rows. A text is handled by one task as a whole.
    """
    spark = docs.sparkSession
    rows = with_text(docs, id_column, text=text)
    shared = spark.sparkContext.broadcast(definition)
    pieces = [r.piece for r in frequent_pieces(rows, shared).collect()]
    lengths = encoder(definition).lengths(pieces) if pieces else []
    # At most TABLE_SIZE entries of at most LONGEST_KEPT characters and a small number.
    table = spark.sparkContext.broadcast(dict(zip(pieces, lengths, strict=True)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(shared.value)
        for batch in batches:
            column = batch.column("text")
            tokens = list(chain.from_iterable(tool.count(s, table.value) for s in slices(column.to_pylist())))
            size = pa.compute.binary_length(column.cast(pa.large_binary())).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size, pa.array(tokens, pa.int64())], [id_column, "n_bytes", "n_tokens"]
            )

    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(counted, f"`{id_column}` {kind}, n_bytes long, n_tokens long")


def over(limit: int) -> Callable[[DataFrame], DataFrame]:
    """Mark the rows with more than `limit` tokens."""
    return lambda counts: counts.withColumn("over_limit", F.col("n_tokens") > limit)
