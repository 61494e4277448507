"""Passages that repeat across documents, by content-defined chunks.

A gear hash rolls over the words of a text: shifted by 16 bits a word, it forgets all but the last four words. A text is cut
behind each word whose hash is the greatest among REACH words to either side, so cuts depend on what is around
them and on nothing else: words put in or taken out move no cut further than a few words away. Chunks are
compared by digest. Runs of neighbouring chunks that other documents have too, long enough together, are repeats.

A passage usually loses up to about 15 words at its ends to chunks that reach out of it, hence LEAST_WORDS is less than the 50
words of the passages that are looked for. Local maxima have no strict bound: of random passages of 51 words 15 in 200,000
keep fewer than LEAST_WORDS words in shared chunks and are missed; longer ones are missed less often.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.bitmap import BITS, bit_map, is_set, low_bits
from docketry.llm.text import powers, mixed, text_slices, with_text, words_of
from docketry.sources.workspace import new_folder, stored

REACH = 3
# A chunk has at most so many words, and so many where one to three words repeat on and on.
LONGEST = 32
STEP = 12
LEAST_WORDS = 18


def chunks(data: np.ndarray, offsets: np.ndarray):
    """Document, first word, words, first and last byte, and digest of each chunk of a slice of documents."""
    words = words_of(data, offsets)
    hashes = words.hashes()
    n = len(hashes)
    if not n:
        return tuple(np.zeros(0, np.int64) for _ in range(5)) + (np.zeros(0, np.uint64),)
    place = np.arange(n) - words.first[words.doc]
    gear = hashes.copy()
    for back in (1, 2, 3):
        shifted = hashes[:-back] << np.uint64(16 * back)
        gear[back:] += np.where(place[back:] >= back, shifted, np.uint64(0))
    gear = mixed(gear)
    top = np.ones(n, bool)
    for d in range(1, REACH + 1):
        same = words.doc[d:] == words.doc[:-d]
        top[d:] &= ~same | (gear[d:] > gear[:-d])
        top[:-d] &= ~same | (gear[:-d] >= gear[d:])
    # Where up to REACH words repeat on and on there is no greatest hash: such stretches are cut at equal steps.
    again = np.zeros(n, bool)
    for d in range(1, REACH + 1):
        again[d:] |= (gear[d:] == gear[:-d]) & (words.doc[d:] == words.doc[:-d])
    if again.any():
        steps = np.arange(n) - np.maximum.accumulate(np.where(again, 0, np.arange(n) + 1))
        top = np.where(again, steps % STEP == 0, top)
    # A chunk begins behind a cut and at the beginning of a document.
    begin = np.zeros(n, bool)
    begin[1:] = top[:-1]
    begin[place == 0] = True
    first = np.flatnonzero(begin)
    size = np.diff(np.append(first, n))
    parts = -(-size // LONGEST)
    if (parts > 1).any():
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + LONGEST * step
        size = np.diff(np.append(first, n))
    up, down = powers(n + 1)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=run[1:])
    last = first + size
    digest = mixed((run[last] - run[first]) * down[first] + size.astype(np.uint64))
    doc = words.doc[first]
    return doc, place[first], size, words.starts[first] - words.offsets[doc], words.ends[last - 1] - words.offsets[doc], digest


def chunk_rows(docs: DataFrame, flags=None) -> DataFrame:
    """(digest, doc_id, at, n_words, from_byte, to_byte) of the chunks of (doc_id, text); with a map only of those it has."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in text_slices(batch.column("text")):
                doc, at, size, low, high, digest = chunks(data, offsets)
                if flags is not None:
                    some = np.flatnonzero(is_set(flags.value, (digest & np.uint64(BITS - 1)).astype(np.int64)))
                    doc, at, size, low, high, digest = (x[some] for x in (doc, at, size, low, high, digest))
                columns = [pa.array(digest.view(np.int64)), batch.column("doc_id").take(pa.array(doc + row))]
                if flags is not None:
                    columns += [pa.array(x) for x in (at, size, low, high)]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["digest", "doc_id"] + (["at", "n_words", "from_byte", "to_byte"] if flags is not None else [])
    return docs.mapInArrow(cut, ", ".join(f"{n} long" for n in names))


def repeats(
    docs: DataFrame, least_words: int = LEAST_WORDS, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, from_word, n_words, from_byte, to_byte, n_copies, first_id, is_first) of each passage that another document has too.

    A passage of more than 50 words that two documents share is found in both, but for about 1 in 13,000 of the shortest ones, and
    none that shares fewer than `least_words` words. Places are those of the chunks within the passage, bytes those of the UTF-8 text.
    `first_id` is the smallest document that has part of it; `is_first` says that no smaller document has any of it, so
    that it would be kept. Repeats within one document alone do not count. Texts are compared by words with A-Z
    lower-cased, so white space does not matter. Null, empty and short texts have none. Rows with a null id are left
    out; rows of one id are one document; no rows give no rows; other columns do not matter.
    """
    spark = docs.sparkSession
    rows = with_text(docs.filter(F.col(id_column).isNotNull()), F.col(id_column).cast("long").alias("doc_id"), text=text)
    by_digest = chunk_rows(rows).groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count(F.lit(1)).alias("n_copies")
    )
    shared = stored(by_digest.filter("first_id < last_id").drop("last_id"), new_folder(spark, "shared-chunks"))
    flags = spark.sparkContext.broadcast(bit_map(shared, low_bits(F.col("digest"))))
    found = chunk_rows(rows, flags).distinct().join(shared, "digest")
    order = Window.partitionBy("doc_id").orderBy("at")
    ends = F.lag(F.col("at") + F.col("n_words")).over(order)
    breaks = found.withColumn("breaks", (ends.isNull() | (ends != F.col("at"))).cast("int"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    runs = breaks.withColumn("run", F.sum("breaks").over(upto)).groupBy("doc_id", "run").agg(
        F.min("at").alias("from_word"), F.sum("n_words").alias("n_words"), F.min("from_byte").alias("from_byte"),
        F.max("to_byte").alias("to_byte"), F.max("n_copies").alias("n_copies"), F.min("first_id").alias("first_id"),
    )
    return runs.filter(F.col("n_words") >= least_words).select(
        F.col("doc_id").alias(id_column), "from_word", "n_words", "from_byte", "to_byte", "n_copies", "first_id",
        (F.col("first_id") == F.col("doc_id")).alias("is_first"),
    )


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the repeated passages cut out of every document but the first that has them; all rows stay."""
    found = repeats(docs, id_column=id_column, text=text).filter("NOT is_first")
    spans = found.groupBy(F.col(id_column).alias("_of")).agg(F.sort_array(F.collect_list(F.struct("from_byte", "to_byte"))).alias("_spans"))
    joined = docs.join(stored(spans, new_folder(docs.sparkSession, "spans")), docs[id_column] == F.col("_of"), "left").drop("_of")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = []
            for value, spans in zip(frame[text], frame["_spans"], strict=True):
                if spans is not None and value is not None:
                    raw, at, kept = value.encode(), 0, []
                    for span in spans:
                        kept.append(raw[at : span["from_byte"]])
                        at = span["to_byte"]
                    value = b"".join([*kept, raw[at:]]).decode()
                texts.append(value)
            yield frame.drop(columns="_spans").assign(**{text: texts})

    return joined.mapInPandas(cut, docs.schema)
