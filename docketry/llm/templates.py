"""Benchmark items in documents, also with other numbers, names and units.

Texts become templates: numbers, names and units are replaced by placeholders of their type, other words stay,
lower-cased and without marks around them. Windows of WINDOW template words are joined by their hashes, and matches are
taken together by alignment, which is the place in the document less the place in the item. What a document has at the
places of placeholders must then agree with the item: one value of the item stands for one value of the document
throughout, and the other way round. So a question with new numbers is found, and a chance match of a form is not.

The words as they are, in small letters and without placeholders, are joined by their hashes as well, so that a verbatim
copy is found whatever its words are and wherever its capitals and line breaks lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.bitmap import BITS, bit_map, is_set, low_bits
from docketry.llm.text import Words, mixed, odd_numbers, runs_of_words, text_slices, with_text, words_of
from docketry.sources.workspace import new_folder, stored

WINDOW = 8
# Words of a window that must be no placeholders.
LEAST_PLAIN = 5
# Share of an item's windows that a document must have.
COVERAGE = 0.5

# Words that measure; a word of digits and letters (5km) counts as a number.
UNITS = (
    "%", "percent", "km", "m", "cm", "mm", "mile", "miles", "foot", "feet", "inch", "inches", "meter", "meters",
    "kilometer", "kilometers", "kg", "g", "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "ounce", "ounces",
    "liter", "liters", "litre", "litres", "ml", "gallon", "gallons", "second", "seconds", "minute", "minutes", "hour",
    "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "cent", "cents",
    "euro", "euros", "degree", "degrees",
)

PLAIN, NUMBER, NAME, UNIT = 0, 1, 2, 3
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?\"'()[]{}")] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?:")] = True
_FACTORS = odd_numbers(WINDOW, 23)
_PLACEHOLDERS = odd_numbers(4, 29)
_VERBATIM = odd_numbers(WINDOW, 31)


def _word_hash(texts: list[str]) -> np.ndarray:
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    return Words(data, offsets[:-1], offsets[1:], offsets[:-1], offsets, offsets).hashes()


_UNIT_HASHES = np.sort(_word_hash(list(UNITS)))


_S = ord("s")


def _folded(text: np.ndarray) -> np.ndarray:
    """UTF-8 text with the capitals of Latin-1 lowered and sharp s as ss, byte for byte."""
    out = np.where((text >= 65) & (text <= 90), text | 32, text).astype(np.uint8)
    lead = np.flatnonzero(text[:-1] == 195) if len(text) else np.zeros(0, int)
    tail = text[lead + 1]
    upper = (tail >= 128) & (tail <= 158) & (tail != 151)
    out[lead[upper] + 1] += 32
    sharp = lead[tail == 159]
    out[sharp], out[sharp + 1] = _S, _S
    return out


Typed = tuple[Words, np.ndarray, np.ndarray]


def template(data: np.ndarray, offsets: np.ndarray) -> tuple[Typed, Typed]:
    """The template words of documents that lie one after the other: places, kinds and hashes; and these of all words.

    A number begins with a digit, or with a sign and a digit. A name has one capital, at its beginning, though the word before it ends no
    sentence and no line break lies between; names that follow each other are one. Words of nothing but marks are left out.
    """
    cased = words_of(data, offsets, lower=False)
    starts, ends = cased.starts.copy(), cased.ends.copy()
    text = cased.data
    last = text[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    for _ in range(3):
        starts += (starts < ends) & _MARKS[text[np.minimum(starts, len(text) - 1)]] if len(text) else 0
        ends -= (starts < ends) & _MARKS[text[ends - 1]] if len(text) else 0
    lines = np.concatenate([[0], np.cumsum(text == 10)])
    opens = np.ones(len(starts), bool)
    if len(starts) > 1:
        same = cased.doc[1:] == cased.doc[:-1]
        opens[1:] = ~same | _STOPS[last[:-1]] | (lines[cased.starts[1:]] > lines[cased.ends[:-1]])
    kept = np.flatnonzero(starts < ends)
    starts, ends, opens, doc = starts[kept], ends[kept], opens[kept], cased.doc[kept]
    lowered = _folded(text)
    words = Words(lowered, starts, ends, doc, np.searchsorted(doc, np.arange(len(offsets))), cased.offsets)
    hashes = words.hashes()
    kinds = np.zeros(len(starts), np.int8)
    if len(starts):
        head = text[starts]
        second = text[np.minimum(starts + 1, len(text) - 1)]
        digit = (head >= 48) & (head <= 57)
        signed = np.isin(head, list(b"+-$")) & (second >= 48) & (second <= 57) & (ends - starts > 1)
        # A capital at the beginning and nowhere else: a text in capitals is not all names.
        capitals = np.concatenate([[0], np.cumsum((lowered != text) & (lowered != _S))])
        begins = (head >= 65) & (head <= 90) | (head == 195) & (second >= 128) & (second <= 158) & (second != 151)
        kinds[begins & (capitals[ends] - capitals[starts] == 1) & (ends - starts > 1) & ~opens] = NAME
        kinds[np.isin(hashes, _UNIT_HASHES)] = UNIT
        kinds[digit | signed] = NUMBER
    single = words, kinds, hashes
    if len(starts):
        # A run of names is one name.
        again = np.zeros(len(kinds), bool)
        again[1:] = (kinds[1:] == NAME) & (kinds[:-1] == NAME) & (doc[1:] == doc[:-1])
        if again.any():
            first = np.flatnonzero(~again)
            ends = np.maximum.reduceat(ends, first)
            total = np.add.reduceat(hashes, first)
            words = Words(lowered, starts[first], ends, doc[first], np.searchsorted(doc[first], np.arange(len(offsets))), cased.offsets)
            hashes, kinds = np.where(kinds[first] == NAME, mixed(total), hashes[first]), kinds[first]
    return (words, kinds, hashes), single


def windows(made: Typed):
    """Documents, places and hashes of the windows with enough plain words, and a function for a window's slots."""
    words, kinds, hashes = made
    shape = np.where(kinds == PLAIN, hashes, _PLACEHOLDERS[kinds])
    runs, place = runs_of_words(words, shape, WINDOW, _FACTORS)
    plain = np.concatenate([[0], np.cumsum(kinds == PLAIN)])
    good = plain[place + WINDOW] - plain[place] >= LEAST_PLAIN
    runs, place = runs[good], place[good]

    def slots(at: int) -> list[str | None]:
        """The values at placeholders, with their kind; null at plain words."""
        found = []
        for k in range(at, at + WINDOW):
            raw = words.data[words.starts[k] : words.ends[k]].tobytes().decode(errors="replace")
            found.append(f"{kinds[k]}{raw}" if kinds[k] else None)
        return found

    return words.doc[place], place - words.first[words.doc[place]], runs, place, slots


def verbatim(single: Typed, lengths: list[int] | None):
    """Documents, places and hashes of the runs of WINDOW words, and how many words these are.

    Texts with fewer words are one run. With `lengths` instead all runs of these numbers of words.
    """
    words, _, hashes = single
    size = np.diff(words.first)[words.doc]
    found = []
    for n in range(1, WINDOW + 1) if lengths is None else lengths:
        runs, place = runs_of_words(words, hashes, n, _VERBATIM)
        if lengths is None and n < WINDOW:
            whole = size[place] == n
            runs, place = runs[whole], place[whole]
        doc = words.doc[place]
        found.append((doc, place - words.first[doc], runs, np.full(len(doc), n)))
    return [np.concatenate(x) for x in zip(*found, strict=True)]


WINDOW_DDL = "id long, at long, window long, slots array<string>, length long"


def template_windows(texts: DataFrame, flags=None, lengths: list[int] | None = None) -> DataFrame:
    """(id, at, window, slots, length) of the windows of (id, text); with a map of bits only of those it has.

    Verbatim windows have no slots, but the number of their words, which is 0 for the others.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def wanted(runs: np.ndarray) -> np.ndarray:
            if flags is None:
                return np.arange(len(runs))
            return np.flatnonzero(is_set(flags.value, (runs & np.uint64(BITS - 1)).astype(np.int64)))

        for batch in batches:
            for row, _, data, offsets in text_slices(batch.column("text")):
                made, single = template(data, offsets)
                doc, at, runs, place, slots = windows(made)
                some = wanted(runs)
                doc, at, runs, place = doc[some], at[some], runs[some], place[some]
                yield rows(batch, doc + row, at, runs, [slots(p) for p in place.tolist()], np.zeros(len(doc), int))
                found = verbatim(single, lengths)
                some = wanted(found[2])
                doc, at, runs, length = (x[some] for x in found)
                yield rows(batch, doc + row, at, runs, [[]] * len(some), length)

    def rows(batch, doc, at, runs, slots, length) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(pa.array(doc, pa.int64())), pa.array(at, pa.int64()), pa.array(runs.view(np.int64)),
                pa.array(slots, pa.list_(pa.string())), pa.array(length, pa.int64()),
            ],
            ["id", "at", "window", "slots", "length"],
        )

    return texts.mapInArrow(cut, WINDOW_DDL)


def contaminated(
    docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, id_column: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(id, item_id, n_windows, item_windows, n_slots, n_changed) of each document and item of which it has enough.

    `n_windows` of the item's `item_windows` different windows are in the document, at least the share `coverage`; of the
    `n_slots` different values at placeholders `n_changed` differ between the two. Both hold for one place in the document,
    so what matches elsewhere in it does not count against a copy; a pair whose values agree nowhere is no match.
    Where no such match is, a verbatim copy of the whole item counts, in small or capital letters and without slots: windows
    are then its runs of WINDOW words, or the only run of a shorter one. Null and empty texts match nothing. Rows with a null id are left out. Rows of one id count as one
    document. Equal rows change nothing; no rows give no rows; other columns do not matter.
    """
    spark = docs.sparkSession
    known = with_text(items.filter(F.col(item_id).isNotNull()), F.col(item_id).cast("long").alias("id"), text=item_text)
    of_items = stored(template_windows(known), new_folder(spark, "item-windows"))
    # A verbatim window counts at each place of the item, so that a whole item is all of its places.
    exact = (F.col("length") > 0).alias("exact")
    counted = F.when(exact, F.col("at")).otherwise(F.col("window"))
    sizes = of_items.groupBy(F.col("id").alias("item"), exact).agg(
        F.countDistinct(counted).alias("item_windows"), (F.max("at") + WINDOW).alias("words")
    )
    flags = spark.sparkContext.broadcast(bit_map(of_items, low_bits(F.col("window"))))
    # At most WINDOW lengths.
    lengths = sorted(x.length for x in of_items.filter("length > 0").select("length").distinct().collect())
    rows = with_text(docs.filter(F.col(id_column).isNotNull()), F.col(id_column).cast("long").alias("id"), text=text)
    of_docs = template_windows(rows, flags, lengths or [WINDOW]).select("id", "at", "window", "length", "slots")
    right = of_items.select(
        F.col("id").alias("item"), "window", "length", F.col("at").alias("item_at"), F.col("slots").alias("item_slots")
    )
    pair = F.transform(
        F.arrays_zip("slots", "item_slots"), lambda z: F.struct(z["slots"].alias("doc"), z["item_slots"].alias("item"))
    )
    both = of_docs.join(right, ["window", "length"]).withColumn("exact", exact)
    met = both.join(sizes, ["item", "exact"]).select(
        "id", "item", "exact", "item_windows", F.when(F.col("exact"), F.col("item_at")).otherwise(F.col("window")).alias("window"),
        F.filter(pair, lambda z: z["item"].isNotNull()).alias("pairs"),
        F.explode(_groups(F.col("at") - F.col("item_at"), F.col("words"), F.col("exact"))).alias("group"),
    )
    met = stored(met, new_folder(spark, "met-windows"))
    # Windows are counted first: values are gathered only where there are enough of them.
    keys = ["id", "item", "exact", "group"]
    counts = met.groupBy(*keys, "item_windows").agg(F.countDistinct("window").alias("n_windows"))
    share = F.when(F.col("exact"), 1.0).otherwise(F.lit(coverage))
    counts = counts.filter(F.col("n_windows") >= share * F.col("item_windows"))
    gathered = met.join(counts.select(*keys), keys, "left_semi").groupBy(*keys).agg(
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )
    values = gathered.join(counts, keys).withColumns({
        "n_slots": F.size("pairs").cast("long"),
        "n_changed": F.size(F.filter("pairs", lambda z: z["doc"] != z["item"])).cast("long"),
        "n_doc": F.size(F.array_distinct(F.transform("pairs", lambda z: z["doc"]))),
        "n_item": F.size(F.array_distinct(F.transform("pairs", lambda z: z["item"]))),
    })
    agrees = (F.col("n_doc") == F.col("n_slots")) & (F.col("n_item") == F.col("n_slots"))
    # Of the groups that agree, one of templates, then the one with the most windows, then with the fewest changes.
    best = F.max(F.struct((~F.col("exact")).alias("typed"), "n_windows", (-F.col("n_changed")).alias("less"), "n_slots", "item_windows"))
    found = values.filter(agrees).groupBy("id", "item").agg(best.alias("best"))
    return found.select(
        F.col("id").alias(id_column), F.col("item").alias(item_id), "best.n_windows", "best.item_windows", "best.n_slots",
        (-F.col("best.less")).alias("n_changed"),
    )


def _groups(shift: Column, words: Column, exact: Column) -> Column:
    """The groups of matches that a match of this alignment belongs to, each of which is judged by itself.

    Those of the same alignment; those whose alignments are less than the item's number of words apart, as a copy has
    into which words were put, on two grids so that none is cut by an edge of both; and all. A verbatim match has only
    the first.
    """
    def group(grid: int, place: Column) -> Column:
        return F.struct(F.lit(grid).alias("grid"), place.cast("long").alias("place"))

    return F.when(exact, F.array(group(0, shift))).otherwise(F.array(
        group(0, shift), group(1, F.floor(shift / words)), group(2, F.floor((shift + F.floor(words / 2)) / words)),
        group(3, F.lit(0)),
    ))


def without_contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with all columns as they were; rows with a null id stay."""
    found = contaminated(docs, items, id_column=id_column, text=text).select(F.col(id_column).alias("_found")).distinct()
    found = stored(found, new_folder(docs.sparkSession, "contaminated"))
    return docs.join(found, docs[id_column] == found["_found"], "left_anti")
