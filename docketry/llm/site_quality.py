"""Quality of documents from their text and from where they come, by hierarchical empirical Bayes.

A classifier over plain measures of a text gives evidence for each document. Documents of one host, and of one path of a
host, tend to be alike, so their evidence is gathered there: the mean of a host is drawn towards the global mean, the
mean of a path towards that of its host, each the more the fewer documents it has. How strongly comes from the
data: the more the groups of a level differ from each other, beyond chance, the less they are drawn.
A document's own evidence is left out of the means it is combined with.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.text import text_slices, with_text, words_of
from docketry.sources.workspace import new_folder, stored

# At most so many labelled rows fit the classifier, those with the smallest digests of their ids.
FIT_ROWS = 20_000
RIDGE = 1e-3
ROUNDS = 25

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".,;:!?'\"-()")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
MEASURES = 16


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of MEASURES numbers for each document of a slice; an empty one has zeros."""
    words = words_of(data, offsets)
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    raw = words_of(data, offsets, lower=False).data

    def share(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])[words.offsets]
        return np.diff(total) / np.maximum(1, size)

    letters, digits, stops, space = share(_LETTERS[raw]), share(_DIGITS[raw]), share(_STOPS[raw]), share(_SPACE[raw])
    capitals, breaks = share((raw >= 65) & (raw <= 90)), share(raw == 10)
    count = np.diff(words.first).astype(float)
    some = np.maximum(1, count)
    hashes = words.hashes()

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(words.doc, values, n) / some

    length = (words.ends - words.starts).astype(float)
    last = raw[words.ends - 1] if len(words.ends) else raw[:0]
    first = raw[words.starts] if len(words.starts) else raw[:0]
    odd_end = ~(_LETTERS[last] | _DIGITS[last] | _STOPS[last])
    odd_word = ~(_LETTERS[first] | _DIGITS[first])
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    order = np.lexsort((hashes, words.doc))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (words.doc[order][1:] != words.doc[order][:-1])
    place = np.flatnonzero(new)
    times = np.diff(np.append(place, len(order))).astype(float)
    different = np.bincount(words.doc[order][new], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, words.doc[order][new], times)
    # A text of twice the length has not twice as many different words; log terms take that up.
    found = [
        letters, digits, stops, space, 1 - letters - digits - stops - space, capitals, breaks * 10,
        np.log1p(count), different / some, np.log1p(different), most / some, mean(length), np.sqrt(mean(length**2)),
        mean(odd_end.astype(float)), mean(odd_word.astype(float)), mean(again),
    ]
    return np.where(size[:, None] > 0, np.stack(found, axis=1), 0.0)


@dataclass
class Model:
    """Weights over standardised measures and their squares."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    share: float

    def terms(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.spread, -8, 8)
        return np.concatenate([np.ones((len(z), 1)), z, z**2], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.terms(x) @ self.weights, -12, 12)


def held_out(id_column: str) -> Column:
    """The third of the rows that the classifier does not learn from, by a checksum of the id as text."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _measured(rows: DataFrame, model) -> DataFrame:
    """The columns of `rows` but its text, with the measures, or with the margin under a broadcast model."""
    kept = [c for c in rows.columns if c != "text"]
    name, kind = ("measures", "array<double>") if model is None else ("margin", "double")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in text_slices(batch.column("text")):
                x = measures(data, offsets)
                value = pa.array(list(x)) if model is None else pa.array(model.value.margin(x))
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(row, stop - row) for c in kept], value], [*kept, name])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(measure, f"{ddl}, {name} {kind}")


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Logistic regression on labelled rows outside the held-out third, by Newton's steps on the driver.

    Rows without a 0/1 label or without a document do not count; without both labels only the share is learnt.
    """
    spark = docs.sparkSession
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
    chosen = stored(
        usable.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("good"))
        .orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS),
        new_folder(spark, "quality-labels"),
    )
    # FIT_ROWS rows at most, here and in the result.
    rows = with_text(docs, F.col(id_column).alias("id"), text=text).join(F.broadcast(chosen), "id")
    table = _measured(rows.select("good", "text"), None).toArrow()
    y = table.column("good").to_numpy().astype(float)
    x = np.array(table.column("measures").to_pylist(), float).reshape(-1, MEASURES)
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order]
    share = float((y.sum() + 1) / (len(y) + 2))
    spread = x.std(axis=0) if len(x) else np.ones(MEASURES)
    model = Model(x.mean(axis=0) if len(x) else np.zeros(MEASURES), np.where(spread > 1e-9, spread, 1.0), np.zeros(2 * MEASURES + 1), share)
    model.weights[0] = np.log(share / (1 - share))
    if 0 < y.sum() < len(y):
        terms = model.terms(x)
        ridge = RIDGE * len(y) * np.eye(terms.shape[1])
        ridge[0, 0] = 0
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-np.clip(terms @ model.weights, -30, 30)))
            slope = terms.T @ (y - p) - ridge @ model.weights
            bend = (terms * (p * (1 - p) + 1e-6)[:, None]).T @ terms + ridge
            move = np.linalg.solve(bend, slope)
            model.weights = model.weights + move * min(1.0, 5.0 / (np.abs(move).max() + 1e-12))
    return model


def _pull(sums: DataFrame, mean: Column, total: float) -> float:
    """How many documents' worth the mean above weighs in a group of this level.

    From the spread of the groups' means about `mean` beyond that of chance; groups have n documents summing to s.
    """
    p = F.col("s") / F.col("n")
    chance = F.greatest(mean * (1 - mean), F.lit(1e-6))
    q, groups, squares = sums.agg(
        F.sum(F.col("n") * (p - mean) ** 2 / chance), F.count(F.lit(1)), F.sum(F.col("n") * F.col("n"))
    ).head()
    if groups < 2 or total <= groups:
        return 10.0
    alike = (q - groups) / max(1e-9, total - squares / total)
    alike = min(0.999, max(1e-4, alike))
    return (1 - alike) / alike


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def posterior(evidence: DataFrame, share: float) -> DataFrame:
    """`evidence` (host, path, margin and others) with host_mean, path_mean and score.

    A null host or path is a group of its own. The means leave the row itself out.
    """
    spark = evidence.sparkSession
    rows = evidence.withColumn("p", 1 / (1 + F.exp(-F.col("margin"))))
    by_path = rows.groupBy("host", "path").agg(F.sum("p").alias("s"), F.count(F.lit(1)).cast("double").alias("n"))
    by_path = stored(by_path, new_folder(spark, "paths"))
    by_host = stored(by_path.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n")), new_folder(spark, "hosts"))
    s, n = by_host.agg(F.coalesce(F.sum("s"), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0.0))).head()
    mean = (s + share) / (n + 1.0)
    pull_host = _pull(by_host, F.lit(mean), n) if n else 10.0
    hosts = by_host.select(
        F.col("host").alias("_host"), F.col("s").alias("host_s"), F.col("n").alias("host_n"),
        ((F.col("s") + pull_host * mean) / (F.col("n") + pull_host)).alias("host_mean"),
    )
    paths = by_path.join(hosts, by_path["host"].eqNullSafe(hosts["_host"]))
    pull_path = _pull(paths, F.col("host_mean"), n) if n else 10.0
    paths = paths.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("s").alias("path_s"), F.col("n").alias("path_n"), "host_s", "host_n"
    )
    joined = rows.join(stored(paths, new_folder(spark, "paths")), F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    host_mean = (F.col("host_s") - F.col("p") + pull_host * mean) / (F.col("host_n") - 1 + pull_host)
    path_mean = (F.col("path_s") - F.col("p") + pull_path * F.col("host_mean")) / (F.col("path_n") - 1 + pull_path)
    found = joined.withColumn("host_mean", host_mean).withColumn("path_mean", path_mean)
    kept = F.least(F.greatest("path_mean", F.lit(1e-6)), F.lit(1 - 1e-6))
    # The classifier's own share of good rows gives way to that of the place.
    logit = F.col("margin") - float(np.log(share / (1 - share))) + _logit(kept)
    return found.withColumn("score", 1 / (1 + F.exp(-logit))).select(*evidence.columns, "host_mean", "path_mean", "score")


def score(
    docs: DataFrame, model: Model, host: str = "source", path: str = "lang", id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, held_out, evidence, host_mean, path_mean, score) of each row; score is the probability of good quality.

    `evidence` is the classifier's log odds from the text. All rows take part in the means of their host and path. Null, empty
    and very long texts are scored like others, by measures of the whole text; a null host or path is one group; null
    ids and equal rows stay; no rows give no rows; other columns do not matter.
    """
    spark = docs.sparkSession
    rows = with_text(
        docs, F.col(id_column).alias("id"), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), text=text
    )
    margins = stored(_measured(rows, spark.sparkContext.broadcast(model)), new_folder(spark, "margins"))
    found = posterior(margins, model.share)
    return found.select(
        F.col("id").alias(id_column), held_out("id").alias("held_out"), F.col("margin").alias("evidence"), "host_mean", "path_mean", "score"
    )


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and first path segment of a web address, for tables that have one; null where it has none."""
    return F.try_parse_url(url, F.lit("HOST")), F.nullif(F.split_part(F.try_parse_url(url, F.lit("PATH")), F.lit("/"), F.lit(2)), F.lit(""))
