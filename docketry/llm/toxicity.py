"""Toxicity scores of whole texts by a linear classifier that is held to equal scores for swapped groups.

The classifier sees which words, and which beginnings of words, a text has, and how thick they lie in it. Where a labelled text names a group of people, a copy with that name
swapped for another of its kind, or for a neutral word, is set beside it, and the fit penalises the squared change
of the margin: a text is not toxic because of whom it mentions.

Words become features only if they tell the labels apart clearly, so a long clean text does not gather a high
score from many weak signs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.text import in_small_batches, with_text
from docketry.sources.workspace import new_folder, stored

# Words are letters only, so marks inside or behind them do not hide them; lower-cased.
WORD = re.compile(r"[^\W\d_]+")

# Beginnings of words are features too, so that compounds and endings do not hide a stem.
BEGINNINGS = range(3, 8)
KEPT_WORDS = 100_000

# Names that may be swapped for each other; the last of each line is neutral. A caller may give other ones.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("man", "woman", "boy", "girl", "person"),
    ("men", "women", "boys", "girls", "people"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "religious"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "believers"),
    ("black", "white", "asian", "latino", "arab", "african", "local"),
    ("gay", "lesbian", "bisexual", "transgender", "straight", "adult"),
    ("immigrants", "refugees", "foreigners", "natives", "residents"),
)


@dataclass(frozen=True)
class Settings:
    """The documented limits and weights of the fit."""

    # At most so many labelled rows fit the classifier, those with the smallest digests of their ids.
    fit_rows: int = 20_000
    # At most so many words and beginnings get a weight: those that say most of the label (the G statistic), which
    # must reach this value and rest on this many different texts.
    features: int = 4_096
    least_g: float = 30.0
    least_texts: int = 5
    steps: int = 400
    rate: float = 0.1
    ridge: float = 1e-4
    counterfactual: float = 1.0


def named(groups: tuple[tuple[str, ...], ...]) -> frozenset[str]:
    return frozenset(w for g in groups for w in g)


def features_of(word: str, whole: frozenset[str]) -> list[str]:
    """The word, and its beginnings marked as such; a swappable name in `whole` is one feature, so a swap changes it all."""
    if word in whole:
        return [word]
    return [word, *["^" + word[:k] for k in BEGINNINGS if k <= len(word)]]


def density(count, n_words):
    """How thick a feature lies in a text: a word in ten counts fully, one in a long text hardly."""
    return np.log1p(100.0 * count / (n_words + 20.0))


@dataclass
class Model:
    """For each feature the weight of being there and the weight of its density."""

    weights: dict[str, tuple[float, float]]
    bias: float
    whole: frozenset[str] = named(IDENTITY_TERMS)

    def __post_init__(self) -> None:
        self.known: dict[str, tuple[str, ...]] = {}

    def __getstate__(self) -> tuple[dict[str, tuple[float, float]], float, frozenset[str]]:
        return self.weights, self.bias, self.whole

    def __setstate__(self, state: tuple[dict[str, tuple[float, float]], float, frozenset[str]]) -> None:
        self.weights, self.bias, self.whole = state
        self.known = {}

    def weighted(self, word: str) -> tuple[str, ...]:
        if word not in self.known:
            if len(self.known) >= KEPT_WORDS:
                self.known = {}
            self.known[word] = tuple(f for f in features_of(word, self.whole) if f in self.weights)
        return self.known[word]

    def score(self, text: str) -> float:
        words = Counter(WORD.findall(text.lower()))
        counts: dict[str, int] = {}
        for word, n in words.items():
            for f in self.weighted(word):
                counts[f] = counts.get(f, 0) + n
        margin = self.bias
        if counts:
            total = words.total()
            # In a fixed order, so that equal words give equal sums.
            for f, n in sorted(counts.items()):
                there, thick = self.weights[f]
                margin += there + thick * float(density(n, total))
        return float(1 / (1 + np.exp(-min(max(margin, -60), 60))))


def held_out(id_column: str) -> Column:
    """The rows that no fit may learn from: a third, by a checksum of the id as text."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features_of_rows(rows: DataFrame, whole: frozenset[str]) -> DataFrame:
    """(features, counts, n_words, toxic): the different features of each row of (text, toxic) with their counts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, counts, totals = [], [], []
            for text in batch.column("text").to_pylist():
                words = Counter(WORD.findall(text.lower()))
                found: Counter[str] = Counter()
                for word, n in words.items():
                    for f in features_of(word, whole):
                        found[f] += n
                names.append(sorted(found))
                counts.append([found[f] for f in names[-1]])
                totals.append(words.total())
            columns = [pa.array(names, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32())), pa.array(totals, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("toxic")], ["features", "counts", "n_words", "toxic"])

    ddl = "features array<string>, counts array<int>, n_words long, toxic int"
    return rows.select("text", "toxic").mapInArrow(cut, ddl)


def chosen_of_rows(rows: DataFrame, place: dict[str, int]) -> DataFrame:
    """(toxic, n_words, at, counts): the rows of `features_of_rows` with the places of the chosen features only."""
    shared = rows.sparkSession.sparkContext.broadcast(place)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, counts = [], []
            for names, numbers in zip(batch.column("features").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                found = [(shared.value[f], n) for f, n in zip(names, numbers, strict=True) if f in shared.value]
                at.append([k for k, _ in found])
                counts.append([n for _, n in found])
            columns = [batch.column("toxic"), batch.column("n_words"), *[pa.array(x, pa.list_(pa.int32())) for x in (at, counts)]]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "n_words", "at", "counts"])

    return rows.mapInArrow(pick, "toxic int, n_words long, at array<int>, counts array<int>")


def clear_features(rows: DataFrame, n: int, n_toxic: int, settings: Settings, always: list[str]) -> list[str]:
    """The features that say most of the label, and of `always` those that occur."""
    counts = rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("both")
    )

    def part(seen: Column, row: Column, column: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen * n / (row * column))).otherwise(0.0)

    a, both = F.col("a"), F.col("both")
    b = both - a
    g = 2 * (
        part(a, both, n_toxic) + part(b, both, n - n_toxic)
        + part(n_toxic - a, n - both, n_toxic) + part(n - n_toxic - b, n - both, n - n_toxic)
    )
    found = counts.withColumn("g", g)
    wanted = (both >= settings.least_texts) & (F.col("g") >= settings.least_g)
    best = found.filter(wanted).orderBy(F.desc("g"), "feature").limit(settings.features)
    present = found.filter(F.col("feature").isin(always))
    return sorted({r.feature for r in best.select("feature").union(present.select("feature")).collect()})


def swaps(rows: list[np.ndarray], place: dict[str, int], groups: tuple[tuple[str, ...], ...]) -> list[tuple[int, int, float]]:
    """(word, word put in its place, rows): the features that change in the swapped copies of the fitting rows.

    A word that is no feature has no weight; its place is the one behind the last feature.
    """
    counts: dict[tuple[int, int], float] = {}
    group_of = {w: g for g in groups for w in g}
    names = {place[w]: w for w in group_of if w in place}
    none = len(place)
    for row in rows:
        present = set(row.tolist())
        for f in present & names.keys():
            for other in group_of[names[f]]:
                to = place.get(other, none)
                if to != f and to not in present:
                    counts[f, to] = counts.get((f, to), 0) + 1
    return [(f, to, n) for (f, to), n in sorted(counts.items())]


def fit_weights(
    rows: list[np.ndarray], thick: list[np.ndarray], labels: np.ndarray, size: int,
    changed: list[tuple[int, int, float]], settings: Settings,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on presence and density, with a ridge and the penalty on changes; full batches, no chance.

    A swapped copy has the other word as often, so both weights of the two words enter its penalty.
    """
    n = len(rows)
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    feature = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    value = np.concatenate([*thick, np.zeros(0)])
    toxic = max(1.0, labels.sum())
    # Presence, density, and a last place for words without a weight.
    weight, bias = np.zeros((2, size + 1)), float(np.log(toxic / max(1.0, n - toxic)))
    a, b, m = (np.array(x) for x in zip(*changed, strict=True)) if changed else (np.zeros(0, int),) * 3
    first, second = np.zeros(2 * size + 3), np.zeros(2 * size + 3)
    for step in range(1, settings.steps + 1):
        margin = bias + np.bincount(at, weight[0][feature] + weight[1][feature] * value, n)
        error = (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - labels) / n
        grad = settings.ridge * weight
        grad[0] += np.bincount(feature, error[at], size + 1)
        grad[1] += np.bincount(feature, error[at] * value, size + 1)
        for k in (0, 1):
            push = 2 * settings.counterfactual * m * (weight[k][a] - weight[k][b]) / n
            grad[k] += np.bincount(a, push, size + 1) - np.bincount(b, push, size + 1)
        grad[:, size] = 0
        whole = np.append(grad, error.sum())
        first = 0.9 * first + 0.1 * whole
        second = 0.999 * second + 0.001 * whole**2
        move = settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weight, bias = weight - move[:-1].reshape(2, -1), bias - float(move[-1])
    return weight[0, :size], weight[1, :size], bias


def fit(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), groups=IDENTITY_TERMS,
    id_column: str = "doc_id", text: str = "text", label: str = "toxic",
) -> Model:
    """Fit on labelled rows outside the held-out third. Rows without a 0/1 label or without a document do not count.

    Without rows of both labels the model is the share of toxic rows alone, drawn towards one half.
    """
    spark = docs.sparkSession
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
    chosen = stored(
        usable.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(settings.fit_rows),
        new_folder(spark, "toxic-labels"),
    )
    # The broadcast holds fit_rows rows at most.
    rows = with_text(docs, F.col(id_column).alias("id"), text=text).join(F.broadcast(chosen), "id")
    # Copies count once, or a group of copies would make its own words look telling.
    rows = stored(features_of_rows(rows, named(groups)).dropDuplicates(["features", "toxic"]), new_folder(spark, "toxic-features"))
    n, n_toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).head()
    if not 0 < n_toxic < n:
        share = (n_toxic + 1) / (n + 2)
        return Model({}, float(np.log(share / (1 - share))), named(groups))
    names = clear_features(rows, n, n_toxic, settings, [w for g in groups for w in g])
    place = {w: k for k, w in enumerate(names)}
    # At most fit_rows rows, each with at most the chosen features.
    kept = chosen_of_rows(rows, place).collect()
    kept.sort(key=lambda r: (r.toxic, r.n_words, r.at, r.counts))
    present = [np.array(r.at, np.int64) for r in kept]
    thick = [density(np.array(r.counts, float), r.n_words) for r in kept]
    labels_of = np.array([r.toxic for r in kept], float)
    there, dense, bias = fit_weights(present, thick, labels_of, len(names), swaps(present, place, groups), settings)
    return Model(dict(zip(names, zip(there.tolist(), dense.tolist(), strict=True), strict=True)), bias, named(groups))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score) of each row; only the text makes the score.

    A null or empty text gets the score of the bias; null ids and equal rows stay; no rows give no rows. Texts are
    read to their end. Other columns, also such as have the names of the new ones, do not matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], [id_column, "score"])

    rows = with_text(docs, id_column, text=text)
    kind = rows.schema[id_column].dataType.simpleString()
    scores = rows.mapInArrow(scored, f"`{id_column}` {kind}, score double")
    return scores.select(id_column, held_out(id_column).alias("held_out"), "score")


def without_toxic(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The rows whose score is below the threshold, with all their columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            yield batch.filter(pa.array([shared.value.score(t or "") < threshold for t in texts], pa.bool_()))

    return in_small_batches(docs).mapInArrow(kept, docs.schema)
