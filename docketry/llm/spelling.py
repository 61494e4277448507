"""Spelling variants: words that differ by one code point, found by walking a trie level by level.

The trie is a relation. A level has the states of all words, (word, position, node, edits), and the edges of its
nodes, (node, first character, label, child); one join moves all states to the next level. Edges with only one way on
are one edge with a longer label, so the number of levels is that of the branchings on a path, whatever
the words' lengths. States without an edit are the words on their own paths, and the edges of a level are made
from them: a label is what the smallest and the largest rest behind a node have in common.

Words walk as they are and backwards. Two near words agree in at least half of the shorter one's
other characters on one of both sides, so an edit is only tried behind the first half of a word: where nodes have few edges
left. An edit is a character of the word left out, or another one in its place that is larger (in the other case the
other word finds the pair); pairs are made symmetric at the end.
"""

from __future__ import annotations

import os
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docketry.sources.workspace import drop_folder, new_folder, ship_package, stored

# What a run of letters is, the share of runs that lose a character, and which words count.
RUN = "[A-Za-zÀ-ÿ]{7,}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHANGED_ONE_IN = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_TIMES = 10


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the runs of letters of whole texts, some with one character deleted, and how often they occur.

    A-Z are lower-cased; where 31 divides the CRC-32 of `<doc_id>:<run>`, the character at that CRC modulo the length is
    deleted. Words have at least 7 code points and 2 occurrences. A null text has none; a null id is written as nothing; equal
    rows count each; other columns do not matter. Runs are counted within tasks before they are moved.
    """
    runs = docs.select(F.col("doc_id"), F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    # Of plain letters alone this is what translate gives, which looks up each character.
    plain = F.octet_length("run") == F.length("run")
    lowered = runs.select(
        F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")
    )
    hashed = lowered.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"), F.length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.col("size")))
    word = F.when(F.col("h") % CHANGED_ONE_IN == 0, shorter).otherwise(F.col("run"))
    counts = hashed.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


@F.pandas_udf(StringType())
def common_start(a: pd.Series, b: pd.Series) -> pd.Series:
    """The characters that both strings begin with."""
    return pd.Series([os.path.commonprefix(pair) for pair in zip(a, b, strict=True)])


def _ahead(size: int | Column) -> Column:
    """The next characters of a word behind the position of its state."""
    return F.substring(F.col("word"), F.col("position") + 1, F.lit(size) if isinstance(size, int) else size)


def _edges(states: DataFrame) -> DataFrame:
    """The edges of a level from the states without an edit: one for each node and first character behind it.

    `ends` says whether a word ends at the child, and `end` which; `leaf` that nothing comes behind it. Minimum and maximum are
    taken within tasks first, so a node that most words go through is no burden.
    """
    paths = states.filter("edits = 0").select(
        "node", _ahead(1).alias("first"), _ahead(F.length("word")).alias("rest"), F.struct("word", "n").alias("end")
    )
    groups = paths.groupBy("node", "first").agg(
        F.min("rest").alias("low"), F.max("rest").alias("high"), F.min_by("end", "rest").alias("end")
    )
    low, high, label = F.col("low"), F.col("high"), F.col("label")
    # A word that is the beginning of others is the smallest of them.
    labelled = groups.withColumn("label", F.when(low == high, low).otherwise(common_start("low", "high")))
    return labelled.select(
        "node", "first", "label", F.xxhash64("node", "label").alias("child"), (low == label).alias("ends"), "end", (low == high).alias("leaf")
    )


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """All states of the next level; `other` is set where a state with an edit has come to the end of a word."""
    size, word, position, edits = F.length("label"), F.col("word"), F.col("position"), F.col("edits")
    ahead = states.drop("other", "is_pair").withColumn("_first", _ahead(1)).withColumnRenamed("node", "_node")
    same = F.col("_first") == F.col("first")
    follows = same & (F.substring(word, position + 1, size) == F.col("label"))
    replaced = (
        (edits == 0) & (position >= F.col("half")) & (F.col("first") > F.col("_first"))
        & (F.substring(word, position + 2, size - 1) == F.substring(F.col("label"), F.lit(2), size))
    )
    met = ahead.join(edges, (F.col("_node") == F.col("node")) & (follows | replaced))
    after = position + size

    def state(place: Column, number: Column) -> Column:
        return F.struct(place.alias("position"), number.cast("int").alias("edits"))

    goes_on = state(after, F.when(same, edits).otherwise(1))
    # A word on its own path may also leave out the character behind the label.
    left_out = F.when(same & (edits == 0) & (after >= F.col("half")) & (after < F.length(word)), state(after + 1, F.lit(1)))
    found = met.select(
        "word", "n", "backwards", "half", F.col("child").alias("node"), "ends", "end", "leaf",
        F.explode(F.array_compact(F.array(goes_on, left_out))).alias("s"),
    ).select("word", "n", "backwards", "half", "node", "ends", "end", "leaf", "s.*")
    done = F.col("position") == F.length("word")
    pair = (F.col("edits") == 1) & done & F.col("ends")
    kept = found.filter(pair | (~done & ~F.col("leaf")))
    return kept.withColumns({"other": F.when(pair, F.col("end")), "is_pair": pair}).drop("ends", "end", "leaf")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all pairs of words, in both directions, that differ by one code point inserted,
    deleted or replaced. `words` are (word, n) with distinct words; null and empty ones are left out, no words give no rows.

    Nodes are 64-bit hashes of the way to them. Two nodes of one hash would only add ways, and each pair is
    checked at the end, so nothing is lost or made up. Each level is written, and then the one before it deleted.
    """
    spark = words.sparkSession
    ship_package(spark)
    given = words.filter("word <> ''").select("word", "n")
    ways = [
        given.select(
            F.reverse("word").alias("word") if back else F.col("word"), "n", F.lit(back).alias("backwards"),
            F.floor(F.length("word") / 2).cast("int").alias("half"), F.xxhash64(F.lit(back)).alias("node"),
            F.lit(0).alias("position"), F.lit(0).alias("edits"),
        )
        for back in (False, True)
    ]
    level = new_folder(spark, "level")
    states = stored(ways[0].unionByName(ways[1]), level)
    found: list[DataFrame] = []
    while not states.isEmpty():
        edge_folder, next_level = new_folder(spark, "edges"), new_folder(spark, "level")
        edges = stored(_edges(states), edge_folder)
        arrived = stored(_step(states, edges), next_level, ["is_pair"])
        drop_folder(spark, level)
        drop_folder(spark, edge_folder)
        found.append(arrived.filter("is_pair").select("word", "n", "backwards", "other"))
        states, level = arrived.filter("NOT is_pair"), f"{next_level}/is_pair=false"
    if not found:
        return given.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    pairs = reduce(DataFrame.unionByName, found)

    def forwards(column: str) -> Column:
        return F.when(F.col("backwards"), F.reverse(column)).otherwise(F.col(column))

    pairs = pairs.select(forwards("word").alias("word"), "n", forwards("other.word").alias("other"), F.col("other.n").alias("other_n"))
    pairs = pairs.filter(F.levenshtein("word", "other", 1) == 1)
    # Both directions from one reading of the levels.
    there, back = (
        F.struct(F.col(a).alias("word"), F.col(f"{m}n").alias("n"), F.col(b).alias("other"), F.col(f"{k}n").alias("other_n"))
        for a, m, b, k in (("word", "", "other", "other_"), ("other", "other_", "word", ""))
    )
    return pairs.select(F.inline(F.array(there, back))).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: the last one on the way. Each round doubles the length of the ways."""
    spark = forms.sparkSession
    links = stored(forms.select("word", F.col("form").alias("root")), new_folder(spark, "links"))
    while True:
        further = links.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = links.join(further, F.col("root") == F.col("_at"), "left")
        moved = stored(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("went")), new_folder(spark, "links"))
        links = moved.select("word", "root")
        if moved.filter("went").isEmpty():
            return links


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each of the distinct words (word, n).

    Near words differ by one code point. The form is the near word of the largest n, of equal ones the smallest by code points,
    if its n is at least 10 times the word's, else null; the root is the last word on the way from form to form, the word itself
    if it has none. Null and empty words are left out; no words give no rows.
    """
    spark = words.sparkSession
    words = stored(words.filter("word <> ''").select("word", "n"), new_folder(spark, "vocabulary"))
    order = F.struct((-F.col("other_n")).alias("minus_n"), F.col("other").alias("form"))
    best = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(order).alias("best"))
    known = words.join(best, "word", "left")
    enough = -F.col("best.minus_n") >= FORM_TIMES * F.col("n")
    formed = known.select(
        "word", F.when(enough, F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, -F.col("best.minus_n")).alias("form_n"),
    )
    formed = stored(formed, new_folder(spark, "forms"))
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
