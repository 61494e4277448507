"""Training text from raw documents, in five stages.

Each stage works on all rows that the one before kept; its result is written and read again as the next one's
documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketry.llm import jaccard_join, mixing, templates, token_files, toxicity
from docketry.llm.queries import TOXIC_FROM, table, tokenizer
from docketry.sources.workspace import new_folder, stored

# The end of a document in the token files.
END_ID = 1

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; one without text is not toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return templates.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of the mix as files; the index of what they hold, read back: doc_id, start, n_tokens, ids_crc32."""
    folder = new_folder(spark, "corpus")
    token_files.write(docs, folder, tokenizer("word_bpe_49k.json"), END_ID)
    return token_files.index(spark, folder)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
    ("token files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, new_folder(spark, "stage"))
    return docs
