import corpus_pipeline
import pytest
from fixtures import frame

from docketry.llm import jaccard_join, templates, toxicity
from docketry.llm.queries import TOXIC_FROM, queries, table


# Large enough for labels to teach something.
SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage returns on a whole small table."""
    sf_dir = SF_DIR
    docs, out = table(spark, sf_dir, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        out.append(docs)
    return out


def ids(frame):
    return [r.doc_id for r in frame.select("doc_id").collect()]


def test_each_stage_takes_effect(spark, steps):
    sf_dir = SF_DIR
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    clean = {r.doc_id for r in toxicity.score(docs, model).filter(f"score < {TOXIC_FROM}").collect()}
    assert set(ids(steps[0])) == clean and len(clean) < docs.count()
    one = {r.doc_id for r in jaccard_join.linked(steps[0]).collect() if r.doc_id == r.component_id}
    assert sorted(ids(steps[1])) == sorted(one)
    hit = {r.doc_id for r in templates.contaminated(steps[1], table(spark, sf_dir, "benchmark")).collect()}
    assert sorted(ids(steps[2])) == sorted(one - hit)
    assert set(ids(steps[3])) <= set(ids(steps[2]))
    assert sorted(ids(steps[4])) == sorted(ids(steps[3]))


def test_all_but_the_last_keep_the_columns(spark, steps):
    columns = table(spark, SF_DIR, "documents").columns
    assert all(s.columns == columns for s in steps[:-1])
    assert steps[-1].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_run_gives_the_last_stage(spark, steps):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[-1].collect()))


def test_stages_take_odd_and_no_rows(spark):
    for rows in (None, []):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR).cache()
            assert (docs.count() > 0) == (rows is None)


def test_every_operator_is_registered():
    names = queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
