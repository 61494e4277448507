import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from fixtures import DDL, documents, frame
from tokenizers import Tokenizer

from docketry.llm import token_counts, token_files
from docketry.llm.huffman import Code, code_lengths
from docketry.llm.queries import op1_token_counts, op2_token_files, tokenizer


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def test_counts_are_those_of_the_library(spark):
    rows = documents()
    got = token_counts.count_tokens(frame(spark), tokenizer("byte_bpe_50k.json")).collect()
    tool = library("byte_bpe_50k.json")
    want = [(i, len((t or "").encode()), len(tool.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows]
    assert sorted(map(tuple, got)) == sorted(want)


def test_counts_with_other_tokenizers_and_tiny_tables(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SUMMARY_SIZE", 50)
    rows = documents()
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        got = token_counts.count_tokens(frame(spark).repartition(3), tokenizer(name)).collect()
        tool = library(name)
        assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted(
            (i, len(tool.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows
        )


def test_counts_of_clashing_columns_null_ids_and_no_rows(spark):
    rows = spark.createDataFrame([(None, "a b", 9, "x"), (1, None, 9, "y")], "doc_id long, text string, n_tokens int, n_bytes string")
    got = token_counts.count_tokens(rows, tokenizer("byte_bpe_50k.json")).transform(token_counts.over(1))
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 0, 0, False), (None, 3, 2, True)]
    empty = token_counts.count_tokens(rows.limit(0), tokenizer("byte_bpe_50k.json"))
    assert empty.columns == ["doc_id", "n_bytes", "n_tokens"] and empty.count() == 0


def test_registered_counts_on_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    tool = library("byte_bpe_50k.json")
    found = tool.encode_batch([r.text or "" for r in rows], add_special_tokens=False)
    want = sorted((r.doc_id, len((r.text or "").encode()), len(e.ids), len(e.ids) > 512) for r, e in zip(rows, found, strict=True))
    assert sorted(map(tuple, op1_token_counts(spark, sf_dir).collect())) == want


@pytest.mark.parametrize("counts", [[0, 0], [5], [0, 7, 0], [1, 1], [1, 2, 4, 8, 16, 32, 64], [3] * 300, list(range(1000))])
@pytest.mark.parametrize("limit", [10, 16, 25])
def test_codes_are_short_enough_complete_and_decodable(counts, limit):
    counts = np.array(counts)
    lengths = code_lengths(counts, limit)
    assert lengths.max(initial=0) <= limit and ((lengths > 0) == (counts > 0)).all()
    if (counts > 0).sum() > 1:
        assert sum(2.0 ** -float(x) for x in lengths if x) == 1.0
    used = np.flatnonzero(counts)
    if len(used):
        code, chance = Code(lengths), np.random.default_rng(0)
        blocks = [chance.choice(used, n) for n in (1, 511, 512, 513, 3000)] + [np.zeros(0, int)]
        packed = [code.pack(b) for b in blocks]
        back = code.unpack([p for p, _ in packed], [c for _, c in packed], [len(b) for b in blocks])
        assert all((a == b).all() for a, b in zip(back, blocks, strict=True))


def test_code_lengths_are_the_best():
    chance = np.random.default_rng(1)
    for _ in range(20):
        counts = chance.integers(1, 50, 6)
        # Without a tight limit the cost is that of Huffman's tree.
        heap, cost = sorted(counts.tolist()), 0
        while len(heap) > 1:
            a, b, *heap = heap
            cost += a + b
            heap = sorted([*heap, a + b])
        assert int((code_lengths(counts, 16) * counts).sum()) == cost


def test_a_code_that_cannot_fit_is_refused():
    with pytest.raises(ValueError, match="do not fit"):
        code_lengths(np.ones(9), 3)


def written(rows, name="word_bpe_49k.json", end=1):
    tool = library(name)
    out, start = [], 0
    coded = [(i, [*tool.encode(t or "", add_special_tokens=False).ids, end]) for i, t, *_ in rows]
    for i, ids in sorted(coded):
        raw = np.array(ids, "<u4").tobytes()
        out.append((i, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    return out, coded


@pytest.mark.parametrize("block", [50, 1 << 17])
def test_files_give_back_the_ids(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", block)
    token_files.write(frame(spark).repartition(4), str(tmp_path), tokenizer("word_bpe_49k.json"), 1)
    want, coded = written(documents())
    assert sorted(map(tuple, token_files.index(spark, str(tmp_path)).collect())) == want
    back = [(r.doc_id, list(r.ids)) for r in token_files.read(spark, str(tmp_path)).collect()]
    assert sorted(back) == sorted(coded)
    assert not (tmp_path / "encoded").exists()


def test_files_of_another_tokenizer_without_end_and_of_repeated_and_null_ids(spark, tmp_path):
    rows = [(None, "x y", "", "", 0), (5, "a b c", "", "", 0), (5, "other text", "", "", 0), (5, "a b c", "", "", 0), (2, None, "", "", 0)]
    token_files.write(spark.createDataFrame(rows, DDL), str(tmp_path), tokenizer("byte_bpe_50k.json"), None)
    got = sorted(token_files.index(spark, str(tmp_path)).collect(), key=lambda r: (r.start, r.n_tokens))
    assert [r.doc_id for r in got][:2] == [None, 2] and [r.start for r in got][0] == 0
    assert got[1].n_tokens == 0 and got[1].ids_crc32 == 0
    for a, b in zip(got, got[1:], strict=False):
        assert b.start == a.start + a.n_tokens


def test_files_of_no_rows(spark, tmp_path):
    token_files.write(frame(spark, []), str(tmp_path), tokenizer("word_bpe_49k.json"), 1)
    assert token_files.index(spark, str(tmp_path)).count() == 0 and token_files.read(spark, str(tmp_path)).count() == 0


def test_registered_files_on_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, op2_token_files(spark, sf_dir).collect())) == written(rows)[0]


def test_definitions_are_read_whole():
    assert Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8") == tokenizer("word_bpe_49k.json")
