import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from fixtures import documents, frame
from tokenizers import Tokenizer

from docketry.llm import bpe_codec
from docketry.llm.queries import op11_bpe_codec, tokenizer


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def by_merging(symbols, ranks):
    """Plain BPE: the earliest merge, of equal ones the leftmost, until none is left."""
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not found:
            return symbols
        i = min(found)[1]
        symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2 :]]


@pytest.mark.parametrize("seed", range(30))
def test_any_merges_give_what_plain_merging_gives(seed):
    chance = random.Random(seed)
    alphabet = bpe_codec.byte_alphabet()
    vocab = {c: i for i, c in enumerate(alphabet)}
    merges, made = [], list("abc")
    while len(merges) < 40:
        pair = (chance.choice(made), chance.choice(made))
        if "".join(pair) not in vocab and len("".join(pair)) < 12:
            vocab["".join(pair)] = len(vocab)
            merges.append(list(pair))
            made.append("".join(pair))
    tool, ranks = bpe_codec.Merges(vocab, merges, None), {tuple(m): r for r, m in enumerate(merges)}
    for _ in range(200):
        word = "".join(chance.choice("abc") for _ in range(chance.randint(1, 25)))
        assert tool.encode(word.encode()) == [vocab[s] for s in by_merging(list(word), ranks)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_and_decoded_texts_are_those_of_the_library(spark, name):
    tool, definition = library(name), tokenizer(name)
    rows = documents()
    want = [(i, tool.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in rows]
    texts = [(i, tool.decode(ids, skip_special_tokens=False)) for i, ids in want]
    encoded = bpe_codec.encoded(frame(spark).repartition(3), definition)
    assert sorted((r.doc_id, r.ids) for r in encoded.collect()) == sorted(want)
    assert sorted(map(tuple, bpe_codec.decoded(encoded, definition).collect())) == sorted(texts)
    got = bpe_codec.digests(frame(spark), definition).collect()
    both = [(i, len(ids), sha(packed(ids)), sha(t.encode())) for (i, ids), (_, t) in zip(want, texts, strict=True)]
    assert sorted(map(tuple, got)) == sorted(both)


def test_long_pieces_odd_characters_and_full_caches(monkeypatch):
    monkeypatch.setattr(bpe_codec, "CACHE_SIZE", 20)
    chance = random.Random(7)
    texts = ["a" * 5000, "ab" * 3000, "the" * 999, "".join(chance.choice("abcdetoinsr") for _ in range(20_000)), "x\U0010ffff", "Ǆİ ΟΔΥΣΣΕΥΣ"]
    for _ in range(300):
        places = [chance.choice([chance.randrange(32, 0x250), chance.randrange(0x250, 0xD000), chance.randrange(0x1F300, 0x1FA00)]) for _ in range(40)]
        texts.append("".join(map(chr, places)))
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        tool, codec = library(name), bpe_codec.Codec(tokenizer(name))
        for text in texts:
            ids = tool.encode(text, add_special_tokens=False).ids
            assert codec.encode(text) == packed(ids)
            assert codec.decode(packed(ids)).decode() == tool.decode(ids, skip_special_tokens=False)


def test_clashing_columns_null_ids_and_no_rows(spark):
    rows = spark.createDataFrame([(None, "a b", 9, "x"), (1, None, 9, "y")], "doc_id long, text string, n_tokens int, ids_sha256 string")
    definition = tokenizer("word_bpe_49k.json")
    got = sorted(map(tuple, bpe_codec.digests(rows, definition).collect()), key=str)
    assert got[0] == (1, 0, sha(b""), sha(b"")) and got[1][:2] == (None, 2)
    none = bpe_codec.digests(rows.limit(0), definition)
    assert none.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and none.count() == 0
    assert bpe_codec.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), definition).first().text == ""


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="plain byte-level"):
        bpe_codec.Codec('{"model": {"type": "WordPiece", "vocab": {}, "merges": []}}')


def test_registered_codec_on_whole_table(spark, sf_dir):
    tool = library("word_bpe_49k.json")
    want = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = tool.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(packed(ids)), sha(tool.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(tuple, op11_bpe_codec(spark, sf_dir).collect())) == sorted(want)
