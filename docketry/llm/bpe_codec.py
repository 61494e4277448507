"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A pre-token is covered from the left with its longest tokens, which one pass of an Aho-Corasick automaton finds. A
token is taken only if it is compatible with the token before it: merging the two side by side must give just
these two. If none of the shorter ones is, the token before is shortened in turn. Each place is given up at most
once, so the time is linear in the length of the pre-token, and the result is that of the merges in their order.

A pair is compatible if no merge across the seam comes first. The pieces at the seam are known from how each token is
built: on the left its right-hand parts, on the right its left-hand parts, each there from the merge that makes it
to the merge that takes it up. A merge of two such pieces happens if it is earlier than the next merge of
the left one, and not later than that of the right one, as of equal merges the leftmost comes first.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from docketry.llm.text import in_small_batches, with_text
from docketry.llm.token_counts import NOT_PLAIN, slices

CACHE_SIZE = 300_000
# A longer pre-token is encoded each time it comes.
LONGEST_KEPT = 64
NEVER = 1 << 60
# Private characters for the last symbol of a word.
_LAST = 0xE000

_CODECS: dict[str, Codec] = {}


def byte_alphabet() -> list[str]:
    """The character that byte-level tokenizers write for each byte: printable Latin-1 as it is, the rest from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    named = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [named[b] for b in range(256)]


class Merges:
    """The merges of a BPE model as an automaton of its tokens and a table of compatible pairs."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str | None) -> None:
        import ahocorasick

        alphabet = byte_alphabet()
        self.symbols = [c if suffix is None else chr(_LAST + b) for b, c in enumerate(alphabet)]
        """How the last byte of a word is written here; the bytes before it are written in the alphabet."""
        written = {vocab[c]: c for c in alphabet if c in vocab}
        if suffix is not None:
            written |= {vocab[c + suffix]: s for c, s in zip(alphabet, self.symbols, strict=True) if c + suffix in vocab}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, token = vocab[left], vocab[right], vocab[left + right]
            if token in written or a not in written or b not in written:
                raise ValueError(f"merge {rank} makes a token twice or before its parts")
            self.rank[a, b] = rank
            self.parts[token], self.made[token] = (a, b), rank
            written[token] = written[a] + written[b]
        self.compatible_pairs: dict[tuple[int, int], bool] = {}
        # A token whose parts would be merged otherwise first is never made; parts come before what is made of them.
        self.written: dict[int, str] = {}
        for token, word in written.items():
            a, b = self.parts.get(token, (None, None))
            if a is None or a in self.written and b in self.written and self._seam_holds(a, b):
                self.written[token] = word
        self.automaton = ahocorasick.Automaton()
        for token, word in self.written.items():
            self.automaton.add_word(word, (token, len(word)))
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces of a token at one of its ends, each with the merge that takes it up."""
        pieces, taken = [], NEVER
        while True:
            pieces.append((token, taken))
            if token not in self.parts:
                return pieces
            taken, token = self.made[token], self.parts[token][side]

    def _seam_holds(self, left: int, right: int) -> bool:
        """Whether nothing is merged across the seam before both tokens are whole."""
        for a, a_taken in self._edge(left, 1):
            for b, b_taken in self._edge(right, 0):
                rank = self.rank.get((a, b))
                if rank is not None and rank < a_taken and rank <= b_taken and (a, b) != (left, right):
                    return False
        return True

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the symbols of both tokens side by side gives just these two."""
        known = self.compatible_pairs.get((left, right))
        if known is None:
            known = (left, right) not in self.rank and self._seam_holds(left, right)
            if len(self.compatible_pairs) >= 4 * CACHE_SIZE:
                self.compatible_pairs.clear()
            self.compatible_pairs[left, right] = known
        return known

    def next_shorter(self, token: int) -> int | None:
        """The longest token that is a proper beginning of this one."""
        if token not in self.shorter:
            word, best = self.written[token], None
            for end, (found, size) in self.automaton.iter(word):
                if end + 1 == size < len(word):
                    best = found
            self.shorter[token] = best
        return self.shorter[token]

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one pre-token, given as UTF-8."""
        if not word:
            return []
        alphabet = _ALPHABET
        text = "".join([alphabet[b] for b in word[:-1]]) + self.symbols[word[-1]]
        longest: list[int | None] = [None] * len(text)
        for end, (token, size) in self.automaton.iter(text):
            longest[end + 1 - size] = token  # ends ascend, so the longest of a place comes last
        tokens: list[int] = []
        # Places from which no cover of the rest is left.
        dead = bytearray(len(text) + 1)
        at, token = 0, longest[0]
        while True:
            while token is not None:
                end = at + len(self.written[token])
                if not dead[end] and (not tokens or self.compatible(tokens[-1], token)):
                    break
                token = self.next_shorter(token)
            if token is not None:
                tokens.append(token)
                at = end
                if at == len(text):
                    return tokens
                token = longest[at]
                continue
            dead[at] = 1
            if not tokens:
                raise ValueError(f"no cover of {word!r} by tokens")
            last = tokens.pop()
            at -= len(self.written[last])
            token = self.next_shorter(last)


_ALPHABET = byte_alphabet()


class Codec:
    """A byte-level BPE tokenizer file: cutting, the encoder, and the offset table of its tokens."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        bpe = parts["model"]
        added = parts.get("added_tokens") or []
        unusual = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if bpe.get(k)]
        if bpe.get("type", "BPE") != "BPE" or unusual or parts.get("post_processor") and not _byte_level(parts["post_processor"]):
            raise ValueError(f"only plain byte-level BPE is known here, not {unusual or bpe.get('type')}")
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must be taken as they are written")
        decoder = parts.get("decoder")
        if decoder is not None and not _byte_level(decoder):
            raise ValueError("only decoders that join bytes, or none, are known here")
        library = Tokenizer.from_str(definition)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.merges = Merges(bpe["vocab"], bpe["merges"], bpe.get("end_of_word_suffix"))
        self.added = {t["content"]: t["id"] for t in added}
        names = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.special = regex.compile(f"({'|'.join(names)})") if names else None
        self.quick = _quick_cut(parts)
        names_by_id = {i: t for t, i in bpe["vocab"].items()} | {i: t for t, i in self.added.items()}
        self._offset_table(names_by_id, join=decoder is None)
        self.known: dict[str, bytes] = {}

    def _offset_table(self, names: dict[int, str], join: bool) -> None:
        """The bytes of all tokens one after the other, and where each begins.

        Without a decoder the library joins the written tokens with blanks, so each has a blank behind it.
        """
        back = {c: b for b, c in enumerate(_ALPHABET)}
        table = []
        for i in range(max(names) + 1):
            name = names.get(i, "")
            if join:
                table.append(name.encode() + b" " if i in names else b"")
            else:
                plain = all(c in back for c in name)
                table.append(bytes([back[c] for c in name]) if plain else name.encode())
        self.joined = join
        self.sizes = np.array([len(t) for t in table], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        self.table = np.frombuffer(b"".join(table), np.uint8)

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if self.quick is not None and not NOT_PLAIN.search(text):
            return self.quick(text)
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        cut = self.pre_tokenizer.pre_tokenize_str(text) if text else []
        back = {c: b for b, c in enumerate(_ALPHABET)}
        # The library gives pieces in the alphabet of bytes; a piece may end within a character.
        return [bytes([back[c] for c in piece]).decode("utf-8", "surrogateescape") for piece, _ in cut]

    def packed(self, piece: str) -> bytes:
        """The ids of a pre-token as little-endian 32-bit numbers."""
        found = self.known.get(piece)
        if found is None:
            ids = self.merges.encode(piece.encode("utf-8", "surrogateescape"))
            found = np.array(ids, "<u4").tobytes()
            if len(piece) <= LONGEST_KEPT:
                if len(self.known) >= CACHE_SIZE:
                    self.known.clear()
                self.known[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian 32-bit numbers; special strings are tokens of their own."""
        if self.special is None or "<" not in text and not self.special.search(text):
            return b"".join(map(self.packed, self.pieces(text)))
        out = []
        for number, part in enumerate(self.special.split(text)):
            if number % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
            else:
                out.extend(map(self.packed, self.pieces(part)))
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        """The text of packed ids, as UTF-8."""
        ids = np.frombuffer(packed, "<u4")
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.offsets[ids] - (ends - sizes), sizes)
        raw = self.table[np.arange(int(ends[-1])) + shift].tobytes()
        return raw[:-1] if self.joined else raw.decode("utf-8", "replace").encode()


def _byte_level(part: dict) -> bool:
    return part.get("type") == "ByteLevel"


def _quick_cut(parts: dict):
    """A cut by one pattern for texts of PLAIN characters, if the file's normalizer and cut are those known here."""
    normal, cut = parts.get("normalizer"), parts.get("pre_tokenizer") or {}
    steps = (normal or {}).get("normalizers", [])
    known = [s.get("type") for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1].get("pattern") == {"Regex": r"\s+"}
    splits = cut.get("pretokenizers", [])
    if not known or steps[1].get("content") != " " or len(splits) != 2 or not _byte_level(splits[1]):
        return None
    first = splits[0]
    if first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert") or splits[1].get("use_regex"):
        return None
    find = regex.compile(first["pattern"]["Regex"]).findall
    return lambda text: find(text.lower())


def codec(definition: str) -> Codec:
    """One codec, with its caches, for each worker and tokenizer."""
    if definition not in _CODECS:
        _CODECS[definition] = Codec(definition)
    return _CODECS[definition]


def encoded(docs: DataFrame, definition: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids) of each row of `docs`: the token ids of its whole text.

    `definition` is the JSON text of a tokenizers file with byte-level BPE. Ids are those of the library without added
    special tokens, truncation or padding; special strings in a text are taken as it takes them. A null or empty text has
    no ids; a null id stays null; equal rows stay; other columns, also such as are named like the new ones, do not
    matter; no rows give no rows. A text is handled by one task as a whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(shared.value)
        for batch in batches:
            done = 0
            for part in slices(batch.column("text").to_pylist()):
                ids = [np.frombuffer(tool.encode(t), "<u4").astype(np.int32) for t in part]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(part)), pa.array(ids, pa.list_(pa.int32()))], [id_column, "ids"]
                )
                done += len(part)

    rows = with_text(docs, id_column, text=text)
    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, ids array<int>")


def decoded(rows: DataFrame, definition: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, text) of each row: its ids as the library decodes them, special tokens kept. Null ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(shared.value)
        for batch in batches:
            texts = [tool.decode(np.array(i or [], "<u4").tobytes()).decode() for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_column, "text"])

    rows = in_small_batches(rows).select(id_column, ids)
    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, text string")


def digests(docs: DataFrame, definition: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each row: digests of its ids and of the text decoded from them.

    The same cases as in `encoded`; ids and decoded texts do not leave the task. An empty text has the digest of nothing twice.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(shared.value)
        sha = hashlib.sha256
        for batch in batches:
            packed = chain.from_iterable(map(tool.encode, s) for s in slices(batch.column("text").to_pylist()))
            found = [(len(p) // 4, sha(p).hexdigest(), sha(tool.decode(p)).hexdigest()) for p in packed]
            n, ids, texts = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                [id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = with_text(docs, id_column, text=text)
    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
