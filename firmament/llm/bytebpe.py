"""Byte-level BPE encoding and decoding by forced boundaries.

A pair of bytes that stands inside no token of the vocabulary can never be merged across, so a
text may be cut between any such two bytes: the fragments are merged independently and their ids
follow each other.  The cuts of the tokenizer's own pattern (words, numerals, signs, space) come
first, since no merge crosses them either.  Fragments are short, whatever the length of a text.

Results equal the library's: texts of common Latin characters are split with ``re``, chunk by
chunk between spaces and with a memo, all others with the pattern's own character classes.  The
string of an added token in a text is that token.  Null counts as the empty text: no ids, and
decoded the empty text.  Repeated rows get equal results; further columns are left as they are.
"""

from __future__ import annotations

import functools
import json
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from firmament.llm.common import append, unpack
from firmament.llm.wordbpe import PLAIN, byte_letters, default_path

VOCABULARY = "byte_bpe_50k.json"
MEMO = 120_000  # entries of the memo at most; a full one is emptied

# Fixed value: the tokenizer's pattern, once for ``re`` on plain texts and once for all texts.
PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Space around a space can join over the cuts between chunks; such texts are split as a whole.
JOINED_SPACE = re.compile(r"\s \s|\s \Z")


class ByteCodec:
    """Ids of texts as little-endian 32-bit words, and back."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        letters = byte_letters()
        added = {t["content"]: t["id"] for t in saved["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): n for token, n in saved["model"]["vocab"].items() if token not in added}
        self.table: list[bytes] = [b""] * (1 + max([*ranks.values(), *added.values()]))
        for token, n in ranks.items():
            self.table[n] = token
        for token, n in added.items():
            self.table[n] = token.encode()
        self.added = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.added_ids = added
        self.forced = forced_pairs(ranks)
        self.merge = tiktoken.Encoding("bytes", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.pieces = regex.compile(PIECES)
        self.memo: dict[str, bytes] = {}

    def fragments(self, piece: bytes) -> list[bytes]:
        """Parts of a piece between forced boundaries."""
        forced = self.forced
        cuts = [i for i, pair in enumerate(zip(piece, piece[1:]), 1) if pair in forced]
        if not cuts:
            return [piece]
        return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)], strict=True)]

    def _split(self, text: str) -> bytes:
        pieces = (PLAIN_PIECES if PLAIN.fullmatch(text) else self.pieces).findall(text)
        ids = [i for p in pieces for f in self.fragments(p.encode()) for i in self.merge(f)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if self.added is not None and self.added.search(text):
            parts = self.added.split(text)
            return b"".join(struct.pack("<I", self.added_ids[p]) if k % 2 else self.encode(p) for k, p in enumerate(parts))
        if JOINED_SPACE.search(text):
            return self._split(text)
        head, *rest = text.split(" ")
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for chunk in rest:
            if chunk not in memo:
                memo[chunk] = self._split(" " + chunk)
        return self._split(head) + b"".join([memo[c] for c in rest])

    def decode(self, ids: bytes) -> str:
        table = self.table
        return b"".join([table[i] for i in struct.unpack(f"<{len(ids) // 4}I", ids)]).decode("utf-8", "replace")


def forced_pairs(tokens) -> set[tuple[int, int]]:
    """Pairs of bytes that stand next to each other in no token."""
    inside = np.zeros((256, 256), bool)
    for token in tokens:
        if len(token) > 1:
            own = np.frombuffer(token, np.uint8)
            inside[own[:-1], own[1:]] = True
    return set(zip(*(axis.tolist() for axis in np.nonzero(~inside)), strict=True))


@functools.lru_cache(maxsize=2)
def codec(path: str) -> ByteCodec:
    """One codec per worker process, with its memo."""
    return ByteCodec(path)


def encode(docs: DataFrame, text: str = "text", vocabulary: str | None = None, check: bool = False) -> tuple[DataFrame, list[str]]:
    """All rows and columns with ``ids``, 32-bit little-endian words; the names of the new columns.

    With ``check`` also ``decoded``, the text that these ids decode to, made in the same pass.
    """

    def start():
        own = codec(vocabulary or default_path(VOCABULARY))

        def work(texts: pa.Array) -> list[pa.Array]:
            ids = [own.encode(t or "") for t in texts.to_pylist()]
            return [pa.array(ids, pa.binary())] + [pa.array([own.decode(i) for i in ids], pa.string())] * check

        return work

    return append(docs, text, [("ids", T.BinaryType())] + [("decoded", T.StringType())] * check, start)


def decode(docs: DataFrame, ids: str = "ids", vocabulary: str | None = None) -> tuple[DataFrame, str]:
    """All rows and columns with ``decoded``, the text of the ids; and the name of that column."""

    def start():
        own = codec(vocabulary or default_path(VOCABULARY))

        def work(column: pa.Array) -> list[pa.Array]:
            data, offsets = unpack(column)
            body = data.tobytes()
            return [pa.array([own.decode(body[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())]

        return work

    found, (name,) = append(docs, ids, [("decoded", T.StringType())], start)
    return found, name
