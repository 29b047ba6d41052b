"""Fast encoding with a word-level BPE file: the library's ids, word by word, with a memo.

The tokenizer splits a lower-cased text into words, numerals and signs, drops the space between
them and merges each on its own.  Its ids ascend in merge order, so a merge engine for ranked
vocabularies gives the same ids once the end of a word is a byte that no text holds.  Texts of
common Latin characters are split here, first at space, then into pieces; any other text, and
one that spells an added token, goes through the library whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct

MEMO = 120_000  # entries of the memo at most; a full one is emptied
WORD_END = "</w>"

# Characters on which the library's classes of letters, numerals and space and those of ``re``
# agree and which Unicode normal form C leaves as they are.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧‰-⁞€]*")
PIECES = re.compile(r"[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d|\d|(?:[^\w\s]|_)+")


def default_path(name: str) -> str:
    """Where the installed vocabulary of that name lies, on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process, with its memo."""
    return WordEncoder(path)


class WordEncoder:
    """Ids of texts as little-endian 32-bit words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        self.path = path
        self.added = [t["content"] for t in saved["added_tokens"]]
        self.memo: dict[str, bytes] = {}
        self.merge = _merger(saved["model"]["vocab"])

    @functools.cached_property
    def library(self):
        """The tokenizers library's own encoder, loaded for the first text that needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    def encode(self, text: str) -> bytes:
        if not PLAIN.fullmatch(text) or any(a in text for a in self.added):
            return _words(self.library.encode(text, add_special_tokens=False).ids)
        chunks = text.lower().split()
        memo = self.memo
        try:
            return b"".join([memo[c] for c in chunks])
        except KeyError:
            pass
        if len(memo) > MEMO:
            memo.clear()
        merge = self.merge
        for chunk in chunks:
            if chunk not in memo:
                if chunk.isalpha():
                    memo[chunk] = _words(merge(chunk.encode() + b"\xff"))
                else:
                    memo[chunk] = b"".join([_words(merge(p.encode() + b"\xff")) for p in PIECES.findall(chunk)])
        return b"".join([memo[c] for c in chunks])


def byte_letters() -> dict[str, int]:
    """The byte behind every letter of a byte-level vocabulary: printable bytes stand for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _merger(vocabulary: dict[str, int]):
    """Ids of one piece of bytes, closed by the byte 255."""
    import tiktoken

    letters, ranks = byte_letters(), {}
    for token, number in vocabulary.items():
        end = token.endswith(WORD_END) and len(token) > len(WORD_END)
        body = token[: -len(WORD_END)] if end else token
        if all(c in letters for c in body):
            ranks[bytes(letters[c] for c in body) + b"\xff" * end] = number
    ranks.setdefault(b"\xff", 1 + max(ranks.values()))
    return tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


def _words(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
