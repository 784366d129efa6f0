"""Token ids of public tokenizers, as their library gives them, at the speed that a full corpus needs.

Natural text repeats its words. Both encoders below cut text where the tokenizer itself cuts it whatever stands around,
and fall back to the library for every text or word whose characters are not known to be cut alike. The ids are the
library's in either case; the tests compare them.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import tiktoken

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks fill the cores

from tokenizers import Tokenizer  # noqa: E402

#: Characters that every engine cuts and folds alike: ASCII without controls, and Latin letters without combining marks.
_PLAIN = "\t\n\x0b\x0c\r\x20-\x7e\xa1-įı-ɏ"
_ODD = re.compile(f"[^{_PLAIN}]")
#: Words kept by a worker; more are encoded anew each time.
CACHED_WORDS = 600_000
#: A longer run without white space goes to the library, whose time does not grow with its square.
LONG_RUN = 2_000


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _octets(vocab: dict[str, int]) -> dict[bytes, int]:
    """The byte strings of a byte-level vocabulary: printable Latin-1 stands for itself, other bytes from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    back = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    return {bytes(back[c] for c in token): i for token, i in vocab.items() if all(c in back for c in token)}


class ByteBpe:
    """A byte-level BPE whose merges are numbered in the order of their ids.

    Plain text goes through a byte-pair encoder that reads the same vocabulary; text with special tokens, with other
    characters or with very long runs goes through the tokenizer library itself.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        letters = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # byte-level pattern
        self.fast = tiktoken.Encoding("plain", pat_str=letters, mergeable_ranks=_octets(vocab), special_tokens={})

    def plain(self, text: str) -> bool:
        return (
            (text.isascii() or not _ODD.search(text))
            and not any(s in text for s in self.special)
            and (len(text) <= LONG_RUN or max(map(len, text.split()), default=0) <= LONG_RUN)
        )

    def ids(self, text: str) -> np.ndarray:
        if self.plain(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


class _Words(dict):
    """Ids of words, encoded when first asked for; a full dictionary keeps what it has."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


class WordBpe:
    """A lower-casing word BPE without ids for white space: words are independent, so their ids are kept.

    A word of plain letters goes through a byte-pair encoder over the same vocabulary, in which the last byte of a word
    is replaced by a byte that no such word has, to mark the word's end. All else goes through the tokenizer library.
    """

    #: Fixed by the tokenizer's own pattern, for folded plain characters: endings, letters, single digits, the rest.
    _LETTERS = "a-zªµºß-öø-įı-ɏ"
    _DIGITS = "0-9²³¹¼½¾"
    _WORD = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\t\n\x0b\x0c\r {_DIGITS}{_LETTERS}]+"
    )
    _CHUNK = re.compile(r"[^\t\n\x0b\x0c\r ]+")
    _END = "</w>"

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        ended = {b: b - 32 for b in range(ord("a"), ord("z") + 1)}
        ended |= dict(zip(range(0x80, 0xC0), [*range(0xCA, 0x100), *range(0x00, 0x20)], strict=False))
        self.ended = {bytes([b]): bytes([e]) for b, e in ended.items()}
        marks = set(ended.values())
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        ranks = {}
        for octets, i in _octets({t: i for t, i in vocab.items() if not t.endswith(self._END)}).items():
            if not marks & set(octets):
                ranks[octets] = i
        whole = {t.removesuffix(self._END): i for t, i in vocab.items() if t.endswith(self._END)}
        for octets, i in _octets(whole).items():
            if octets[-1:] in self.ended and not marks & set(octets):
                ranks[octets[:-1] + self.ended[octets[-1:]]] = i
        self.fast = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.words = _Words(self._word)
        self._plain_word = re.compile(f"[{self._LETTERS}]{{1,{LONG_RUN}}}").fullmatch

    def _word(self, word: str) -> bytes:
        if self._plain_word(word):
            octets = word.encode()
            ids = self.fast._encode_single_piece(octets[:-1] + self.ended[octets[-1:]])
        else:
            ids = self.library.encode(word, add_special_tokens=False).ids
        return np.array(ids, dtype=self.dtype).tobytes()

    def _pieces(self, text: str) -> list[str]:
        """Pieces in order that the tokenizer encodes independently."""
        if text.isascii() or not _ODD.search(text):
            return self._WORD.findall(text.lower())
        out: list[str] = []
        for chunk in self._CHUNK.findall(text):
            if _ODD.search(chunk):
                out.append(chunk)
            else:
                out += self._WORD.findall(chunk.lower())
        return out

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian numbers of ``dtype``."""
        if any(s in text for s in self.special):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype=self.dtype).tobytes()
        return b"".join(map(self.words.__getitem__, self._pieces(text)))


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    """One per worker."""
    return ByteBpe(path)


@lru_cache(maxsize=4)
def word_bpe(path: str) -> WordBpe:
    """One per worker."""
    return WordBpe(path)
