"""Token ids of whole texts with a cache of words.

White space always ends a token in the tokenizers used here, so a text's ids are those of its words in a row. Words
repeat, so each worker keeps the ids of the words, and of the letter runs in them, that it has met, up to a bound.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import regex

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.tiktoken"
#: Characters that str.split() takes for white space and the tokenizer doesn't.
_ODD = re.compile("[\x1c-\x1f]")
#: Lower case of these depends on their place in a word, or on the library.
_CASED = re.compile("[\u0130\u03a3]")
#: What the byte-level step changes: all but the visible ASCII characters.
_REMAPPED = re.compile("[^\x21-\x7e]")
#: Byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for U+0100 and on, in order.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LEVEL = {b: b for b in _SHOWN} | {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}


class Cache(dict):
    """What `make` gives for a key, of which up to `most` keys of under 64 characters are kept."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        out = self.make(key)
        if len(self) < self.most and len(key) < 64:
            self[key] = out
        return out


class WordBpe:
    """Ids of a `tokenizers` file whose pre-tokenizer drops white space, as little-endian bytes of `kind`."""

    def __init__(self, path: str, kind: str = "<u4", most_words: int = 300_000, most_pieces: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.kind = np.dtype(kind)
        self.words, self.pieces = Cache(self._word, most_words), Cache(self._piece, most_pieces)
        # the pre-tokenizer's own rule, which the file states
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(BYTE_LEVEL) if _REMAPPED.search(piece) else piece
        return self._packed([t.id for t in self.model.tokenize(mapped)])

    def _word(self, word: str) -> bytes:
        if "<|" in word or len(word) > 400:
            return self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        plain = word.isascii() or unicodedata.is_normalized("NFC", word) and not _CASED.search(word)
        low = word.lower() if plain else self.normalizer.normalize_str(word)
        return b"".join(map(self.pieces.__getitem__, self.split(low)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _ODD.search(text):
            return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, text.split()))


#: A run of white space of this length is taken out of a text before the splitting pattern, which looks ahead of each and would
#: run out of stack at some ten times that.
LONG_RUN = 100_000
_LONG = re.compile(r"[^\S\x1c-\x1f]{%d,}" % LONG_RUN)


def stretches(text: str, ends: tuple[str, ...] = ()) -> Iterator[tuple[str, bool]]:
    """The text in order as (part, whole): a long run of white space is whole, that is one piece of the pattern, but for its last
    character where a text goes on: that begins the next piece. A text does not go on at one of the control strings `ends`."""
    done = 0
    if len(text) >= LONG_RUN:
        for m in _LONG.finditer(text):
            a, b = m.span()
            b -= b < len(text) and not text.startswith(ends, b)
            if done < a:
                yield text[done:a], False
            yield text[a:b], True
            done = b
    if done < len(text):
        yield text[done:], False


_WHOLE: dict = {}


def whole(encoding):
    """The encoding without a splitting pattern, for parts that are one piece; made when first wanted."""
    import tiktoken

    if encoding.name not in _WHOLE:
        _WHOLE[encoding.name] = tiktoken.Encoding(f"{encoding.name}-whole", pat_str="(?s:.+)", mergeable_ranks=encoding._mergeable_ranks, special_tokens={})
    return _WHOLE[encoding.name]


class ByteBpe:
    """Ids of a `tiktoken` vocabulary, as little-endian bytes of `kind`."""

    def __init__(self, path: str, kind: str = "<u2"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.kind = np.dtype(kind)

    def encode(self, text: str | None) -> bytes:
        return b"".join(np.array((whole(self.encoding) if run else self.encoding).encode_ordinary(part), self.kind).tobytes() for part, run in stretches(text or ""))


_LOADED: dict = {}


def forget() -> None:
    """Empties the caches of this worker process, where other work follows."""
    for one in _LOADED.values():
        if isinstance(one, WordBpe):
            one.words.clear()
            one.pieces.clear()


def loaded(kind, name: str):
    """One instance a worker process, whose caches later tasks use. name: a public tokenizer, or a path that every
    executor has."""
    if (kind, name) not in _LOADED:
        _LOADED[kind, name] = kind(name if "/" in name else public_tokenizers.path(name))
    return _LOADED[kind, name]
