"""Token ids by a public tokenizer, one white-space word at a time with a bounded cache.

The tokenizer drops white space and never joins characters across it, so the ids of a text are
those of its words in turn. Texts share most of their words: a word is encoded once per worker
while the cache holds it. A word of letters only is a single run for the tokenizer; its model is
asked directly, after the same normalization (NFC, lower case, bytes as printable characters).
"""

from __future__ import annotations

import os
import struct
import unicodedata

CACHE_WORDS = 600_000
CACHE_LENGTH = 40  # longer words are encoded anew
_TAIL = ".,;:!?"
_loaded: dict[str, "WordEncoder"] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


class WordEncoder:
    """``ids_bytes(texts)``: each text's ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.characters = byte_characters()
        self.cache: dict[str, bytes] = {"": b""}

    def _encode(self, word: str) -> bytes:
        if word.isalpha():
            form = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()
            if word.isascii() or (form.isalpha() and "Σ" not in word):
                if not word.isascii():
                    form = "".join([self.characters[b] for b in form.encode()])
                ids = [t.id for t in self.model.tokenize(form)]
                return struct.pack(f"<{len(ids)}I", *ids)
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, word: str) -> bytes:
        ids = self.cache.get(word)
        if ids is None:
            ids = self._encode(word)
            if len(word) <= CACHE_LENGTH:
                self.cache[word] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """Marks that end a word after a letter or digit are a run of their own."""
        core = word.rstrip(_TAIL)
        if len(core) == len(word) or not core or not core[-1].isalnum():
            return self._part(word)
        ids = self._part(core) + self._part(word[len(core):])
        if len(word) <= CACHE_LENGTH:
            self.cache[word] = ids
        return ids

    def ids_bytes(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > CACHE_WORDS:
            self.cache = {"": b""}
        get, word = self.cache.get, self._word
        out = []
        for text in texts:
            words = text.replace("\n", " ").split(" ")
            ids = [get(w) for w in words]
            if None in ids:
                ids = [word(w) if x is None else x for w, x in zip(words, ids)]
            out.append(b"".join(ids))
        return out


def encoder(path: str) -> WordEncoder:
    """One encoder per worker and file."""
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]
