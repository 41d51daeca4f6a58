"""Token ids of whole texts with a public tokenizer file, fast enough for one pass over a corpus.

A tokenizer that lower-cases and drops white space encodes each run of other characters on its own,
so a word seen before need not be encoded again: its ids come from a bounded dictionary in the task.
A new word of letters goes straight to the tokenizer's BPE model, any other through its whole
pipeline. Texts for which that could differ from encoding them whole, and tokenizers of another
kind, are encoded whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

#: Special tokens, characters that are lower-cased by context, and blanks that only Python splits at.
UNUSUAL = re.compile("<\\||[\x1c-\x1fİΣ]")
TAIL = ".,!?;:*#$%&|()\"-"
KEPT_WORDS = 400_000
LONGEST_KEPT = 48


def byte_letters() -> dict[int, int]:
    """The printable stand-in of each byte in byte-level vocabularies, for the bytes that need one."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in plain)}


def splits_at_blanks(config: dict) -> bool:
    """Whether the file describes: NFC, blanks to spaces, lower case; letters, digits and the rest apart; bytes; word ends."""
    steps = [s["type"] for s in (config.get("normalizer") or {}).get("normalizers", [])]
    before = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    model = config.get("model", {})
    return (steps == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in before] == ["Split", "ByteLevel"]
            and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in before[0]["pattern"].get("Regex", "")
            and before[0]["invert"] and not before[1]["add_prefix_space"] and model.get("type") == "BPE"
            and model.get("end_of_word_suffix") is not None and not config.get("post_processor"))


class Encoder:
    """Encodes texts to little-endian unsigned integers, 16 bits wide if the vocabulary allows, else 32."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.by_word = splits_at_blanks(json.load(file))
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = "<u2" if self.code == "H" else "<u4"
        self.words = _Words(self)
        self.letters = byte_letters()

    def pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        stem = word.rstrip(TAIL)
        if not stem.isalpha():
            return self.whole(word)
        shown = stem if stem.isascii() else stem.encode().decode("latin-1").translate(self.letters)
        ids = self.pack([t.id for t in self.tokenizer.model.tokenize(shown)])
        return ids if len(stem) == len(word) else ids + self.words[word[len(stem):]]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word or UNUSUAL.search(text):
            return self.whole(text)
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        return b"".join(map(self.words.__getitem__, text.lower().split()))


class _Words(dict):
    """Ids by word, filled when asked for."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        ids = self.encoder.word(word)
        if len(word) <= LONGEST_KEPT:
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)
