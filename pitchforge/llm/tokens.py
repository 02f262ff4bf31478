"""Token ids of whole texts, with the words of a worker's texts cached.

The tokenizers library spends most of its time on alignments that are not
needed here.  For plain Latin text the split into words is done by the
vocabulary's own published pattern, and each new word goes through the model of
the tokenizers object once.  Any other text takes the library's usual path.
Both give the same ids (tests/llm/test_tokens.py).
"""

from __future__ import annotations

import gc
import re
from array import array

from .common import worker_state

#: Words that a worker keeps; when full, it starts anew.
CACHE_WORDS = 700_000

# The vocabularies' published split patterns for characters up to U+024F; letters and numbers there are fixed values.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
BYTE_PATTERN = rf" ?[{LETTERS}]+| ?[{NUMBERS}]+|'(?:[stmd]|re|ve|ll)| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
WORD_PATTERN = rf"[{LETTERS}]+|[{NUMBERS}]|'(?:[stmd]|re|ve|ll)|[^\s{LETTERS}{NUMBERS}]+"
#: Text with other characters, odd white space or what may be a special token.
UNUSUAL = r"[^\t\n\r\x20-\x7e\xa1-ɏ]|<\|"
#: What of it there can be in Latin-1 text: white space on which the two split patterns differ, special tokens.
ODD = ("<|", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0")


def byte_alphabet() -> dict[int, int]:
    """Byte -> character of byte-level vocabularies: printable bytes stand for themselves."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


class WordIds(dict):
    """Word -> its ids as bytes, from the model when it is first met."""

    def __init__(self, model):
        super().__init__()
        self.split, self.alphabet = model.tokenize, byte_alphabet()
        self.space = chr(self.alphabet[32])

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word[1:].isalpha():  # only a space in front needs its stand-in
            known = word if word[0] != " " else self.space + word[1:]
        else:
            known = word.encode().decode("latin-1").translate(self.alphabet)
        pieces = self.split(known)
        ids = self[word] = array("I", [p.id for p in pieces]).tobytes()
        return ids


class Encoder:
    """``encode(text)`` gives the ids as unsigned 32-bit numbers in the machine's (little-endian) order."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Lower-casing vocabularies drop white space, byte-level ones keep it.
        self.lower = bool(json.loads(self.tokenizer.to_str())["normalizer"])
        self.words = re.compile(WORD_PATTERN if self.lower else BYTE_PATTERN).findall
        self.unusual = re.compile(UNUSUAL).search
        self.ids = WordIds(self.tokenizer.model)

    def odd(self, text: str) -> bool:
        """Whether the text needs the library's own path; a few byte searches tell for most."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.unusual(text) is not None
        return any(c in text for c in ODD)

    def plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.odd(text):
            return self.plain(text)
        if len(self.ids) > CACHE_WORDS:
            self.ids.clear()
        return b"".join(map(self.ids.__getitem__, self.words(text.lower() if self.lower else text)))


def encoder(path: str) -> Encoder:
    """The worker's encoder for one vocabulary file."""
    made = worker_state("encoders")
    if path not in made:
        gc.set_threshold(200_000, 20, 100)  # the cached words hold no cycles to look for
        made[path] = Encoder(path)
    return made[path]
