"""Token ids of whole texts for a word-level BPE file of the tokenizers library.

Where the file's normalizer and text splitting never look across white space, the ids
of a text are those of its words put together, and each different word is looked at once
per worker. Words of characters below PLAIN are split further by the file's own pattern,
and the library's model merges each different part once; any other word goes to the
library as it is. Texts that hold a special token's string, and files that are not known
to split at white space, go to the library whole.
"""

import json
import struct
from functools import lru_cache

import numpy as np
import regex

from gaugeflow.llm.token_ids import byte_letters

# Fixed value: the splitting pattern of lower-case word vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PARTS = regex.compile(PATTERN)
# Latin letters up to here stay as they are in normal form, and lower-casing looks at one
# at a time, but for the dotted capital I, which becomes two characters.
PLAIN, DOTTED = "\u0250", "\u0130"
# Words and parts that a worker remembers; both tables start again beyond it.
REMEMBERED = 1 << 20
LONGEST = 64
_OPEN = {}


@lru_cache(maxsize=64)
def numbers(size):
    return struct.Struct(f"<{size}I")


def splits_at_white_space(spec):
    """Whether the file lower-cases, folds white space, drops it and splits by PATTERN."""
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    folds = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    known = [s["type"] if s != folds else "fold" for s in steps] == ["NFC", "fold", "Lowercase"]
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if not known or [s["type"] for s in split] != ["Split", "ByteLevel"]:
        return False
    first, letters = split
    return (
        first["pattern"] == {"Regex": PATTERN}
        and first["behavior"] == "Removed"
        and first["invert"]
        and not letters.get("add_prefix_space")
        and not letters.get("use_regex", True)
        and spec["model"]["type"] == "BPE"
        and not spec["model"].get("dropout")
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
    )


def packed(ids):
    """Ids as little-endian 32-bit numbers."""
    return numbers(len(ids)).pack(*ids)


class Remembered(dict):
    """Ids (little-endian 32-bit numbers) of words or parts, made on first use."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        ids = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = ids
        return ids


class WordEncoder:
    """`ids(text)`: what the library gives without added special tokens, as an array."""

    def __init__(self, path):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.by_words = splits_at_white_space(spec)
        self.letters = {b: letter for b, letter in byte_letters().items() if letter != chr(b)}
        self.model = self.library.model
        self.parts = Remembered(self.of_part)
        self.words = Remembered(self.of_word)

    def whole(self, text):
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def of_part(self, part):
        """A part is one word to the model, which knows bytes by their letters."""
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return packed([t.id for t in self.model.tokenize(letters)])

    def of_word(self, word):
        text = word.decode()
        if not text.isprintable() or not (word.isascii() or max(text) < PLAIN and DOTTED not in text):
            return self.whole(text)
        text = text.lower()
        if text.isalpha():
            return self.parts[text]
        if text[:-1].isalpha():
            return self.parts[text[:-1]] + self.parts[text[-1]]
        return b"".join(map(self.parts.__getitem__, _PARTS.findall(text)))

    def ids(self, text):
        if not text:
            return np.zeros(0, "<u4")
        if not self.by_words or any(s in text for s in self.special):
            return np.frombuffer(self.whole(text), "<u4")
        # Cut at ASCII white space only: it is white space to every reader of the pattern.
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.encode().split())), "<u4")


def word_encoder(path):
    """One encoder per Python worker and file."""
    if path not in _OPEN:
        _OPEN[path] = WordEncoder(path)
    return _OPEN[path]
