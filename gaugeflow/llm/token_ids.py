"""Token ids of whole texts for a byte-level BPE file of the tokenizers library.

If the file's merges are in the order of their ids, and its text splitting is the
plain byte-level one, the same ids come from tiktoken's merge loop, which is three
times as fast. Texts that hold a special token's string go to the library itself.
"""

import json

import numpy as np

# The split that the byte-level pre-tokenizer applies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OPEN = {}


def byte_letters():
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain}
    return letters | {b: chr(0x100 + i) for i, b in enumerate(others)}


def merge_ranks(spec):
    """Byte strings with their ids, if merging by id is merging in the file's order; else None."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    options = (model.get("dropout"), model.get("continuing_subword_prefix"), model.get("end_of_word_suffix"))
    plain = (
        model.get("type") == "BPE"
        and spec.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and not any(options)
        and not model.get("ignore_merges")
    )
    if not plain:
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"].get(a + b) for a, b in merges]
    if ids != sorted(ids) or len(set(ids)) != len(ids):
        return None
    to_byte = {letter: b for b, letter in byte_letters().items()}
    ranks = {
        bytes(to_byte[c] for c in token): i
        for token, i in model["vocab"].items()
        if token not in special
    }
    singles = [ranks.get(bytes([b])) for b in range(256)]
    first = min(ids, default=256)
    if len(ranks) != 256 + len(ids) or any(s is None or s >= first for s in singles):
        return None
    return ranks


class Encoder:
    """`ids(text)`: what the library gives without added special tokens, as an array.

    The library itself is opened when a text needs it, which most tasks never see.
    """

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path, self.opened = path, None
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        ranks = merge_ranks(spec)
        self.fast = None
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding(
                "ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
            )

    @property
    def library(self):
        if self.opened is None:
            from tokenizers import Tokenizer

            self.opened = Tokenizer.from_file(self.path)
            self.opened.no_truncation()
            self.opened.no_padding()
        return self.opened

    def ids(self, text):
        if not text:
            return np.zeros(0, dtype=np.uint32)
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


def encoder(path):
    """One encoder per Python worker and file."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]
