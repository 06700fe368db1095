"""Token counts of whole texts by a SentencePiece BPE model, without encoding most words.

A text is cut before every run of spaces and before every line end. No piece of
the vocabulary holds a space behind another character, or a line end at all
(checked when the model is opened), so no merge crosses a cut and the counts of
the parts add up. Which parts are a single token is proved beforehand by encoding
every string of the vocabulary alone; those are counted directly. The rest is
merged by the library, each distinct part once per block of rows.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.blocks import blocks
from gaugeflow.llm.scale import mapped

META = "▁"
# Parts remembered by a task besides the proved ones; a full memory starts afresh.
REMEMBERED = 200_000
_PART = re.compile(r" +[^ \n]*|\n[^ \n]*")
_OPEN = {}


class PartCounter:
    """Counts the parts of texts for one model."""

    def __init__(self, path):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [
            (i, self.model.id_to_piece(i))
            for i in range(self.model.get_piece_size())
            if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))
        ]
        if any(META in p.lstrip(META) or "\n" in p for _, p in pieces):
            raise ValueError(f"{path}: pieces reach across word ends, parts do not add up")
        if self.model.encode("a  b\n", out_type=str)[0][0] != META:
            raise ValueError(f"{path}: the model does not mark the start of a text")
        self.alone = self._prove(pieces)
        self.seen = {}

    def _prove(self, pieces):
        """Parts that the library itself encodes as exactly one token (two with a line end)."""
        heads = [(i, p) for i, p in pieces if p.startswith(META)]
        tails = [(i, p) for i, p in pieces if not p.startswith(META)]
        proved = {" ": 1, "\n": 1}
        for (i, piece), ids in zip(heads, self.model.encode([p[1:] for _, p in heads])):
            if ids == [i]:
                proved[piece.replace(META, " ")] = 1
        for (i, piece), ids in zip(tails, self.model.encode(["\n" + p for _, p in tails])):
            if len(ids) == 3 and ids[2] == i:
                proved["\n" + piece] = 2
        return proved

    def _merge(self, parts):
        """The library adds one start mark: a part's own first space, or one too many before a line end."""
        spaced = [part[1:] if part[0] == " " else part for part in parts]
        encoded = self.model.encode(spaced, num_threads=1)
        return [len(ids) - (part[0] == "\n") for part, ids in zip(parts, encoded)]

    def counts(self, texts):
        cut = [_PART.findall(" " + t.replace(META, " ")) if t else [] for t in texts]
        new = list(set().union(*cut) - self.alone.keys() - self.seen.keys())
        if len(self.seen) + len(new) > REMEMBERED:
            self.seen.clear()
            new = list(set().union(*cut) - self.alone.keys())
        known = {**dict(zip(new, self._merge(new)))} if new else {}
        if len(new) <= REMEMBERED:
            self.seen.update(known)
            known = {}
        alone, seen = self.alone, self.seen
        lookup = alone.get
        out = []
        for parts in cut:
            total = 0
            for part in parts:
                one = lookup(part)
                if one is None:
                    one = seen.get(part)
                    if one is None:
                        one = known[part]
                total += one
            out.append(total)
        return out


def counter(path):
    """One counter per Python worker and model."""
    if path not in _OPEN:
        _OPEN[path] = PartCounter(path)
    return _OPEN[path]


def token_counts(docs: DataFrame, model, id_col="doc_id", text_col="text", limit=4096) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row.

    `model` is the path of a SentencePiece file that every worker can open. Null
    and empty texts have 0 bytes and 0 tokens; a null id stays null; repeated rows
    give repeated results; other columns are ignored, whatever their names.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def count(batches):
        parts = counter(model)
        for block in blocks(batches, "text"):
            texts = block.column("text")
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n_tokens = parts.counts([t or "" for t in texts.to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), n_bytes, pa.array(np.array(n_tokens, dtype=np.int64))],
                names=["id", "n_bytes", "n_tokens"],
            )

    counted = mapped(rows, count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_col),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
