"""Packing token sequences of bounded length by fitted length patterns.

Pieces are counted by length; the histogram has at most `capacity` bins whatever
the input. All patterns of two or three lengths that fill a sequence are
enumerated, their repeat counts fitted to the histogram by non-negative least
squares and rounded down; what is left is packed by best fit, again on the
histogram. The fit keeps a set of active patterns, at most as many as there are
lengths, so rounding takes little away. The plan is a bounded list of rank ranges per length. Pieces find their
place by their rank among the pieces of their length, which every task numbers for
itself and a table of sums puts in sequence, so no group of equal lengths ever
meets in one task.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.blocks import blocks
from gaugeflow.llm.scale import mapped
from gaugeflow.llm.token_ids import encoder
from gaugeflow.session import written

CAPACITY = 1024
# Patterns that may become active at once, and the gain of a sequence's share below which none does.
JOINING = 128
LEAST_GAIN = 0.5
NOTHING = 1e-9


def cut(length, capacity):
    """Start and length of each piece; all but the first are full."""
    pieces = -(-length // capacity)
    first = length - (pieces - 1) * capacity
    return [(0, first)] + [(first + i * capacity, capacity) for i in range(pieces - 1)]


def token_pieces(docs: DataFrame, model, end_id, capacity=CAPACITY, id_col="doc_id",
                 text_col="text", keep_ids=False) -> DataFrame:
    """Pieces of every text: id, piece, start, length, ids_crc32, task and rank, written once.

    A text's ids are those of the tokenizer file `model` plus `end_id`; null counts as
    empty. `rank` numbers the pieces of a length within the task that made them. With
    `keep_ids` the ids come along as little-endian 32-bit numbers.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def pieces(batches):
        own, task, seen = encoder(model), TaskContext.get().partitionId(), Counter()
        for block in blocks(batches, "text"):
            at, out = [], []
            for row, text in enumerate(block.column("text").to_pylist()):
                ids = np.append(own.ids(text), end_id).astype("<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    data = ids[start : start + length].tobytes()
                    at.append(row)
                    out.append((piece, start, length, zlib.crc32(data), task, seen[length],
                                data if keep_ids else None))
                    seen[length] += 1
            columns = list(zip(*out))
            kinds = [pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [block.column("id").take(pa.array(at)), *map(pa.array, columns, kinds)],
                names=["id", "piece", "start", "length", "ids_crc32", "task", "rank", "ids"],
            )

    schema = (
        f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "task int, rank bigint, ids binary"
    )
    made = mapped(rows, pieces, schema).withColumnRenamed("id", id_col)
    return written(made if keep_ids else made.drop("ids"), "pieces")


def patterns(lengths, capacity):
    """All pairs and threes of lengths that fill a sequence exactly."""
    present = set(lengths)
    found = [(a, capacity - a) for a in lengths if a <= capacity - a and capacity - a in present]
    return found + [
        (a, b, capacity - a - b)
        for i, a in enumerate(lengths)
        for b in lengths[i:]
        if capacity - a - b >= b and capacity - a - b in present
    ]


def active_counts(active, wanted, counts):
    """Which columns of `active` stay, and their non-negative counts of least squared misfit.

    Columns that would be negative leave at once; if that has not come to an end after a
    few times, the counts go towards the solution only until the first reaches zero.
    """
    kept, turns = np.arange(active.shape[1]), 0
    while len(kept):
        own = active[:, kept]
        normal = own.T @ own
        normal[np.diag_indices_from(normal)] += NOTHING
        solved = np.linalg.solve(normal, own.T @ wanted)
        bad, turns = solved <= NOTHING, turns + 1
        if not bad.any():
            return kept, solved
        if turns <= 4:
            counts, kept = solved[~bad], kept[~bad]
            continue
        share = np.where(bad, counts / np.maximum(counts - solved, NOTHING), 1.0)
        counts = counts + min(1.0, share[bad].min()) * (solved - counts)
        stays = ~(bad & (counts <= NOTHING))
        stays[np.argmin(share)] = False
        counts, kept = np.maximum(counts[stays], 0.0), kept[stays]
    return kept, np.zeros(0)


def fit_counts(found, histogram):
    """(pattern, count) of non-negative least squares: patterns times counts against the histogram.

    Patterns with the steepest gain become active, those of no length in common at once;
    the counts of all active ones are then solved together. As soon as a round gains
    nothing, fewer join, in the end one at a time.
    """
    lengths = sorted(histogram)
    size, number = len(lengths), {a: i for i, a in enumerate(lengths)}
    # The last row stands for the third length that a pair does not have.
    parts = np.array([[*(number[a] for a in p), *[size] * (3 - len(p))] for p in found]).reshape(-1, 3)
    wanted = np.array([histogram[a] for a in lengths], dtype=float)
    same = (parts[:, :, None] == parts[:, None, :]) & (parts < size)[:, :, None]
    norms = np.sqrt(same.sum(axis=(1, 2)))

    def columns(chosen):
        made = np.zeros((size + 1, len(chosen)))
        np.add.at(made, (parts[chosen].ravel(), np.repeat(np.arange(len(chosen)), 3)), 1.0)
        return made[:size]

    chosen, counts, active = np.zeros(0, dtype=int), np.zeros(0), np.zeros((size, 0))
    best, joining = (np.inf, chosen, counts), JOINING
    while joining and len(found):
        left = wanted - active @ counts
        misfit = float(left @ left)
        if misfit < best[0] * (1 - NOTHING):
            best = (misfit, chosen, counts)
        else:
            joining //= 2
        gain = np.append(left, 0.0)[parts].sum(axis=1) / norms
        gain[chosen] = 0.0
        taken, new = np.zeros(size + 1, dtype=bool), []
        for j in np.argsort(-gain, kind="stable"):
            if gain[j] <= LEAST_GAIN or len(new) >= joining:
                break
            if not taken[parts[j]].any():
                new.append(j)
                taken[parts[j]], taken[size] = True, False
        if not new:
            break
        chosen = np.append(chosen, new)
        active = np.hstack([active, columns(np.array(new))])
        stay, counts = active_counts(active, wanted, np.append(counts, np.zeros(len(new))))
        chosen, active = chosen[stay], active[:, stay]
    return [(found[j], float(n)) for j, n in zip(*best[1:])]


def best_fit(histogram, capacity):
    """(pattern, repeats) that use a histogram up: the longest left, then the longest that fits.

    Each pattern is repeated until one of its lengths runs out, so there are at most
    as many patterns as lengths.
    """
    left = {a: n for a, n in histogram.items() if n}
    while left:
        space, parts = capacity, Counter()
        for a in sorted(left, reverse=True):
            take = min(space // a, left[a])
            if take:
                parts[a] = take
                space -= take * a
        repeats = min(left[a] // m for a, m in parts.items())
        yield tuple(parts.elements()), repeats
        for a, m in parts.items():
            left[a] -= m * repeats
            if not left[a]:
                del left[a]


def plan(histogram, capacity=CAPACITY):
    """Ranges (length, first rank, last rank, first sequence, pieces per sequence, place, offset).

    The pieces of a length take a range's ranks in turn: `per` neighbours of equal
    length share a sequence.
    """
    left = Counter({a: n for a, n in histogram.items() if a < capacity and n})
    chosen = []
    fitted = fit_counts(patterns(sorted(left), capacity), left)
    for pattern, count in sorted(fitted, key=lambda f: (-f[1], f[0])):
        parts = Counter(pattern)
        repeats = min(int(count + 1e-6), *(left[a] // m for a, m in parts.items()))
        if repeats > 0:
            chosen.append((pattern, repeats))
            for a, m in parts.items():
                left[a] -= m * repeats
    chosen += best_fit(left, capacity)
    if histogram.get(capacity):
        chosen.append(((capacity,), histogram[capacity]))
    ranges, used, sequence = [], Counter(), 0
    for parts, repeats in chosen:
        offset = 0
        for a, m in sorted(Counter(parts).items(), reverse=True):
            ranges.append((a, used[a], used[a] + m * repeats - 1, sequence, m, offset))
            used[a] += m * repeats
            offset += a * m
        sequence += repeats
    return ranges, sequence


def pack(pieces: DataFrame, capacity=CAPACITY) -> DataFrame:
    """All columns of `pieces` but task and rank, with sequence_id and offset.

    `pieces` has length (1 to capacity), task and rank as made by `token_pieces`. Every
    piece gets one place, sequences have no gaps, and two pieces never overlap.
    Repeated rows are packed as often as they occur. No pieces, no sequences.
    """
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    ranges, _ = plan(histogram, capacity)
    # At most one range per length and pattern, whatever the number of pieces.
    places = spark.createDataFrame(
        ranges or [(0, 0, -1, 0, 1, 0)],
        "length bigint, first bigint, last bigint, sequence bigint, per bigint, place bigint",
    )
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    shifts = per_task.select("task", "length", before.alias("before"))
    ranked = pieces.join(shifts, ["task", "length"]).withColumn(
        "_rank", F.col("rank") + F.col("before")
    )
    slot = F.col("_rank") - F.col("first")
    placed = ranked.join(
        F.broadcast(places.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("first"), F.col("last")),
    )
    own = [c for c in pieces.columns if c not in ("task", "rank")]
    return placed.select(
        *own,
        (F.col("sequence") + F.expr("(_rank - first) div per")).alias("sequence_id"),
        (F.col("place") + slot % F.col("per") * F.col("length")).alias("offset"),
    )


def assemble(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids (little-endian 32-bit numbers), from pieces with ids.

    A group is one sequence, at most `capacity` numbers.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda whole, p: F.concat(whole, p.ids))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def pack_documents(docs: DataFrame, model, end_id, capacity=CAPACITY, id_col="doc_id",
                   text_col="text") -> DataFrame:
    """Where every piece of every text goes: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece that holds only `end_id`. Null ids stay null,
    repeated rows are packed as often as they occur, other columns are ignored, an
    empty table gives an empty result.
    """
    return pack(token_pieces(docs, model, end_id, capacity, id_col, text_col), capacity)
