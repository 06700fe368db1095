"""Removal of word passages that repeat across documents, by super-k-mers.

A window is `n` consecutive words. Its minimiser is the least hash of the `m`-word
grams in it; consecutive windows of a text that share their minimiser travel together,
as one packed string of words, to the minimiser's bucket. Equal windows have equal
minimisers, so they meet in one bucket, where sorting brings them side by side.

Each task first settles what it can see itself: of equal packed strings only those with
the smallest id travel, the others are known to repeat. So a passage that millions of
documents share reaches its bucket about once per task. While a bucket is compared,
memory holds its distinct windows, not their occurrences. The strings that a task has
for the same part of the buckets are compressed together.

Windows that only touch a passage or phrase that very many documents share differ from
document to document, and yet have one minimiser. Such minimisers are counted in a sample
of the texts first; their windows travel singly, each dealt by the hash of its own words.
Equal windows still meet, whatever the sample says.

Words are compared by two independent 64-bit hashes of the window's words.
"""

from collections import defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.blocks import (
    blocks,
    flat,
    gram_hashes,
    mix,
    ragged,
    range_hashes,
    word_hashes,
    words,
)
from gaugeflow.llm.scale import counted_broadcast, mapped
from gaugeflow.session import written

WINDOW = 13
MINIMISER = 4
# Strings a task remembers as already on their way.
REMEMBERED = 50_000
SEND_BYTES = 1 << 20
# What a task gathers before it sends; larger loads compress better.
FLUSH_BYTES = 48 << 20
# A task looks at one sub-bucket of about this many windows at a time, and at a few in turn.
SUB_WINDOWS = 1 << 19
SUBS_PER_PARTITION = 8
CHUNK_WINDOWS = 1 << 19
# Windows are estimated from one in SAMPLE texts. A minimiser is hot from HOT_WINDOWS on, or
# from one in MOST_HOT of all windows, so that there are never more than MOST_HOT of them.
HOT_WINDOWS = 1 << 18
MOST_HOT = 1 << 21
SAMPLE = 64
LAST_ID = (1 << 63) - 1
_ZSTD = zstandard.ZstdCompressor(level=6)

_SENT = "sub int, settled boolean, load binary"
_RANGES = "owner bigint, row bigint, first int, windows int"


def super_kmers(hashes, before, n, m):
    """First word, number of windows, bucket and text of each run of windows."""
    grams, width = gram_hashes(hashes, m), n - m + 1
    count = max(0, len(hashes) - n + 1)
    least = grams[:count].copy()
    for k in range(1, width):
        np.minimum(least, grams[k : k + count], out=least)
    text = np.repeat(np.arange(len(before) - 1), np.diff(before))[:count]
    whole = np.flatnonzero(np.arange(count) + n <= before[text + 1])
    if not len(whole):
        return whole, whole, least[:0], whole
    least, text = least[whole], text[whole]
    head = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (text[1:] != text[:-1])])
    return whole[head], np.diff(np.r_[head, len(whole)]), least[head], text[head]


def runs(owner, row, first, windows):
    """Ranges sorted by owner and row, with those that touch or overlap joined."""
    order = np.lexsort((first, row, owner))
    owner, row, first = owner[order], row[order], first[order]
    end = first + windows[order]
    if not len(owner):
        return owner, row, first, end
    other = np.r_[False, (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])]
    shift = np.cumsum(other) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    head = np.r_[True, (first + shift)[1:] > reach[:-1]]
    last = np.r_[np.flatnonzero(head)[1:] - 1, len(owner) - 1]
    return owner[head], row[head], first[head], (reach - shift)[last] - first[head]


def groups(keys, owner):
    """Order by keys then owner, where groups begin in it, and each place's group's least owner."""
    order = np.argsort(keys[0])
    same = keys[0][order][1:] == keys[0][order][:-1]
    # Most keys are unique; only the others need the full order.
    shared = np.flatnonzero(np.r_[False, same] | np.r_[same, False]) if len(order) > 1 else order[:0]
    rows = order[shared]
    order[shared] = rows[np.lexsort((owner[rows], *[key[rows] for key in keys[::-1]]))]
    head = np.zeros(len(order), dtype=bool)
    head[:1] = True
    for key in keys:
        head[1:] |= key[order][1:] != key[order][:-1]
    return order, head, owner[order][head][np.cumsum(head) - 1]


def _packed(parts):
    """One compressed load of (owner, row, first, windows, sizes, strings) parts, column by column."""
    columns = [np.concatenate(x) for x in list(zip(*parts))[:5]]
    head = np.array([len(columns[0]), len(columns[4])], dtype=np.int64)
    strings = [p[5] for p in parts]
    return _ZSTD.compress(b"".join([head.tobytes(), *(c.tobytes() for c in columns), *strings]))


def _unpacked(load):
    """owner, row, first, windows, and the strings' bytes and offsets."""
    data = zstandard.ZstdDecompressor().decompress(load)
    count, strings = np.frombuffer(data, np.int64, 2).tolist()
    at, out = 16 + 16 * count, [np.frombuffer(data, np.int64, count, 16 + 8 * count * k) for k in (0, 1)]
    for size in (count, count, strings):
        out.append(np.frombuffer(data, np.int32, size, at))
        at += 4 * size
    offsets = np.r_[0, np.cumsum(out.pop(), dtype=np.int64)]
    return *out, np.frombuffer(data, np.uint8, offset=at), offsets


def _settled(sent, keys, owner):
    """Which strings repeat one with a smaller id, in this block or sent before by the task."""
    order, head, least = groups(keys, owner)
    leads, ids = order[head], np.diff(np.r_[np.flatnonzero(head), len(order)])
    known = least[head].copy()
    if len(sent) > REMEMBERED:
        sent.clear()
    for g, key in enumerate(zip(keys[0][leads].tolist(), keys[1][leads].tolist())):
        earlier = sent.get(key)
        if earlier is not None and earlier < known[g]:
            known[g] = earlier
        elif earlier is not None or ids[g] > 1:
            sent[key] = int(known[g])
    repeats = np.zeros(len(order), dtype=bool)
    repeats[order] = owner[order] > known[np.cumsum(head) - 1]
    return repeats


def _part(owner, row, first, windows, strings=()):
    sizes = np.array([len(x) + 1 for x in strings], dtype=np.int32)
    columns = [*(x.astype(np.int64) for x in (owner, row)), *(x.astype(np.int32) for x in (first, windows)), sizes]
    return *columns, b"".join([x for string in strings for x in (string, b" ")])


def _loads(pending, settled):
    """Everything gathered, a row for each sub-bucket, and one for the settled ranges."""
    loads = [(sub, False, _packed(parts)) for sub, parts in pending.items()]
    if settled:
        loads.append((next(iter(pending), 0), True, _packed(settled)))
    columns = list(zip(*loads)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.bool_(), pa.binary()))],
        names=["sub", "settled", "load"],
    )


def minimiser_counts(batches, n, m):
    """(minimiser, windows) of the texts, added up for each block."""
    for block in blocks(batches, "text", SEND_BYTES):
        data, offsets = flat(block.column("text"))
        starts, ends, before = words(data, offsets)
        _, windows, bucket, _ = super_kmers(word_hashes(data, starts, ends), before, n, m)
        keys, of = np.unique(bucket, return_inverse=True)
        total = np.bincount(of, windows, len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(total)], names=["minimiser", "windows"]
        )


def measured(rows: DataFrame, n, m):
    """The number of windows, and the sorted minimisers that are hot, both estimated from the sample."""
    some = rows.where(F.pmod(F.xxhash64("owner", "row", "text"), F.lit(SAMPLE)) == 0)
    counts = mapped(
        some.select("text"), lambda batches: minimiser_counts(batches, n, m), "minimiser bigint, windows bigint"
    )
    counts = written(counts.groupBy("minimiser").agg((F.sum("windows") * SAMPLE).alias("windows")), "minimisers")
    total = counts.agg(F.sum("windows")).first()[0] or 0
    hot = counts.where(F.col("windows") >= max(HOT_WINDOWS, total // MOST_HOT)).select("minimiser").toArrow()
    return total, np.sort(hot["minimiser"].to_numpy().astype(np.int64).view(np.uint64))


def send(batches, n, m, subs, hot=()):
    """(sub, settled, load): super-k-mers for the buckets, and ranges already known to repeat.

    Buckets are dealt to `subs` sub-buckets; what a task has gathered for one goes as one load.
    Windows of `hot` minimisers are buckets of their own.
    """
    hot = np.asarray(hot, dtype=np.uint64)
    sent, pending, ranges, size = {}, defaultdict(list), [], 0
    for block in blocks(batches, "text", SEND_BYTES):
        data, offsets = flat(block.column("text"))
        starts, ends, before = words(data, offsets)
        hashes = word_hashes(data, starts, ends)
        first, windows, bucket, text = super_kmers(hashes, before, n, m)
        if not len(first):
            continue
        owners, rows = (block.column(c).to_numpy() for c in ("owner", "row"))
        last = first + windows + n - 1
        both = hashes, word_hashes(data, starts, ends, seed=1)
        repeats = _settled(sent, [range_hashes(h, first, last) for h in both], owners[text])
        split = ~repeats & np.isin(bucket, hot)
        if split.any():
            single, of = ragged(first[split], windows[split]), np.repeat(text[split], windows[split])
            keys = [range_hashes(h, single, single + n) for h in both]
            repeats = np.r_[repeats[~split], _settled(sent, keys, owners[of])]
            first, text = np.r_[first[~split], single], np.r_[text[~split], of]
            windows = np.r_[windows[~split], np.ones_like(single)]
            bucket = np.r_[bucket[~split], mix(keys[0])]
            last = first + windows + n - 1
        owner, row = owners[text], rows[text]
        word = first - before[text]
        go = np.flatnonzero(~repeats)
        sub = (bucket[go] % np.uint64(subs)).astype(np.int64)
        order = np.argsort(sub, kind="stable")
        go, sub = go[order], sub[order]
        heads = np.flatnonzero(np.r_[True, sub[1:] != sub[:-1]]) if len(go) else go
        low, high = starts[first], ends[last - 1]
        for a, b in pairwise([*heads.tolist(), len(go)]):
            own = go[a:b]
            strings = [data[x:y].tobytes() for x, y in zip(low[own].tolist(), high[own].tolist())]
            pending[int(sub[a])].append(_part(owner[own], row[own], word[own], windows[own], strings))
        size += int((high - low)[go].sum()) + 24 * len(go)
        found = runs(owner[repeats], row[repeats], word[repeats], windows[repeats])
        if len(found[0]):
            ranges.append(_part(*found))
        if size > FLUSH_BYTES:
            yield _loads(pending, ranges)
            pending, ranges, size = defaultdict(list), [], 0
    yield _loads(pending, ranges)


def _ranges(owner, row, first, windows):
    found = runs(owner, row, first, windows)
    kinds = (np.int64, np.int64, np.int32, np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(x.astype(k)) for x, k in zip(found, kinds)],
        names=["owner", "row", "first", "windows"],
    )


def compare(batches, n):
    """Ranges of windows that also start in a text with a smaller id, sub-bucket by sub-bucket.

    Loads come sorted by sub-bucket. Of every distinct window the places with the least id
    so far are kept while the sub-bucket lasts; all others are known to repeat.
    """
    nothing = [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 3
    kept, current, held, size = nothing, None, [], 0

    def settle(kept, held):
        """Sorted by window then id: places beyond the least id repeat."""
        own = [np.concatenate(x) for x in zip(kept, *held)]
        order, _, least = groups(own[:2], own[2])
        later = own[2][order] > least
        out = [x[order[later]] for x in own[2:]]
        return [x[order[~later]] for x in own], _ranges(*out, np.ones(len(out[0]), np.int64))

    for batch in batches:
        for sub, settled, load in zip(*(batch.column(i) for i in range(3))):
            owner, row, first, windows, data, offsets = _unpacked(load.as_py())
            if settled.as_py():
                yield _ranges(owner, row, first, windows)
                continue
            if sub.as_py() != current or size > CHUNK_WINDOWS:
                if held:
                    kept, found = settle(kept, held)
                    yield found
                kept = kept if sub.as_py() == current else nothing
                current, held, size = sub.as_py(), [], 0
            starts, ends, before = words(data, offsets)
            at = ragged(before[:-1], windows)
            of = np.repeat(np.arange(len(windows)), windows)
            keys = [gram_hashes(word_hashes(data, starts, ends, seed), n)[at] for seed in (0, 1)]
            place = (first - before[:-1])[of] + at
            held.append([*keys, owner[of], row[of].astype(np.int64), place])
            size += len(at)
    if held:
        yield settle(kept, held)[1]


def keep_words(text, found, n):
    """Number of words, number removed, and the kept words joined by one space."""
    parts = text.encode().split()
    if found is None or not len(found):
        return len(parts), 0, b" ".join(parts).decode()
    stays = np.ones(len(parts), dtype=bool)
    for x in found:
        stays[x["first"] : x["first"] + x["windows"] + n - 1] = False
    kept = [parts[i] for i in np.flatnonzero(stays)]
    return len(parts), len(parts) - len(kept), b" ".join(kept).decode()


def repeated_ranges(rows: DataFrame, n=WINDOW, m=MINIMISER) -> DataFrame:
    """(owner, row, found) of rows (owner, row, text): the runs of repeating windows, as an array."""
    context = rows.sparkSession.sparkContext
    total, found = measured(rows, n, m)
    partitions = max(context.defaultParallelism, -(-total // (SUB_WINDOWS * SUBS_PER_PARTITION)))
    subs, hot = SUBS_PER_PARTITION * partitions, context.broadcast(found)
    sent = mapped(rows, lambda batches: send(batches, n, m, subs, hot.value), _SENT)
    dealt = sent.repartition(partitions, "sub").sortWithinPartitions("sub")
    found = mapped(dealt, lambda batches: compare(batches, n), _RANGES)
    # A text's ranges are fewer than its words.
    return found.groupBy("owner", "row").agg(
        F.collect_set(F.struct("first", "windows")).alias("found")
    )


def drop_repeats(docs: DataFrame, id_col="doc_id", text_col="text", n=WINDOW, m=MINIMISER) -> DataFrame:
    """id, n_words, n_removed and the kept text of every row.

    A word goes if a window of n words that covers it also starts in a row with a
    smaller id. Windows are judged on the input. Null and empty texts have no words; a
    null id counts as larger than any other and null ids as equal; rows with the same
    id never remove each other's words; ids are whole numbers. Other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    owner = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("owner")
    rows = docs.select(F.col(id_col).alias("id"), owner, text.alias("text"))
    # Rows of one id are told apart by a hash of the text; all others need none.
    several = rows.groupBy("owner").agg(F.count("*").alias("n")).where("n > 1")
    several = counted_broadcast(written(several.select("owner", F.lit(True).alias("_several")), "owners"))
    row = F.when(F.col("_several"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    rows = rows.join(several, "owner", "left").withColumn("row", row).drop("_several")
    # As large as the repeats in the corpus, so it is joined by shuffle at any size.
    ranges = written(repeated_ranges(rows.select("owner", "row", "text"), n, m), "ranges")

    def keep(batches):
        for block in blocks(batches, "text"):
            kept = [
                keep_words(t, f, n)
                for t, f in zip(block.column("text").to_pylist(), block.column("found").to_pylist())
            ]
            n_words, n_removed, left = zip(*kept)
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), pa.array(n_words), pa.array(n_removed), pa.array(left, pa.string())],
                names=["id", "n_words", "n_removed", "kept"],
            )

    joined = rows.join(ranges, ["owner", "row"], "left").select("id", "text", "found")
    out = mapped(joined, keep, f"id {kind}, n_words bigint, n_removed bigint, kept string")
    return out.withColumnRenamed("id", id_col)
