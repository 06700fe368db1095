"""Near-duplicate documents: HyperMinHash registers, banding, estimates, exact links.

1. A text's set of word shingles becomes `BUCKETS` registers. A shingle's hash picks the
   bucket; the bucket keeps its least remaining hash as a count of leading zeros and some
   mantissa bits, 16 bits in all. A bucket that no shingle fell into takes the least of
   another hash of its own, so short texts have full sketches too. Equal sets are one node.
2. Nodes that agree in all registers of a band share a bucket. Within a bucket the
   registers estimate similarities, corrected for chance collisions, and nodes that may
   be similar are joined: candidate groups.
3. The full sets of each candidate group meet, and exact links are confirmed.

Steps 2 and 3 look at all pairs of a bucket or group in numpy, a node against those not
reached yet, and hand on at most one edge per node: neither the pairs nor the failures
ever become rows. A bucket or group above a bound is dealt out in chunks, and each pair
of chunks is a piece of work, so no task gathers more than two chunks.

A pair at a threshold t is missed by banding with probability (1 - t**4)**32, 6e-11 at
0.85 and 5e-8 at 0.8, by the estimate with less than 1e-10.
"""

from fractions import Fraction
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.blocks import (
    LOWER,
    blocks,
    flat,
    gram_hashes,
    mix,
    range_hashes,
    word_hashes,
    words,
)
from gaugeflow.llm.components import components
from gaugeflow.llm.scale import counted_broadcast, mapped
from gaugeflow.session import written

SHINGLE = 5
THRESHOLD = 0.85
# Below it, banding would miss too many pairs.
LEAST_THRESHOLD = 0.8
BUCKETS, MANTISSA_BITS = 128, 10
BAND = 4
# A pair at the threshold may be missed by its estimate with this probability.
MISSED = 1e-10
# Sizes of a chunk. Nodes of a bucket: small chunks spread a bucket over more tasks, large ones
# copy a node less often, so they grow with the root of the bucket between two bounds.
CHUNK_NODES, MAX_CHUNK_NODES = 512, 8192
# Shingles of a candidate group.
CHUNK_SHINGLES = 1 << 20
LAST_ID = (1 << 63) - 1

_EDGES = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(57)
_OTHER = mix(np.arange(1, BUCKETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def as_fraction(threshold):
    """The threshold as the exact decimal that it is written as."""
    if not LEAST_THRESHOLD <= threshold < 1:
        raise ValueError(f"threshold {threshold} is not in [{LEAST_THRESHOLD}, 1)")
    return Fraction(str(threshold))


def least_estimate(threshold):
    """What the estimate of a pair at the threshold falls below with probability below MISSED."""
    t, below = float(as_fraction(threshold)), 0.0
    for count in range(BUCKETS + 1):
        below += comb(BUCKETS, count) * t**count * (1 - t) ** (BUCKETS - count)
        if below >= MISSED:
            # Half a register less, for the correction of chance matches.
            return (count - 0.5) / BUCKETS


def least_linked(threshold):
    """Size of the smallest set that another set can be similar to: n of n + 1 shingles shared."""
    t = as_fraction(threshold)
    return ceil(t / (1 - t))


def shingle_sets(texts, n=SHINGLE):
    """Sorted shingle hashes of each text of an Arrow array."""
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, before = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    grams = gram_hashes(hashes, n)
    whole = range_hashes(hashes, before[:-1], before[1:])
    for text, (a, b) in enumerate(zip(before[:-1], before[1:])):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        else:
            yield whole[text : text + 1] if b > a else grams[:0]


def _compressed(least):
    """Leading zeros and the first bits after the leading one."""
    fraction, exponent = np.frexp(least.astype(np.float64))
    bits = ((fraction * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    zeros = np.clip(64 - exponent, 0, 63)
    return ((zeros << MANTISSA_BITS) | np.clip(bits, 0, (1 << MANTISSA_BITS) - 1)).astype(np.uint16)


def registers(shingles):
    """The 16-bit registers of a sorted set that is not empty."""
    first = np.searchsorted(shingles, _EDGES)
    filled = np.diff(np.r_[first, len(shingles)]) > 0
    least = np.empty(BUCKETS, dtype=np.uint64)
    least[filled] = shingles[first[filled]] << np.uint64(7)
    empty = np.flatnonzero(~filled)
    for k in range(0, len(empty), 16):
        at = empty[k : k + 16]
        least[at] = mix(shingles[:, None] ^ _OTHER[at][None, :]).min(axis=0)
    return _compressed(least)


def node_key(shingles):
    """128 bits that stand for the whole set."""
    end = np.array([len(shingles)])
    halves = [range_hashes(s, end * 0, end) for s in (shingles, mix(shingles))]
    return np.concatenate(halves).tobytes()


def estimated(equal, n, others):
    """Jaccard estimates from matching registers, less the matches expected by chance."""
    ratio = others / n
    chance = 0.16992 * 4 * ratio / (1 + ratio) ** 2 / (1 << MANTISSA_BITS)
    return (equal / BUCKETS - chance) / (1 - chance)


def spread(count, linked):
    """Roots and members of the groups that `linked(x, rest)` (a mask) makes of count items."""
    rest, out = np.arange(count), []
    while len(rest):
        root, rest, queue = rest[0], rest[1:], [rest[0]]
        while queue and len(rest):
            hit = linked(queue.pop(), rest)
            found, rest = rest[hit], rest[~hit]
            out += [(root, x) for x in found]
            queue += found.tolist()
    return out


def keyed_groups(batches, keys, limit):
    """Record batches cut at changes of the key columns; no group is split.

    Input is sorted by the keys. Yields tables of whole groups, about `limit` bytes each,
    with the first row of every group.
    """
    held, size = [], 0

    def cut(table):
        changed = np.zeros(table.num_rows, dtype=bool)
        changed[:1] = True
        for key in keys:
            column = table.column(key).combine_chunks()
            if pa.types.is_binary(column.type):
                column = column.dictionary_encode().indices
            column = column.to_numpy(zero_copy_only=False)
            changed[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(changed)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < limit:
            continue
        table = pa.Table.from_batches(held)
        heads = cut(table)
        if len(heads) > 1:
            yield table.slice(0, heads[-1]), heads[:-1]
            rest = table.slice(heads[-1]).combine_chunks()
            held, size = rest.to_batches(), rest.nbytes
        # A longer group is looked at again only when it has doubled.
        limit = max(limit, 2 * size) if len(heads) == 1 else limit
    if held:
        table = pa.Table.from_batches(held)
        yield table, cut(table)


def _pairs(nodes, found):
    a, b = (np.array(x, dtype=np.int64) for x in zip(*found)) if found else (np.zeros(0, int),) * 2
    return pa.RecordBatch.from_arrays(
        [nodes.take(pa.array(a)), nodes.take(pa.array(b))], names=["a", "b"]
    )


def likely_edges(batches, least):
    """At most one edge per member of a bucket, between nodes whose estimate is `least` or more."""
    for table, heads in keyed_groups(batches, ("key", "low", "high"), 4 << 20):
        nodes = table.column("node").combine_chunks()
        n = table.column("n").to_numpy()
        sketch, _ = flat(table.column("registers"))
        sketch = sketch.view(np.uint16).reshape(-1, BUCKETS)
        sizes = np.diff(np.r_[heads, len(nodes)])
        lead = np.repeat(heads, sizes)
        near = estimated((sketch == sketch[lead]).sum(axis=1), n[lead], n) >= least
        group = np.repeat(np.arange(len(heads)), sizes)
        all_near = np.logical_and.reduceat(near, heads)
        star = np.flatnonzero(all_near[group] & (lead != np.arange(len(nodes))))
        found = list(zip(lead[star].tolist(), star.tolist()))
        for g in np.flatnonzero(~all_near & (sizes > 2)):
            own = slice(heads[g], heads[g] + sizes[g])
            s, m = sketch[own], n[own]
            found += [
                (heads[g] + a, heads[g] + b)
                for a, b in spread(
                    sizes[g],
                    lambda x, rest: estimated((s[rest] == s[x]).sum(axis=1), m[x], m[rest]) >= least,
                )
            ]
        yield _pairs(nodes, found)


def exact_edges(batches, threshold):
    """At most one confirmed edge per member of a candidate group."""
    part, whole = as_fraction(threshold).as_integer_ratio()
    for table, heads in keyed_groups(batches, ("component", "low", "high"), 8 << 20):
        nodes = table.column("node").combine_chunks()
        data, offsets = flat(table.column("shingles"))
        values, offsets = data.view(np.uint64), offsets // 8
        found = []
        for first, last in zip(heads, np.r_[heads[1:], len(nodes)]):
            if last - first < 2:
                continue
            inside = values[offsets[first] : offsets[last]]
            numbers = np.unique(inside, return_inverse=True)[1]
            at = offsets[first : last + 1] - offsets[first]
            sizes = np.diff(at)
            mark = np.zeros(len(inside), dtype=bool)

            def linked(x, rest):
                own = numbers[at[x] : at[x + 1]]
                mark[own] = True
                if 4 * len(rest) >= len(sizes):
                    shared = np.add.reduceat(mark[numbers], at[:-1], dtype=np.int64)[rest]
                else:
                    shared = np.array([np.count_nonzero(mark[numbers[at[r] : at[r + 1]]]) for r in rest])
                mark[own] = False
                return whole * shared >= part * (sizes[x] + sizes[rest] - shared)

            found += [(first + a, first + b) for a, b in spread(last - first, linked)]
        yield _pairs(nodes, found)


def dealt(rows: DataFrame, chunks, *spread_by) -> DataFrame:
    """Rows copied to every pair of chunks (low <= high) that holds their own chunk."""
    own = F.pmod(F.xxhash64(*spread_by, F.lit(5)), chunks).cast("int")
    copies = rows.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), (chunks - 1).cast("int")))
    )
    return copies.withColumns(
        {"low": F.least("_own", "_other"), "high": F.greatest("_own", "_other")}
    ).drop("_own", "_other")


def grouped(rows: DataFrame, *keys) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def sketches(rows: DataFrame, threshold) -> DataFrame:
    """(owner, row, n, node, registers) of rows (owner, row, text); null node without words."""
    smallest = least_linked(threshold)

    def sketch(batches):
        for block in blocks(batches, "text"):
            sets = list(shingle_sets(block.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("owner"),
                    block.column("row"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([node_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(
                        [registers(s).tobytes() if len(s) >= smallest else None for s in sets],
                        pa.binary(),
                    ),
                ],
                names=["owner", "row", "n", "node", "registers"],
            )

    return mapped(
        rows,
        sketch, "owner bigint, row bigint, n bigint, node binary, registers binary"
    )


def candidate_groups(nodes: DataFrame, threshold) -> DataFrame:
    """(node, component) of nodes that some bucket and its estimates join to another."""
    known = nodes.where("registers IS NOT NULL")
    bands = [
        F.xxhash64(F.lit(b), F.substring("registers", 2 * BAND * b + 1, 2 * BAND))
        for b in range(BUCKETS // BAND)
    ]
    members = known.select("node", F.explode(F.array(*bands)).alias("key"))
    crowds = members.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = members.join(crowds, "key")
    size = F.greatest(F.lit(float(CHUNK_NODES)), 4 * F.sqrt("members"))
    chunks = F.ceil(F.col("members") / F.least(size, F.lit(float(MAX_CHUNK_NODES))))
    copies = dealt(members, chunks, "node").select("key", "low", "high", "node")
    sketched = copies.join(known.select("node", "n", "registers"), "node")
    least = least_estimate(threshold)
    sketched = grouped(sketched, "key", "low", "high")
    edges = mapped(sketched, lambda batches: likely_edges(batches, least), "a binary, b binary")
    return components(edges)


def confirmed_links(rows: DataFrame, nodes: DataFrame, groups: DataFrame, threshold) -> DataFrame:
    """Edges (a, b) between nodes whose full sets are similar, enough to connect all that are."""
    members = groups.join(nodes.select("node", "n", "pick"), "node")
    weight = members.groupBy("component").agg(F.sum("n").alias("weight"))
    members = members.join(weight, "component").select(
        "pick.owner", "pick.row", "node", "component",
        F.ceil(F.col("weight") / CHUNK_SHINGLES).alias("chunks"),
    )
    wanted = counted_broadcast(written(members, "members"), F.lit(48))
    texts = rows.join(wanted, ["owner", "row"]).select("component", "chunks", "node", "text")

    def sets(batches):
        for block in blocks(batches, "text"):
            found = [s.tobytes() for s in shingle_sets(block.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [block.column(c) for c in ("component", "chunks", "node")]
                + [pa.array(found, pa.binary())],
                names=["component", "chunks", "node", "shingles"],
            )

    full = mapped(
        texts, sets, "component binary, chunks bigint, node binary, shingles binary"
    )
    copies = dealt(full, F.col("chunks"), "node").drop("chunks")
    copies = grouped(copies, "component", "low", "high")
    return mapped(copies, lambda batches: exact_edges(batches, threshold), "a binary, b binary")


def with_keys(docs: DataFrame, id_col, text_col):
    """The key of a row: its id, or the largest long for null, and the hash of its text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)), F.xxhash64(text), text


def placements(
    docs: DataFrame, id_col="doc_id", text_col="text", threshold=THRESHOLD
) -> DataFrame:
    """(owner, row, n, node, least) of every row: its set's size and its component's least owner."""
    owner, row, text = with_keys(docs, id_col, text_col)
    rows = docs.select(owner.alias("owner"), row.alias("row"), text.alias("text"))
    sketched = written(sketches(rows, threshold), "sketches")
    nodes = sketched.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("owner", "row")).alias("pick"),
        F.max("n").alias("n"),
        F.max("registers").alias("registers"),
    )
    nodes = written(nodes, "nodes")
    groups = written(candidate_groups(nodes, threshold), "groups")
    linked = components(written(confirmed_links(rows, nodes, groups, threshold), "links"))
    joined = nodes.select("node", "pick").join(linked, "node")
    least = joined.groupBy("component").agg(F.min("pick").alias("least"))
    named = linked.join(least, "component").select("node", "least")
    of_node = nodes.select("node", F.col("pick").alias("own")).join(named, "node", "left")
    of_node = of_node.select("node", F.coalesce("least", "own").alias("least"))
    placed = sketched.select("owner", "row", "n", "node").join(of_node, "node", "left")
    alone = F.struct("owner", "row")
    return placed.select("owner", "row", "n", "node", F.coalesce("least", alone).alias("least"))


def near_duplicates(
    docs: DataFrame, id_col="doc_id", text_col="text", threshold=THRESHOLD
) -> DataFrame:
    """id, n_shingles, component_id (least id reachable over links) and kept of every row.

    Sets are the distinct 5-word shingles of the text with A-Z lowered, or the whole
    sequence if it has fewer words; rows are linked from a similarity of `threshold`. Null and
    empty texts have no set and are their own component. A null id counts as larger than
    any other; a component of null ids has a null id, and its rows are kept. Rows that
    repeat an id are all kept if it names the component. Other columns are ignored.
    """
    placed = placements(docs, id_col, text_col, threshold)
    component = F.col("least.owner")

    def id_of(column):
        return F.when(column < LAST_ID, column)

    return placed.select(
        id_of(F.col("owner")).alias(id_col),
        F.col("n").alias("n_shingles"),
        id_of(component).alias("component_id"),
        (F.col("owner") == component).alias("kept"),
    )


def one_of_each(
    docs: DataFrame, id_col="doc_id", text_col="text", threshold=THRESHOLD
) -> DataFrame:
    """The rows of `docs`, all columns, with one row of each component; wordless rows all stay.

    Components are those of `near_duplicates` at the same threshold.

    The row with the least id stays, among equal ids that with the least text hash, and
    of rows equal in both any one.
    """
    placed = written(placements(docs, id_col, text_col, threshold), "placements")
    stays = placed.where((F.col("least.owner") == F.col("owner")) & (F.col("least.row") == F.col("row")))
    stays = stays.groupBy(F.col("owner").alias("_owner"), F.col("row").alias("_row")).agg(
        F.count("*").alias("_copies"), F.first("node").isNotNull().alias("_worded")
    )
    stays = counted_broadcast(written(stays, "stays"))
    owner, row, _ = with_keys(docs, id_col, text_col)
    names = [F.col(f"`{c}`") for c in docs.columns]
    found = docs.select(*names, owner.alias("_owner"), row.alias("_row")).join(stays, ["_owner", "_row"])
    twice = (F.col("_copies") > 1) & F.col("_worded")
    once = found.where(~twice).select(*names)
    # Only rows that repeat both id and text are shuffled.
    return once.unionAll(found.where(twice).dropDuplicates(["_owner", "_row"]).select(*names))
