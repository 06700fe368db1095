"""The trie of conversation prefixes, with totals over subtrees by time-forward processing.

A node is a distinct sequence of first turns. It is known by its depth and 128 bits: the
exclusive or of two 64-bit hashes of (place, role, text) over its turns, so that the
prefixes of one long conversation can be worked out in parts.

Totals go up in two steps. Nodes whose subtree may have many rows are the top of the
trie, at most TOP_SHARE of them on a level; what hangs below them are subtrees of
limited size, the shards. Each task sorts the nodes of its shards in reverse level order
(Spark's sort, which spills) and passes totals to parents through a spilling priority
queue. The totals of the shards' roots are added up by parent, also where one parent has
most of them, and the same process runs over the top, in bands of BAND levels.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.forward import Totals
from gaugeflow.llm.scale import counted_broadcast, mapped
from gaugeflow.operators.series import GROUP_LIMIT, series_index
from gaugeflow.operators.skew import per_key_join
from gaugeflow.session import written

# A subtree belongs to the top if its rows may be over this share of all, and over LEAST_ROWS.
TOP_SHARE = 1000
LEAST_ROWS = 256
BAND = 1 << 16
DIGEST_BYTES = 1 << 16
KEY = ["depth", "k1", "k2"]


def ordered_turns(turns: DataFrame, conv_col, turn_col, role_col, text_col) -> DataFrame:
    """conv_id, idx (from 0), n, role, text; null ids are dropped, null roles and texts empty."""
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    return series_index(rows, "conv_id", "turn", ("role", "text")).drop("turn")


def rebuilt(turns: DataFrame, heads=6, stride=100):
    """Turns of the rebuilt conversations (conv_id, depth from 1, role, text, length), and their lengths.

    Conversation c begins with the first h turns of conversation c - c % stride, where h is
    crc32 of c's decimal digits modulo `heads`, and goes on with its own turns after its
    first h. The second frame has one row per conversation, also for those without turns.
    """
    c = F.col("conv_id")
    first = F.col("idx") == 0
    convs = turns.where(first).select(
        "conv_id", "n", (c - c % stride).alias("base"), (F.crc32(c.cast("string").cast("binary")) % heads).alias("h")
    )
    bases = turns.where(first).select(c.alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    lengths = convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
    )
    lengths = written(lengths, "trie-lengths")
    # A conversation lends at most `heads` turns to at most `stride` others.
    lent = turns.where(F.col("idx") < heads - 1).select(c.alias("base"), "idx", "role", "text")
    borrowed = lengths.join(lent, "base").where("idx < h").select(
        "conv_id", (F.col("idx") + 1).alias("depth"), "role", "text", "length"
    )
    own = per_key_join(turns.select("conv_id", "idx", "role", "text"), lengths, ["conv_id"]).where("idx >= h")
    own = own.select("conv_id", (F.col("taken") + F.col("idx") - F.col("h") + 1).alias("depth"), "role", "text", "length")
    return borrowed.union(own), lengths.select("conv_id", "length")


def prefix_keys(rows: DataFrame, crowded) -> DataFrame:
    """conv_id, depth, length, chars, and the keys of the prefix that ends here and of its parent.

    If some conversation is `crowded`, ranges of (conv_id, depth) become groups of their
    own, and each gets what the ranges before it have added up to.
    """
    place = [F.col("depth"), F.col("role"), F.col("text")]
    hashed = rows.select(
        "conv_id", "depth", "length", F.length("text").cast("long").alias("chars"),
        F.xxhash64(F.lit(1), *place).alias("h1"), F.xxhash64(F.lit(2), *place).alias("h2"),
    )
    group = ["conv_id"]
    if crowded:
        hashed = written(
            hashed.repartitionByRange("conv_id", "depth").withColumn("_pid", F.spark_partition_id()), "trie-turns"
        )
        group = ["conv_id", "_pid"]
    so_far = Window.partitionBy(*group).orderBy("depth")
    keyed = hashed.withColumns({f"k{i}": F.bit_xor(f"h{i}").over(so_far) for i in (1, 2)})
    if crowded:
        parts = hashed.groupBy(*group).agg(*[F.bit_xor(f"h{i}").alias(f"x{i}") for i in (1, 2)])
        before = Window.partitionBy("conv_id").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        carried = parts.select(*group, *[F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"c{i}") for i in (1, 2)])
        keyed = per_key_join(keyed, carried, group)
        keyed = keyed.withColumns({f"k{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"c{i}")) for i in (1, 2)})
    parents = [F.col(f"k{i}").bitwiseXOR(F.col(f"h{i}")).alias(f"p{i}") for i in (1, 2)]
    return keyed.select("conv_id", "depth", "length", "chars", "k1", "k2", *parents)


def trie_nodes(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node: key, parent's key, conv_id, n_convs, saved, and the most rows below it.

    Members are counted in each task first, however many share a node. The root has no
    parent and no text.
    """
    below = F.sum(F.col("length") - F.col("depth") + 1)
    inner = prefixes.groupBy(*KEY).agg(
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        ((F.count("*") - 1) * F.max("chars")).alias("saved"),
        below.alias("below"),
    )
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    root = lengths.agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.coalesce(F.sum("length"), zero).alias("below")
    ).where("n_convs > 0")
    root = root.select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"),
        "conv_id", "n_convs", zero.alias("saved"), "below",
    )
    return inner.select(root.columns).union(root)


def passed_up(nodes: DataFrame) -> DataFrame:
    """`nodes` with children, leaves and saved of their whole subtrees within a shard.

    `nodes` has `shard`, the key, the parent's key, and what has come from outside. Each
    task processes whole shards one after the other, in reverse level order.
    """
    made = ("children", "leaves", "saved")
    columns = [c for c in nodes.columns if c not in made]
    ordered = nodes.select(*columns, *made).repartition("shard")
    ordered = ordered.sortWithinPartitions("shard", F.desc("depth"), "k1", "k2")

    def process(batches):
        through = Totals()
        for batch in batches:
            found = []
            for shard, depth, k1, k2, p1, p2, *own in zip(
                *(batch.column(c).to_pylist() for c in ("shard", *KEY, "p1", "p2", *made))
            ):
                parent = None if p1 is None else (1 - depth, p1, p2)
                found.append(through.node(shard, (-depth, k1, k2), parent, *own))
            if found:
                kinds = [pa.array(values, pa.int64()) for values in zip(*found)]
                yield pa.RecordBatch.from_arrays([*map(batch.column, columns), *kinds], names=[*columns, *made])

    return mapped(ordered, process, ordered.schema)


def subtree_totals(nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Every node with the children, leaves and saved of its whole subtree.

    `nodes` and `prefixes` are written tables.
    """
    rows, deepest = nodes.agg(F.coalesce(F.max("below"), F.lit(0)), F.coalesce(F.max("depth"), F.lit(0))).first()
    limit = max(LEAST_ROWS, rows // TOP_SHARE)
    is_top = (F.col("below") > limit) | (F.col("depth") == 0)
    top = written(nodes.where(is_top), "trie-top")
    # How far down each conversation's prefixes belong to the top; a node's parent always does if it does.
    marked = counted_broadcast(top.where("depth > 0").select(*KEY))
    in_top = prefixes.select("conv_id", *KEY).join(marked, KEY).groupBy("conv_id").agg(F.max("depth").alias("cut"))
    cut = F.coalesce("cut", F.lit(0))
    roots = prefixes.select("conv_id", *KEY).join(in_top, "conv_id", "left").where(F.col("depth") == cut + 1)
    roots = roots.select("conv_id", cut.alias("cut"), F.xxhash64("k1", "k2").alias("shard"))
    nothing = {c: F.lit(0).cast("long") for c in ("children", "leaves")}
    light = per_key_join(nodes.where(~is_top).withColumns(nothing), roots, ["conv_id"])
    low = written(passed_up(light), "trie-shards")
    messages = low.where(F.col("depth") == F.col("cut") + 1)
    out = [low.drop("shard", "cut")]
    # The top, from its deepest band of levels to the root.
    for band in reversed(range(deepest // BAND + 1)):
        inside = F.expr(f"depth DIV {BAND} = {band}")
        here = top.where(inside)
        if band and here.isEmpty():
            continue
        from_below = messages.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        sums = from_below.agg(
            F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("more")
        )
        seeded = here.join(sums, KEY, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("children", "leaves", "more")})
        seeded = seeded.withColumn("saved", F.col("saved") + F.col("more")).drop("more")
        done = written(passed_up(seeded.withColumn("shard", F.lit(band).cast("long"))), "trie-band").drop("shard")
        out.append(done)
        messages = messages.select(done.columns).union(done.where(F.col("depth") == band * BAND))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending conv_ids, joined by commas, for each key of `ends`.

    Ids are sorted over ranges of (key, id), so a key with very many becomes many tasks;
    each makes texts of up to DIGEST_BYTES from its ids, and only these texts follow one
    another through a key's digest, which keeps nothing but its state.
    """
    key_schema = "depth long, k1 long, k2 long"

    def texts(batches):
        kind = pa.schema([(c, pa.int64()) for c in (*KEY, "first")] + [("ids", pa.string())])
        key, ids, first, size = None, [], None, 0

        def joined():
            return dict(zip(KEY, key), first=first, ids=",".join(ids))

        for batch in batches:
            rows = []
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in (*KEY, "conv_id"))):
                if at != key or size > DIGEST_BYTES:
                    rows += [joined()] if ids else []
                    key, ids, first, size = at, [], conv, 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield pa.RecordBatch.from_pylist(rows, schema=kind)
        yield pa.RecordBatch.from_pylist([joined()] if ids else [], schema=kind)

    ranged = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    made = mapped(ranged, texts, f"{key_schema}, first long, ids string")
    dealt = made.repartition(*KEY).sortWithinPartitions(*KEY, "first")

    def digests(batches):
        key, state = None, None
        kind = pa.schema([(c, pa.int64()) for c in KEY] + [("ends_sha256", pa.string())])
        for batch in batches:
            rows = []
            for *at, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if at != key:
                    if key is not None:
                        rows.append(dict(zip(KEY, key), ends_sha256=state.hexdigest()))
                    key, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist(rows, schema=kind)
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(KEY, key), ends_sha256=state.hexdigest())], schema=kind)

    return mapped(dealt, digests, f"{key_schema}, ends_sha256 string")


def prefix_trie(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text",
                heads=6, stride=100, group_limit=GROUP_LIMIT) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are in the order of `turn_col`, null first, equal ones by role and text; repeated
    rows are turns of their own. A null role or text is empty; rows without a conversation
    are dropped; other columns are ignored. Conversations are rebuilt as `rebuilt` says; one
    that ends up without turns is a member of the root only. An empty table has no root.
    """
    ordered = written(ordered_turns(turns, conv_col, turn_col, role_col, text_col), "trie-ordered")
    rows, lengths = rebuilt(ordered, heads, stride)
    longest = lengths.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]
    prefixes = written(prefix_keys(rows, longest > group_limit), "trie-prefixes")
    nodes = written(trie_nodes(prefixes, lengths), "trie-nodes")
    whole = subtree_totals(nodes, prefixes)
    ends = prefixes.where("depth = length").select(*KEY, "conv_id")
    zero = F.lit(0).cast("long")
    turnless = lengths.where("length = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id")
    digests = end_digests(ends.union(turnless))
    empty = hashlib.sha256().hexdigest()
    named = whole.join(digests, KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))
    # One parent may have most of the nodes; the side of the parents has one row each.
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    named = named.join(parents, ["depth", "p1", "p2"], "left")
    return named.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256",
    )
