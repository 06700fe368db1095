"""Benchmark items inside documents: fingerprints of item-sized windows, then exact similarity.

Words are runs of letters and digits in lower case; shingles are five words (a text with
fewer is one shingle). An item's windows in a document are all runs of as many words as
the item has, or the whole document if it is shorter. The similarity of a window and an
item is that of their shingles weighted by how often they occur: the sum of the smaller
weights over the sum of the larger ones. An item is found where it reaches `THRESHOLD`.

1. Only windows that start with a shingle of the item, or end the document, are looked at.
   Nothing is lost: moving a window on to its next such shingle drops none of the shared
   ones, and all windows of an item have the same size. An item of fewer than five words
   is one shingle, so its windows are runs of as many words that are equal to it; the
   first one in a document is enough. A bitmap of the items' shingles sorts out most of a
   document's before any of them becomes a row.
2. Those windows and the items get 64-bit fingerprints (for each bit the majority of the
   shingle hashes). Fingerprints are cut into eight blocks; any two within 23 bits of each
   other differ by two bits or fewer in some block, so items are indexed under every block
   value within two bits, and windows look up their eight blocks.
3. The exact similarity of shingle texts decides. At 0.8 the angle between the weight
   vectors flips a bit with probability 0.15; more than 23 of 64 have a chance below 1e-4
   at the threshold itself and vanish above it, and a document has several such windows.

Everything is DataFrame expressions.
"""

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.scale import counted_broadcast
from gaugeflow.session import written

SHINGLE = 5
THRESHOLD = 0.8
# Bytes of the bitmap that sorts out a document's shingles, sixteen for each of an item's at best.
MOST_PLACES = 1 << 20
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
LAST_ID = (1 << 63) - 1
_BOTH_HALVES = (1 << 32) | 1
_NEIGHBOURS = [
    sum(1 << bit for bit in bits)
    for r in range(BLOCK_RADIUS + 1)
    for bits in combinations(range(BLOCK_BITS), r)
]


def words_of(text):
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def grams_of(words, make):
    """`make` of every run of five words, or of all words if there are fewer; empty for none."""
    every = F.transform(
        F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)),
        lambda i: make(F.slice(words, i, SHINGLE)),
    )
    return F.when(F.size(words) >= SHINGLE, every).when(F.size(words) > 0, F.array(make(words)))


def gram_count(words):
    return F.greatest(F.size(words) - (SHINGLE - 1), F.least(F.size(words), F.lit(1)))


def fingerprints(rows: DataFrame, keys) -> DataFrame:
    """keys and a 64-bit `print` of rows (keys, words).

    Each half of a long counts one bit of the hashes; all shingles of a row are in the
    same task, so the sums are whole before anything is shuffled.
    """
    hashed = rows.select(*keys, F.explode(grams_of(F.col("words"), F.xxhash64)).alias("h"))
    half = F.lit(_BOTH_HALVES)
    sums = [
        F.sum(F.shiftrightunsigned("h", j).bitwiseAND(half)).alias(f"_s{j}") for j in range(32)
    ]
    counted = hashed.groupBy(*keys).agg(F.count("*").alias("_n"), *sums)

    def bit(count, at):
        return F.shiftleft(F.when(count * 2 > F.col("_n"), F.lit(1)).otherwise(F.lit(0)).cast("long"), at)

    bits = [bit(F.col(f"_s{j}").bitwiseAND(F.lit(0xFFFFFFFF)), j) for j in range(32)]
    bits += [bit(F.shiftrightunsigned(f"_s{j}", 32), j + 32) for j in range(32)]
    return counted.select(*keys, reduce(lambda x, y: x.bitwiseOR(y), bits).alias("print"))


def block(value, b):
    return F.shiftrightunsigned(value, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def shared_weight(a, b):
    """Sum of the smaller weights of two arrays of shingles."""

    def times(array, x):
        return F.size(F.filter(array, lambda y: y == x))

    general = F.aggregate(
        F.array_distinct(a), F.lit(0), lambda total, x: total + F.least(times(a, x), times(b, x))
    )
    single = F.size(F.array_distinct(a)) == F.size(a)
    return F.when(single, F.size(F.array_intersect(a, b))).otherwise(general)


def benchmark_items(benchmark: DataFrame, id_col="item_id", text_col="text") -> DataFrame:
    """(item, words, size), one row per distinct word sequence, under its smallest id."""
    own = benchmark.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    named = own.where("size(words) > 0").groupBy("words").agg(F.min("id").alias("item"))
    return named.select("item", "words", F.size("words").alias("size"))


def document_rows(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("owner"),
        F.xxhash64(text).alias("row"),
        text.alias("text"),
    )


def shingle_hashes(words, n):
    """Hashes of every run of n words; none if there are fewer."""
    every = F.transform(
        F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n))
    )
    return F.when(F.size(words) >= n, every)


def known_places(postings: DataFrame):
    """A test whether a hash may be among `postings`: one byte for each remainder, MOST_PLACES at most."""
    places = min(MOST_PLACES, 1 << max(12, (16 * postings.count()).bit_length()))
    there = postings.select(F.pmod("gram", F.lit(places)).cast("int").alias("place")).distinct().collect()
    bitmap = bytearray(places)
    for row in there:
        bitmap[row.place] = 1
    bitmap, one = F.lit(bytes(bitmap)), F.lit(b"\x01")
    return lambda h: F.substring(bitmap, F.pmod(h, F.lit(places)).cast("int") + 1, F.lit(1)) == one


def candidate_windows(rows: DataFrame, items: DataFrame) -> DataFrame:
    """(owner, row, start, size, words) of windows that share a first or a last-window shingle."""
    postings = items.select(
        F.explode(F.array_distinct(grams_of(F.col("words"), F.xxhash64))).alias("gram"), "size"
    )
    postings = written(postings.groupBy("gram").agg(F.collect_set("size").alias("sizes")), "grams")
    # One number for each size of short items, and at most MOST_PLACES for the rest.
    short = sorted(r.size for r in items.where(F.col("size") < SHINGLE).select("size").distinct().collect())
    known = known_places(postings)
    postings = counted_broadcast(postings, 4 * F.size("sizes"))
    worded = rows.select("owner", "row", words_of(F.col("text")).alias("words"))

    def places(n):
        """Place, length and hash of the runs of n words; what no item has goes at once."""
        hashes = F.coalesce(shingle_hashes(F.col("words"), n), F.array().cast("array<bigint>"))
        every = F.transform(
            hashes, lambda h, i: F.struct(i.alias("at"), F.lit(n).alias("length"), h.alias("gram"))
        )
        return F.filter(every, lambda x: known(x.gram))

    runs = F.concat(*map(places, [*short, SHINGLE]))
    placed = worded.select("owner", "row", F.size("words").alias("n"), F.explode(runs).alias("p"))
    placed = placed.select("owner", "row", "n", "p.*")
    hits = placed.join(postings, "gram").select(
        "owner", "row", "at", "n", "length", "gram", F.explode("sizes").alias("size")
    )
    hits = hits.where(F.col("length") == F.least("size", F.lit(SHINGLE)))
    if short:
        # Equal runs are equally similar, so only the first of each counts.
        first = hits.where(F.col("size") < SHINGLE).groupBy("owner", "row", "n", "length", "gram", "size")
        first = first.agg(F.min("at").alias("at")).select(*hits.columns)
        hits = hits.where(F.col("size") >= SHINGLE).unionByName(first)
    start = F.greatest(F.lit(0), F.least(F.col("at"), F.col("n") - F.col("size")))
    # A text has no more windows than shingles, for each size among the items.
    starts = hits.groupBy("owner", "row").agg(
        F.collect_set(F.struct(start.alias("start"), "size")).alias("windows")
    )
    starts = counted_broadcast(written(starts, "windows"), 12 * F.size("windows"))
    found = rows.join(starts, ["owner", "row"]).dropDuplicates(["owner", "row"])
    worded = found.select("owner", "row", "windows", words_of(F.col("text")).alias("all_words"))
    each = worded.select("owner", "row", "all_words", F.explode("windows").alias("w"))
    words = F.slice("all_words", F.col("w.start") + 1, F.col("w.size"))
    return each.select("owner", "row", "w.start", "w.size", words.alias("words"))


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col="doc_id",
    text_col="text",
    item_col="item_id",
    item_text_col="text",
    threshold=THRESHOLD,
) -> DataFrame:
    """(owner, row, item, similarity, start, size): the best window of each item found in a document.

    `owner` is the id, or the largest long for null, and `row` the hash of the text, so
    repeated rows share their results.
    """
    rows = document_rows(docs, id_col, text_col)
    items = written(benchmark_items(benchmark, item_col, item_text_col), "items")
    windows = written(candidate_windows(rows, items), "candidates")
    window = ["owner", "row", "start", "size"]
    prints = fingerprints(windows, window)
    known = fingerprints(items, ["item", "size"])
    near = F.array(
        *[
            F.struct(
                F.lit(b).alias("block"),
                block(F.col("print"), b).bitwiseXOR(F.lit(m)).alias("value"),
            )
            for b in range(BLOCKS)
            for m in _NEIGHBOURS
        ]
    )
    own = F.array(
        *[
            F.struct(F.lit(b).alias("block"), block(F.col("print"), b).alias("value"))
            for b in range(BLOCKS)
        ]
    )
    index = known.select("item", "size", F.col("print").alias("other"), F.explode(near).alias("k"))
    index = written(index, "index")
    index = counted_broadcast(index.select("item", "size", "other", "k.block", "k.value"))
    looked_up = prints.select(*window, "print", F.explode(own).alias("k")).select(
        *window, "print", "k.block", "k.value"
    )
    close = F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= RADIUS
    pairs = looked_up.join(index, ["size", "block", "value"]).where(close)
    pairs = pairs.select(*window, "item").distinct()
    item_words = counted_broadcast(
        items.select("item", F.col("words").alias("item_words")),
        F.length(F.array_join("item_words", " ")) + 24 * F.size("item_words"),
    )
    both = pairs.join(windows, window).join(item_words, "item")

    def shingles(words):
        return grams_of(F.col(words), lambda part: F.array_join(part, " "))

    shared = both.select(
        *window,
        "item",
        shared_weight(shingles("words"), shingles("item_words")).alias("shared"),
        (gram_count(F.col("words")) + gram_count(F.col("item_words"))).alias("both"),
    )
    similarity = F.col("shared") / (F.col("both") - F.col("shared"))
    scored = shared.withColumn("similarity", similarity).where(F.col("similarity") >= threshold)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    return (
        scored.groupBy("owner", "row", "item", "size")
        .agg(best)
        .select("owner", "row", "item", "best.similarity", (-F.col("best.back")).alias("start"), "size")
    )


def leaked_items(
    docs: DataFrame, benchmark: DataFrame, id_col="doc_id", item_col="item_id", **columns
) -> DataFrame:
    """id, item id, similarity, start and n_words (in words) of every item found in a document.

    One row for each pair of a contaminated document and an item; equal items are one,
    under their smallest id. Of equally similar windows it is the first that starts with
    a shingle of an item of that size, or the last window of the document. Null, empty and
    wordless texts and items match nothing; items of fewer than five words match the same
    words in a row, anywhere. Null ids of documents stay null; repeated rows are reported once.
    """
    found = contaminations(docs, benchmark, id_col, item_col=item_col, **columns)
    return found.select(
        F.when(F.col("owner") < LAST_ID, F.col("owner")).alias(id_col),
        F.col("item").alias(item_col),
        "similarity",
        F.col("start").cast("long").alias("start"),
        F.col("size").cast("long").alias("n_words"),
    )


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", **columns
) -> DataFrame:
    """The rows of `docs`, all columns, in which no item is found."""
    found = contaminations(docs, benchmark, id_col, text_col, **columns)
    found = found.select("owner", "row").distinct().toDF("_owner", "_row")
    found = counted_broadcast(written(found, "leaks"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    owner = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_owner")
    row = F.xxhash64(F.col(text_col).cast("string")).alias("_row")
    return docs.select(*names, owner, row).join(found, ["_owner", "_row"], "left_anti").select(*names)
