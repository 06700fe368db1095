"""The interval join and its windows as one stateful operator over one stream.

Both metrics arrive in one stream of readings, which is read and parsed once. A state
group belongs to one key, or to a part of one that is hot; it holds the rows of either
side in time cells as long as the band, and drops a cell once the watermark says that
nothing on time can meet it. A new row meets the stored rows of the cells that its band
touches, and the other new ones.

A hot key is cut in 2**level parts: a left row goes to one part by its hash, a right row
to all. Levels may change from one micro-batch to the next (see `traffic`): a row also
visits the parts of every other level that the key's earlier rows are stored under, but is
stored under its own level only, so every pair meets exactly once.

Pairs are handed over in pieces of PAIRS_AT_ONCE, or folded: the left rows, the right rows
and which of these each left row meets, in blocks of BLOCK_ROWS a side. A block of a crowd
stands for up to 250,000 pairs with 1,000 rows, so stream and store hold little beside the
pairs, and `pairs_of` unfolds every pair where it is read. Windows do not need pairs: how many rows a
band holds and what they sum to are two running sums, as in `joined_windows`, so their cost
follows the rows. `window_means` gives the windows of two streams that way.

Spark would drop rows behind the watermark before an operator sees them. Here the time
travels as a plain number, so late rows arrive; they join nothing and come out marked,
for `repair` to deal with.
"""

from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from gaugeflow.functions.times import micros_of

PAIR, FOLDED, LATE, WINDOW = "pair", "folded", "late", "window"
LATE_ROWS = "late_rows"
# A key is cut in 2**MOST_LEVEL parts at most.
MOST_LEVEL = 10
# Pairs that a task holds at once, unless one row meets more.
PAIRS_AT_ONCE = 100_000
# Rows of either side in a block of folded pairs, and the columns of such a block: the rows of
# both sides, and for every left row the first of those right rows that it meets, and how many.
BLOCK_ROWS = 500
BLOCK = {
    "times1": "ARRAY<BIGINT>", "values1": "ARRAY<DOUBLE>", "from2": "ARRAY<INT>", "many2": "ARRAY<INT>",
    "times2": "ARRAY<BIGINT>", "values2": "ARRAY<DOUBLE>",
}
# Blocks that the operator hands over at once.
BLOCKS_AT_ONCE = 50
# For a store of blocks: a reader holds a row group, or 4,096 rows, of all its columns at once.
BLOCK_STORE = {"parquet.block.row.count.limit": "256"}
# Tasks that unfold blocks, for every core: blocks of a hot key are dealt out.
UNFOLDING_TASKS = 4
# Rows are stored in cells of a minute at least: every cell is a call to the state store.
LEAST_CELL = 60_000_000
# Timers that one batch sets for the cells of a key.
CELL_TIMERS = 4
# Side of a row without a value: that of its side, and this.
UNKNOWN = 2


def sided(readings: DataFrame, keys, time, left, right) -> DataFrame:
    """One row per metric of a reading: keys, time, side (0 left, 1 right), v, and what spreads it.

    Rows without a key or a time pair with nothing and are dropped. `level`, `others`,
    `late` and `landed` are taken along if `traffic` has added them.
    """
    plain = {
        "level": F.lit(0), "others": F.array().cast("array<int>"), "late": F.lit(False), "landed": F.lit(0).cast("long"),
    }
    there = [c for c in plain if c in readings.columns]
    levels = [F.col(c) if c in there else value.alias(c) for c, value in plain.items()]
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col(left).cast("double").alias("v")),
        F.struct(F.lit(1).alias("side"), F.col(right).cast("double").alias("v")),
    )
    rows = readings.dropna(subset=[*keys, time]).select(
        *keys, time, *levels, F.xxhash64(*[c for c in readings.columns if c not in there]).alias("spread"),
        F.explode(sides).alias("s"),
    )
    return rows.where("s.v IS NOT NULL").select(*keys, time, *plain, "spread", "s.side", "s.v")


def dealt(rows: DataFrame, keys, time) -> DataFrame:
    """A copy of each row for every part of its key that it visits; `probe` marks those not to be stored."""

    def at(level, probe):
        powers = F.array(*[F.lit(1 << k) for k in range(MOST_LEVEL + 1)])
        parts = F.element_at(powers, level + 1)
        own = F.col("spread").bitwiseAND((parts - 1).cast("long")).cast("int")
        first = F.when(F.col("side") % UNKNOWN == 0, own).otherwise(F.lit(0))
        last = F.when(F.col("side") % UNKNOWN == 0, own).otherwise(parts - 1)
        return F.transform(
            F.sequence(first, last),
            lambda n: F.struct(level.alias("level"), n.alias("node"), F.lit(probe).alias("probe")),
        )

    older = F.flatten(F.transform("others", lambda level: at(level, True)))
    copies = F.concat(at(F.col("level").cast("int"), False), older)
    return rows.select(
        *keys, F.unix_micros(time).alias("t"), "side", "v", "late", "landed", F.explode(copies).alias("c")
    ).select(*keys, "t", "side", "v", "late", "landed", "c.level", "c.node", "c.probe")


def band_pairs(left, right, low, high, most=None):
    """Positions (in left, in right) of all pairs with right - left in [low, high]; right is sorted.

    They come in pieces of `most` pairs (PAIRS_AT_ONCE); a left row is never cut.
    """
    most = most or PAIRS_AT_ONCE
    first = np.searchsorted(right, left + low, "left")
    count = np.searchsorted(right, left + high, "right") - first
    ends = np.cumsum(count)
    begin = 0
    while begin < len(left):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, "right")))
        own = count[begin:end]
        at = np.repeat(np.arange(begin, end), own)
        start = np.repeat(first[begin:end] - (np.cumsum(own) - own), own)
        yield at, np.arange(len(at)) + start
        begin = end


def band_blocks(left, right, low, high, most=None):
    """The pairs of `band_pairs` in blocks of at most `most` (BLOCK_ROWS) rows a side.

    A block is: positions in left, for each of these the first right row that it meets (counted
    from the start of the block's) and how many it meets, and the slice of right.
    """
    most = most or BLOCK_ROWS
    order = np.argsort(left, kind="stable")
    first = np.searchsorted(right, left[order] + low, "left")
    last = np.searchsorted(right, left[order] + high, "right")
    order, first, last = (x[last > first] for x in (order, first, last))
    for begin in range(0, len(order), most):
        own, a, b = (x[begin : begin + most] for x in (order, first, last))
        for start in range(int(a[0]), int(b[-1]), most):
            end = min(start + most, int(b[-1]))
            one, past = np.maximum(a, start), np.minimum(b, end)
            met = past > one
            if met.any():
                yield own[met], (one - start)[met], (past - one)[met], slice(start, end)


def band_sums(left, right, values, known, low, high):
    """For every left row: the right rows in its band, those that are known, and the sum of these.

    `right` is sorted. Cells are as long as the band, which is then the end of one cell and
    the beginning of the next. Nothing is subtracted but counts, so a NaN or a huge value
    outside of a band cannot touch its sum.
    """
    first = np.searchsorted(right, left + low, "left")
    last = np.searchsorted(right, left + high, "right")
    upto = np.concatenate([[0], np.cumsum(known)])
    sums = np.zeros(len(left))
    if len(right):
        width = high - low + 1
        cells, values = right // width, np.where(known, values, 0.0)
        forwards, backwards = np.empty(len(right)), np.empty(len(right))
        edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(right)]
        for a, b in zip(edges, edges[1:]):
            forwards[a:b] = np.cumsum(values[a:b])
            backwards[a:b] = np.cumsum(values[a:b][::-1])[::-1]
        some, one, two = last > first, (left + low) // width, (left + high) // width
        head = some & (cells[np.minimum(first, len(right) - 1)] == one)
        tail = some & (two != one) & (cells[np.maximum(last - 1, 0)] == two)
        sums[head] += backwards[first[head]]
        sums[tail] += forwards[last[tail] - 1]
    return last - first, upto[last] - upto[first], sums


class OnePass(StatefulProcessor):
    """Joins the rows of a group; gives pairs, or sums per window when the window is over."""

    def __init__(self, keys, low, high, size=None):
        self.keys, self.low, self.high, self.size = keys, low, high, size
        self.width = max(high - low, LEAST_CELL)
        self.reach = max(abs(low), abs(high))

    def init(self, handle):
        self.handle = handle
        self.cells = handle.getMapState("cells", "side INT, cell BIGINT", "t ARRAY<BIGINT>, v ARRAY<DOUBLE>")
        if self.size:
            self.windows = handle.getMapState(
                "windows", "start BIGINT", "sum1 DOUBLE, sum2 DOUBLE, known1 BIGINT, known2 BIGINT, n BIGINT"
            )

    def stored(self, there, side, times, low, high):
        """Times, values and whether these are known, sorted, of the stored rows in the cells that
        [times + low, times + high] touch; `there` are the cells of the key."""
        touched = set()
        if len(times) and there:
            first, last = (times + low) // self.width, (times + high) // self.width
            for a, b in set(zip(first.tolist(), last.tolist())):
                touched.update(range(a, b + 1))
        wanted = [k for k in there if k[0] % UNKNOWN == side and k[1] in touched]
        found = [self.cells.getValue(k) for k in wanted]
        t = np.array([x for f in found for x in f[0]], dtype=np.int64)
        v = np.array([x for f in found for x in f[1]], dtype=np.float64)
        known = np.repeat([k[0] < UNKNOWN for k in wanted], [len(f[0]) for f in found]).astype(bool)
        order = np.argsort(t, kind="stable")
        return t[order], v[order], known[order]

    def store(self, there, side, t, v):
        cells = t // self.width
        for c in np.unique(cells).tolist():
            own = cells == c
            times, values = t[own].tolist(), v[own].tolist()
            if (side, c) in there:
                before = self.cells.getValue((side, c))
                times, values = list(before[0]) + times, list(before[1]) + values
            self.cells.updateValue((side, c), (times, values))

    def timer(self, micros):
        self.handle.registerTimer(-(-micros // 1000))

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows), ignore_index=True)
        t, v, side = (new[c].to_numpy() for c in ("t", "v", "side"))
        own, late = (new[c].to_numpy(dtype=bool) for c in ("probe", "late"))
        own, late = ~own, late | (t < max(0, timerValues.getCurrentWatermarkInMs()) * 1000)
        known, side = side < UNKNOWN, side % UNKNOWN
        # A right row visits every part of its key, and is reported late by the first.
        told = late & own & ((side == 0) | (key[-1] == 0))
        if told.any():
            yield self.late_rows(key, t[told], v[told], side[told], timerValues)
        fields = [t, v, known, new["landed"].to_numpy()]
        lt, lv, lk, l_landed, l_own = (x[(side == 0) & ~late] for x in (*fields, own))
        rt, rv, rk, r_landed, r_own = (x[(side == 1) & ~late] for x in (*fields, own))
        order = np.argsort(rt, kind="stable")
        rt, rv, rk, r_landed, r_own = (x[order] for x in (rt, rv, rk, r_landed, r_own))
        there = {(k[0], k[1]) for k in self.cells.keys()}
        old_left = self.stored(there, 0, rt, -self.high, -self.low)
        old_right = self.stored(there, 1, lt, self.low, self.high)
        left, right = (lt, lv, lk), (rt, rv, rk)
        if self.size:
            sums = {}
            self.add_up(sums, left, old_right)
            self.add_up(sums, old_left, right)
            for one, two in self.meetings(l_own, l_landed, r_own, r_landed):
                self.add_up(sums, [x[one] for x in left], [x[two] for x in right])
            self.keep(sums)
        else:
            yield from self.pairs(key, left, old_right)
            yield from self.pairs(key, old_left, right)
            for one, two in self.meetings(l_own, l_landed, r_own, r_landed):
                yield from self.pairs(key, [x[one] for x in left], [x[two] for x in right])
        cells = set()
        for s, (times, values, certain), mine in ((0, left, l_own), (1, right, r_own)):
            for extra, kind in ((0, certain), (UNKNOWN, ~certain)):
                if (mine & kind).any():
                    self.store(there, s + extra, times[mine & kind], values[mine & kind])
            cells.update((times[mine] // self.width).tolist())
        cells = sorted(cells, reverse=True)
        for c in cells[:: -(-len(cells) // CELL_TIMERS) or 1]:
            self.timer((c + 1) * self.width + self.reach)

    def meetings(self, l_own, l_landed, r_own, r_landed):
        """Masks (left, right) of the new rows that meet, every two of them once.

        A visitor meets what has landed before it; two rows of this level always meet.
        """
        if l_own.any() and r_own.any():
            yield l_own, r_own
        for landed in np.unique(r_landed[~r_own]):
            yield l_own & (l_landed < landed), ~r_own & (r_landed == landed)
        for landed in np.unique(l_landed[~l_own]):
            yield ~l_own & (l_landed == landed), r_own & (r_landed < landed)

    def pairs(self, key, left, right):
        for a, b in band_pairs(left[0], right[0], self.low, self.high):
            if len(a):
                yield self.pair_rows(key, left[0][a], left[1][a], right[0][b], right[1][b])

    def add_up(self, sums, left, right):
        """Adds what the pairs of every window sum to (see the state `windows`) to `sums`."""
        t, v, known = left
        n, known2, sum2 = band_sums(t, *right, self.low, self.high)
        met = n > 0
        if not met.any():
            return
        t, v, known, n, known2, sum2 = (x[met] for x in (t, v, known, n, known2, sum2))
        starts, of = np.unique(t // self.size * self.size, return_inverse=True)
        known1 = np.where(known, n, 0)
        totals = [np.bincount(of, w, len(starts)).tolist() for w in (np.where(known, v, 0.0) * n, sum2)]
        counts = []
        for w in (known1, known2, n):
            counts.append(np.zeros(len(starts), dtype=np.int64))
            np.add.at(counts[-1], of, w)
        for start, *own in zip(starts.tolist(), *totals, *(c.tolist() for c in counts)):
            sums[start] = tuple(x + y for x, y in zip(own, sums.get(start, (0.0, 0.0, 0, 0, 0))))

    def closes(self, start):
        """When nothing on time can belong to a window any more."""
        return start + self.size + max(0, self.high)

    def keep(self, sums):
        there = {k[0] for k in self.windows.keys()} if sums else ()
        for start, own in sums.items():
            if start in there:
                own = tuple(x + y for x, y in zip(own, self.windows.getValue((start,))))
            self.windows.updateValue((start,), own)
            self.timer(self.closes(start))

    def frame(self, key, size, kind, **columns):
        given = {name: [value] * size for name, value in zip(self.keys, key)}
        empty = {c: [None] * size for c in ("t1", "v1", "t2", "v2", "window_start", "record_count")}
        return pd.DataFrame({"kind": [kind] * size, **given, **empty, **columns})

    def late_rows(self, key, t, v, side, timerValues):
        left = side == 0
        columns = {f"t{s + 1}": pd.array(np.where(own, t, 0), dtype="Int64").copy() for s, own in ((0, left), (1, ~left))}
        for s, own in ((1, left), (2, ~left)):
            columns[f"t{s}"][~own] = None
            columns[f"v{s}"] = np.where(own, v, np.nan)
        return self.frame(key, len(t), LATE, **columns)

    def pair_rows(self, key, t1, v1, t2, v2):
        return self.frame(key, len(t1), PAIR, t1=t1, v1=v1, t2=t2, v2=v2)

    def window_rows(self, key, starts, sums):
        v1, v2, _, _, n = sums
        return self.frame(key, len(starts), WINDOW, window_start=starts, v1=v1, v2=v2, record_count=n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        there = [(k[0], k[1]) for k in self.cells.keys()]
        over = [k for k in there if (k[1] + 1) * self.width + self.reach <= watermark]
        if over and len(over) == len(there):
            self.cells.clear()
        else:
            for k in over:
                self.cells.removeKey(k)
        if self.size:
            closed = [k[0] for k in self.windows.keys() if self.closes(k[0]) <= watermark]
            if closed:
                sums = [self.windows.getValue((start,)) for start in closed]
                for start in closed:
                    self.windows.removeKey((start,))
                yield self.window_rows(key, closed, [list(column) for column in zip(*sums)])

    def close(self):
        pass


class FoldedPairs(OnePass):
    """Blocks of pairs; late rows are those of OnePass."""

    def frame(self, key, size, kind, **columns):
        return super().frame(key, size, kind, **{**{c: [None] * size for c in BLOCK}, **columns})

    def pairs(self, key, left, right):
        found = band_blocks(left[0], right[0], self.low, self.high)
        while some := list(islice(found, BLOCKS_AT_ONCE)):
            blocks = [
                (left[0][a], left[1][a], first.astype(np.int32), many.astype(np.int32), right[0][b], right[1][b])
                for a, first, many, b in some
            ]
            yield self.frame(key, len(blocks), FOLDED, **{c: list(column) for c, column in zip(BLOCK, zip(*blocks))})


class WindowSums(OnePass):
    """The windows of rows that may be without a value; of late rows only their number (no window)."""

    names = ("sum1", "sum2", "known1", "known2", "n")

    def part_rows(self, key, closes, starts, sums):
        given = {name: [value] * len(closes) for name, value in zip(self.keys, key)}
        # With the first watermark beyond them; the next one may be the same.
        closes = [pd.Timestamp(at // 1000 + 1, unit="ms", tz="UTC") for at in closes]
        starts = pd.array(starts, dtype="Int64")
        return pd.DataFrame({**given, "closes": closes, "window_start": starts, **dict(zip(self.names, sums))})

    def window_rows(self, key, starts, sums):
        return self.part_rows(key, [self.closes(start) for start in starts], starts, sums)

    def late_rows(self, key, t, v, side, timerValues):
        at = timerValues.getCurrentWatermarkInMs() * 1000
        return self.part_rows(key, [at], [None], [[0.0], [0.0], [0], [0], [len(t)]])


def one_pass(
    readings: DataFrame, left, right, keys=("obs_key",), time="arrival_ts", lower=-5, upper=5,
    max_delay="10 minutes", size_seconds=None, folded=False,
) -> DataFrame:
    """A stream of marked rows out of a stream of readings with the metrics `left` and `right`.

    `kind` is `pair` (t1, v1, t2, v2 of every pair of equal keys whose times differ by
    lower to upper seconds), `late` (a row behind the watermark: t1 and v1, or t2 and v2),
    or, with `size_seconds` instead of the pairs, `window`: window_start, the sums v1 and
    v2 of its pairs and their record_count, once, when the watermark has passed. A window
    comes in parts, all in the same micro-batch. Times are microseconds. A reading with
    both metrics is on both sides; one without either is dropped.

    With `folded`, rows `folded` with the columns BLOCK stand for the pairs, many each.
    `pairs_of` gives the pairs of either form.
    """
    keys = list(keys)
    watermarked = sided(readings, keys, time, left, right).withWatermark(time, max_delay)
    copies = dealt(watermarked, keys, time)
    kinds = {f.name: f.dataType.simpleString() for f in readings.schema}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    schema = f"kind STRING, {schema}, t1 BIGINT, v1 DOUBLE, t2 BIGINT, v2 DOUBLE, window_start BIGINT, record_count BIGINT"
    if folded:
        schema = ", ".join([schema, *[f"{c} {kind}" for c, kind in BLOCK.items()]])
    size = micros_of(size_seconds) if size_seconds else None
    processor = (FoldedPairs if folded else OnePass)(keys, micros_of(lower), micros_of(upper), size)
    return copies.groupBy(*keys, "level", "node").transformWithStateInPandas(processor, schema, "append", "eventTime")


def unfolded(blocks: DataFrame, keys=("obs_key",)) -> DataFrame:
    """Every pair of folded ones (keys, t1, v1, t2, v2), one after the other: no task holds them.

    The blocks are dealt out evenly first, as those of a key come from one task.
    """
    tasks = UNFOLDING_TASKS * blocks.sparkSession.sparkContext.defaultParallelism
    lefts = F.inline(F.arrays_zip("times1", "values1", "from2", "many2")).alias("t1", "v1", "_from", "_many")
    rows = blocks.select(*keys, *BLOCK).repartition(tasks).select(*keys, "times2", "values2", lefts)
    met = rows.withColumn("_at", F.explode(F.sequence("_from", F.col("_from") + F.col("_many") - 1)))
    return met.select(*keys, "t1", "v1", F.get("times2", "_at").alias("t2"), F.get("values2", "_at").alias("v2"))


def pairs_of(marked: DataFrame, keys=("obs_key",)) -> DataFrame:
    """The pairs of a micro-batch or of stored rows, folded or not, with times as timestamps."""
    if set(BLOCK) <= set(marked.columns):
        pairs = unfolded(marked.where(F.col("kind") == FOLDED), keys)
    else:
        pairs = marked.where(F.col("kind") == PAIR)
    times = [F.timestamp_micros(t).alias(t) for t in ("t1", "t2")]
    return pairs.select(*keys, times[0], "v1", times[1], "v2")


def window_means(
    left: DataFrame, right: DataFrame, keys=("obs_key",), time="arrival_ts", lower=-5, upper=5,
    max_delay="10 minutes", size_seconds=120, names=("avg_v1", "avg_v2"), salts=1,
) -> DataFrame:
    """Window means over the pairs of two streams `(keys, time, value)`, without the pairs.

    The same windows as those of `paired_readings` and `tumbling_agg`: a pair without a value
    counts, but not in the mean. The watermark is that of the slower stream; rows behind it
    are left out and counted, as `rows` of the observation LATE_ROWS. `salts` cuts every key
    in as many parts, up to the next power of two: left rows are dealt out, right rows are
    copied to all.
    """
    keys, size = list(keys), micros_of(size_seconds)
    level = min(MOST_LEVEL, (salts - 1).bit_length())

    def side(rows, number):
        rows = rows.withWatermark(time, max_delay).dropna(subset=[*keys, time])
        missing = F.when(F.col("value").isNull(), F.lit(number + UNKNOWN)).otherwise(F.lit(number))
        return rows.select(
            *keys, time, missing.alias("side"), F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("v"),
            F.lit(level).alias("level"), F.array().cast("array<int>").alias("others"), F.lit(False).alias("late"),
            F.lit(0).cast("long").alias("landed"), F.xxhash64(*rows.columns).alias("spread"),
        )

    copies = dealt(side(left, 0).unionByName(side(right, 1)), keys, time)
    kinds = {f.name: f.dataType.simpleString() for f in left.schema}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    schema += ", closes TIMESTAMP, window_start BIGINT, sum1 DOUBLE, sum2 DOUBLE, known1 BIGINT, known2 BIGINT, n BIGINT"
    parts = copies.groupBy(*keys, "level", "node").transformWithStateInPandas(
        WindowSums(keys, micros_of(lower), micros_of(upper), size), schema, "append", "eventTime",
        eventTimeColumnName="closes",
    )
    late = F.sum(F.when(F.col("window_start").isNull(), F.col("n")))
    parts = parts.observe(LATE_ROWS, F.coalesce(late, F.lit(0)).alias("rows")).where("window_start IS NOT NULL")
    windows = parts.groupBy("closes", "window_start").agg(
        *[F.sum(c).alias(c) for c in WindowSums.names], F.max(keys[0]).alias("avg_timestamp")
    )
    return windows.select(
        F.timestamp_micros("window_start").alias("window_start_ts"),
        F.timestamp_micros(F.col("window_start") + size).alias("window_end_ts"),
        *[F.try_divide(f"sum{i}", f"known{i}").alias(name) for i, name in enumerate(names, 1)],
        F.col("n").alias("record_count"), "avg_timestamp",
    )
