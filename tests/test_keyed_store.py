import glob
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeflow.schemas import WINDOW_DOCUMENT
from gaugeflow.sinks import keyed_store
from gaugeflow.sinks.keyed_store import KeyedStore
from gaugeflow.streaming import jobs

DAY = datetime(2025, 1, 1)
SCHEMA = "series string, start timestamp, v double, day date"


def docs(spark, rows):
    """(series, minute, value) rows as documents; minute 1440 is the next day."""
    made = [(s, DAY + timedelta(minutes=m), float(v), (DAY + timedelta(minutes=m)).date()) for s, m, v in rows]
    return spark.createDataFrame(made, SCHEMA)


def a_store(spark, tmp_path, name="store"):
    return KeyedStore(spark, f"{tmp_path}/{name}", ["series", "start"], docs(spark, []).schema, "day")


def contents(frame):
    return {(r.series, int((r.start - DAY).total_seconds() // 60)): r.v for r in frame.collect()}


def test_random_commits_equal_a_dictionary(spark, tmp_path):
    rng, store, expected, done = random.Random(3), a_store(spark, tmp_path), {}, {}
    for batch in range(6):
        rows = {(rng.choice(["a", "b", None]), rng.randrange(4) * 700 + rng.randrange(5)): rng.random() for _ in range(30)}
        store.upsert(docs(spark, [(*k, v) for k, v in rows.items()]), batch, "r")
        expected.update(rows)
        done[batch] = rows
        if batch == 3:
            store.compact()
        if batch in (2, 4):
            # An earlier batch that is run again stays earlier.
            store.upsert(docs(spark, [(*k, v) for k, v in done[batch - 1].items()]), batch - 1, "r")
        found = store.read()
        assert found.count() == len(expected) and contents(found) == expected
        assert found.columns == [f.name for f in store.schema]
    asked = docs(spark, [("a", 0, 0), (None, 1, 0), ("zz", 5, 0)])
    got = contents(store.lookup(asked))
    assert got == {k: v for k, v in expected.items() if k in (("a", 0), (None, 1))}


def test_two_checkpoints_and_a_replay_leave_one_row_per_key(spark, tmp_path):
    landed = f"{tmp_path}/landed"
    session = jobs.state_session(spark, partitions=2)
    store = a_store(session, tmp_path)
    for part in range(3):
        docs(spark, [("a", part * 10 + k, part) for k in range(15)]).coalesce(1).write.mode("append").parquet(landed)
    stream = session.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landed)
    for checkpoint in ("one", "two"):
        jobs.start(stream, [store.sink()], f"{tmp_path}/{checkpoint}", {"availableNow": True}).awaitTermination()
        found = contents(store.read())
        assert len(found) == 35 and store.read().count() == 35
    # A batch whose commit got lost runs again under the same checkpoint.
    last = os.path.basename(sorted(glob.glob(f"{tmp_path}/two/commits/[0-9]*"))[-1])
    for name in (last, f".{last}.crc"):
        os.rename(f"{tmp_path}/two/commits/{name}", f"{tmp_path}/lost{name}")
    jobs.start(stream, [store.sink()], f"{tmp_path}/two", {"availableNow": True}).awaitTermination()
    assert contents(store.read()) == found and store.read().count() == 35


def files_of(store):
    return {r.path: r.part for r in store.live().collect()}


def test_untouched_dates_are_not_rewritten(spark, tmp_path):
    store = a_store(spark, tmp_path)
    store.upsert(docs(spark, [(s, m, 0) for s in "abc" for m in range(0, 4320, 60)]))
    first = files_of(store)
    assert set(first.values()) == {"2025-01-01", "2025-01-02", "2025-01-03"}
    stamps = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/store/data/**/*.parquet", recursive=True)}
    store.upsert(docs(spark, [("a", 1500, 7), ("a", 1560, 7)]), 1)
    after = files_of(store)
    assert set(first) < set(after) and {after[p] for p in set(after) - set(first)} == {"2025-01-02"}
    store.compact()
    compacted = files_of(store)
    assert {p for p in first if first[p] != "2025-01-02"} == {p for p in compacted if compacted[p] != "2025-01-02"}
    assert not any(p in compacted for p in after if after[p] == "2025-01-02")
    assert {f: os.stat(f).st_mtime_ns for f in stamps} == stamps
    assert contents(store.read()) == {(s, m): 7.0 if (s, m) in (("a", 1500), ("a", 1560)) else 0.0
                                      for s in "abc" for m in [*range(0, 4320, 60)]} | {("a", 1500): 7.0, ("a", 1560): 7.0}
    before = files_of(store)
    store.compact()
    assert files_of(store) == before


def test_only_files_that_share_keys_are_merged(spark, tmp_path, monkeypatch):
    store = a_store(spark, tmp_path)
    for batch in range(4):
        store.upsert(docs(spark, [("a", batch * 100 + k, batch) for k in range(10)]), batch)
    store.upsert(docs(spark, [("a", 5, 9)]), 9)
    live = store.live()
    shared = {r.path for r in store._shared(live).collect()}
    assert len(files_of(store)) == 5 and len(shared) == 2
    opened, files = [], store._files
    monkeypatch.setattr(store, "_files", lambda paths, *a: opened.extend(paths) or files(paths, *a))
    assert contents(store.lookup(docs(spark, [("a", 203, 0)]))) == {("a", 203): 2.0}
    assert len(opened) <= 2
    plan = store.read().where("start > '2030-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(start), GreaterThan(start") >= 1


def test_empty_stores_and_batches(spark, tmp_path):
    store = a_store(spark, tmp_path)
    assert store.read().count() == 0 and store.lookup(docs(spark, [("a", 1, 1)])).count() == 0
    store.compact()
    store.upsert(docs(spark, []))
    assert store.read().count() == 0 and files_of(store) == {}
    store.upsert(docs(spark, [("a", 1, 1), ("a", 1, 1)]), 1)
    assert store.read().count() == 1


def test_a_lost_commit_changes_nothing(spark, tmp_path, monkeypatch):
    store = a_store(spark, tmp_path)
    store.upsert(docs(spark, [("a", 1, 1)]))
    monkeypatch.setattr(KeyedStore, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.upsert(docs(spark, [("a", 1, 2), ("b", 1, 2)]), 1)
    with pytest.raises(RuntimeError):
        store.upsert(docs(spark, [("a", 1, 3)]))
    assert contents(store.read()) == {("a", 1): 1.0}


def test_window_documents_fit(spark, tmp_path):
    store = KeyedStore(spark, f"{tmp_path}/w", ["window_start"], WINDOW_DOCUMENT)
    row = ("2025-01-01T00:00:00", "2025-01-01T00:02:00", "k", 1.0, 2.0, 3, DAY, DAY, DAY.date())
    store.upsert(spark.createDataFrame([row], WINDOW_DOCUMENT))
    assert [tuple(r) for r in store.read().collect()] == [row] and keyed_store.BUCKETS == 4096
    assert store.live().select(F.sum("n")).first()[0] == 1
