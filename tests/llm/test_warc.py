import gzip
import hashlib
import time

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import warc
from gaugeflow.llm.oracles import ORACLES
from gaugeflow.llm.queries import QUERIES
from tests.compare import connect, differences
from tests.llm.conftest import as_sorted

SCHEMA = "page_id long, url string, html string, payload string, digest string, first long"


def record(payload, number, digest=None):
    digest = digest or hashlib.sha256(payload).hexdigest()
    head = (
        f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:{number}>\r\n"
        f"WARC-Block-Digest: sha256:{digest}\r\nContent-Length: {len(payload)}\r\n\r\n"
    )
    return head.encode() + payload + b"\r\n\r\n"


def pages(spark):
    big = "<p>" + "same é text " * 20 + "</p>"
    inner = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n" * 4
    rows = [
        (5, "http://a/\r\nx: y", big), (3, "http://b", big), (3, "http://b", big), (9, None, big), (None, "u", big),
        (1, "u", None), (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (7, "u", inner), (8, "u", "\r\n\r\n" + inner),
        (-4, "u", "x" * 100), (10, "u", "x" * 100), (11, "u", "y" * 99), (12, "u", "y" * 99),
    ]
    return spark.createDataFrame([(*r, "p", "d", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_round_trip(spark, tmp_path, compression):
    df = pages(spark).repartition(3)
    warc.write_archives(df, str(tmp_path / "w"), compression)
    out = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert all(r.reason is None for r in out)
    expected = {}
    for r in df.collect():
        expected.setdefault(r.page_id, []).append((r.html or "").encode())
    got = {}
    for r in out:
        found = r.record_id.removeprefix("<urn:x-page:").rstrip(">")
        key = int(found) if found else None
        if r.record_type == "response":
            assert bytes(r.payload) in expected[key] and r.payload_bytes == len(r.payload)
        else:
            assert r.payload is None and r.refers_to == "<urn:x-page:3>" or key == 10
        got[key] = got.get(key, 0) + 1
        assert r.payload_digest in {hashlib.sha256(p).hexdigest() for p in expected[key]}
    assert got == {k: len(v) for k, v in expected.items()}


@pytest.mark.parametrize("rows", [True, False])
def test_query_equals_sql(spark, tmp_path, rows):
    df = pages(spark) if rows else pages(spark).limit(0)
    df.select("page_id", "url", "html").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = connect(str(tmp_path / "none"))
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    out = QUERIES["op6_warc"](spark, str(tmp_path))
    assert differences(out, con, ORACLES["op6_warc"]) == ""


def test_shuffled_join_changes_nothing(spark, tmp_path, monkeypatch):
    df = pages(spark)
    one = as_sorted(warc.archive_records(df).collect())
    monkeypatch.setattr(warc, "counted_broadcast", lambda table, *_: table)
    assert as_sorted(warc.archive_records(df).collect()) == one


def summary(data):
    found = list(warc.salvage(data))
    good = [h["warc-record-id"][12:-1] for _, _, h, _, _ in found if h]
    gaps = [(a, b, reason) for a, b, h, _, reason in found if h is None]
    return good, gaps


PAYLOADS = [b"alpha", b"", b"x" * 500, "é".encode() * 40, b"WARC/1.0 is a word here"]
RECORDS = [record(p, k) for k, p in enumerate(PAYLOADS)]
ENDS = [sum(map(len, RECORDS[: k + 1])) for k in range(len(RECORDS))]


@pytest.mark.parametrize("pack", [lambda r: r, gzip.compress])
def test_intact_files(pack):
    assert summary(b"".join(map(pack, RECORDS))) == (list("01234"), [])
    assert summary(b"") == ([], [])


def test_damaged_bytes_are_quarantined():
    data = bytearray(b"".join(RECORDS))
    data[ENDS[1] + len(RECORDS[2]) - 100] ^= 1
    assert summary(bytes(data)) == (list("0134"), [(ENDS[1], ENDS[2], "block digest")])
    assert summary(bytes(data[: ENDS[3] - 20])) == (["0", "1"], [(ENDS[1], ENDS[3] - 20, "block digest")])


def test_cut_and_foreign_bytes():
    data = b"".join(RECORDS)
    junk = b"\x1f\x8b\x08 junk WARC/1.0\r\nContent-Length: 9999999\r\n\r\n"
    good, gaps = summary(data[: ENDS[0]] + junk + data[ENDS[0] :])
    assert good == list("01234") and gaps == [(ENDS[0], ENDS[0] + len(junk), "bad member")]
    good, gaps = summary(data[7 : ENDS[2]] + data[ENDS[2] + 30 :])
    assert good == ["1", "2", "4"]
    assert [g[2] for g in gaps] == ["no version line", "no version line"]
    assert summary(b"no archive at all") == ([], [(0, 17, "no version line")])


def test_lying_lengths():
    longer = RECORDS[0].replace(b"Content-Length: 5", b"Content-Length: 9")
    assert summary(longer + RECORDS[1])[0] == ["1"]
    without = RECORDS[0].replace(b"Content-Length: 5\r\n", b"")
    assert summary(without + RECORDS[1]) == (["1"], [(0, len(without), "bad length")])


def test_damaged_members():
    members = [gzip.compress(r) for r in RECORDS]
    broken = bytearray(members[2])
    broken[len(broken) // 2] ^= 0xFF
    good, gaps = summary(b"".join([*members[:2], bytes(broken), *members[3:]]))
    start = len(members[0]) + len(members[1])
    assert good == list("0134") and gaps == [(start, start + len(broken), "bad member")]
    # What was unpacked before the cut is still looked at.
    good, gaps = summary(b"".join(members)[:-6])
    assert good == list("01234") and gaps == [(sum(map(len, members[:4])), sum(map(len, members)) - 6, "cut member")]
    good, gaps = summary(b"".join(members)[: -len(members[4]) // 2])
    assert good == list("0123") and gaps[0][2] == "cut member"


def test_records_before_the_damage_of_a_long_member():
    texts = [hashlib.sha512(bytes([k])).hexdigest().encode() * 9 for k in range(50)]
    for level in (0, 6):
        member = bytearray(gzip.compress(b"".join(record(t, k) for k, t in enumerate(texts)), compresslevel=level))
        middle = len(member) // 2
        good, gaps = summary(bytes(member[:middle]) + b"\0\xff" * 9 + bytes(member[middle:]) + gzip.compress(RECORDS[0]))
        assert len(good) >= 20 and good[-1] == "0" and len(set(good)) >= len(good) - 1
        assert gaps == [(0, len(member) + 18, "bad member")]


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch, compression):
    """Large pages: files of few bundles; one flipped byte costs one record."""
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 40_000)
    monkeypatch.setattr(warc, "BUNDLES_PER_FILE", 3)
    rows = [(k, "u", hashlib.sha512(bytes([k % 256, k // 256])).hexdigest() * (60 + k % 50)) for k in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"), compression)
    files = sorted((tmp_path / "w").glob("part-*"))
    assert len(files) > (1 if compression else 3) and max(f.stat().st_size for f in files) < 3 * 40_000 + 60_000
    out = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert {r.payload.decode() for r in out} == {h for _, _, h in rows} and all(r.reason is None for r in out)
    data = bytearray(files[0].read_bytes())
    whole = sum(h is not None for _, _, h, _, _ in warc.salvage(bytes(data)))
    for at in range(500, len(data), len(data) // 7):
        hurt = bytes(data[:at]) + bytes([data[at] ^ 0xFF]) + bytes(data[at + 1 :])
        assert sum(h is not None for _, _, h, _, _ in warc.salvage(hurt)) >= whole - 1


def test_a_record_of_many_megabytes(spark, tmp_path):
    """The length at the end of its member does not end with a zero."""
    df = spark.createDataFrame([(1, "u", "x" * (17 << 20)), (2, "u", "small")], "page_id long, url string, html string")
    warc.write_archives(df.coalesce(1), str(tmp_path / "w"), "gzip")
    out = warc.read_archives(spark, str(tmp_path / "w"), keep_payload=False).collect()
    assert sorted((r.payload_bytes, r.reason) for r in out) == [(5, None), (17 << 20, None)]


def test_marks_are_searched_for_once():
    data = b"WARC/1.0\r\nContent-Length: 1\r\n" * 60_000 + b"\x1f\x8b\x08" * 20_000
    before = time.perf_counter()
    assert summary(data)[0] == []
    assert time.perf_counter() - before < 10


def test_every_byte_is_accounted_for():
    data = bytearray(b"".join([*RECORDS, *(gzip.compress(r) for r in RECORDS)]))
    for at in range(0, len(data), 37):
        hurt = bytes(data[:at]) + bytes([data[at] ^ 0x55]) + bytes(data[at + 1 :])
        found = list(warc.salvage(hurt))
        assert found[0][0] == 0 and found[-1][1] == len(hurt)
        assert all(a[1] == b[0] for a, b in zip(found, found[1:]))
        assert sum(h is not None for _, _, h, _, _ in found) >= 9


def test_gaps_are_reported_by_spark(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"".join(RECORDS)[:-10])
    (tmp_path / "empty.warc").write_bytes(b"")
    out = warc.read_archives(spark, str(tmp_path))
    assert out.where("reason IS NULL").count() == 4
    gap = out.where(F.col("reason").isNotNull()).first()
    assert (gap.offset, gap.length, gap.reason) == (ENDS[3], len(RECORDS[4]) - 10, "cut block")
