from __future__ import annotations

import gzip
import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripmart.llm import warc
from tripmart.llm.tables import shared_folder

SCHEMA = "page_id long, url string, html string"


def archive(payloads):
    """Bytes of an archive and where its records begin."""
    data, starts = warc.info_record("x.warc.gz", "2026-01-01T00:00:00Z"), [0]
    for k, payload in enumerate(payloads):
        starts.append(len(data))
        data += warc.page_record(k, f"http://h/{k}", payload, len(payload), hashlib.sha256(payload).hexdigest(), "2026-01-01T00:00:00Z")
    return data, starts


def test_every_record_once_however_ranges_are_cut(monkeypatch):
    monkeypatch.setattr(warc, "LEVEL", 0)
    rng = random.Random(1)
    false = gzip.compress(b"no record at all") + warc.MAGIC + b"\x00" * 40 + gzip.compress(b"WARC/1.0\r\nno end")
    noise = [bytes(rng.getrandbits(8) for _ in range(rng.choice([0, 3, 900, 60_000]))) for _ in range(40)]
    payloads = [x + false + x for x in noise] + [b"<p>" * rng.randint(0, 9000) for _ in range(40)]
    rng.shuffle(payloads)
    data, starts = archive(payloads)
    assert data.count(warc.MAGIC) > len(starts)  # the false ones stand there as they are
    source = pa.BufferReader(data)
    for step in (613, 4099, 70_001, len(data)):
        found = [r for begin in range(0, len(data), step) for r in warc.records(source, begin, begin + step, payloads=True)]
        assert [r["at"] for r in found] == starts
        assert [r["payload"] for r in found[1:]] == payloads
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == len(starts)


def test_damaged_archives_raise():
    data, starts = archive([b"<html>one page</html>" * 20] * 3)
    for broken in (data[:-5], data[: starts[2] + 30], data[: starts[1]] + b"junk" + data[starts[1] :]):
        with pytest.raises(warc.NotARecord):
            list(warc.records(pa.BufferReader(broken), 0, len(broken)))
    wrong = warc.page_record(1, None, b"abc", 3, hashlib.sha256(b"abd").hexdigest(), "d")
    with pytest.raises(warc.NotARecord):
        list(warc.records(pa.BufferReader(wrong), 0, len(wrong)))


def odd_pages():
    long, short = "<p>équal</p>" * 30, "x" * 99
    rows = [(k, f"http://h/{k}", long) for k in (7, 3, 12, -4)] + [(20, None, short), (21, "u", short), (22, "a b\r\nEvil: 1", "y" * 100)]
    rows += [(23, "u", "y" * 100), (24, "u", None), (25, "u", ""), (26, "u", "🙂" * 400_000), (None, "n", long), (None, "n", "z" * 200), (None, "n", "z" * 200)]
    return rows + [(30, "u", "twice" * 30), (30, "u", "twice" * 30), (31, "u", "twice" * 30)]


def brute(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= 100:
            first[data] = min(page, first.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        of = first.get(data)
        again = of is not None and of != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", of if again else None))
    return sorted(out, key=repr)


def test_round_trip_of_odd_pages(spark):
    df = spark.createDataFrame(odd_pages(), SCHEMA)
    for name in ("payload", "payload_digest", "path", "n", "first_id", "its_digest"):
        df = df.withColumn(name, F.lit("x"))
    for range_bytes in (1000, 1 << 25):
        assert sorted(map(tuple, warc.round_trip(df, range_bytes=range_bytes).collect()), key=repr) == brute(odd_pages())
    assert warc.round_trip(df.limit(0)).count() == 0


def test_records_carry_what_pages_have(spark):
    df = spark.createDataFrame(odd_pages(), SCHEMA)
    files = warc.write_warc(df, shared_folder(spark), date="2026-05-06T00:00:00Z", file_bytes=400)
    assert files.count() > 3 and files.agg(F.sum("n_records")).first()[0] == len(odd_pages())
    rows = {r["record_id"]: r for r in warc.read_warc(files, payloads=True).collect() if r["record_type"] != "warcinfo"}
    assert rows["<urn:page:26>"]["payload"].decode() == "🙂" * 400_000
    assert rows["<urn:page:7>"]["payload"] is None and rows["<urn:page:7>"]["refers_to"] == "<urn:page:-4>"
    assert rows["<urn:page:22>"]["url"] == "a%20b%0D%0AEvil:%201" and rows["<urn:page:20>"]["url"] is None
    assert {r["date"] for r in rows.values()} == {"2026-05-06T00:00:00Z"}
