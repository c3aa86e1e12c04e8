"""WARC archives: oracle, streams in odd pieces, damaged files, odd rows."""

import gzip
import hashlib
import io
import random

import pytest

from aeroloom.llm import files, queries, warc
from tests.llm.conftest import SF
from verification.run import compare, duck


def test_query_matches_oracle(spark):
    con = duck(SF)
    assert compare(queries.op8_warc(spark, SF).toPandas(), con.execute(queries.ORACLES["op8_warc"]).fetchdf()) == ""


@pytest.fixture
def pages(spark):
    big = "<p>" + "é🎉" * 200_000
    rows = [(1, "u", None), (2, None, ""), (3, "u\r\nx: y", "short"), (4, "u", "short"), (9, "u", "a" * 100), (7, "u", "a" * 100), (8, "u", "a" * 100),
            (10, "u", "é" * 50), (11, "u", "é" * 50), (12, "u", "b" * 99), (13, "u", "b" * 99), (14, "u", big), (15, "u", big), (16, "u", "WARC/1.1\r\n\r\n" * 30)]
    return rows, spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], "page_id long, url string, html string, payload string, first string, key string, Key_ string, n string")


def test_odd_pages(spark, pages):
    rows, df = pages
    archives = warc.write_archives(warc.mark_revisits(df), files.fresh(spark, "w"), roll=500)
    got = {r.page_id: r for r in warc.read_archives(warc.normalise_archives(archives, files.fresh(spark, "m"))).collect()}
    assert got.keys() == {r[0] for r in rows}
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == raw]
        first = min(same) if len(raw) >= 100 else i
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first))


def test_other_columns_stay_and_short_payloads_spread(spark, pages):
    marked = warc.mark_revisits(pages[1])
    assert set(marked.columns) == {*pages[1].columns, "payload_bytes", "payload_digest", "refers_to"}
    assert {(r["first"], r["key"], r["Key_"], r["n"]) for r in marked.select("first", "key", "Key_", "n").collect()} == {("clash",) * 4}


def test_no_pages(spark, pages):
    archives = warc.write_archives(warc.mark_revisits(pages[1].where("false")), files.fresh(spark, "w"))
    assert warc.read_archives(warc.normalise_archives(archives, files.fresh(spark, "m"))).collect() == []


def test_records_from_any_pieces():
    draw = random.Random(1)
    records = [warc.record("response", i, "http://x", "d", bytes(draw.randrange(256) for _ in range(draw.randrange(300)))) for i in range(50)]
    whole = b"".join(records)
    for _ in range(20):
        cuts = sorted(draw.randrange(len(whole)) for _ in range(draw.randrange(200)))
        pieces = [whole[a:b] for a, b in zip([0, *cuts], [*cuts, len(whole)])]
        assert list(warc.split_records(iter(pieces))) == [r[:-4] for r in records]
    assert list(warc.split_records(iter([]))) == []
    for bad in (whole[:-200], b"no record", records[0][:30]):
        with pytest.raises(ValueError):
            list(warc.split_records(iter([bad])))


def test_inflate_one_and_many_members(monkeypatch):
    data = bytes(range(256)) * 5000
    monkeypatch.setattr(warc, "PIECE", 1000)
    for raw in (gzip.compress(data), b"".join(gzip.compress(data[i:i + 9999]) for i in range(0, len(data), 9999))):
        assert b"".join(warc.inflate(io.BytesIO(raw))) == data
        with pytest.raises(ValueError):
            list(warc.inflate(io.BytesIO(raw[:-20])))


def test_members_are_read_alone(tmp_path):
    source, target = str(tmp_path / "a.warc.gz"), str(tmp_path / "b.warc.gz")
    records = [warc.record("response", i, "http://x", hashlib.sha256(b"%d" % i).hexdigest(), b"%d" % i) for i in range(5)]
    with open(source, "wb") as f:
        f.write(gzip.compress(b"".join(records)))
    n, index = warc.normalise(source, target)
    assert n == 5 and [h["x-page-id"] for h, _ in warc.read_members(target, index)] == list("01234")
    assert gzip.open(target).read() == b"".join(records)
