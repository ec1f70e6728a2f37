import gzip
import hashlib
import io
import os
import random

import pytest

from plotwise.llm import arc

SCHEMA = "page_id long, url string, html string, file string, number long"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "f", 1) for i, u, h in rows], SCHEMA)


def test_round_trip(spark):
    rng = random.Random(41)
    bodies = ["<p>" + "ä" * 60, "x" * 99, "y" * 100, "", None, "HTTP/1.0 200 OK\r\n\r\nnested", "filedesc://x\n\n1 0", "line\r\n\r\nline " * 2000]
    rows = [(i, rng.choice(["http://a.example/p q?x=ü", None, "", "http://b.example/\n"]), rng.choice(bodies)) for i in range(300)]
    rows += [(None, None, "z" * 500), (7000, "u", "z" * 500), (5, "again", bodies[0]), (5, "again", bodies[0])]
    rng.shuffle(rows)
    got = arc.round_trip(pages_of(spark, rows).repartition(5)).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    per = {}
    for r in got:
        per.setdefault((r["payload_digest"], r["payload_bytes"]), []).append(r)
    for body in {h or "" for _, _, h in rows}:
        raw = body.encode()
        mine = per.pop((hashlib.sha256(raw).hexdigest(), len(raw)))
        assert sorted(str(r["page_id"]) for r in mine) == sorted(str(i) for i, _, h in rows if (h or "") == body)
        responses = [r for r in mine if r["record_type"] == "response"]
        if len(raw) < 100:
            assert len(responses) == len(mine)
        else:
            assert [r["page_id"] for r in responses] == [first[body]]
            assert {r["refers_to"] for r in mine if r["record_type"] == "revisit"} <= {first[body]}
        assert all(r["refers_to"] is None for r in responses)
    assert not per and all(r["date"] == "1996-01-01T00:00:00Z" for r in got) and len({r["record_id"] for r in got}) == len(rows)


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [True, False])
def test_header_lines_of_each_version(version, packed):
    records = [arc.Record("http://x.example/a b", "1.2.3.4", "19970102030405", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n\nmore"),
               arc.Record("dns:x.example", "0.0.0.0", "1997", "text/dns", b""), arc.Record("http://y/", "1.1.1.1", "20010101", "no-type", b"no head")]
    parts = [arc.version_block(version, "f.arc", "19970101000000")] + [arc.arc_record(version, r, 0, "f.arc") for r in records]
    data = b"".join(gzip.compress(p) for p in parts) if packed else b"".join(parts)
    assert list(arc.arc_records(io.BytesIO(data))) == records


def test_damaged_archives_are_refused():
    good = arc.version_block(1, "f", "1997") + arc.arc_record(1, arc.Record("u", "i", "d", "m", b"12345"), 0, "f")
    for bad in (good[:-4], b"http://x 1 2 3 4\n" + good, arc.version_block(1, "f", "1997").replace(b"\n1 0", b"\n9 0") + b"", good + b"one two\n"):
        with pytest.raises(ValueError):
            list(arc.arc_records(io.BytesIO(bad)))
    record = arc.converted(arc.Record("u", "i", "1997", "m", b"HTTP/1.0 200 OK\r\n\r\nbody"), "<id>", None)
    fields, block = next(arc.warc_records(io.BytesIO(record)))
    assert fields["warc-type"] == "response" and block.endswith(b"body")
    with pytest.raises(ValueError):
        list(arc.warc_records(io.BytesIO(record.replace(b"body", b"b0dy"))))


def test_dates():
    assert arc.warc_date("19970102030405") == "1997-01-02T03:04:05Z"
    assert arc.warc_date("1997") == "1997-01-01T00:00:00Z" and arc.warc_date("") == "1970-01-01T00:00:00Z"


def test_records_without_a_head_are_resources(spark, tmp_path):
    body = b"x" * 150
    records = [arc.Record("dns:a", "0.0.0.0", "1997", "text/dns", body), arc.Record("ftp://b/", "0.0.0.0", "1998", "text/plain", body),
               arc.Record("http://c/", "1.1.1.1", "1999", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n" + body),
               arc.Record("dns:d", "0.0.0.0", "1997", "text/dns", b"short"), arc.Record("dns:e", "0.0.0.0", "1997", "text/dns", b"short")]
    folder, ids = tmp_path / "arc", []
    folder.mkdir()
    for name in ("one.arc.gz", "two.arc.gz"):
        (folder / name).write_bytes(gzip.compress(arc.version_block(1, name, "1997") + b"".join(arc.arc_record(1, r, 0, name) for r in records)))
    files = spark.createDataFrame([("one.arc.gz", 5), ("two.arc.gz", 5)], arc.schema_of(arc.ARC_FILES))
    found = arc.staged(arc.read_arc(files, str(folder)), "arc")
    got = arc.read_warc(arc.convert(found, str(folder), str(tmp_path / "warc")), str(tmp_path / "warc")).collect()
    assert len(got) == 10 and len({r["record_id"] for r in got}) == 10
    kinds = sorted((r["payload_bytes"], r["record_type"]) for r in got)
    assert kinds == [(5, "resource")] * 4 + [(150, "resource")] + [(150, "revisit")] * 5
    assert len({r["refers_to_id"] for r in got if r["record_type"] == "revisit"}) == 1


def test_archives_go_with_the_staged_tables(spark):
    from plotwise import session
    kept = list(session._STAGED)
    arc.round_trip(pages_of(spark, [(1, "u", "x" * 200)])).collect()
    top = [p for p in session._STAGED if p not in kept and "/archives-" in p]
    assert len(top) == 1 and os.path.isdir(top[0])
    session._STAGED[:] = top
    session.drop_staged(spark)
    session._STAGED[:] = kept
    assert not os.path.exists(top[0])


def test_empty(spark):
    assert arc.round_trip(pages_of(spark, [])).collect() == []
