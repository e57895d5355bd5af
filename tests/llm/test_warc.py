"""Archives: round trip, revisit resolution, edge rows."""

import hashlib

from riskloom.llm.warc import decode_record, encode_record, read_archives, resolve, with_resolved_payload, write_archives

A, B = "a" * 1500, "é" * 600


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, Archive string, record_type int")


def _trip(spark, rows, **k):
    return read_archives(write_archives(resolve(_pages(spark, rows))), **k)


def test_revisits_and_round_trip(spark):
    rows = [(1, "http://x/1", A, "x", 1), (5, "http://x/5", A, "x", 1), (3, None, A, None, None),
            (7, "u", B, "", 0), (8, "u", "short", "", 0), (9, "u\r\nX-Page-Id: 4", "short", "", 0),
            (10, "u", None, "", 0), (11, "u", "", "", 0), (None, "u", A, "", 0), (5, "http://x/5", A, "x", 1)]
    got = with_resolved_payload(_trip(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted((r[0] if r[0] is not None else -1, (r[2] or "").encode()) for r in rows)
    assert sorted((r.key if r.key is not None else -1, bytes(r.payload)) for r in got) == want
    for r in got:
        assert r.payload_bytes == len(r.payload)
        assert r.payload_digest == hashlib.sha1(r.payload).hexdigest()
        if bytes(r.payload) == A.encode():
            assert (r.record_type, r.refers_to) == (("response", None) if r.key == 5 else ("revisit", 5))
        else:
            assert (r.record_type, r.refers_to) == ("response", None)
    assert {r.url for r in got if r.key == 9} == {"u%0D%0AX-Page-Id: 4"}


def test_empty_table(spark):
    assert _trip(spark, [], with_payload=False).count() == 0


def test_damage_is_found():
    row = {"key": 1, "url": "u", "payload": b"abc", "payload_bytes": 3, "record_type": "response", "refers_to": None,
           "payload_digest": hashlib.sha1(b"abc").hexdigest()}
    raw = encode_record(row, "2024-01-01T00:00:00Z")
    assert decode_record(raw, "f")["payload"] == b"abc"
    try:
        decode_record(raw.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"), "f")
    except ValueError:
        return
    raise AssertionError("damage not found")
