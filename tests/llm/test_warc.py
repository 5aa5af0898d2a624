import hashlib
import os

from salestide.llm import warc


def by_hand(rows):
    data = [(page, (html or "").encode()) for page, _, html in rows]
    out = []
    for page, payload in data:
        same = [p for p, other in data if other == payload and p is not None]
        keep = max(same) if same else None
        revisit = len(payload) >= 1000 and keep is not None and page != keep
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=repr)


def sample():
    start = "WARC/1.1\r\nWARC-Type: response\r\n"
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}</p>" * (i % 50 * 9)) for i in range(90)]
    rows += [
        (100, None, None), (101, "http://h/\r\nX: y", ""), (102, "u", "é" * 70_000), (103, "u", "é" * 70_000),
        (104, "u", start), (105, "u", "a" + start * 400 + "\r\n\r\n"), (106, "u", "\r\n\r\n" * 3 + start + "\r\n\r\n"),
        (107, "u", "x" * 999), (108, "u", "x" * 999), (109, "u", "x" * 1000), (110, "u", "x" * 1000),
        (None, "u", "x" * 1000), (None, "u", "y" * 1000), (111, "u", "WARC/1.1\r\n" * 3000),
    ]
    return rows


def test_round_trip_equals_brute_force(spark):
    rows = sample()
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, keep string")
    for chunk_bytes in (warc.CHUNK_BYTES, 700):
        got = warc.round_trip(pages.repartition(3), chunk_bytes).collect()
        assert all(r.intact for r in got)
        assert sorted([tuple(r)[:3] + (r.record_type, r.refers_to) for r in got], key=repr) == by_hand(rows)


def test_rows_that_repeat_whole_are_responses(spark):
    pages = spark.createDataFrame([(1, "u", "z" * 90_000)] * 3 + [(0, "u", "z" * 90_000)], "page_id long, url string, html string")
    got = warc.round_trip(pages).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == [
        (0, "revisit", 1), (1, "response", None), (1, "response", None), (1, "response", None),
    ]
    assert all(r.intact and r.payload_bytes == 90_000 for r in got)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_shuffle_way_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(warc, "MAX_BROADCAST_GROUPS", 0)
    rows = sample()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.round_trip(pages).collect()
    assert sorted([tuple(r)[:3] + (r.record_type, r.refers_to) for r in got], key=repr) == by_hand(rows)


def test_files_are_warc_and_damage_is_seen(spark, folder):
    pages = spark.createDataFrame([(1, "http://h/1", "<p>" * 30_000), (2, "http://h/2", "<b>")], "page_id long, url string, html string")
    path = f"{folder}/archive"
    warc.write(pages.coalesce(1), path)
    (name,) = [f for f in os.listdir(path) if f.startswith("part")]
    with open(f"{path}/{name}", "rb") as file:
        data = file.read()
    found, at = [], 0
    while at < len(data):  # a plain sequential reader
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.1"
        fields = dict(line.split(b": ", 1) for line in lines[1:])
        start = at + len(head) + 4
        end = start + int(fields[b"Content-Length"])
        assert data[end : end + 4] == b"\r\n\r\n"
        found.append((fields[b"WARC-Type"], fields[b"WARC-Record-ID"]))
        at = end + 4
    assert found == [(b"response", b"<urn:page:1>"), (b"continuation", b"<urn:page:1:2>"), (b"continuation", b"<urn:page:1:3>"), (b"response", b"<urn:page:2>")]
    hurt = f"{folder}/hurt"
    os.mkdir(hurt)
    with open(f"{hurt}/part-0.txt", "wb") as file:
        file.write(data.replace(b"<p><p>", b"<p><q>", 1))
    got = {r.page_id: r.intact for r in warc.payloads(spark, hurt).collect()}
    assert got == {"1": False, "2": True}
