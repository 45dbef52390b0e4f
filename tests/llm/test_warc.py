from __future__ import annotations

import base64
import hashlib

from tickwatch.llm import warc
from tickwatch.session import scratch_path

HTML = ["<p>é</p>", "x" * 300000, "", None, "<p>é</p>", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "<p>é</p>", "", "\x00\r\n"]


def pages(spark, extra=()):
    rows = [(i, None if i == 2 else f"http://h/{i}\r\nEvil: 1", h) for i, h in enumerate(HTML)]
    return spark.createDataFrame([*rows, *extra], "page_id bigint, url string, html string")


def expected(rows, least=0):
    out = []
    for page, html in rows:
        data = (html or "").encode()
        same = [p for p, h in rows if (h or "") == (html or "")]
        original = max(same) if len(data) >= least else page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if page == original else "revisit", None if page == original else original))
    return sorted(out)


def test_revisits_resolve(spark):
    for least in (0, 1, 9):
        out = warc.archived_pages(pages(spark), least_bytes=least).collect()
        assert sorted(map(tuple, out), key=lambda r: r[0]) == expected(list(enumerate(HTML)), least)


def test_archives_hold_payloads_once(spark):
    first, second = scratch_path(spark, "w"), scratch_path(spark, "w")
    warc.capture(pages(spark), first)
    raw = {r.page_id: bytes(r.payload) for r in warc.read_archive(spark, first, payloads=True).collect()}
    assert raw == {i: (h or "").encode() for i, h in enumerate(HTML)}
    warc.deduplicate(spark, first, second)
    records = warc.read_archive(spark, second, payloads=True).collect()
    assert sorted(bytes(r.payload) for r in records if r.payload is not None) == sorted({(h or "").encode() for h in HTML})
    ids = {r.record_id for r in records}
    assert len(ids) == len(HTML) and all(r.refers_to in ids for r in records if r.type == "revisit")
    assert not ids & {r.record_id for r in warc.read_archive(spark, first).collect()}  # fresh headers


def test_repeated_rows_null_ids_and_empty_tables(spark):
    extra = [(5, "u", "same"), (5, "u", "same"), (None, None, "own"), (None, None, "<p>é</p>")]
    out = warc.archived_pages(pages(spark, extra)).collect()
    assert len(out) == len(HTML) + 4
    same = [r for r in out if r.page_id == 5 and r.payload_bytes == 4]
    assert sorted(r.record_type for r in same) == ["response", "revisit"]
    assert [r.refers_to for r in out if r.page_id is None and r.record_type == "revisit"] == [6]
    assert warc.archived_pages(pages(spark).limit(0)).collect() == []


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    table = pages(spark).select("*", *[F.lit("x").alias(n) for n in ("type", "payload", "record_id", "digest", "TYPE_")])
    assert len(warc.archived_pages(table).collect()) == len(HTML)


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    """Small, larger and very large records: no file holds more than the bound, or one record alone."""
    import glob
    import gzip

    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 18)
    sizes = [100] * 30 + [70_000] * 9 + [200_000] * 4 + [900_000] * 3
    rows = [(i, f"http://h/{i}", chr(97 + i % 26) * n + str(i)) for i, n in enumerate(sizes)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    first, second = scratch_path(spark, "w"), scratch_path(spark, "w")
    warc.capture(table, first)
    warc.deduplicate(spark, first, second)
    for path in (first, second):
        files = [gzip.open(f).read() for f in glob.glob(f"{path.removeprefix('file:')}/size_class=*/part-*")]
        counts = [sum(1 for _ in warc.parse_records(f)) for f in files]
        assert sum(counts) == len(sizes)
        assert all(len(f) <= 1 << 18 or n == 1 for f, n in zip(files, counts))
    assert len(warc.archived_pages(table).collect()) == len(sizes)
