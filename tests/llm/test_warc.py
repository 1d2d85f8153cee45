import hashlib
import zlib

import pytest
from helpers import frame, prose, seeded

from tripwise.llm import warc

DDL = "page_id long, url string, html string, payload string"


def expected(pages):
    out = []
    for page_id, _, html, _ in pages:
        raw = (html or "").encode()
        same = [p for p, _, h, _ in pages if (h or "") == (html or "") and p is not None]
        last = max(same) if same else None
        revisit = len(raw) >= 1000 and last is not None and page_id != last
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


def test_pages_round_trip(spark):
    rng = seeded(1)
    hot = "<p>" + prose(rng, 400)
    pages = [(i, f"http://e.x/{i} ä\r\nX: y", hot if i % 3 == 0 else prose(rng, rng.randint(1, 500)), "c") for i in range(60)]
    pages += [(100, None, None, "c"), (101, "u", "", "c"), (102, "u", "é" * 500, "c"), (103, "u", "é" * 500, "c"),
              (104, "u", "z" * 999, "c"), (105, "u", "z" * 999, "c"), (None, "u", hot, "c"), pages[0], pages[57],
              (106, "u", "WARC/1.1\r\n\r\n\r\n\r\n" * 90, "c"), (107, "u", "x" * 3_000_000, "c")]
    got = warc.pages_to_warc(frame(spark, pages, DDL)).collect()
    rows = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str)
    assert rows == expected(pages)
    assert warc.pages_to_warc(frame(spark, pages, DDL).filter("false")).count() == 0


def test_normalise_gives_a_member_a_record():
    records = [warc.warc_record(i, "http://x", bytes([i]) * (i * 40_000), "d" * 40, None if i % 2 else 5) for i in range(9)]
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    whole = b"".join(c.compress(r) for r in records) + c.flush()
    data, index = warc.normalise(whole)
    assert [zlib.decompress(data[a:a + n], 31) for a, n in index] == records
    assert zlib.decompress(data[index[4][0]:index[4][0] + index[4][1]], 31) == records[4]
    assert warc.normalise(data) == (data, index)
    with pytest.raises((ValueError, zlib.error)):
        warc.normalise(whole[:-40])


def test_small_archives_close(spark):
    pages = frame(spark, [(i, "u", "a" * 600, "c") for i in range(50)], DDL).coalesce(1)
    archives = warc.write_monolithic(warc.assign_revisits(pages), archive_bytes=5000)
    assert archives.count() >= 5
    assert warc.read_records(warc.normalise_archives(archives)).count() == 50
