"""ZIP-packaged archives: an exact round trip, and the directory reader against packages of others."""

import base64
import hashlib
import io
import zipfile

import pytest

from quillwave.llm import warc_zip


def test_round_trip(spark):
    pages = [(1, "http://a/1", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://a/ b\r\n", None), (4, "u", ""), (5, "u", "x" * 300_000), (5, "u", "x" * 300_000), (None, "u", "<p>é</p>"), (None, "u", "alone"), (9, "u", "a\r\n\r\nb")]
    df = spark.createDataFrame([(*p, "clash", 1) for p in pages], "page_id long, url string, html string, path string, at long").repartition(3)
    got = sorted(map(repr, (tuple(r) for r in warc_zip.archive_round_trip(df).collect())))
    last = {}
    for i, _, h in pages:
        last[h or ""] = max([x for x in (last.get(h or ""), i) if x is not None], default=None)
    want = []
    for i, _, h in pages:
        b = (h or "").encode()
        revisit = last[h or ""] is not None and last[h or ""] != i
        want.append(repr((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", last[h or ""] if revisit else None)))
    assert got == sorted(want)
    assert warc_zip.archive_round_trip(df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [1 << 31, 10])
def test_directory(monkeypatch, limit):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3 if limit == 10 else 65535)
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.comment = b"PK\x05\x06 in a comment"
        for k in range(6):
            z.writestr(f"é{k}.bin", bytes([k]) * (50 + k))
        z.writestr("packed", b"y" * 99, zipfile.ZIP_DEFLATED)
    size = data.seek(0, 2)
    found = warc_zip.directory(data, size)
    assert len(found) == 7
    for k in range(6):
        m = found[f"é{k}.bin"]
        data.seek(warc_zip.begin(data, m))
        assert data.read(m.size) == bytes([k]) * (50 + k)
    with pytest.raises(ValueError):
        warc_zip.begin(data, found["packed"])
    with pytest.raises(ValueError):
        warc_zip.directory(io.BytesIO(b"not a package"), 13)


def test_damage():
    good = warc_zip.record(1, "u", b"payload", None)
    assert warc_zip.parse(good)["payload_bytes"] == 7
    with pytest.raises(ValueError):
        warc_zip.parse(good.replace(b"payload\r\n", b"pAyload\r\n"))
