"""Archives written and read back, against the rows they came from; damage is noticed."""

import base64
import gzip
import hashlib
import io
import os

import pytest

from tickwatch.llm import warc


def expected(rows, least):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        first = max(same, default=None) if len([1 for _, _, h in rows if (h or "") == (html or "")]) > 1 and len(payload) >= least else None
        refers = first if first is not None and first != page_id else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, "response" if refers is None else "revisit", refers, digest, len(payload)))
    return sorted(out, key=repr)


ROWS = [(1, "http://a/\r\nx", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "y" * 200_000),
        (None, "u", "<p>é</p>"), (6, "u", "only"), (6, "u", "only"), (None, "u", "z"), (None, "u", "z")]


@pytest.mark.parametrize("p", [warc.WarcParams(), warc.WarcParams(min_revisit_bytes=3, segment_bytes=50, segments_a_file=2)])
def test_round_trip(spark, tmp_path, p):
    pages = spark.createDataFrame([(*r, "extra") for r in ROWS], "page_id long, url string, html string, refers_to string")
    warc.write(pages, f"{tmp_path}/w", p)
    back = warc.read(spark, f"{tmp_path}/w").collect()
    assert sorted(((r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes) for r in back), key=repr) == expected(ROWS, p.min_revisit_bytes)
    by_digest = {r.payload_digest: bytes(r.payload) for r in back if r.record_type == "response"}
    assert by_digest.keys() == {r.payload_digest for r in back}
    for name in os.listdir(f"{tmp_path}/w"):
        if name.startswith("part-"):  # an ordinary gzip reader reads the file to its end
            data = gzip.GzipFile(fileobj=io.BytesIO(open(f"{tmp_path}/w/{name}", "rb").read())).read()
            assert data == b"" or data.startswith(b"WARC/1.0\r\n")


def test_no_pages(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/w")
    assert warc.read(spark, f"{tmp_path}/w").count() == 0


def test_damage():
    good = warc.member(warc.page_record(1, "u", b"payload", None, "d"), 6)
    assert [r["page_id"] for r in warc.pages_of(memoryview(good + good))] == [1, 1]
    with pytest.raises(ValueError, match="within a gzip member"):
        list(warc.pages_of(memoryview(good[:-9])))
    with pytest.raises(ValueError, match="digest"):
        list(warc.pages_of(memoryview(warc.member(gzip.decompress(good).replace(b"payload\r\n", b"paylaod\r\n"), 6))))
    with pytest.raises(ValueError, match="content length"):
        list(warc.pages_of(memoryview(warc.member(gzip.decompress(good) + b"x", 6))))


def test_query_against_its_sql(spark):
    from oracle_compare import compare
    assert compare(spark, "/root/testdata/sf0.001", ["op8_warc"], verbose=False)["op8_warc"] is True
