import gzip
import hashlib
import io

import pytest

from weavemine.llm import warc as W


def rows():
    big, other = "<p>é" * 400, "x" * 999
    out = [(i, f"http://h{i}.example.com/a b\n{i}", big if i % 3 == 0 else f"page {i} " * i) for i in range(60)]
    return out + [(100, None, other), (101, "", other), (102, "u", None), (103, "u", ""), (None, "u", big), (57, "again", big), (57, "again", big), (104, "v", "HTTP/1.1\r\n\r\nWARC/1.1\n" * 90), (105, "w", "long " * 400_000)]


def brute(rows):
    pay = [(d, (h or "").encode()) for d, _, h in rows]
    best = {}
    for i, (d, p) in enumerate(pay):
        if len(p) >= 1000 and (p not in best or (d if d is not None else -1) >= best[p][0]):
            best[p] = (d if d is not None else -1, i)
    out = []
    for i, (d, p) in enumerate(pay):
        again = p in best and best[p][1] != i
        out.append((d, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", best[p][0] if again else None))
    return sorted(out, key=str)


def test_query_matches_brute_force(spark, tmp_path):
    df = spark.createDataFrame([(*r, "x") for r in rows()], "page_id long, url string, html string, archive string")
    df.repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted((tuple(r) for r in W.query(spark, str(tmp_path)).collect()), key=str) == brute(rows())


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert W.query(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_convert(version):
    body = b"HTTP/1.0 200 OK\nContent-Type: text/html\n\nhello\n\nworld"
    data = W.arc_head("a.arc", version, "20010203040506") + W.arc_record("http://x/", "20010203040507", "text/html; charset=utf-8", body, version, "a.arc", 99)
    data += W.arc_record("dns:x", "20010203", "text/dns", b"1.2.3.4", version)
    recs = list(W.parse_arc(io.BytesIO(data)))
    assert [r.version for r in recs] == [version] * 3 and recs[1].content == body and recs[1].fields["Content-type"] == "text/html; charset=utf-8"
    assert data[recs[1].offset :].startswith(b"http://x/ ")
    out = [h for h, _ in W.parse_warc(io.BytesIO(b"".join(W.convert(r, "a.arc") for r in recs)))]
    assert [h["warc-type"] for h in out] == ["warcinfo", "response", "resource"]
    assert out[1]["warc-date"] == "2001-02-03T04:05:07Z" and out[2]["warc-date"] == "2001-02-03T00:00:00Z"
    assert out[1]["warc-payload-digest"] == W.sha1_name(b"hello\n\nworld") and out[1]["warc-block-digest"] == W.sha1_name(body)
    assert len({h["warc-record-id"] for h in out}) == 3
    h, block = next(W.parse_warc(io.BytesIO(W.convert(recs[1], "a.arc", ("<urn:uuid:1>", "http://y/", "2001-01-01T00:00:00Z")))))
    assert (h["warc-type"], h["warc-refers-to"], h["warc-profile"]) == ("revisit", "<urn:uuid:1>", W.REVISIT) and b"hello" not in block


def test_damaged_archives_are_refused():
    head = W.arc_head("a", 1, "2001")
    for bad in (b"http://x 1.1.1.1 2001 text/plain 5\nab", b"no header\n"):
        with pytest.raises(ValueError):
            list(W.parse_arc(io.BytesIO(head + bad)))
    with pytest.raises(ValueError):
        list(W.parse_arc(io.BytesIO(b"http://x 1.1.1.1 2001 text/plain 2\nab\n")))


def test_archives_roll_and_are_gzip_members(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"{i} " * 3000) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    uris = [r.archive for r in W.write_arc(df, f"file://{tmp_path}/arc", roll=1_000).collect()]
    assert len(uris) > 1
    data = open(uris[0].removeprefix("file://"), "rb").read()
    assert gzip.decompress(data).startswith(b"filedesc:") and data.count(b"\x1f\x8b\x08") > 1
