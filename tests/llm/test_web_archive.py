"""Archives of both kinds: bounds in bytes, other encodings, identifiers, damaged files."""

import gzip
import io
import zlib

import pytest
from pyspark.sql import functions as F

from tablewright.llm import web_archive

HTTP = b"HTTP/1.1 200 OK\r\nX-Page-Id: %d\r\n\r\n%s"


def arc(records, version=1, made="20010203"):
    extra = b"" if version == 1 else b"200 - - 0 f.arc "
    out = b"filedesc://f.arc 0.0.0.0 %s text/plain %s%d\n%d 0 x\n\n" % (made.encode(), extra, 6, version)
    for url, date, content in records:
        out += b"%s 10.0.0.1 %s text/html %s%d\n%s\n" % (url, date, extra, len(content), content)
    return out


def put(folder, name, data):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(data)


def converted(spark, tmp_path, **more):
    web_archive.convert_arc(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", **more)
    return web_archive.read_warc(spark, f"{tmp_path}/warc").collect()


def test_other_bytes_and_packings(spark, tmp_path):
    latin, image = "grüße".encode("latin-1"), bytes(range(256)) * 40
    put(tmp_path / "arc", "part-a", arc([(b"http://a/", b"2001", HTTP % (3, latin)), (b"http://b/ c", b"20010230000000", HTTP % (1, image))]))
    put(tmp_path / "arc", "part-b", gzip.compress(arc([(b"http://c/", b"20011231235959", HTTP % (2, image)),
                                                        (b"dns:c", b"junk", b"no header\r\n\r\n")], 2)))
    got = {r.url: r for r in converted(spark, tmp_path)}
    assert all(r.intact for r in got.values()) and len({r.record_id for r in got.values()}) == 4
    assert got["http://a/"].payload_digest == web_archive.sha1_text(latin)
    assert (got["http://c/"].record_type, got["http://c/"].refers_to, got["http://c/"].payload_bytes) == ("revisit", 1, len(image))
    assert got["http://c/"].refers_to_id == got["http://b/ c"].record_id
    assert (got["dns:c"].record_type, got["dns:c"].page_id) == ("resource", None)
    records = [r for f in (tmp_path / "warc").glob("part-*") for r in web_archive.warc_records(f.read_bytes())]
    dates = {web_archive.header_value(h, b"WARC-Target-URI"): web_archive.header_value(h, b"WARC-Date") for h, _ in records}
    assert dates == {"http://a/": "2001-01-01T00:00:00Z", "http://b/ c": "2001-02-03T00:00:00Z",
                     "http://c/": "2001-12-31T23:59:59Z", "dns:c": "2001-02-03T00:00:00Z"}


def test_archives_are_bounded_in_bytes_and_members_stand_alone(spark, tmp_path):
    pages = spark.range(60).select(F.col("id").alias("page_id"), F.lit("http://h/").alias("url"),
                                   F.expr("repeat(sha2(cast(id as string), 512), 40)").alias("html")).coalesce(1)
    web_archive.write_arc(pages, f"{tmp_path}/arc", archive_bytes=2_000)
    assert len(converted(spark, tmp_path, archive_bytes=2_000)) == 60
    for kind, read in (("arc", web_archive.arc_records), ("warc", web_archive.warc_records)):
        files = [f.read_bytes() for f in (tmp_path / kind).glob("part-*")]
        assert len(files) > 1 and max(map(len, files)) <= 2_000 + 500
        assert sum(len(list(read(data))) for data in files) == 60
    rest, members = files[0], 0
    while rest.strip(b"\0"):
        one = zlib.decompressobj(31)
        assert one.decompress(rest).startswith(b"WARC/1.0\r\n")
        rest, members = one.unused_data, members + 1
    assert members == len(list(web_archive.warc_records(files[0])))


@pytest.mark.parametrize("hot", [1, 4096])
def test_common_payloads_by_either_way(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(web_archive, "HOT_KEYS", hot)
    rows = [(i, "u", ["same", "other", None][i % 3]) for i in range(90)] + [(None, None, "same"), (4, "u", "other"), (200, "u", "one")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    web_archive.write_arc(pages, f"{tmp_path}/arc", 2)
    got = converted(spark, tmp_path)
    first = {"same": 0, "other": 1, "": 2}
    assert len(got) == len(rows) == len({r.record_id for r in got})
    assert sum(r.record_type == "response" for r in got) == 4
    by_digest = {web_archive.sha1_text(t.encode()): (t, q) for t, q in first.items()}
    for r in got:
        if r.record_type == "revisit":
            text, page = by_digest[r.payload_digest]
            assert (r.refers_to, r.payload_bytes) == (page, len(text))


def test_small_payloads_stay_responses(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "ab" if i % 2 else "abcdef") for i in range(8)], "page_id long, url string, html string")
    web_archive.write_arc(pages, f"{tmp_path}/arc")
    kinds = {r.page_id: r.record_type for r in converted(spark, tmp_path, least_bytes=3)}
    assert [kinds[i] for i in range(8)] == ["response"] * 2 + ["revisit", "response"] * 3


def test_damaged_archives(spark, tmp_path):
    good = (b"http://a/", b"20010101000000", HTTP % (1, b"x"))
    tail = arc([good])
    data = tail + b"no header\n\nhttp://b/ 0 20010101000000 t 99999\nlost line 5\n" + tail[tail.index(b"http://a/"):]
    with pytest.raises(ValueError, match="no header line"):
        list(web_archive.arc_records(data))
    assert [h["url"] for h, _, _ in web_archive.arc_records(data, damaged="skip")] == ["http://a/"] * 2
    packed = gzip.compress(arc([good] * 500))
    with pytest.raises(ValueError, match="unpacked"):
        list(web_archive.arc_records(packed[:-30]))
    assert list(web_archive.arc_records(packed[:-30], damaged="skip"))
    put(tmp_path / "arc", "part-a", data)
    assert len(converted(spark, tmp_path, damaged="skip")) == 2


def test_empty_table_gives_no_records(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    web_archive.write_arc(pages, f"{tmp_path}/arc")
    assert converted(spark, tmp_path) == []


def test_a_named_record_elsewhere_leaves_page_and_size_null(spark, tmp_path):
    record = (b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:a>\r\nWARC-Refers-To: <urn:b>\r\n"
              b"Content-Length: 0\r\n\r\n\r\n\r\n")
    put(tmp_path / "warc", "part-a", record)
    (row,) = web_archive.read_warc(spark, f"{tmp_path}/warc").collect()
    assert (row.refers_to, row.payload_bytes, row.refers_to_id) == (None, None, "urn:b")


def test_records_are_made_where_they_are_packed(spark, tmp_path, monkeypatch):
    put(tmp_path / "arc", "part-a", arc([(b"http://a/", b"2001", HTTP % (1, b"x")), (b"http://b/", b"2001", HTTP % (2, b"x"))]))
    rows = []
    with monkeypatch.context() as m:
        m.setattr(web_archive, "write_archives", lambda df, *_, **more: rows.append((df, more)))
        web_archive.convert_arc(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    ((df, more),) = rows
    # contents pass through Python once behind the archives' reader, not once more to be packed
    assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    (batch,) = df.orderBy("page_id").toArrow().combine_chunks().to_batches()
    assert list(more["records"](batch)) == [web_archive.warc_record(row) for row in batch.to_pylist()]


def test_header_values_and_dates():
    header = (b"WARC/1.0\r\nWARC-Type: \t response \r\nwarc-type: second\r\nEmpty:\r\nNo colon\n"
              b"URL:http://a/:8\nLatin: gr\xfc\xdfe\r\r\n x: y\r\n\r\n")
    made = web_archive.header_values(header)
    for name in (b"WARC-Type", b"Empty", b"URL", b"Latin", b" x", b"Missing"):
        assert made.get(name.lower()) == web_archive.header_value(header, name)
    cases = {"2001": "20010101000000", "200102": "20010201000000", "20240229235959": "20240229235959", "0001": "00010101000000",
             "20230229": "-", "0000": "-", "20010101235960": "-", "20010101240000": "-", "20011301": "-", "20010100": "-", "20010": "-", "٢٠٢٠": "-", "": "-"}
    assert {d: web_archive.arc_date(d, "-") for d in cases} == cases


def test_members_are_read_as_gzip_reads_them():
    plain = bytes(range(256)) * 300 + b"line\n" * 9000
    named = b"\x1f\x8b\x08\x1e" + bytes(6) + b"\x03\x00abcname\0comment\0\0\0" + gzip.compress(b"extra", mtime=0)[10:]
    packed = gzip.compress(plain) + b"\0" * 40_000 + named + gzip.compress(b"") + gzip.compress(b"last") + b"\0"
    whole = plain + b"extralast"
    archive = web_archive.opened(packed)
    assert archive.read(5) + archive.read() == whole == gzip.decompress(packed)
    assert archive.seek(76_802) == 76_802 and archive.readline() == whole[76_802:].split(b"\n")[0] + b"\n"
    assert archive.seek(3) == 3 == archive.tell() and archive.read() == whole[3:]
    wrong = bytearray(packed)
    wrong[len(gzip.compress(plain)) - 8] ^= 1  # the checksum of the first member
    for data, error in ((packed[:100], EOFError), (gzip.compress(b"x")[:-3], EOFError), (b"\x1f\x8b", EOFError),
                        (packed + b"junk", OSError), (bytes(wrong), OSError)):
        for read in (web_archive.opened(data), gzip.open(io.BytesIO(data))):
            with pytest.raises(error):
                read.read()
    archive = web_archive.opened(bytes(wrong))
    assert b"".join(archive.read1(4096) for _ in range(-(-len(plain) // 4096))).startswith(plain[:70_000])
