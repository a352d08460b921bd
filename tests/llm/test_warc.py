import base64
import hashlib
import uuid

import pytest
from pyarrow import fs

from mesada.llm import warc

PAGES = [
    (1, "http://a/1", "<html>one</html>"),
    (2, "http://a/2", "<html>two é 漢</html>"),
    (5, "http://a/5", "<html>one</html>"),
    (3, "http://a/3\r\nX: y", "<html>one</html>"),
    (4, None, None),
    (6, "http://a/6", ""),
    (7, "http://a/7", "x" * 300_000),
    (8, "http://a/8", "a\r\n\r\nb"),
    (8, "http://a/8", "a\r\n\r\nb"),
    (None, "http://a/n", "<html>two é 漢</html>"),
    (None, None, "alone"),
    (None, None, "alone"),
]


def expected(pages):
    last = {}
    for page, _, html in pages:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", page))
    out = []
    for page, _, html in pages:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = last.get(html or "")
        revisit = first is not None and page != first
        kind = "revisit" if revisit else "response"
        out.append((page, len(data), digest, kind, first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ROLL", 500)
    pages = spark.createDataFrame([(*p, "x") for p in PAGES],
                                  "page_id long, url string, html string, digest string")
    folder = f"file://{tmp_path}/{uuid.uuid4().hex}"
    warc.write_warc(pages.repartition(3), folder)
    index = warc.read_index(spark, folder)
    assert index.count() == len(PAGES)
    got = warc.read_warc(index, folder)
    columns = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    have = sorted(map(tuple, got.select(columns).collect()), key=str)
    assert have == expected(PAGES)
    texts = {p: (h or "").encode() for p, _, h in PAGES if p is not None}
    for r in got.where("record_type = 'response' and id is not null").collect():
        assert bytes(r["payload"]) == texts[r["id"]]
    some = warc.read_warc(index.where("url = 'http://a/7'"), folder).collect()
    assert [r["id"] for r in some] == [7]
    assert {r["url"] for r in got.where("id = 3").collect()} == {"http://a/3%0D%0AX:%20y"}


def test_small_payloads_are_responses(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:6], "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "a"), least_bytes=1_000)
    got = warc.read_warc(warc.read_index(spark, str(tmp_path / "a")), str(tmp_path / "a"))
    assert {r["record_type"] for r in got.collect()} == {"response"}


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = str(tmp_path / "none")
    warc.write_warc(pages, folder)
    assert warc.read_warc(warc.read_index(spark, folder), folder).count() == 0


def test_ranges_are_merged():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP, 5), ("a", 21 + 2 * warc.GAP, 5)]
    rows += [("b", 0, 3), ("b", 3, warc.RANGE)]
    merged = list(warc.merged_ranges(iter(rows)))
    assert merged == [
        ("a", [(0, 10), (10, 5), (15 + warc.GAP, 5)]),
        ("a", [(21 + 2 * warc.GAP, 5)]),
        ("b", [(0, 3)]),
        ("b", [(3, warc.RANGE)]),
    ]


def test_every_record_is_a_gzip_member_with_warc_headers(tmp_path):
    writer = warc._Writer(str(tmp_path), "2024-01-01T00:00:00Z")
    record, digest = warc.page_record(9, "http://u", b"body", None, False, "2024-01-01T00:00:00Z")
    name, offset, length = writer.put(record)
    writer.close()
    data = fs.LocalFileSystem().open_input_file(str(tmp_path / name)).read()
    headers, block = warc.parse_record(data[offset : offset + length])
    assert headers["warc-type"] == "response" and headers["warc-payload-digest"] == f"sha1:{digest}"
    assert block.endswith(b"\r\n\r\nbody")
    assert warc.parse_record(data[:offset])[0]["warc-type"] == "warcinfo"


def test_text_ids_come_back_as_they_are(spark, tmp_path):
    pages = [
        ("a/1 ü:>", "u", "same"), ("b", "u", "same"), ("", "u", "other"), (None, "u", "same"),
        ("007", "u", None), ("b", "u", "same"), ("null", "u", "x"),
    ]
    df = spark.createDataFrame(pages, "page_id string, url string, html string").repartition(3)
    folder = f"file://{tmp_path}/{uuid.uuid4().hex}"
    warc.write_warc(df, folder)
    index = warc.read_index(spark, folder)
    assert dict(index.dtypes)["id"] == "string"
    got = warc.read_warc(index, folder, payloads=False)
    columns = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == expected(pages)
    # Ids of another record than the one the index points to are not passed on.
    wrong = index.where("id = '007'").selectExpr("* except (id)", "'b' AS id")
    with pytest.raises(Exception, match="not the one that the index names"):
        warc.read_warc(wrong, folder).collect()


def test_other_types_of_ids(spark, tmp_path):
    df = spark.sql(
        "select * from values (date'2024-01-02', 'u', 'a'), (date'2024-01-03', 'u', 'a'),"
        " (null, null, 'b') as t(page_id, url, html)"
    )
    folder = f"file://{tmp_path}/{uuid.uuid4().hex}"
    warc.write_warc(df, folder)
    got = warc.read_warc(warc.read_index(spark, folder), folder).collect()
    assert {(str(r["id"]), str(r["refers_to"])) for r in got} == {
        ("2024-01-03", "None"), ("2024-01-02", "2024-01-03"), ("None", "None"),
    }
