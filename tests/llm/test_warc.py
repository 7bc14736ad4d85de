import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from velometry.llm import warc

SCHEMA = "page_id bigint, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def round_trip(spark, rows, least=0, **how):
    marked = warc.mark_revisits(pages(spark, rows), least)
    return warc.read_archives(warc.write_archives(marked, **how)).collect()


def test_equal_payloads_refer_to_the_largest(spark):
    rows = [(1, "u1", "same"), (7, "u7", "same"), (3, None, "same"), (4, "u4", "other"), (5, "u5", None), (6, "u6", "")]
    got = {r.page_id: r for r in round_trip(spark, rows)}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("revisit", 7), 3: ("revisit", 7), 7: ("response", None), 4: ("response", None),
        5: ("revisit", 6), 6: ("response", None),
    }
    assert all(r.payload_digest == warc.payload_digest((h or "").encode())
               for i, _, h in rows for r in [got[i]])
    assert all(r.payload_bytes == len((h or "").encode()) for i, _, h in rows for r in [got[i]])
    assert got[7].payload == b"same" and got[1].payload is None and got[3].url is None


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (3, "a", "long enough"), (4, "a", "long enough")]
    got = {r.page_id: r.refers_to for r in round_trip(spark, rows, least=5)}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_nulls_repeats_and_odd_texts(spark):
    rows = [(None, "http://ü/\r\nX: y", "n"), (None, "", "n"), (2, "a b", "d"), (2, "a b", "d"), (9, "q", "\r\n\r\n" * 9), (8, "q", "é\u2028\x00")]
    got = round_trip(spark, rows)
    assert sorted(str((r.page_id, r.record_type, r.problem)) for r in got) == sorted(
        str((i, "response", None)) for i, _, _ in rows
    )
    assert {r.payload.decode() for r in got} == {h for _, _, h in rows}
    assert round_trip(spark, []) == []


def test_archives_are_bounded_and_start_with_a_dictionary(spark):
    rows = [(i, f"http://a/{i}", f"<html><body>{'word ' * (i % 50)}{i}</body></html>") for i in range(400)]
    archives = warc.write_archives(warc.mark_revisits(pages(spark, rows)), archive_bytes=20_000)
    found = archives.collect()
    assert len(found) > 3
    for a in found:
        assert struct.unpack("<I", a.content[:4])[0] == warc.DICT_FRAME
        assert sum(map(len, warc.frames(a.content))) < 25_000
    read = warc.read_archives(archives, payloads=False)
    assert read.filter("problem is null").count() == 400
    assert read.filter("payload is not null").count() == 0


def test_stored_table_and_files(spark, tmp_path):
    rows = [(i, "u", "text " * i) for i in range(30)]
    archives = warc.store_archives(
        warc.write_archives(warc.mark_revisits(pages(spark, rows))), str(tmp_path / "table")
    )
    assert warc.read_archives(archives).count() == 30
    for a in archives.collect():
        (tmp_path / a.archive).write_bytes(a.content)
    files = spark.read.format("binaryFile").load(f"{tmp_path}/*.warc.zst")
    files = files.select(F.col("path").alias("archive"), "content")
    assert warc.read_archives(files).filter("problem is null").count() == 30


def record(**changes):
    fields = {
        "WARC-Type": "response", "WARC-Record-ID": "<urn:page:1>", "WARC-Date": "d",
        "WARC-Payload-Digest": "sha1:" + warc.payload_digest(b"abc"),
    }
    block = changes.pop("block", b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc")
    fields |= {"Content-Length": str(len(block))} | {k.replace("_", "-"): v for k, v in changes.items()}
    head = "".join(f"\r\n{k}: {v}" for k, v in fields.items() if v is not None)
    return f"{warc.VERSION}{head}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_good_record():
    assert warc.parse_record(record())["payload"] == b"abc"


@pytest.mark.parametrize(
    "bad",
    [
        b"",
        b"junk\r\n\r\n",
        record(WARC_Type=None),
        record(WARC_Type="other"),
        record(Content_Length="5"),
        record(Content_Length="x"),
        record(block=b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nabc"),
        record(block=b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabd"),
        record(block=b"HTTP/1.1 200 OK\r\n\r\nabc"),
        record(WARC_Type="revisit"),
        record()[:-1],
        record() + b"x",
    ],
)
def test_bad_records(bad):
    with pytest.raises(warc.WarcError):
        warc.parse_record(bad)


def test_damaged_archives_give_problem_rows(spark):
    good = warc.build_archive([record(), record()])
    plain = zstandard.ZstdCompressor().compress(record())
    rows = [
        ("good", good), ("no dictionary", plain), ("cut", good[:-20]), ("dictionary", good[:30]),
        ("flipped", good[:-12] + bytes(12)), ("junk", b"not zstd"), ("empty", b""), ("null", None),
        ("bad record", warc.build_archive([b"nonsense", record()])),
    ]
    df = spark.createDataFrame(rows, "archive string, content binary")
    got = {}
    for r in warc.read_archives(df).collect():
        got.setdefault(r.archive, []).append(r.problem is None)
    assert got == {
        "good": [True, True], "no dictionary": [True], "cut": [True, False], "dictionary": [False],
        "flipped": [True, False], "junk": [False], "null": [False], "bad record": [False, True],
    }
