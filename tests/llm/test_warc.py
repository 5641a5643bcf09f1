import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import warc
from ledgerloom.llm.warc import read_archives, write_archives

PAGES = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (5, "http://a/5\r\nWARC-Type: evil", "<p>same</p>"),
    (3, None, "ünïcödé 漢字 \U0001f600\r\n\r\nWARC/1.1\r\n"),
    (4, "http://a/4", None),
    (6, "http://a/6", ""),
    (7, "http://a/7", "x" * 300_000),
    (8, "http://a/8", "".join(chr(33 + i * 7 % 90) for i in range(200_000))),
    (9, "http://a/9", "twice"),
    (9, "http://a/9", "twice"),
    (None, "http://a/none", "<p>same</p>"),
    (None, "http://a/none", "only nobody's"),
]


@pytest.fixture
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    return df.withColumns({"payload": F.lit(1), "kept": F.lit(2), "digest": F.lit(3)}).repartition(3)


def _wanted(min_bytes=0):
    rows = []
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        equal = [i for i, _, other in PAGES if (other or "") == (html or "") and i is not None]
        kept = max(equal) if equal and len(raw) >= min_bytes else page_id
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        kind = "response" if page_id == kept else "revisit"
        rows.append((page_id, len(raw), digest, kind, None if kind == "response" else kept))
    return sorted(rows, key=str)


def _id(record):
    return int(record[10:-1]) if record and record != "<urn:page:>" else None


@pytest.mark.parametrize("min_bytes, file_bytes", [(0, 1 << 28), (6, 100)])
def test_round_trip(spark, pages, tmp_path, min_bytes, file_bytes):
    written = write_archives(pages, f"file://{tmp_path}", min_bytes, file_bytes)
    files = list(tmp_path.glob("*.warc.gz"))
    assert written == {"files": len(files), "records": len(PAGES), "bytes": sum(p.stat().st_size for p in files)}
    rows = read_archives(spark, f"file://{tmp_path}").collect()
    found = [(_id(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], _id(r["refers_to"])) for r in rows]
    assert sorted(found, key=str) == _wanted(min_bytes)
    texts = {i: (h or "") for i, _, h in PAGES}
    for r in rows:
        if r["record_type"] == "response" and _id(r["record_id"]) is not None:
            assert bytes(r["payload"]).decode() == texts[_id(r["record_id"])]
        elif r["record_type"] == "revisit":
            assert r["payload"] is None
    # Any reader of gzip reads them.
    plain = b"".join(gzip.decompress(p.read_bytes()) for p in tmp_path.glob("*.warc.gz"))
    assert plain.count(b"WARC/1.1\r\nWARC-Type:") == len(PAGES)


def test_members_without_lengths_and_filters(spark, pages, tmp_path):
    write_archives(pages, f"file://{tmp_path}")
    whole = gzip.decompress(b"".join(p.read_bytes() for p in sorted(tmp_path.glob("*.warc.gz"))))
    other = tmp_path / "other"
    other.mkdir()
    (other / "one.warc.gz").write_bytes(b"".join(gzip.compress(b"WARC/1.1\r\n" + r) for r in whole.split(b"WARC/1.1\r\nWARC-Type")[1:] and [b"WARC-Type" + x for x in whole.split(b"WARC/1.1\r\nWARC-Type")[1:]]))
    for folder in (tmp_path, other):
        read = read_archives(spark, f"file://{folder}")
        revisits = read.where("record_type = 'revisit'")
        assert revisits.count() == sum(kind == "revisit" for *_, kind, _ in _wanted())
        one = read.where("record_id = '<urn:page:7>' and record_type in ('response', 'revisit')")
        assert [bytes(r["payload"]) for r in one.collect()] == [b"x" * 300_000]
        heads = read_archives(spark, f"file://{folder}", ["record_id", "payload_bytes"]).where("payload_bytes > 1000")
        assert {_id(r["record_id"]) for r in heads.collect()} == {7, 8}


def _found(spark, folder):
    rows = read_archives(spark, f"file://{folder}").collect()
    found = [(_id(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], _id(r["refers_to"])) for r in rows]
    return sorted(found, key=str)


def test_written_twice_and_by_lost_attempts(spark, pages, tmp_path):
    """What is read is what the last call wrote, each record once."""
    write_archives(pages.repartition(4), f"file://{tmp_path}")
    write_archives(pages.repartition(2), f"file://{tmp_path}")
    left = next(tmp_path.glob("*.warc.gz"))
    (tmp_path / "part-00000-0000-lost.warc.gz").write_bytes(left.read_bytes())
    assert _found(spark, tmp_path) == _wanted()


def test_tasks_that_are_run_again(spark, pages, tmp_path, monkeypatch):
    """A first attempt writes its files and is lost afterwards; a second one writes them again."""
    marks = tmp_path / "marks"
    marks.mkdir()
    folder = tmp_path / "out"

    def lost_once(batches, folder, file_bytes, kept=warc._write_part):
        from pyspark import TaskContext

        yield from kept(batches, folder, file_bytes)
        mark = marks / str(TaskContext.get().partitionId())
        if not mark.exists():
            mark.touch()
            raise RuntimeError("lost")

    # A session on one machine gives tasks one attempt, so the whole write is called again.
    monkeypatch.setattr(warc, "_write_part", lost_once)
    for _ in range(len(PAGES)):
        try:
            write_archives(pages, f"file://{folder}")
            break
        except Exception as error:  # noqa: BLE001
            assert "lost" in str(error)
    assert _found(spark, folder) == _wanted() and len(list(folder.glob("*.warc.gz"))) > len(list(marks.iterdir())) / 2


def test_archives_of_others(spark, pages, tmp_path):
    """Plain ones, subfolders, one member for a whole file, and files that are none."""
    ours, other = tmp_path / "ours", tmp_path / "other"
    write_archives(pages, f"file://{ours}")
    records = [r for r in gzip.decompress(b"".join(p.read_bytes() for p in ours.glob("*.warc.gz"))).split(b"WARC/1.1\r\n")[1:]]
    # The text of one page looks like the start of a record.
    whole = b"WARC/1.1\r\n" + b"WARC/1.1\r\n".join(records)
    (other / "a" / "b").mkdir(parents=True)
    (other / "a" / "b" / "plain.warc").write_bytes(whole)
    assert _found(spark, other) == _wanted()
    one = read_archives(spark, f"file://{other}").where("record_id = '<urn:page:7>'").collect()
    assert [bytes(r["payload"]) for r in one] == [b"x" * 300_000]
    (other / "a" / "b" / "plain.warc").rename(tmp_path / "kept.warc")
    (other / "single.warc.gz").write_bytes(gzip.compress(whole))
    (other / "_SUCCESS").touch()
    assert _found(spark, other) == _wanted()
    (other / "index.cdx").write_text("no archive")
    with pytest.raises(Exception, match="index.cdx"):
        read_archives(spark, f"file://{other}").collect()
    with pytest.raises(FileExistsError):
        write_archives(pages, f"file://{other}")


def test_no_pages(spark, pages, tmp_path):
    assert write_archives(pages.limit(0), f"file://{tmp_path}") == {"files": 0, "records": 0, "bytes": 0}
    assert read_archives(spark, f"file://{tmp_path}").collect() == []
