"""WARC archives written and read back, with payloads that hold what looks like records."""

import base64
import pathlib
import random
import re
import uuid
from hashlib import sha1

import numpy as np
import pytest
from pyspark.sql import functions as F

from fetchplan.llm import warc
from fetchplan.session import checkpoint_dir

PAGES = "page_id long, url string, html string"
FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666:X>\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"


def pages() -> list[tuple]:
    rng = random.Random(3)
    inner = FAKE.format(5, "hello") * 3
    evil = ["\r\nWARC/1.1\r\n", "WARC/1.1\r\n", inner, "\r\n" + inner, "\r\n\r\n" + inner + "WARC/1.1", "x\r\nWARC/1.1", "\r\n\r\nWARC/1.1\r",
            "\r\n" + FAKE.format(100_000, "beyond"), "\r\n" + FAKE.format(10**18 - 1, "far"), "\r\n" + FAKE.format("abc", "no number"),
            "\r\n\r\n", "\r\n", "\r\n" + FAKE.format(0, "") + "é漢" * 50, "\r\nWARC/1.1\r\n" * 40, ("a" * 300 + "\r\n" + inner) * 8,
            "\r\nWARC/1.1\r\nContent-Length: 7\r\n", "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"]
    rows = [(k, f"http://x/{k}", text) for k, text in enumerate(evil)]
    rows += [(100 + k, None if k % 3 else "http://x/a b\r\nWARC-Type: metadata\r\n\x00WARC/1.1", "w" * rng.randrange(400)) for k in range(40)]
    rows += [(200 + k, "u", "the same") for k in range(20)] + [(None, "u", "the same"), (219, "v", "the same"), (219, "v", "the same")]
    rows += [(300, "u", None), (301, "u", ""), (None, None, None), (None, "a", "only null ids"), (None, "b", "only null ids")]
    rows += [(400 + k, "u", evil[k % 17]) for k in range(10)]
    rows.append((500, "u", "".join(rng.choice(["\r\n", "WARC/1.1", "\r\nWARC/1.1\r\n", "Content-Length: 9\r\n", "é"]) for _ in range(4000))))
    rng.shuffle(rows)
    return rows


def plain(rows, least):
    """(id, bytes, digest, type, refers_to) per row, in any order."""
    last = {}
    for i, _, text in rows:
        key = text or ""
        last[key] = max(last.get(key, -1), -1 if i is None else i)
    seen = set()
    for i, _, text in rows:
        raw = (text or "").encode()
        told = (i, len(raw), base64.b32encode(sha1(raw).digest()).decode())
        first = (-1 if i is None else i) == last[text or ""] and (text or "") not in seen
        if first:
            seen.add(text or "")
        page = last[text or ""]
        yield (*told, "response", None) if first or len(raw) < least else (*told, "revisit", None if page < 0 else page)


def sequential(folder):
    """Records of all archives, read one after another from each file's start."""
    for path in pathlib.Path(folder.removeprefix("file:")).glob("part-*"):
        data, at = path.read_bytes(), 0
        while at < len(data):
            assert data[at:at + 10] == b"WARC/1.1\r\n"
            end = data.index(b"\r\n\r\n", at)
            head = dict(x.split(b": ", 1) for x in data[at:end].split(b"\r\n")[1:])
            size = int(head[b"Content-Length"])
            block = data[end + 4:end + 4 + size]
            assert data[end + 4 + size:end + 8 + size] == b"\r\n\r\n"
            yield {k.decode(): v.decode() for k, v in head.items()}, block
            at = end + 8 + size


@pytest.fixture
def small_shares(spark, request):
    """Shares of so many bytes: records are torn between tasks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, (request.param, "1"), strict=True):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


@pytest.mark.parametrize("small_shares,least,parts", [("128m", 0, 3), ("700", 0, 2), ("97", 9, 1)], indirect=["small_shares"])
def test_round_trip(spark, small_shares, least, parts):
    rows = pages()
    given = spark.createDataFrame(rows, PAGES).repartition(parts).checkpoint().withColumns({c: F.lit("x") for c in ("size", "value", "sha", "row", "n")})
    got = warc.round_trip(given, min_bytes=least).collect()
    want = sorted(map(repr, plain(rows, least)))
    assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == want
    assert all(r.intact for r in got)


def test_archives_read_alike_one_by_one(spark):
    rows, folder = pages(), f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(2).checkpoint(), folder)
    got = {r.record_id: r for r in warc.read_warc(spark, folder).collect()}
    records = list(sequential(folder))
    assert len(records) == len(got) == len(rows)
    for head, block in records:
        r = got[head["WARC-Record-ID"]]
        http, _, payload = block.partition(b"\r\n\r\n")
        assert (r.record_type, r.url, r.refers_id) == (head["WARC-Type"], head.get("WARC-Target-URI"), head.get("WARC-Refers-To"))
        assert f"sha1:{r.payload_digest}" == head["WARC-Payload-Digest"]
        assert r.payload_bytes == int(re.search(rb"Content-Length: (\d+)", http)[1]) and (r.record_type == "revisit") <= (payload == b"")
        assert r.refers_id is None or r.refers_id in got and got[r.refers_id].record_type == "response"


def test_a_cut_archive_is_refused(spark):
    folder = pathlib.Path(checkpoint_dir(spark).removeprefix("file:")) / uuid.uuid4().hex
    folder.mkdir()
    (folder / "a.warc").write_bytes((FAKE.format(5, "hello") * 3).encode()[:-6])
    with pytest.raises(ValueError, match="1 archives"):
        warc.read_warc(spark, str(folder))


def test_a_changed_payload_is_told(spark):
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_warc(spark.createDataFrame([(1, "u", "abc"), (2, "u", "def")], PAGES).coalesce(1), folder)
    for path in pathlib.Path(folder.removeprefix("file:")).glob("part-*"):
        path.write_bytes(path.read_bytes().replace(b"abc", b"abd"))
    for path in pathlib.Path(folder.removeprefix("file:")).glob(".part-*.crc"):
        path.write_bytes(b"")
    spark.sparkContext._jsc.hadoopConfiguration().set("io.skip.checksum.errors", "true")
    try:
        got = {r.record_id.split(":")[2]: r.intact for r in warc.read_warc(spark, folder).collect()}
    except Exception as ex:  # the file system's own checksum tells it first
        assert "hecksum" in str(ex)
    else:
        assert got == {"1": False, "2": True}


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_chains_within_a_share():
    at, to = np.array([0, 10, 20, 30, 45]), np.array([20, 30, 30, 99, 60])
    assert warc.leave(at, to, 50).tolist() == [99, 99, 99, 99, 60]
    assert warc.leave(at, np.array([20, 31, 45, -1, 44]), 50).tolist() == [-1, -1, -1, -1, -1]
    assert warc.leave(np.zeros(0, int), np.zeros(0, int), 5).tolist() == []
