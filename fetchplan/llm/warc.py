"""WARC archives of pages, written and read back by Spark's text source.

Writing.  Every page is one record: a text row whose lines end as the format
wants them, so that the files of the text sink are archives.  Of the pages with
equal payloads of at least ``min_bytes`` bytes, that of the largest id (null
least) is a response; the others are revisits that name it, without the payload.

Reading.  The text source splits archives at every line that reads like a
record's first line, also within payloads, and at any byte where a task's share
ends.  Each such line is a candidate, and the length that its header states leads
to its successor.  A task jumps pointers within its share, so that each candidate
knows where its chain leaves the share; the shares' entries are chained in turn
from the start of each file by pointer jumping over a table of a few rows a
share.  Only candidates on the chain from a file's start are records: others lie
within payloads.  A record whose payload holds such lines is read over
several rows and, where it crosses shares, several tasks: a second read of the shares
concerned hands its pieces on in order.

Digests of payloads are those of the bytes read back.  An archive whose chain does not end
at the end of its file is refused; so is one with a header line that ends like a
record's first line (addresses are written so that none does).  Null payloads are empty; null addresses have no
header line; control characters in addresses are percent-encoded.  Of rows
that repeat an id and payload one is the response.  An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha1

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fetchplan.plans.strategy import bounded_broadcast
from fetchplan.session import checkpoint_dir

VERSION = "WARC/1.1"
CRLF = "\r\n"
#: A record's first line, at which the text source splits.  No two of them overlap, so all tasks split alike.
MARK = VERSION + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(digest: Column) -> Column:
    """Base 32 of a digest given as hexadecimal digits, whole runs of five of them."""
    out = []
    for at in range(1, 41, 5):
        bits = F.conv(F.substring(digest, at, 5), 16, 10).cast("int")
        out += [F.substr(F.lit(BASE32), F.shiftright(bits, k).bitwiseAND(31) + 1, F.lit(1)) for k in (15, 10, 5, 0)]
    return F.concat(*out)


def _lines(*lines) -> Column:
    """Lines of text or columns; a null line is left out."""
    return F.concat(*[F.coalesce(F.concat(x if isinstance(x, Column) else F.lit(x), F.lit(CRLF)), F.lit("")) for x in lines])


def _address(url: Column) -> Column:
    """Control characters and blanks percent-encoded, so that the address stays on its line, and the end of one that would make its line a mark."""
    clean = url
    for code in (*range(33), 127):
        clean = F.replace(clean, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    clean = F.when(url.rlike(r"[\x00-\x20\x7F]"), clean).otherwise(url)
    return F.when(clean.endswith(VERSION), F.concat(F.substr(clean, F.lit(1), F.length(clean) - 1), F.lit("%31"))).otherwise(clean)


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", date: str = DATE, max_broadcast_bytes: int = 64 << 20) -> None:
    """Write one record per row of ``pages`` (a table read from files, or a checkpoint) below ``folder``.

    Payloads are compared by three hashes of 64 and 60 bits and their length.  Pages without a copy take no part in
    a shuffle of payloads where the table of copies' groups is at most ``max_broadcast_bytes``.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                        F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("sha", F.sha1(F.col("payload").cast("binary"))).withColumn("size", F.octet_length("payload").cast("long"))
    rows = rows.withColumns({"k1": F.conv(F.substring("sha", 1, 15), 16, 10).cast("long"), "k2": F.xxhash64("payload")})
    same = (rows.where(F.col("size") >= min_bytes).groupBy("k1", "k2", "size")
            .agg(F.max(F.struct("id", "row")).alias("last"), F.count("*").alias("n")).where("n > 1")
            .select("k1", "k2", "size", F.col("last.id").alias("last_id"), F.col("last.row").alias("last_row"))).checkpoint()
    rows = rows.join(bounded_broadcast(same, max_broadcast_bytes), ["k1", "k2", "size"], "left")
    revisit = F.col("last_row") != F.col("row")  # null where there is no copy

    def name(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), F.col("digest"), F.lit(">"))

    rows = rows.withColumns({"digest": base32(F.col("sha")), "revisit": F.coalesce(revisit, F.lit(False))})
    own = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(":"), F.col("digest"), F.lit(":"),
                   F.col("row").cast("string"), F.lit(">"))
    http = _lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=UTF-8",
                  F.concat(F.lit("Content-Length: "), F.col("size").cast("string")), "")
    head = _lines(
        VERSION,
        F.when(F.col("revisit"), "WARC-Type: revisit").otherwise("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), F.when(F.col("revisit") | (F.col("size") < min_bytes), own).otherwise(name(F.col("id")))),
        f"WARC-Date: {date}",
        F.concat(F.lit("WARC-Target-URI: "), _address(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(F.col("revisit"), f"WARC-Profile: {PROFILE}"),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: "), name(F.col("last_id")))),
        "Content-Type: application/http; msgtype=response",
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("size"))).cast("string")),
        "")
    body = F.when(F.col("revisit"), "").otherwise(F.col("payload"))
    # a record ends with two line ends: the sink adds them
    rows.select(F.concat(head, http, body).alias("value")).write.option("lineSep", CRLF * 2).text(folder)


def _header(name: str, head: Column) -> Column:
    value = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", value)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{c} {kind}" for c, kind in df.dtypes)


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the text source: file (hashed name), share (where a task's part of the file begins), value."""
    return spark.read.option("lineSep", MARK).text(folder).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("share"),
        F.col("_metadata.file_size").alias("file_size"))


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    """What a row's header says, were it a record: sizes, fields, and the payload's digest where the row holds all of it."""
    rows = _rows(spark, folder).withColumn("size", F.octet_length("value").cast("long"))
    rows = rows.withColumn("head", F.substring_index("value", CRLF * 2, 1))
    cut = F.octet_length("head").cast("long")
    rows = rows.withColumn("cut", F.when(cut < F.col("size"), cut))
    rows = rows.withColumn("stated", F.expr("try_cast(regexp_extract(head, '(?i)(?:^|\\r\\n)Content-Length:[ \\t]*([0-9]{1,18})[ \\t]*(?:\\r\\n|$)', 1) AS long)"))
    rows = rows.withColumn("complete", F.coalesce(F.col("cut") + 4 + F.col("stated") <= F.col("size"), F.lit(False)))
    block = F.when(F.col("complete"), F.expr("substring(cast(value AS binary), cast(cut + 5 AS int), cast(stated AS int))"))
    rows = rows.withColumn("block", block)
    rows = rows.withColumn("http", F.substring_index(F.col("block").cast("string"), CRLF * 2, 1))
    rows = rows.withColumn("payload", F.expr("substring(block, octet_length(http) + 5, octet_length(block))"))
    return rows.select(
        "file", "share", "file_size", "size", "complete",
        F.expr("cut + 4 + stated + 4").alias("ahead"),
        _header("WARC-Type", F.col("head")).alias("record_type"), _header("WARC-Record-ID", F.col("head")).alias("record_id"),
        _header("WARC-Target-URI", F.col("head")).alias("url"), _header("WARC-Refers-To", F.col("head")).alias("refers_id"),
        _header("WARC-Payload-Digest", F.col("head")).alias("stated_digest"),
        _header("Content-Length", F.col("http")).try_cast("long").alias("http_length"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_sha"))


def leave(at: np.ndarray, to: np.ndarray, end: int) -> np.ndarray:
    """Where the chain of each candidate of a share leaves it; -1: nowhere, as it ends within a payload.

    ``at``: the candidates' places, ascending; ``to``: their successors' (-1: none); ``end``: the share's.
    """
    n = len(at)
    nth = np.minimum(np.searchsorted(at, to), max(n - 1, 0))
    found = (to >= 0) & (to < end) & (at[nth] == to) if n else np.zeros(0, bool)
    jump = np.where(found, nth, np.arange(n))
    while not np.array_equal(again := jump[jump], jump):
        jump = again
    out = to[jump]
    return np.where(out >= end, out, -1)


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one share after another; they come in the order of the file."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        file, share = batch.column("file").to_numpy(), batch.column("share").to_numpy()
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (share[1:] != share[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(file)], strict=True):
            if held and (held[0].column("file")[0].as_py(), held[0].column("share")[0].as_py()) != (file[a], share[a]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds, counted from the share's first row: where a row's text begins, its mark, its successor's, where its chain leaves the share, and all rows' bytes."""
    for rows in _shares(batches):
        size = rows.column("size").to_numpy() + len(MARK)
        begin, total = np.cumsum(size) - size, int(size.sum())
        at, ahead = begin - len(MARK), rows.column("ahead").fill_null(-1).to_numpy()
        to = np.where(ahead >= 0, begin + ahead, -1)
        # the next share's first mark, or the file's end
        leaves = leave(at, to, total - len(MARK))
        for name, values in {"begin": begin, "at": at, "next": to, "leaves": leaves, "total": np.full(len(at), total)}.items():
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        yield from rows.to_batches(5000)


def _reach(steps: DataFrame, starts: DataFrame, rounds: int) -> DataFrame:
    """Nodes (file, at) that the starts reach over steps (file, at, leaves), by pointer jumping."""
    reached, jump = starts, steps
    for _ in range(rounds):
        onward = reached.join(jump, ["file", "at"]).select("file", F.col("leaves").alias("at"))
        reached = reached.unionByName(onward).distinct().checkpoint()
        far = jump.select("file", F.col("at").alias("leaves"), F.col("leaves").alias("far"))
        jump = (jump.withColumnRenamed("leaves", "mid").join(far.withColumnRenamed("leaves", "mid"), ["file", "mid"])
                .select("file", "at", F.col("far").alias("leaves"))).checkpoint()
    return reached


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each share's candidates, those on the chain from its entry."""
    for rows in _shares(batches):
        at, to, entry = rows.column("at").to_numpy(), rows.column("next").to_numpy(), rows.column("entry")[0].as_py()
        kept, nth = [], {int(x): k for k, x in enumerate(at)}
        while entry in nth:
            kept.append(nth[entry])
            entry = int(to[nth[entry]])
        yield from rows.take(pa.array(kept, pa.int64())).to_batches(5000)


def read_warc(spark: SparkSession, folder: str, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Records of the archives in ``folder``: record_id, record_type, url, refers_id, payload_bytes, payload_sha, payload_digest, intact.

    ``payload_bytes`` and the digests are those of the whole payload; a revisit
    has them from its header.  ``intact``: a response's payload has the stated digest.
    """
    checkpoint_dir(spark)
    found = _candidates(spark, folder)
    placed = found.mapInArrow(_place, f"{_ddl(found)}, begin long, at long, next long, leaves long, total long").checkpoint()
    # where each share begins, by the rows before it in its file: one row a share
    earlier = Window.partitionBy("file").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    shares = placed.groupBy("file", "share").agg(F.max("total").alias("total"), F.max("file_size").alias("file_size"))
    shares = shares.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0))).checkpoint()
    placed = placed.drop("file_size").join(shares.select("file", "share", "base"), ["file", "share"])
    steps = placed.where("leaves >= 0").select("file", "share", "base", (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("leaves")).alias("leaves"))
    starts = shares.where("share = 0").select("file", F.lit(0).cast("long").alias("at"))
    entries = steps.select("file", F.col("leaves").alias("at")).distinct().unionByName(starts).distinct()
    steps = steps.join(entries, ["file", "at"], "left_semi").checkpoint()
    rounds = (shares.groupBy("file").count().agg(F.max("count")).first()[0] or 0).bit_length()
    reached = _reach(steps.select("file", "at", "leaves"), starts, rounds)
    ends = shares.groupBy("file").agg(F.max("file_size").alias("at"), F.max(F.col("base") + F.col("total") - len(MARK)).alias("read"))
    broken = ends.join(reached, ["file", "at"], "left_anti").select("file").union(ends.where("read != at").select("file")).distinct().count()
    if broken:
        raise ValueError(f"{broken} archives whose records do not end at the end of the file")
    own = steps.join(reached, ["file", "at"]).groupBy("file", "share").agg((F.min("at") - F.min("base")).alias("entry"))
    records = placed.join(own, ["file", "share"]).repartition("file", "share").sortWithinPartitions("file", "share", "at")
    records = records.mapInArrow(_walk, _ddl(records)).checkpoint()
    whole = records.where("complete").select(*RECORD)
    torn = records.where("not complete")
    if torn.limit(1).count():
        whole = whole.unionByName(_mended(spark, folder, torn, shares, max_broadcast_bytes))
    stated = F.regexp_replace(F.col("stated_digest"), "^sha1:", "")
    computed = base32(F.col("payload_sha"))
    revisit = F.col("record_type") == "revisit"
    return whole.select("record_id", "record_type", "url", "refers_id",
                        F.when(revisit, F.col("http_length")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                        F.when(revisit, stated).otherwise(computed).alias("payload_digest"),
                        (revisit | (stated == computed)).alias("intact"))


RECORD = ["record_id", "record_type", "url", "refers_id", "stated_digest", "http_length", "payload_bytes", "payload_sha"]


def _mended(spark: SparkSession, folder: str, torn: DataFrame, shares: DataFrame, max_broadcast_bytes: int) -> DataFrame:
    """Records that several rows hold: their shares are read again, and their pieces go on in order."""
    whole = (torn.withColumns({"starts": F.col("base") + F.col("begin"), "stops": F.col("base") + F.col("next"),
                               "crosses": F.col("next") > F.col("total") - len(MARK)})
             .select("file", "share", "base", "starts", "stops", "crosses", *RECORD).checkpoint())
    # the share that a record begins in and, for the one that leaves it, those it reaches into
    later = shares.select("file", F.col("share").alias("other"), F.col("base").alias("other_base"))
    into = (whole.where("crosses").select("file", "share", "starts", "stops").join(later, "file").where("other > share and other_base < stops")
            .select("file", F.col("other").alias("share"), F.col("other_base").alias("base"), "starts", "stops"))
    spans = whole.select("file", "share", "base", "starts", "stops").unionByName(into).checkpoint()
    rows = _rows(spark, folder).withColumn("nth", F.monotonically_increasing_id())
    rows = rows.join(bounded_broadcast(spans.select("file", "share").distinct(), max_broadcast_bytes), ["file", "share"], "left_semi")
    rows = rows.select("file", "share", "nth", F.lit(None).cast("long").alias("base"), F.lit(None).cast("long").alias("starts"),
                       F.lit(None).cast("long").alias("stops"), F.col("value").cast("binary").alias("value"))
    marks = spans.withColumns({"nth": F.lit(-1).cast("long"), "value": F.lit(None).cast("binary")})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at, starts, stops = None, 0, [], []
        for batch in batches:
            kept, places, record = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("file", "share", "base", "starts", "stops")]
            for nth, (file, share, base, start, stop) in enumerate(zip(*columns, strict=True)):
                if (file, share) != here:
                    here, at, starts, stops = (file, share), base, [], []
                if start is not None:  # the share's records come first, in their order
                    starts.append(start)
                    stops.append(stop)
                    continue
                k = bisect_right(starts, at) - 1
                if k >= 0 and at < stops[k]:
                    kept.append(nth)
                    places.append(at)
                    record.append((starts[k], stops[k]))
                at += len(batch.column("value")[nth].as_buffer()) + len(MARK)
            some = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [some.column("file"), pa.array([r[0] for r in record], pa.int64()), pa.array([r[1] for r in record], pa.int64()),
                 pa.array(places, pa.int64()), some.column("value")], names=["file", "starts", "stops", "place", "value"])

    pieces = (rows.unionByName(marks).repartition("file", "share").sortWithinPartitions("file", "share", "nth", "starts")
              .mapInArrow(place, "file long, starts long, stops long, place long, value binary"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, block = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("file", "starts", "stops", "value")]
            for file, start, stop, value in zip(*columns, strict=True):
                if (file, start) != here:
                    if block:
                        yield block.result(*here)
                    here, block = (file, start), Block(stop - start - 4)
                block.add(value)
        if block:
            yield block.result(*here)

    digests = (pieces.repartition("file", "starts").sortWithinPartitions("file", "starts", "place")
               .mapInArrow(digest, "file long, starts long, http_length long, payload_bytes long, payload_sha string"))
    return whole.drop("http_length", "payload_bytes", "payload_sha").join(digests, ["file", "starts"]).select(*RECORD)


class Block:
    """A record's bytes, piece after piece; holds its headers only."""

    def __init__(self, size: int):
        self.left, self.heads, self.head, self.sha, self.size, self.begun = size, 2, b"", sha1(), 0, False

    def add(self, piece: bytes) -> None:
        piece, self.begun = (MARK.encode() if self.begun else b"") + piece, True
        piece = piece[:max(self.left, 0)]
        self.left -= len(piece)
        while self.heads and piece:
            self.head += piece
            piece = b""
            if (cut := self.head.find(b"\r\n\r\n")) >= 0:
                self.heads -= 1
                piece, self.head = self.head[cut + 4:], b"" if self.heads else self.head[:cut]
        self.sha.update(piece)
        self.size += len(piece)

    def result(self, file: int, start: int) -> pa.RecordBatch:
        lines = dict(x.lower().split(b":", 1) for x in self.head.split(b"\r\n") if b":" in x)
        length = int(lines.get(b"content-length", b"-1"))
        return pa.RecordBatch.from_pydict({
            "file": pa.array([file], pa.int64()), "starts": pa.array([start], pa.int64()), "http_length": pa.array([length], pa.int64()),
            "payload_bytes": pa.array([self.size], pa.int64()), "payload_sha": pa.array([self.sha.hexdigest()])})


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages as archives to the session's shared folder and read them back: the records, with page_id and refers_to."""
    spark = pages.sparkSession
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, folder, min_bytes)

    def page(name: str) -> Column:
        return F.regexp_extract(name, "^<urn:page:(-?[0-9]+):", 1)

    return read_warc(spark, folder).withColumns({
        c: F.when(page(name) != "", page(name).cast("long")) for c, name in (("page_id", "record_id"), ("refers_to", "refers_id"))})
