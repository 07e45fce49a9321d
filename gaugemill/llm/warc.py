"""WARC archives: writing payloads as records, reading them back with segments put together again.

Writing. Rows of equal payload (by length and SHA-1) form a group; the row with the smallest id is the ``response``, the
others are ``revisit`` records that refer to it. Blocks of a response longer than ``segment_bytes`` are cut: the first
piece stays a ``response`` with segment number 1, the rest are ``continuation`` records naming it as their origin. Bodies
are written in chunked transfer framing. Each task writes one archive, every record a gzip member of its own, through
Arrow's file systems under a name of its attempt; the returned manifest, itself written by Spark's committer, names the
archives of the attempts that counted, so a repeated task leaves no doubles.

Reading. Each archive is parsed in a stream, one record at a time. Whole records are finished where they are read; only
the pieces of segmented records are shuffled, by origin, ordered by segment number, checked against the total length
and joined. Chunked framing is decoded and the payload digest compared.

Record ids are made of the page id, the payload's length and digest, and, but for the first of the rows that agree in
these, a row number, so no two written records share one and a revisit names the id of its response.

Defined results: a NULL payload is an empty one; equal rows of one id are written once each; a row without id gets the
id text ``null``; a damaged, missing or repeated segment raises.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.llm._rows import written
from gaugemill.session import work_dir

VERSION = b"WARC/1.1"
END = b"\r\n"
SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 8 * 1024
READ_BYTES = 1 << 16
BATCH_BYTES = 4 << 20
DATE = "2000-01-01T00:00:00Z"

MANIFEST = "path string, records long, bytes long"
RECORD = "page_id string, record_type string, refers_to string, digest string, origin string, number int, total long, block binary"


def sha1_name(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP chunked framing."""
    parts = []
    for at in range(0, len(body), size):
        piece = body[at : at + size]
        parts += [b"%X\r\n" % len(piece), piece, END]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes:
    """Body of chunked framing; chunk extensions and trailers are passed over, anything else wrong raises."""
    out, at = [], 0
    while True:
        line = framed.index(END, at)
        size = int(framed[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if framed[at + size : at + size + 2] != END:
            raise ValueError("chunk does not end where its size says")
        out.append(framed[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """Payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(END)[1:])}
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        return unchunked(body)
    if b"content-length" in fields and len(body) != int(fields[b"content-length"]):
        raise ValueError("body is not as long as its header says")
    return body


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in [*fields, ("Content-Length", str(len(block)))])]
    return END.join([*head, b"", block, b"", b""])


def header_text(value: str, reversible: bool = False) -> str:
    """A value that stays within its header line: control characters and blanks at the ends are percent-encoded.

    ``reversible`` also encodes the percent sign, so that ``unquote`` gives back any text.
    """
    marks = "%" if reversible else ""
    inner = len(value) - len(value.lstrip()), len(value.rstrip())
    return "".join(
        quote(c, safe="") if c in marks or not c.isprintable() or (c.isspace() and not inner[0] <= i < inner[1]) else c for i, c in enumerate(value)
    )


def record_id(seed: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, seed)}>"


def page_records(page_id: str, url: str, payload: bytes, digest: str, refers_to: str | None, segment_bytes: int, row: str = "") -> Iterator[bytes]:
    """The records of one page: a revisit, a response, or a response with its continuations.

    ``row`` tells rows of one page id and payload apart; it is empty for the first.
    """
    seed = lambda page, row="", part="": record_id(f"{len(payload)}:{digest}:{row}:{part}:{page}")
    own = seed(page_id, row)
    url = header_text(url)
    common = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("X-Page-ID", header_text(page_id, True)), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        head = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload)
        more = [("WARC-Type", "revisit"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ("WARC-Refers-To", seed(refers_to)), ("X-Refers-To-Page-ID", header_text(refers_to, True))]
        yield record([*more, *common], head)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), *common], block)
        return
    pieces = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    yield record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", "1")], pieces[0])
    for n, piece in enumerate(pieces[1:], 2):
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", seed(page_id, row, str(n))), ("WARC-Date", DATE), ("WARC-Target-URI", url),
                  ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(n))]
        if n == len(pieces):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield record(fields, piece)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write the archives below ``path`` and return their manifest. Payloads under ``min_bytes`` are never revisits."""
    text = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.coalesce(F.col(page_id).cast("string"), F.lit("null")).alias("page_id"), F.col(page_id).alias("rank"), F.coalesce(F.col(url), F.lit("")).alias("url"), text.alias("html"))
    size, sha = F.octet_length("html").alias("size"), F.sha1(F.col("html").cast("binary")).alias("sha")
    key = ["page_id", "size", "sha"]
    keys = written(rows.select("page_id", "rank", size, sha).groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min("rank").alias("rank")), "payload-keys")
    firsts = keys.where(F.col("size") >= min_bytes).groupBy("size", "sha").agg(F.sum("copies").alias("all_copies"), F.min("rank").alias("first"))
    firsts = written(firsts.where("all_copies > 1").select("size", "sha", F.coalesce(F.col("first").cast("string"), F.lit("null")).alias("first")), "repeated-payloads")
    known = keys.join(firsts, ["size", "sha"], "left").select(*key, F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("first"), (F.col("copies") > 1).alias("again"))
    known = written(known.where("first is not null or again"), "revisits")
    planned = rows.select("page_id", "url", "html", size, sha).join(known, key, "left")
    columns = ["page_id", "url", "html", "first"]
    if known.where("again").isEmpty():
        planned = planned.select(*columns, F.lit("").alias("row"))
    else:
        # rows of one page id and payload get numbers, which hold once they are written; the smallest is the first's
        repeated = written(planned.where("again").withColumn("row", F.monotonically_increasing_id()), "repeated-rows")
        leaders = repeated.groupBy(*key).agg(F.min("row").alias("row")).select("row", F.lit("").alias("leader"))
        repeated = repeated.join(leaders, "row", "left").select(*columns, F.coalesce("leader", F.col("row").cast("string")).alias("row"))
        planned = planned.where("again is null or not again").select(*columns, F.lit("").alias("row")).union(repeated)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = pafs.FileSystem.from_uri(path)
        fs.create_dir(folder, recursive=True)
        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        n = size = 0
        with fs.open_output_stream(name, compression=None) as out:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    payload = row.html.encode("utf-8")
                    refers_to = row.first if isinstance(row.first, str) else None
                    for data in page_records(row.page_id, row.url, payload, sha1_name(payload), refers_to, segment_bytes, row.row):
                        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                        size += out.write(pack.compress(data) + pack.flush())
                        n += 1
        yield pd.DataFrame({"path": [name], "records": [n], "bytes": [size]})

    return written(planned.mapInPandas(write, MANIFEST), "warc-manifest")


def parse(stream: io.RawIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of a gzipped archive, one member at a time."""
    data = b""
    while True:
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            if not data:
                data = stream.read(READ_BYTES)
                if not data:
                    if out:
                        raise ValueError("archive ends within a record")
                    return
            out.append(unpack.decompress(data))
            data = unpack.unused_data
        raw = b"".join(out)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.split(END)
        if lines[0] != VERSION:
            raise ValueError("not a WARC record")
        fields = {k: v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}
        size = int(fields["Content-Length"])
        if len(rest) != size + 4:
            raise ValueError("record is not as long as its header says")
        yield fields, rest[:size]


def read_records(spark: SparkSession, manifest: DataFrame, uri: str) -> DataFrame:
    """Every record of the archives of a manifest, unsegmented ones and pieces alike."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for name in batch["path"]:
                rows, held = [], 0
                with fs.open_input_stream(name, compression=None) as stream:
                    for fields, block in parse(stream):
                        segment = int(fields.get("WARC-Segment-Number", 0))
                        origin = fields.get("WARC-Segment-Origin-ID") or (fields["WARC-Record-ID"] if segment else None)
                        total = fields.get("WARC-Segment-Total-Length")
                        ids = [v if v is None else unquote(v) for v in map(fields.get, ("X-Page-ID", "X-Refers-To-Page-ID"))]
                        rows.append((ids[0], fields["WARC-Type"], ids[1], fields.get("WARC-Payload-Digest"), origin, segment, int(total) if total else None, block))
                        held += len(block)
                        if held >= BATCH_BYTES:
                            yield _frame(rows)
                            rows, held = [], 0
                if rows:
                    yield _frame(rows)

    n = max(1, manifest.count())
    return manifest.select("path").repartition(n, "path").mapInPandas(read, RECORD)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD.split(", ")])
    return frame.astype({"number": "int32", "total": "Int64"})


PAYLOAD = "page_id string, record_type string, refers_to string, payload_bytes long, payload_digest string"


def read_payloads(spark: SparkSession, manifest: DataFrame, uri: str) -> DataFrame:
    """One row per page: type, reference, and length and digest of the whole payload.

    Blocks of whole records are digested by the task that reads them; of segmented ones, only the pieces are moved.
    """
    records = read_records(spark, manifest, uri)
    pieces_path = written(records.mapInPandas(_digested, RECORD), "warc-records")
    whole = pieces_path.where("origin is null").select("page_id", "record_type", "refers_to", F.col("total").alias("payload_bytes"), F.col("digest").alias("payload_digest"))
    joined = pieces_path.where("origin is not null").groupBy("origin").applyInPandas(_joined, PAYLOAD)
    return whole.unionByName(joined)


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole records carry the length and digest of their payload on, without their block."""
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            if isinstance(r.origin, str):
                rows.append(tuple(r))
                continue
            if r.record_type == "revisit":
                size, name = int(r.block.split(b"Content-Length: ")[1].split(END)[0]), r.digest.removeprefix("sha1:")
            else:
                size, name = _checked(payload_of(r.block), r.digest)
            rows.append((r.page_id, r.record_type, r.refers_to, name, None, 0, size, None))
        yield _frame(rows)


def _checked(payload: bytes, digest: str) -> tuple[int, str]:
    name = sha1_name(payload)
    if f"sha1:{name}" != digest:
        raise ValueError("payload does not have the digest of its header")
    return len(payload), name


def _joined(group: pd.DataFrame) -> pd.DataFrame:
    """One segmented record: pieces by number, all there, as long as the last one says."""
    group = group.sort_values("number")
    if list(group["number"]) != list(range(1, len(group) + 1)):
        raise ValueError("segments are missing or doubled")
    block = b"".join(group["block"])
    if len(block) != int(group["total"].iloc[-1]):
        raise ValueError("segments are not as long together as the last one says")
    first = group.iloc[0]
    size, name = _checked(payload_of(block), first["digest"])
    return pd.DataFrame({"page_id": [first["page_id"]], "record_type": [first["record_type"]], "refers_to": [None], "payload_bytes": [size], "payload_digest": [name]})


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages to archives in the shared work folder and read them back."""
    spark = pages.sparkSession
    path = work_dir(spark, "warc")
    uri = path if "://" in path else f"file://{path.removeprefix('file:')}"
    manifest = write_archives(pages, uri, min_bytes=min_bytes)
    return read_payloads(spark, manifest, uri)
