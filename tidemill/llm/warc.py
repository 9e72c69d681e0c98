"""WARC archives: write captures as linked records, read them back and assemble transactions.

Writing: every capture becomes three records in one archive file: a request, a response (or a revisit) and a metadata
record; request and metadata name the response's record id in WARC-Concurrent-To. Of the captures with equal payloads
of at least `min_revisit_bytes` the one with the largest id is stored in full, the others become revisits that refer
to it. Records are built by DataFrame expressions and written by Spark's text writer, whose line separator is the blank
line pair that ends every WARC record, so that archives are byte-exact wherever Spark can write.

Files: tasks write about TASK_BYTES each, as files that are rolled after as many records as make FILE_BYTES on average, so
that neither tasks nor what a reader holds grow with the input.

Reading: each archive file (*.warc, *.warc.gz, *.txt, *.txt.gz) is one row of binaryFile, whose gzip members are unpacked one
after the other and cut into records by Content-Length; memory holds one member's rest and one record. Archives of
other writers are read too: names of header fields in any case, folded lines, several concurrent-to ids (the first counts),
warcinfo and other records without a target, HTTP heads without a length or of any status, resource and conversion
records. A truncated last record ends its file. Transactions are assembled by joining request, response and
metadata records through their concurrent-to ids, whichever side names the other, into one nested row.

Defined cases: null html is an empty payload; null urls are written as `about:blank`; captures with a null id are
written and returned with a null id, and are stored in full. Rows that repeat an id are captures each; those that repeat
the stored capture's id and payload are stored in full too. Empty tables give an empty archive and no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import SALTS, hot_keys, scratch_path, written

CRLF = "\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 16 << 20
TASK_BYTES = 256 << 20
_RECORD = "file string, warc_type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, payload_digest string, capture_id long, payload_bytes long, payload binary, metadata string"


def _uuid(kind: str, key: Column) -> Column:
    """A record id from the capture's key: a name-based uuid in urn form."""
    h = F.md5(F.concat(F.lit(f"{kind}:"), key))
    return F.concat(F.lit("<urn:uuid:"), *[x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in ([F.lit("-")] if i else []) + [F.substring(h, a, n)]], F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    return F.concat(F.lit("WARC/1.1\r\n"), F.concat_ws(CRLF, *lines, F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))), F.lit(END), block)


def plan_captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 1000, files: int = 1) -> DataFrame:
    """capture_id, deal, url, html, digest, refers_to (null: stored in full) for every page, dealt into `files` partitions.

    Which capture is stored is found from ids and digests alone: partial maxima, then a join with the short table of
    repeated payloads, which a skew join may split where a third of all pages share one. Payloads are shuffled once, by
    id and digest, to the file that they are written to; `deal` spreads captures without an id and those repeated very often."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("capture_id"), F.coalesce(F.col(url_col), F.lit("about:blank")).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    narrow = written(rows.select("capture_id", "digest", (F.octet_length("html") >= min_revisit_bytes).alias("large")).filter("capture_id is not null"), "capture-keys")
    pair = F.xxhash64("capture_id", "digest")
    hot = hot_keys(narrow.groupBy(pair.alias("pair")).count(), "pair", "count")  # a capture that is repeated very often
    short = narrow.filter("large").select("capture_id", "digest")
    first = short.groupBy("digest").agg(F.max("capture_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    deals = F.when(pair.isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<bigint>")
    refers = short.join(written(first, "stored"), "digest").filter("capture_id <> refers_to").dropDuplicates(["capture_id", "digest"]).withColumn("deal", F.explode(deals))
    # As a table it has no partitioning of its own that payloads would have to be shuffled once more for.
    refers = written(refers, "refers")
    number = F.monotonically_increasing_id()
    dealt = rows.withColumn("deal", F.when(F.col("capture_id").isNull(), number).when(pair.isin(hot), F.pmod(number, F.lit(SALTS))).otherwise(F.lit(0)))
    keys = ["capture_id", "digest", "deal"]
    # The hash table holds the short rows of one file's captures; payloads are neither sorted nor shuffled again.
    return dealt.repartition(files, *keys).join(refers.hint("shuffle_hash"), keys, "left")


def write_archives(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES, task_bytes: int = TASK_BYTES, compression: str = "gzip", **columns) -> str:
    """Write all captures as WARC files of about `file_bytes` under `path`; returns the path."""
    sized = pages.select(F.sum(F.octet_length(F.coalesce(F.col(columns.get("html_col", "html")), F.lit(""))) + 2000), F.count("*"))
    total, rows = (x or 0 for x in sized.first())
    # As many tasks as make files of their own, but no more than cores unless tasks would pass their bound.
    tasks = max(min(-(-total // file_bytes), 2 * pages.sparkSession.sparkContext.defaultParallelism), -(-total // task_bytes), 1)
    records = 3 * max(1, rows * file_bytes // max(1, total))
    caps = plan_captures(pages, files=int(tasks), **columns)
    caps = caps.withColumn("key", F.coalesce(F.col("capture_id").cast("string"), F.concat(F.lit("null "), F.col("deal").cast("string"))))
    main, uri = _uuid("response", F.col("key")), F.regexp_replace("url", r"[\r\n]+", " ")
    host = F.regexp_extract("url", r"://([^/?#]*)", 1)
    base = lambda kind, rid: [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", uri)]
    reply = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit(END))
    stored = F.col("refers_to").isNull()
    response = _record(
        [*base(F.when(stored, "response").otherwise("revisit"), main), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), ("WARC-Refers-To", _uuid("response", F.col("refers_to").cast("string"))), ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.when(stored, F.concat(reply, F.col("html"))).otherwise(reply),
    )
    request = _record([*base(F.lit("request"), _uuid("request", F.col("key"))), ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/http; msgtype=request"))], F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)))
    about = F.concat(F.lit("capture-id: "), F.coalesce(F.col("capture_id").cast("string"), F.lit("")), F.lit("\r\nrefers-to-capture: "), F.coalesce(F.col("refers_to").cast("string"), F.lit("")), F.lit(CRLF))
    meta = _record([*base(F.lit("metadata"), _uuid("metadata", F.col("key"))), ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/warc-fields"))], about)
    caps.select(F.explode(F.array(request, response, meta)).alias("value")).write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", int(records)).text(path)
    return path


def _unpacked(data: bytes) -> Iterator[bytes]:
    """A file's bytes: its gzip members' one by one, or the file itself."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    rest = memoryview(data)
    while len(rest) and bytes(rest[:2]) == b"\x1f\x8b":
        one = zlib.decompressobj(31)
        yield one.decompress(rest)
        if not one.eof:  # a truncated member ends the file
            return
        rest = rest[len(rest) - len(one.unused_data) :]


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name, the first of each; a line that begins with a blank continues the one before."""
    out: dict[str, str] = {}
    lines = re.sub(r"\r?\n[ \t]+", " ", head.decode("utf-8", "replace")).splitlines()
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), value.strip())
    return out


def _whole(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def _row(name: str, head: dict[str, str], block: bytes) -> tuple:
    kind, payload, size, capture, fields = head.get("warc-type", ""), None, None, None, None
    if kind in ("response", "revisit"):
        payload = block
        if block.startswith(b"HTTP/"):
            http, _, payload = block.partition(b"\r\n\r\n")
            size = _whole(_fields(http).get("content-length"))
        payload = payload if kind == "response" else None
    elif kind in ("resource", "conversion"):
        payload = block
    elif kind in ("metadata", "warcinfo"):
        fields = block.decode("utf-8", "replace")
        capture = _whole(_fields(b"\n" + block).get("capture-id"))
    if size is None and payload is not None:
        size = len(payload)
    get = head.get
    return name, kind, get("warc-record-id"), get("warc-concurrent-to"), get("warc-refers-to"), get("warc-target-uri"), get("warc-date"), get("warc-payload-digest"), capture, size, payload, fields


def parse(name: str, data: bytes) -> Iterator[tuple]:
    """The records of one archive in order."""
    held = b""
    for part in _unpacked(data):
        held, at = held + part if held else part, 0
        while True:
            while held[at : at + 2] == b"\r\n" or held[at : at + 1] == b"\n":
                at += 2 if held[at : at + 1] == b"\r" else 1
            end = held.find(b"\r\n\r\n", at)
            if end < 0:
                break
            head = _fields(held[at:end])
            start, n = end + 4, _whole(head.get("content-length"))
            if n is None:
                raise ValueError(f"{name}: a record without Content-Length")
            if len(held) < start + n:
                break
            yield _row(name, head, held[start : start + n])
            at = start + n
        held = held[at:]


def read_archives(spark: SparkSession, path: str, batch_rows: int = 512) -> DataFrame:
    """Every record of the archives below a path, one row each."""

    def records(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = []
                for row in parse(name, data):
                    found.append(row)
                    if len(found) == batch_rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _arrow(), strict=True)], names=_names())
                        found = []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _arrow(), strict=True)], names=_names())

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,warc,txt.gz,warc.gz}").option("recursiveFileLookup", "true").load(path).select("path", "content")
    # One file at a time in a Python worker: Arrow batches are cut by bytes as well as rows.
    return files.mapInArrow(records, _RECORD)


def _names() -> list[str]:
    return [x.split()[0] for x in _RECORD.split(", ")]


def _arrow() -> list:
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return [kinds[x.split()[1]] for x in _RECORD.split(", ")]


def assemble(records: DataFrame, with_payload: bool = True) -> DataFrame:
    """One nested row per capture: its response or revisit with its request and metadata, joined by concurrent-to.

    Payloads are digested where they were parsed; without `with_payload` they stay out of the shuffles."""
    hashed = records.withColumn("stored_digest", F.sha1("payload")).withColumn("stored_bytes", F.octet_length("payload").cast("long"))
    if not with_payload:  # parse the archives once: what is read twice below is the short table
        hashed = written(hashed.drop("payload"), "records")
    kept = ["file", "record_id", "warc_type", "target_uri", "date", "refers_to", "payload_digest", "payload_bytes", "stored_digest", "stored_bytes", *(["payload"] if with_payload else [])]
    main = hashed.filter(F.col("warc_type").isin("response", "revisit")).select(F.col("record_id").alias("rid"), F.struct(*kept).alias("response"))
    side = hashed.filter(F.col("warc_type").isin("request", "metadata")).select("record_id", "concurrent_to", "refers_to", "warc_type", F.struct("record_id", "target_uri", "date", "capture_id", "metadata").alias("r"))
    named = side.select(F.coalesce("concurrent_to", F.when(F.col("warc_type") == "metadata", F.col("refers_to"))).alias("rid"), "warc_type", "r").filter("rid is not null")
    # Other writers may let the response name its request.
    back = hashed.filter(F.col("warc_type").isin("response", "revisit") & F.col("concurrent_to").isNotNull()).select(F.col("concurrent_to").alias("record_id"), F.col("record_id").alias("rid"))
    side = named.unionByName(side.filter("concurrent_to is null").drop("concurrent_to", "refers_to").join(back, "record_id").select("rid", "warc_type", "r"))
    side = side.groupBy("rid").agg(F.max(F.when(F.col("warc_type") == "request", F.col("r"))).alias("request"), F.max(F.when(F.col("warc_type") == "metadata", F.col("r"))).alias("metadata"))
    return main.join(side, "rid", "left").select(F.col("rid").alias("record_id"), "request", "response", "metadata")


def resolved(captures: DataFrame) -> DataFrame:
    """capture_id, payload_bytes, payload_digest, record_type, refers_to: revisits take size and digest from the response that they refer to."""
    rows = captures.select("record_id", F.col("metadata.capture_id").alias("capture_id"), F.col("response.warc_type").alias("record_type"), F.col("response.refers_to").alias("ref"), F.col("response.stored_bytes").alias("bytes"), F.col("response.stored_digest").alias("digest"))
    # As a table of its own, so that the join below shuffles both sides and can split a response with many revisits.
    rows = written(rows, "captures")
    stored = rows.filter("record_type = 'response'").select(F.col("record_id").alias("ref"), F.col("capture_id").alias("refers_to"), F.col("bytes").alias("ref_bytes"), F.col("digest").alias("ref_digest"))
    named = rows.select("ref").distinct()
    stored = written(stored.join(named, "ref", "left_semi").dropDuplicates(["ref"]), "responses")
    out = rows.join(stored, "ref", "left")
    return out.select("capture_id", F.coalesce("bytes", "ref_bytes").alias("payload_bytes"), F.coalesce("digest", "ref_digest").alias("payload_digest"), "record_type", "refers_to")


def archive_round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write all pages as archives in the shared folder, read them back and resolve every capture."""
    path = write_archives(pages, scratch_path(pages.sparkSession, "warc"), **columns)
    return resolved(assemble(read_archives(pages.sparkSession, path), with_payload=False))
