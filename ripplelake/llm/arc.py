"""Converts legacy ARC archives to WARC.

An ARC file starts with a ``filedesc:`` record whose block names the version.  Each record is a header line, which
version 1 has as ``url ip date type length`` and version 2 as ``url ip date type status checksum location offset filename
length``, then as many bytes as the line declares, then a line feed.  A field list that the first record declares goes before these.
A content type may hold blanks.  The converter walks the file by the lengths; a record whose header or length is broken is set aside
(``broken_arc`` lists file, offset and reason), and the walk goes on at the next line that looks like a header.  It makes
the WARC fields: a UUID of the name kind from file, offset and URL, the date in ISO form, the record type, and SHA-1 digests of block and payload.  Equal
payloads become one response (the one with the smallest id) and revisits that refer to it.

Archives are written with Spark's text writer (bytes as they are; the line separator is the record's end) and read back with the
``binaryFile`` source, so any file system that Spark reaches will do.  A file has a bounded number of records.

Nulls: a null html is an empty payload, a null url a made-up URN; a null page_id gives a record that has no ``X-Record-Number``.  An empty
table gives archives with header records only and no row.  Repeated rows are records of their own; of those with the
same id and payload one is the response.  Other columns are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelake.llm.common import stored
from ripplelake.session import scratch

#: The field lists that the two versions declare.
V1 = "URL IP-address Archive-date Content-type Archive-length"
V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
DATE = "20200101000000"
#: Records of an archive file.
PER_FILE = 2000


def write_arc(pages: DataFrame, per_file: int = PER_FILE) -> str:
    """The pages as ARC files in the shared folder, alternately of version 1 and 2; returns the folder."""
    url = F.coalesce(F.col("url"), F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))))
    url = F.regexp_replace(url, r"[\s\x00-\x20]", "%20")
    block = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"),
        F.coalesce(F.concat(F.lit("X-Record-Number: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")),
        F.lit("\r\n"),
        F.coalesce(F.col("html"), F.lit("")),
    )
    rows = pages.select(url.alias("url"), block.alias("block"), F.col("page_id"))
    files = max(1, -(-rows.count() // per_file))

    def lay_out(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        version = 1 + number % 2
        desc = f"{version} 0 Origin\n{V1 if version == 1 else V2}\n"
        head = f"filedesc://{number}.arc 0.0.0.0 {DATE} text/plain "
        yield pd.DataFrame({"value": [f"{head}{len(desc)}\n{desc}" if version == 1 else f"{head}200 - - 0 {number}.arc {len(desc)}\n{desc}"]})
        for part in parts:
            out = []
            for url, block in zip(part["url"], part["block"]):
                n = len(block.encode())
                more = "" if version == 1 else f"200 - - 0 {number}.arc "
                out.append(f"{url} 0.0.0.0 {DATE} text/html {more}{n}\n{block}")
            yield pd.DataFrame({"value": out})

    path = scratch(pages.sparkSession, "arc")
    dealt = rows.repartition(files, F.xxhash64("page_id", "url", F.length("block"))).select("url", "block")
    dealt.mapInPandas(lay_out, "value string").write.option("lineSep", "\n").option("compression", "gzip").text(path)
    return path


HEADER = re.compile(rb"\n(?=[A-Za-z][A-Za-z0-9+.-]*:[^ \n]* [^ \n]+ \d{8,17} [^\n]* \d+\r?\n)")


def _fields(line: str, names: list[str]) -> dict[str, str]:
    """The fields of a header line.  Only the content type may hold blanks, so what follows it is counted from the end."""
    values, kind = line.split(" "), names.index("Content-type")
    spare = len(values) - len(names)
    if spare < 0 or not (values[-1].isascii() and values[-1].isdigit()):
        raise ValueError(f"header of {len(values)} fields, {len(names)} declared")
    return dict(zip(names, [*values[:kind], " ".join(values[kind : kind + spare + 1]), *values[kind + spare + 1 :]]))


def _declared(block: bytes) -> list[str] | None:
    """The field list in the block of a ``filedesc`` record, if it has one that can be used."""
    lines = block.decode("utf-8", "replace").splitlines()
    names = lines[1].split() if len(lines) > 1 else []
    needed = {"URL", "IP-address", "Archive-date", "Content-type", "Archive-length"}
    return names if needed <= set(names) and names[0] == "URL" and names[-1] == "Archive-length" else None


def arc_records(content: bytes, aside: list[tuple[int, str]] | None = None) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, header fields, block)`` of each record.

    Where lengths and lines disagree it raises ValueError; with ``aside``, it notes offset and reason there and goes on at
    the next line that looks like a header.
    """
    at, names = 0, V1.split()
    while at < len(content):
        try:
            end = content.find(b"\n", at)
            if end < 0:
                raise ValueError("no header line")
            line = content[at:end].decode("utf-8", "replace").strip("\r")
            described = line.startswith("filedesc:")
            if described:
                names = (V1 if len(line.split(" ")) < len(V2.split()) else V2).split()
            fields = _fields(line, names)
            stop = end + 1 + int(fields["Archive-length"])
            if stop > len(content):
                raise ValueError("record is cut short")
        except ValueError as why:
            if aside is None:
                raise ValueError(f"{why} at {at}") from None
            aside.append((at, str(why)))
            later = HEADER.search(content, at)
            at = later.end() if later else len(content)
            continue
        block = content[end + 1 : stop]
        if described:
            names = _declared(block) or names
        yield at, fields, block
        at = stop
        while content[at : at + 1] == b"\n":
            at += 1


def _unpacked(name: str, content: bytes, aside: list[tuple[int, str]]) -> bytes:
    """The bytes of a file; of a damaged gzip file those before the damage, which is noted."""
    if not name.endswith(".gz"):
        return content
    out = []
    while content:
        member = zlib.decompressobj(wbits=31)
        try:
            out.append(member.decompress(content))
        except zlib.error as why:
            aside.append((sum(map(len, out)), f"gzip: {why}"))
            break
        if not member.eof:
            aside.append((sum(map(len, out)), "gzip: cut short"))
            break
        content = member.unused_data.lstrip(b"\0")
    return b"".join(out)


RECORDS = (
    "record_id string, url string, date string, ip string, number long, payload_digest string, block_digest string, "
    "payload_bytes long, block binary"
)


def _base32(data: bytes) -> str:
    import base64
    import hashlib

    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _split(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header and payload."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    return (head + mark, payload) if mark else (b"", block)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Archive files; names that start with a dot or an underscore are Spark's own."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of ARC files with the fields that WARC needs; the ``filedesc`` records and broken ones are left out."""

    def convert(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, content in zip(part["path"], part["content"]):
                rows, aside = [], []
                for at, fields, block in arc_records(_unpacked(name, bytes(content), aside), aside):
                    if fields["URL"].startswith("filedesc:"):
                        continue
                    head, payload = _split(block)
                    number = re.search(rb"X-Record-Number: (-?\d+)\r", head)
                    d = fields["Archive-date"].ljust(14, "0")
                    rows.append(
                        (f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {at} {fields['URL']}')}>", fields["URL"],
                         f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z", fields["IP-address"],
                         int(number[1]) if number else None, _base32(payload), _base32(block), len(payload), block)
                    )
                    if len(rows) == 200:
                        yield _frame(rows)
                        rows = []
                yield _frame(rows)

    return _files(spark, path).mapInPandas(convert, RECORDS)


def broken_arc(spark: SparkSession, path: str) -> DataFrame:
    """What ``read_arc`` leaves out: ``path, offset, reason``, offsets in the unpacked file."""

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, content in zip(part["path"], part["content"]):
                aside: list[tuple[int, str]] = []
                for _ in arc_records(_unpacked(name, bytes(content), aside), aside):
                    pass
                yield pd.DataFrame([(name, *one) for one in aside], columns=["path", "offset", "reason"]).astype({"offset": "int64"})

    return _files(spark, path).mapInPandas(walk, "path string, offset long, reason string")


def _frame(rows: list[tuple], names: str = RECORDS) -> pd.DataFrame:
    columns = [c.split()[0] for c in names.split(", ")]
    frame = pd.DataFrame(rows, columns=columns)
    return frame.astype({c: "Int64" for c in ("number", "refers_to") if c in columns})


def write_warc(records: DataFrame, least_bytes: int = 0) -> str:
    """The records as WARC files in the shared folder: of equal payloads one response, the others revisits of it."""
    records = stored(records, "records")
    key = F.struct(F.col("number").isNull().alias("a"), F.col("number").alias("n"), F.col("record_id").alias("r"), F.col("url").alias("u"))
    firsts = stored(
        records.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(
            F.min(key).alias("first"), F.count("*").alias("n")
        ).where("n > 1").drop("n"),
        "firsts",
    )
    joined = records.join(firsts, ["payload_digest", "payload_bytes"], "left")
    revisit = F.coalesce(F.col("first.r") != F.col("record_id"), F.lit(False))
    block = F.when(revisit, F.expr("substring(block, 1, 0)").cast("string")).otherwise(F.col("block").cast("string"))
    text = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), F.col("record_id"),
        F.lit("\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Date: "), F.col("date"),
        F.lit("\r\nWARC-IP-Address: "), F.col("ip"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.coalesce(F.concat(F.lit("\r\nX-Record-Number: "), F.col("number").cast("string")), F.lit("")),
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
                F.col("first.r"), F.lit("\r\nWARC-Refers-To-Target-URI: "), F.col("first.u"),
                F.coalesce(F.concat(F.lit("\r\nX-Refers-To-Number: "), F.col("first.n").cast("string")), F.lit("")),
            ),
        ).otherwise(F.concat(F.lit("\r\nWARC-Block-Digest: sha1:"), F.col("block_digest"))),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block,
    )
    path = scratch(records.sparkSession, "warc")
    writer = joined.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", PER_FILE)
    writer.option("compression", "gzip").text(path)
    return path


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.0":
            raise ValueError(f"no record at {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(fields["Content-Length"])
        yield fields, content[start:stop]
        at = stop + 4


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string, payload_ok boolean"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files; ``payload_ok`` is whether a response's payload has the digest and length it declares."""

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip

        for part in parts:
            for content in part["content"]:
                rows = []
                for f, block in warc_records(gzip.decompress(bytes(content))):
                    number = lambda name: int(f[name]) if name in f else None  # noqa: B023, E731
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                    payload = _split(block)[1]
                    ok = f["WARC-Type"] == "revisit" or (_base32(payload) == digest and len(payload) == int(f["X-Payload-Length"]))
                    rows.append(
                        (number("X-Record-Number"), int(f["X-Payload-Length"]), digest, f["WARC-Type"],
                         number("X-Refers-To-Number"), f["WARC-Record-ID"], f["WARC-Target-URI"], ok)
                    )
                frame = _frame(rows, READ)
                yield frame.astype({"page_id": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(parse, READ)


def convert(spark: SparkSession, arc_path: str) -> str:
    """ARC files to WARC files; returns the folder."""
    return write_warc(read_arc(spark, arc_path))


def round_trip(pages: DataFrame, per_file: int = PER_FILE) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the WARC read back."""
    spark = pages.sparkSession
    return read_warc(spark, convert(spark, write_arc(pages, per_file)))
