"""WARC archives: a whole file in one gzip stream goes in, one gzip member a record comes out.

A monolithic archive can only be read from its start. The normaliser inflates such a stream
once, in pieces, and writes every record as a member of its own beside an index of offsets;
from then on any run of records can be read by any task. Archives are written and read by
the tasks through ``pyarrow.fs`` (mounted folders, ``s3://``, ``gs://``, ``hdfs://``), under
a temporary name first, so that a task which is lost or repeated leaves no half file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import quote

from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmark.llm.common import Batches, map_batches, table
from tillmark.operators.skew import join_unique
from tillmark.staging import stage, staging_path

GZIP = 31
PIECE = 1 << 20
RUN = 8 << 20
BREAK = b"\r\n\r\n"
#: Longest head of a record that is believed.
HEAD = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def place(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path inside it."""
    if path.startswith("file:"):
        path = re.sub("^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class Output:
    """A file that appears under its name only when it is whole."""

    def __init__(self, folder: str, name: str):
        self.fs, root = place(folder)
        self.fs.create_dir(root, recursive=True)
        self.name, self.path = name, f"{root}/{name}"
        attempt = TaskContext.get()
        self.shadow = f"{self.path}.{attempt.taskAttemptId() if attempt else 0}.part"
        self.stream = self.fs.open_output_stream(self.shadow, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.shadow, self.path)


# Records --------------------------------------------------------------------


def record_id(key: object, digest: str) -> str:
    """``<urn:page:KEY:DIGEST>``: equal for equal rows only, and the key can be read from it."""
    return f"<urn:page:{'' if key is None else key}:{digest}>"


def head_of(kind: str, name: str, length: int, fields: dict[str, str | None]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {DATE}"]
    lines += [f"{k}: {v}" for k, v in fields.items() if v is not None]
    return ("\r\n".join([*lines, f"Content-Length: {length}"]) + "\r\n\r\n").encode()


def page_record(key: object, uri: str | None, payload: bytes, digest: str, refers_to: object) -> bytes:
    """A response, or, where ``refers_to`` names another page, a revisit that holds the HTTP head alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = {
        # Nothing in an address may end the line or the field.
        "WARC-Target-URI": None if uri is None else quote(uri, safe="%/:=&?~#+!$,;'@()*[]"),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http;msgtype=response",
    }
    kind, block = "response", http + payload
    if refers_to is not None:
        fields |= {"WARC-Refers-To": record_id(refers_to, digest), "WARC-Profile": PROFILE}
        kind, block = "revisit", http
    return head_of(kind, record_id(key, digest), len(block), fields) + block + BREAK


def fields_of(head: bytes) -> dict[str, str]:
    """Fields of a record's head by lower-case name."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def inflated(read, most: int = PIECE) -> Iterator[bytes]:
    """Pieces of the text of a gzip stream; ``read()`` gives compressed bytes until b''. Members may follow each other."""
    unzip = zlib.decompressobj(GZIP)
    begun = False
    while data := read():
        while data:
            begun = True
            if piece := unzip.decompress(data, most):
                yield piece
            data = unzip.unconsumed_tail
            if unzip.eof:
                data, unzip, begun = unzip.unused_data.lstrip(b"\0"), zlib.decompressobj(GZIP), False
    if begun and (rest := unzip.flush()):
        yield rest
    if begun and not unzip.eof:
        raise ValueError("the gzip stream ends too early")


class Records:
    """Records of a text that comes in pieces. Of a record only its head is held as a whole."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at = pieces, b"", 0

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held, self.at = self.held[self.at :] + piece, 0
        return True

    def head(self) -> bytes | None:
        """Head of the next record without its last line break; None at the end."""
        while True:
            while self.held[self.at : self.at + 1] in (b"\r", b"\n"):
                self.at += 1
            end = self.held.find(BREAK, self.at)
            if end >= 0:
                found, self.at = self.held[self.at : end], end + len(BREAK)
                return found
            if len(self.held) - self.at > HEAD:
                raise ValueError("the head of a record does not end")
            if not self._more():
                if self.held[self.at :].strip():
                    raise ValueError("the archive ends inside a record")
                return None

    def block(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes in pieces."""
        while length:
            if self.at == len(self.held) and not self._more():
                raise ValueError("the archive ends inside a record")
            part = self.held[self.at : self.at + length]
            self.at += len(part)
            length -= len(part)
            yield part


# Monolithic archives ----------------------------------------------------------


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """``key, digest, refers_to`` of the rows of ``key, digest, size`` that only repeat another's payload (an action).

    Of equal payloads of ``least`` bytes or more the one with the smallest key stays; NULL comes
    last. Rows that share that key are all kept whole.
    """
    slim = stage(pages.select("key", "digest", "size"), "digests")
    first = slim.where(F.col("size") >= least).groupBy("digest").agg(F.min("key").alias("refers_to"), F.count("*").alias("_n"))
    first = first.where((F.col("_n") > 1) & F.col("refers_to").isNotNull()).drop("_n")
    later = ~F.col("key").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull()
    return stage(join_unique(slim, first, ["digest"]).where(later).select("key", "digest", "refers_to").distinct(), "revisits")


def write_monolithic(pages: DataFrame, folder: str, least: int = 0, most: int = 1 << 30, level: int = 6) -> DataFrame:
    """``archive, records, bytes`` of the archives written (an action): ``key, uri, payload`` as WARC, one gzip stream a file.

    A file is closed at ``most`` bytes of text. Which pages are revisits is settled on digests
    alone; their list meets the pages by a join, which Spark makes a broadcast only where the
    written list is small. A NULL payload counts as empty, a NULL uri has no field.
    """
    full = pages.select("key", "uri", F.coalesce("payload", F.lit(b"")).alias("payload"))
    full = full.withColumn("digest", F.sha1("payload"))
    later = revisits(full.withColumn("size", F.length("payload")), least)
    same = full["key"].eqNullSafe(later["key"]) & (full["digest"] == later["digest"])
    told = full.join(later, same, "left").select(full["key"], "uri", "payload", full["digest"], "refers_to")

    def work(batches: Batches) -> Iterator[dict]:
        part, number, out, zipped, raw, records = TaskContext.get().partitionId(), 0, None, None, 0, 0

        def close() -> dict:
            out.write(zipped.flush())
            out.close()
            return {"archive": [out.name], "records": [records], "bytes": [out.size]}

        for batch in batches:
            for key, uri, payload, digest, refers_to in zip(*[batch.column(c).to_pylist() for c in ("key", "uri", "payload", "digest", "refers_to")]):
                if out is None:
                    out, zipped = Output(folder, f"{part:06d}-{number:05d}.warc.gz"), zlib.compressobj(level, zlib.DEFLATED, GZIP)
                    info = b"format: WARC File Format 1.1\r\n"
                    out.write(zipped.compress(head_of("warcinfo", f"<urn:archive:{out.name}>", len(info), {"Content-Type": "application/warc-fields"}) + info + BREAK))
                    raw, records = 0, 1
                record = page_record(key, uri, payload, base32_sha1(bytes.fromhex(digest)), refers_to)
                if data := zipped.compress(record):
                    out.write(data)
                raw, records = raw + len(record), records + 1
                if raw >= most:
                    yield close()
                    out, number = None, number + 1
        if out is not None:
            yield close()

    return stage(map_batches(told, work, "archive string, records long, bytes long"), "archives")


# The normaliser ---------------------------------------------------------------

INDEX = "archive string, offset long, length long, record_id string, record_type string, uri string"


def normalise_file(source: str, target: str, name: str, level: int = 6) -> Iterator[dict]:
    """Rewrite one archive, record by record; index rows come in portions."""
    fs, root = place(source)
    out = Output(target, name)
    rows: dict[str, list] = defaultdict(list)
    with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
        records = Records(inflated(lambda: stream.read(PIECE)))
        while (head := records.head()) is not None:
            fields = fields_of(head)
            start, member = out.size, zlib.compressobj(level, zlib.DEFLATED, GZIP)
            out.write(member.compress(head + BREAK))
            for part in records.block(int(fields["content-length"])):
                if data := member.compress(part):
                    out.write(data)
            out.write(member.compress(BREAK) + member.flush())
            found = (name, start, out.size - start, fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"))
            for column, value in zip(("archive", "offset", "length", "record_id", "record_type", "uri"), found, strict=True):
                rows[column].append(value)
            if len(rows["archive"]) == 4096:
                yield rows
                rows = defaultdict(list)
    out.close()
    yield rows


def normalise(archives: DataFrame, source: str, target: str, level: int = 6) -> DataFrame:
    """The index ``INDEX`` of the archives rewritten from folder ``source`` into ``target`` (an action).

    ``archives`` names files in column ``archive``; gzip streams of one or of many members are
    both read. A monolithic stream has one reader, so a file is one task's work and files run
    side by side; memory is some pieces of 1 MiB, however large a file or record. The index is
    also written to ``target/index``. A truncated or foreign file is an error; no file, no rows.
    """
    names = archives.select("archive").distinct()
    parts = max(1, archives.count())

    def work(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                yield from normalise_file(source, target, name, level)

    map_batches(names.repartition(parts), work, INDEX).write.mode("overwrite").parquet(f"{target}/index")
    return archives.sparkSession.read.schema(INDEX).parquet(f"{target}/index")


# Reading by the index -----------------------------------------------------------

READ = "record_id string, record_type string, uri string, refers_to string, payload_bytes long, payload_digest string, declared string"


def read_record(pieces: Iterator[bytes], keep: bool = False) -> dict:
    """Fields of one record and size and digest of its payload; the payload itself with ``keep``.

    A revisit holds no payload: size and digest are those that it declares.
    """
    records = Records(pieces)
    fields = fields_of(records.head() or b"")
    declared = (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None
    block, length = records.block(int(fields["content-length"])), None
    payload: list[bytes] = []
    if fields.get("content-type", "").startswith("application/http"):
        inner = Records(block)
        http = dict(line.lower().split(b": ", 1) for line in (inner.head() or b"").split(b"\r\n")[1:])
        length = int(http.get(b"content-length", 0))
        block = iter([inner.held[inner.at :]])
        rest = inner.pieces
    else:
        rest = iter(())
    digest, size = hashlib.sha1(), 0
    for source in (block, rest):
        for part in source:
            digest.update(part)
            size += len(part)
            if keep:
                payload.append(part)
    kind = fields.get("warc-type")
    sha = base32_sha1(digest.digest())
    if kind == "revisit":
        size, sha = length, declared
    made = {
        "record_id": fields.get("warc-record-id"), "record_type": kind, "uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"), "payload_bytes": size, "payload_digest": sha, "declared": declared,
    }
    return made | ({"payload": None if kind == "revisit" else b"".join(payload)} if keep else {})


class Members:
    """Members of archives by offset. Neighbours are fetched together, at most ``RUN`` bytes at a time."""

    def __init__(self, folder: str):
        self.fs, self.root = place(folder)
        self.name, self.file, self.size, self.from_, self.held = None, None, 0, 0, b""

    def pieces(self, name: str, offset: int, length: int) -> Iterator[bytes]:
        if name != self.name:
            self.close()
            self.name, self.file, self.from_, self.held = name, self.fs.open_input_file(f"{self.root}/{name}"), 0, b""
            self.size = self.file.size()
        end = offset + length
        while offset < end:
            if not self.from_ <= offset < self.from_ + len(self.held):
                self.from_, self.held = offset, self.file.read_at(min(RUN, self.size - offset), offset)
                if not self.held:
                    raise ValueError(f"{name} ends before a record of its index")
            at = offset - self.from_
            part = self.held[at : at + end - offset]
            offset += len(part)
            yield part

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def read(index: DataFrame, folder: str, payload: bool = False, run: int = 32 << 20) -> DataFrame:
    """Records that ``index`` names, read from ``folder``: columns ``READ``, and ``payload`` on demand.

    Each member is inflated on its own. Tasks take runs of about ``run`` bytes, so a large archive
    is read by many at once. ``payload_digest`` is computed from what was read, ``declared`` is the
    field of the record; of a revisit both are the field. An empty index gives no rows.
    """
    schema = READ + (", payload binary" if payload else "")
    volume = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = max(index.sparkSession.sparkContext.defaultParallelism, -(-volume // run))
    dealt = index.select("archive", "offset", "length").repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")

    def work(batches: Batches) -> Iterator[dict]:
        members = Members(folder)
        for batch in batches:
            rows: dict[str, list] = defaultdict(list)
            held = 0
            for name, offset, length in zip(*[batch.column(c).to_pylist() for c in ("archive", "offset", "length")]):
                compressed = members.pieces(name, offset, length)
                made = read_record(inflated(lambda: next(compressed, b"")), payload)  # noqa: B023 - used at once
                for column, value in made.items():
                    rows[column].append(value)
                held += len(made.get("payload") or b"")
                if held > RUN:
                    yield rows
                    rows, held = defaultdict(list), 0
            yield rows
        members.close()

    return map_batches(dealt, work, schema)


def archived(pages: DataFrame, least: int = 0, key: str = "page_id", uri: str = "url", text: str = "html") -> DataFrame:
    """Every page as a WARC record: written, normalised and read back (an action).

    Columns ``key``, ``payload_bytes``, ``payload_digest`` (base32 SHA-1), ``record_type``,
    ``refers_to``. The payload is the text in UTF-8; NULL is empty. Rows of equal payload and key
    are all responses; a NULL key comes after all others and stays NULL. One row a row of the
    table; an empty table gives none. Other columns are not read.
    """
    spark = pages.sparkSession
    root = staging_path(spark, "warc")
    slim = pages.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{uri}`").cast("string").alias("uri"), F.col(f"`{text}`").cast("string").cast("binary").alias("payload")
    )
    written = write_monolithic(slim, f"{root}/whole", least)
    index = normalise(written, f"{root}/whole", f"{root}/members")
    found = read(index.where("record_type in ('response', 'revisit')"), f"{root}/members")
    page = [F.split(c, ":")[2].try_cast("long") for c in ("record_id", "refers_to")]
    return found.select(page[0].alias(key), "payload_bytes", "payload_digest", "record_type", page[1].alias("refers_to"))


def op11_gzip_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    return archived(table(spark, folder, "pages"))


ORACLE = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, CAST(from_hex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS bits FROM pages),
d AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i:
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(5), lambda j:
        CAST(bits[5 * i + j + 1] AS INT) * (1 << CAST(4 - j AS INT))))::INT]), '') AS payload_digest
  FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM head THEN NULL ELSE head END AS refers_to
FROM f
"""
