"""WARC archives: written and read as sequences of gzip members, one a record.

The writer makes one archive per portion of a task's records, in the shared
folder; a manifest table, committed by Spark, names the archives of the tasks
that counted, so what a lost or repeated attempt left behind is never read.
The reader takes an archive as a stream: it inflates member after member
piece by piece, parses the head, takes as many bytes as Content-Length says,
and checks the block's and the payload's digest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Run, col

#: Compressed bytes after which the writer begins another archive, bytes the
#: reader takes at once, and bytes of payload that a batch of rows holds.
ARCHIVE, PIECE, BATCH = 64 << 20, 1 << 16, 16 << 20
#: Tasks that read archives at most; beyond, a task reads some after another.
MOST_READERS = 100_000
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else int(page_id)}>"


def page_of(ident: str | None) -> int | None:
    """Page id in a record id; None for a page without one."""
    name = ident[len("<urn:page:"):-1] if ident else "none"
    return None if name == "none" else int(name)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit
    of page ``refers_to`` with the HTTP head alone."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)),
            ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        # No character of a URL may end the line or the head.
        head.append(("WARC-Target-URI", "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode())
                                                for c in url)))
    if refers_to is not None:
        head += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", IDENTICAL)]
    head += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", "sha1:" + digest(payload)),
             ("WARC-Block-Digest", "sha1:" + digest(block)), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(lines.encode() + block + b"\r\n\r\n") + z.flush()


class Members:
    """The bytes of a stream's gzip members, one member after the other."""

    def __init__(self, stream) -> None:
        self.stream, self.rest = stream, b""

    def next_member(self) -> Member | None:
        if not self.rest:
            self.rest = self.stream.read(PIECE)
        return Member(self) if self.rest else None


class Member:
    """One member, inflated as it is read; never more than a piece ahead."""

    def __init__(self, source: Members) -> None:
        self.source, self.z, self.ready = source, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        s = self.source
        if self.z.eof:
            return False
        data = self.z.unconsumed_tail
        if not data:
            data, s.rest = s.rest or s.stream.read(PIECE), b""
        new = self.z.decompress(data, PIECE)
        if not data and not new and not self.z.eof:
            raise ValueError("the archive ends within a record")
        self.ready += new
        if self.z.eof:
            s.rest = self.z.unused_data
        return True

    def line(self) -> bytes:
        while (at := self.ready.find(b"\r\n")) < 0:
            if not self._more():
                raise ValueError("a record's head has no end")
        out, self.ready = self.ready[:at], self.ready[at + 2:]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.ready], len(self.ready)
        while have < n:
            self.ready = b""
            if not self._more():
                raise ValueError("a record is shorter than its Content-Length")
            parts.append(self.ready)
            have += len(self.ready)
        data = b"".join(parts)
        self.ready = data[n:]
        return data[:n]

    def end(self) -> None:
        while not self.z.eof:
            self._more()
        if self.ready != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")


def head_fields(member: Member) -> dict[str, str]:
    fields = {}
    while text := member.line().decode():
        name, _, value = text.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def read_records(stream) -> Iterator[dict]:
    """Records of an archive in order: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest (of the full payload, also for a revisit:
    as its head states them) and payload (None for a revisit)."""
    members = Members(stream)
    while (m := members.next_member()) is not None:
        if not m.line().startswith(b"WARC/"):
            raise ValueError("a member does not begin with a record's version")
        head = head_fields(m)
        block = m.take(int(head["content-length"]))
        m.end()
        if head["warc-block-digest"] != "sha1:" + digest(block):
            raise ValueError(f"block digest of {head['warc-record-id']}")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(next(x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")))
        kind = head["warc-type"]
        if kind == "response" and (len(payload) != size or head["warc-payload-digest"] != "sha1:" + digest(payload)):
            raise ValueError(f"payload of {head['warc-record-id']}")
        yield {"page_id": page_of(head["warc-record-id"]), "url": head.get("warc-target-uri"), "record_type": kind,
               "refers_to": page_of(head.get("warc-refers-to")), "payload_bytes": size,
               "payload_digest": head["warc-payload-digest"].removeprefix("sha1:"),
               "payload": payload if kind == "response" else None}


def _writer(folder: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, records = None, "", 0
        for b in batches:
            for page_id, url, html, refers_to in zip(b["page_id"], b["url"], b["html"], b["refers_to"]):
                if out is None:
                    # A name of its own for each attempt: attempts never write one file.
                    path, records = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{path}", compression=None)
                out.write(make_record(None if pd.isna(page_id) else int(page_id), url, (html or "").encode(),
                                      None if pd.isna(refers_to) else int(refers_to)))
                records += 1
                if out.tell() >= ARCHIVE:
                    out.close()
                    yield pd.DataFrame({"path": [path], "records": [records]})
                    out = None
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [path], "records": [records]})
    return write


_RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "payload binary")


def _reader(folder: str, columns: list[str]):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        def frame(rows: list[dict]) -> pd.DataFrame:
            whole = {"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"}
            t = pd.DataFrame(rows, columns=columns, dtype=object)
            return t.astype({k: v for k, v in whole.items() if k in columns})

        store, root = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, records in zip(b["path"], b["records"]):
                rows, held, count = [], 0, 0
                with store.open_input_stream(f"{root}/{path}", compression=None) as stream:
                    for r in read_records(stream):
                        rows.append({c: r[c] for c in columns})
                        held += len(r["payload"] or b"") if "payload" in columns else 256
                        count += 1
                        if held >= BATCH:
                            yield frame(rows)
                            rows, held = [], 0
                if count != records:
                    raise ValueError(f"{path}: {count} records, {records} were written")
                if rows:
                    yield frame(rows)
    return read


def write_archives(pages: DataFrame, run: Run, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   text_col: str = "html") -> tuple[DataFrame, str]:
    """Write one record per row of ``pages`` and return the manifest (path,
    records) and the folder the paths are in. Of pages whose payloads (the
    text in UTF-8; null: empty) are equal and have ``least_bytes`` or more,
    that with the largest id is a response and the others revisit it."""
    text = F.coalesce(col(text_col), F.lit(""))
    # Payloads are compared by two hashes and the length; the text itself is not grouped.
    same = F.struct(F.sha1(text).alias("sha1"), F.xxhash64(text).alias("xx"), F.octet_length(text).alias("bytes"))
    p = docs_of(pages, id_col, url_col, text_col).withColumn("same", same)
    groups = (p.groupBy("same").agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("last"))
              .filter((F.col("copies") > 1) & (F.col("same.bytes") >= least_bytes)).select("same", "last"))
    dealt = (p.join(groups, "same", "left")
             .withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")), F.col("last")))
             .select("page_id", "url", "html", "refers_to"))
    folder = f"{run.dir}/archives"
    manifest = run.stage(dealt.mapInPandas(_writer(_uri(folder)), "path string, records long"), "manifest")
    return manifest, folder


def docs_of(pages: DataFrame, id_col: str, url_col: str, text_col: str) -> DataFrame:
    return pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).alias("url"), col(text_col).alias("html"))


def _uri(folder: str) -> str:
    return folder if "://" in folder or not folder.startswith("file:") else "file://" + folder[len("file:"):]


def read_archives(manifest: DataFrame, folder: str, columns: list[str] | None = None) -> DataFrame:
    """The records of the manifest's archives (``columns`` of page_id, url,
    record_type, refers_to, payload_bytes, payload_digest, payload), each
    archive read in order by one task of its own in bounded memory; a damaged
    one fails the job. A manifest row is a few bytes, so that left to itself
    Spark would give all archives to one task: the number is given."""
    kinds = dict(c.split() for c in _RECORD.split(", "))
    columns = columns or list(kinds)
    each = manifest.repartitionByRange(max(1, min(manifest.count(), MOST_READERS)), F.col("path"))
    return each.mapInPandas(_reader(_uri(folder), columns), ", ".join(f"{c} {kinds[c]}" for c in columns))


def round_trip(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
               text_col: str = "html", columns: list[str] | None = None) -> DataFrame:
    """``pages`` written to archives and read back, one row per record.

    Null and empty texts are empty payloads (equal to each other). A page
    without an id is read back without one; it revisits an equal page that
    has an id, else it is a response. Rows that repeat a largest id and
    payload are all responses. A null URL is left out of the record. Extra
    columns are ignored; an empty table gives no rows."""
    run = Run(pages.sparkSession, "warc")
    manifest, folder = write_archives(pages, run, least_bytes, id_col, url_col, text_col)
    return read_archives(manifest, folder, columns)
