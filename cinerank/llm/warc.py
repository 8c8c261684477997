"""WARC archives compressed record by record with a shared Zstandard dictionary."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import materialize, scratch_path

#: Magic number of the skippable frame that holds the dictionary of a .warc.zst file.
DICT_FRAME = 0x184D2A5D
FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")
LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*(\d+)", re.I)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page: str, url: str, payload: bytes, sha: str, size: int, refers: str | None, date: str) -> bytes:
    """One WARC 1.1 record. A revisit has the headers only and names the response that holds its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [f"WARC/1.1\r\nWARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {date}",
            "WARC-Target-URI: " + re.sub(r"\s+", "%20", url), f"WARC-Payload-Digest: sha1:{sha}", f"WARC-Payload-Length: {size}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def classify(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) as rows (page_id, url, payload, payload_bytes, sha in hex, record_type, refers_to).

    Of the records with equal payloads of at least ``min_revisit_bytes`` bytes the smallest page_id is the response,
    the others revisit it; records with a null page_id revisit too, and if a payload has only those, all of them are
    responses. Rows that repeat the smallest page_id are responses each. The smallest ids are found on narrow rows,
    combined map-side; the payloads are shuffled once, to meet them, and only responses keep theirs."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha", F.sha1("payload"))
    first = p.groupBy("sha", "payload_bytes").agg(F.min("page_id").alias("_first"))
    again = F.coalesce((F.col("payload_bytes") >= min_revisit_bytes) & F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")), F.lit(False))
    p = p.join(first, ["sha", "payload_bytes"]).withColumn("_again", again)
    return p.select("page_id", "url", F.when(~F.col("_again"), F.col("payload")).alias("payload"), "payload_bytes", "sha",
                    F.when(F.col("_again"), "revisit").otherwise("response").alias("record_type"), F.when(F.col("_again"), F.col("_first")).alias("refers_to"))


def build_dictionary(pages: DataFrame, size: int = 65536, sample_rows: int = 1000, sample_bytes: int = 8192, seed: int = 3) -> bytes:
    """A dictionary trained on the records of at most ``sample_rows`` pages, each up to ``sample_bytes`` of its payload.

    The pages are chosen by hash order of their ids, on narrow rows; only the chosen ones' beginnings, 8 MB at
    most, reach the driver. Empty (no dictionary) if there is too little to train on."""
    import zstandard

    pick = pages.where("page_id is not null and html <> ''").select("page_id").distinct().orderBy(F.xxhash64(F.lit(seed), "page_id"), "page_id").limit(sample_rows)
    pick = materialize(pick, "warc_sample")
    part = F.substring(F.col("html").cast("binary"), 1, sample_bytes).alias("part")
    some = pages.join(F.broadcast(pick), "page_id").select("page_id", "url", part).orderBy("page_id", F.xxhash64("url", "part")).limit(sample_rows).collect()
    samples = [record("response", str(r.page_id), r.url or "", bytes(r.part), digest(bytes(r.part)), len(r.part), None, "1970-01-01T00:00:00Z")
               for r in sorted(some, key=lambda r: (r.page_id, bytes(r.part)))]
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_frame(data: bytes) -> bytes:
    return struct.pack("<II", DICT_FRAME, len(data)) + data if data else b""


def open_folder(folder: str):
    """The file system of a folder's URI, and the folder's path in it. A bare path is local, for tests."""
    uri = re.sub(r"^file:/+", "file:///", folder) if folder.startswith("file:") else folder
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write_archives(records: DataFrame, folder: str, dictionary: bytes, archive_bytes: int = 64 << 20, level: int = 6,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes ``records`` (of ``classify``) to ``folder``/*.warc.zst, and to ``folder``/index the rows (path, n_records) that
    it returns.

    Every task writes the records of its partition, a new archive whenever one exceeds ``archive_bytes`` compressed.
    A file has the number of its task's attempt in its name, and the index, which Spark commits, lists the files of the
    attempts that counted. What a lost or speculative attempt leaves behind is never read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        zdict = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if zdict:
            zdict.precompute_compress(level=level)
        packer = zstandard.ZstdCompressor(level=level, dict_data=zdict) if zdict else zstandard.ZstdCompressor(level=level)
        fs, root = open_folder(folder)
        fs.create_dir(root, recursive=True)
        me = TaskContext.get()
        out, size, count, done = None, 0, 0, []

        def name() -> str:
            return f"{me.partitionId():06d}-{me.taskAttemptId()}-{len(done):04d}.warc.zst"

        def finish():
            out.close()
            done.append((f"{folder}/{name()}", count))

        for b in batches:
            c = b.to_pydict()
            for page, url, payload, n, sha, kind, refers in zip(*c.values(), strict=True):
                if out is None:
                    out = fs.open_output_stream(f"{root}/{name()}", compression=None)
                    out.write(dictionary_frame(dictionary))
                    size = count = 0
                b32 = base64.b32encode(bytes.fromhex(sha)).decode()
                frame = packer.compress(record(kind, str(page), url or "", payload or b"", b32, n, None if refers is None else str(refers), date))
                out.write(frame)
                size, count = size + len(frame), count + 1
                if size >= archive_bytes:
                    finish()
                    out = None
        if out is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], ["path", "n_records"])

    fs, root = open_folder(folder)
    fs.create_dir(root, recursive=True)  # so that a table without pages has an empty folder to read
    cols = ["page_id", "url", "payload", "payload_bytes", "sha", "record_type", "refers_to"]
    records.select(*cols).mapInArrow(run, "path string, n_records long").write.mode("overwrite").parquet(f"{folder}/index")
    return records.sparkSession.read.parquet(f"{folder}/index")


def raw_records(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(headers, block) of the records of one archive, whose leading skippable frame holds the dictionary."""
    import zstandard

    at, zdict = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICT_FRAME:
        size = struct.unpack_from("<I", data, 4)[0]
        zdict = zstandard.ZstdCompressionDict(data[8:8 + size])
        at = 8 + size
    z = zstandard.ZstdDecompressor(dict_data=zdict) if zdict else zstandard.ZstdDecompressor()
    source = io.BytesIO(data)
    source.seek(at)
    stream = io.BufferedReader(z.stream_reader(source, read_across_frames=True), 1 << 20)
    while line := stream.readline():
        head = [line]
        while (line := stream.readline()) not in (b"\r\n", b""):
            head.append(line)
        whole = b"".join(head)
        block = stream.read(int(LENGTH.search(whole)[1]))
        stream.read(4)
        yield whole, block


def parse_record(head: bytes, block: bytes) -> dict:
    f = {k.decode().lower(): v.decode() for k, v in FIELD.findall(head.split(b"\r\n", 1)[1])}
    payload = block.partition(b"\r\n\r\n")[2]
    number = lambda s: None if s is None or s == "<urn:page:None>" else int(s[10:-1])
    return {"page_id": number(f["warc-record-id"]), "url": f["warc-target-uri"], "record_type": f["warc-type"], "payload": payload if f["warc-type"] == "response" else None,
            "payload_bytes": int(f["warc-payload-length"]), "payload_digest": f["warc-payload-digest"].removeprefix("sha1:"), "refers_to": number(f.get("warc-refers-to"))}


def read_archives(spark, folder: str, with_payload: bool = True) -> DataFrame:
    """Rows (page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of the archives that the index
    of ``folder`` lists.

    Of a response, length and digest are those of the payload that was read; a payload that differs from its header
    raises. Archives are read one at a time, each of bounded size. An empty folder gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                rows: list[dict] = []
                with fs.open_input_stream(root + "/" + path.rsplit("/", 1)[1], compression=None) as f:
                    data = f.read()
                for raw in raw_records(data):
                    r = parse_record(*raw)
                    if r["record_type"] == "response":
                        own = (len(r["payload"]), digest(r["payload"]))
                        if own != (r["payload_bytes"], r["payload_digest"]):
                            raise ValueError(f"record {r['page_id']}: payload and header differ")
                        if not with_payload:
                            r["payload"] = None
                    rows.append(r)
                    if len(rows) >= 256:
                        yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    files = spark.read.parquet(f"{folder}/index").select("path")
    return files.repartition(max(1, min(files.count(), 10_000)), "path").mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def warc_digest(pages: DataFrame) -> DataFrame:
    """Writes every page to archives below the shared folder, reads them back and returns what they hold."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    write_archives(classify(pages), folder, build_dictionary(pages))
    return read_archives(spark, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes, sha1(html) as hex from p),
v as (select *, list_transform(range(8), lambda k: cast('0x' || substr(hex, 5 * k + 1, 5) as bigint)) as parts,
             min(page_id) over (partition by hex, payload_bytes) as first_id from d)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           cast((parts[i // 4 + 1] >> cast(15 - 5 * (i % 4) as integer)) & 31 as integer) + 1, 1)), '') as payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from v
"""
