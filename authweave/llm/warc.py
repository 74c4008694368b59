"""WARC archives, dictionary-compressed: a leading skippable frame holds a Zstandard
dictionary built from the archive's records, each record is a frame of its own."""

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authweave.llm.tables import stored
from authweave.workspace import new_path

ARCHIVE_BYTES = 16 * 1024 * 1024  # uncompressed records of an archive; bounds a task's memory
SAMPLE_BYTES = 1024 * 1024  # evenly spread records the dictionary is built from
DICTIONARY_BYTES = 48 * 1024
REVISIT_BYTES = 1000  # smaller payloads are always stored whole
CHUNK = 64 * 1024
MAX_READERS = 20_000  # tasks that read archives; each reads its archives one after another
DATE = "2000-01-01T00:00:00Z"
SKIPPABLE = (0x184D2A5D).to_bytes(4, "little")  # fixed by the format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the format
MANIFEST = "archive string, records long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, "
    "payload_digest string, payload_bytes long, payload binary"
)


def _record(page_id, url, digest: bytes, size: int, payload: bytes, refers_to) -> bytes:
    """One WARC/1.1 record. Null ids and URLs are left out of the header."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest.hex()}')}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        f"X-Payload-Length: {size}",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """From records spread evenly over the archive; none where they are too few to build one."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    sample = [r[:128 * 1024] for r in records[::step]]
    if len(sample) < 8:
        return None
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, sample)) // 8))
    try:
        return zstandard.train_dictionary(size, sample, k=256, d=8)
    except zstandard.ZstdError:
        return None


def archive_bytes(records: list[bytes], level: int = 3) -> bytes:
    """The file of one archive."""
    trained = _dictionary(records)
    out = io.BytesIO()
    if trained is not None:
        raw = trained.as_bytes()
        out.write(SKIPPABLE + len(raw).to_bytes(4, "little") + raw)
        trained.precompute_compress(level=level)
    packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_content_size=True)
    for record in records:
        out.write(packer.compress(record))
    return out.getvalue()


def read_archive(file) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, one record in memory at a time."""
    head = file.read(8)
    trained = None
    if head[:4] == SKIPPABLE:
        raw = file.read(int.from_bytes(head[4:], "little"))
        if raw[:4] == (0xFD2FB528).to_bytes(4, "little"):  # the dictionary may be compressed
            raw = zstandard.ZstdDecompressor().decompress(raw)
        trained = zstandard.ZstdCompressionDict(raw)
    else:
        file.seek(0)
    unpacker = zstandard.ZstdDecompressor(dict_data=trained)
    data = file.read(CHUNK)
    while data:
        frame, parts = unpacker.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                break
            data = file.read(CHUNK)
            if not data:
                raise EOFError("the archive ends within a record")
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        fields = (line.partition(": ") for line in head.decode().split("\r\n")[1:])
        headers = {name: value for name, _, value in fields}
        yield headers, rest[:int(headers["Content-Length"])]
        data = frame.unused_data or file.read(CHUNK)


def _place(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def plan_records(pages: DataFrame, key: str = "page_id", body: str = "html") -> DataFrame:
    """page_id, url, payload, digest, size and refers_to (null: the record is a response).

    Of equal payloads of REVISIT_BYTES or more the row with the largest id is the response
    and the others revisit it; rows that repeat that id with that payload are responses too.
    A null id is smaller than any other; payloads that only rows without an id have are all
    responses. Digests are grouped without the payloads; a hot payload is one group of
    partial maxima, and its rows are split by adaptive execution in the join.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col(body), "UTF-8"), F.lit(b"")).alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    latest = (
        rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size")
        .agg(F.max("page_id").alias("latest"), F.count("*").alias("copies"))
        .where("copies > 1").drop("copies")
    )
    same = F.col("page_id").eqNullSafe(F.col("latest")) | F.col("latest").isNull()
    return rows.join(latest, ["digest", "size"], "left").select(
        "page_id", "url", "payload", "digest", "size",
        F.when(~same, F.col("latest")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the planned records as archives below `folder`; returns the manifest.

    `folder` is a URI that all executors can write. A task writes an archive for each
    ARCHIVE_BYTES of records under a name of its own; the manifest, a table of Spark's, lists
    only those of tasks that ended well, so a task that runs again leaves no double records.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _place(folder)
        system.create_dir(root, recursive=True)

        def flush(records: list[bytes]) -> pd.DataFrame:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(archive_bytes(records))
            return pd.DataFrame({"archive": [f"{folder}/{name}"], "records": [len(records)]})

        waiting, size = [], 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                refers = None if pd.isna(row.refers_to) else int(row.refers_to)
                page = None if pd.isna(row.page_id) else int(row.page_id)
                waiting.append(_record(
                    page, row.url, bytes.fromhex(row.digest), row.size,
                    row.payload if refers is None else b"", refers,
                ))
                size += len(waiting[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush(waiting)
                    waiting, size = [], 0
        if waiting:
            yield flush(waiting)

    light = records.withColumns({  # ids as text: pandas would turn long with nulls into float
        "payload": F.when(F.col("refers_to").isNull(), F.col("payload")),
        "page_id": F.col("page_id").cast("string"),
        "refers_to": F.col("refers_to").cast("string"),
    })
    return stored(light.mapInPandas(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all archives, digests of responses checked against their payloads.

    A record whose payload does not have the digest of its header ends the job. Without
    `payloads` the payload column is null.
    """

    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("payload", pa.binary()),
    ])

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for archive in frame["archive"]:
                system, path = _place(archive)
                rows, size = [], 0
                with system.open_input_file(path) as file:
                    for headers, block in read_archive(file):
                        digest = base64.b32decode(headers["WARC-Payload-Digest"][5:]).hex()
                        payload = None
                        if headers["WARC-Type"] == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4:]
                            if hashlib.sha1(payload).hexdigest() != digest:
                                raise ValueError(f"payload of {headers['WARC-Record-ID']} differs")
                        refers, page = headers.get("X-Refers-To-Page"), headers.get("X-Page-ID")
                        rows.append({
                            "page_id": page and int(page),
                            "url": headers.get("WARC-Target-URI"),
                            "record_type": headers["WARC-Type"],
                            "refers_to": refers and int(refers), "payload_digest": digest,
                            "payload_bytes": int(headers["X-Payload-Length"]),
                            "payload": payload if payloads else None,
                        })
                        size += len(block) if payloads else 300
                        if size > ARCHIVE_BYTES // 4:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    def read_arrow(batches):
        return read(batch.to_pandas() for batch in batches)

    files = max(1, manifest.count())
    return manifest.repartition(min(files, MAX_READERS), "archive").mapInArrow(read_arrow, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes a record per page below `folder` and returns what the archives hold.

    Null bodies are empty payloads, an empty table gives no archive and no rows, repeated
    rows are written each, and other columns are not looked at.
    """
    folder = folder or new_path(pages.sparkSession, "warc")
    return read_archives(write_archives(plan_records(pages), folder), payloads=False)
