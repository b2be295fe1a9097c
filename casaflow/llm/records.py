"""Token-id files: length-delimited binary records with a separate offset index.

A data file is a sequence of frames::

    u64 length | u32 masked crc32(length bytes) | payload | u32 masked crc32(payload)

(little endian; mask: rotate right by 15, add 0xA282EAD8). A payload is one
serialized document: i64 id, u8 "id is not null", u8 bytes per token id, u16
zero, then the ids. The index file holds one fixed-width entry per record
(id, offset, frame length, number of ids), so any record is one seek away.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casaflow.session import ship_package

MASK_DELTA = 0xA282EAD8
HEAD = np.dtype([("length", "<u8"), ("crc", "<u4")])
META = np.dtype([("id", "<i8"), ("valid", "u1"), ("width", "u1"), ("zero", "<u2")])
ENTRY = np.dtype([("id", "<i8"), ("valid", "<u8"), ("offset", "<u8"), ("length", "<u8"), ("n_ids", "<u8")])
SHARDS = "shard int, data_file string, index_file string, n_docs long, n_ids long, n_bytes long"
DOCS = "shard int, row long, doc_id long, start_in_shard long, n_tokens long, ids binary, ids_crc32 long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One framed record."""
    length = len(payload).to_bytes(8, "little")
    return b"".join((length, masked_crc(length).to_bytes(4, "little"), payload,
                     masked_crc(payload).to_bytes(4, "little")))


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the frame at ``at`` and the next frame's position; raises
    ValueError when a length or checksum doesn't hold."""
    if at + 12 > len(data):
        raise ValueError(f"truncated record at {at}")
    length = int.from_bytes(data[at:at + 8], "little")
    if masked_crc(data[at:at + 8]) != int.from_bytes(data[at + 8:at + 12], "little"):
        raise ValueError(f"bad length checksum at {at}")
    end = at + 12 + length
    if end + 4 > len(data):
        raise ValueError(f"truncated record at {at}")
    payload = data[at + 12:end]
    if masked_crc(payload) != int.from_bytes(data[end:end + 4], "little"):
        raise ValueError(f"bad payload checksum at {at}")
    return payload, end + 4


def serialize(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    meta = np.array([(doc_id or 0, doc_id is not None, width, 0)], dtype=META)
    return meta.tobytes() + ids.astype(f"<u{width}").tobytes()


def deserialize(payload: memoryview) -> tuple[int | None, np.ndarray]:
    meta = np.frombuffer(payload[:META.itemsize], META)[0]
    ids = np.frombuffer(payload[META.itemsize:], f"<u{int(meta['width'])}")
    return (int(meta["id"]) if meta["valid"] else None), ids


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text", end_id: int | None = 2, shard_bytes: int = 32 << 20,
                  width: int | None = None) -> DataFrame:
    """Encode every whole text and write the ids in ascending id order.

    Returns the manifest, one row per shard, written beside the data as
    Parquet: only files it names count, so files of lost or repeated attempts
    (each attempt writes files of its own name) are never read. Nulls: a null
    text is empty (just the end id), null ids come first and stay null. Equal
    ids are all kept, ordered by their text's hash; an id that most rows share
    is still spread over shards. Very long texts are one record. An empty table
    gives an empty manifest. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    pick = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = pick.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    n = max(1, -(-int(size) // shard_bytes))
    if width is None:
        from tokenizers import Tokenizer
        width = 2 if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else 4
    order = [F.col("doc_id"), F.col("h"), F.col("row")]
    sorted_docs = (pick.withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
                   .repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from casaflow.llm.tokens import encoder
        enc = encoder(tokenizer_path)
        shard = TaskContext.get().partitionId()
        name = f"{folder.rstrip('/')}/shard-{shard:05d}-{uuid.uuid4().hex[:12]}"
        out, entries, at, n_ids = None, [], 0, 0
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                ids, offsets = enc.encode([t or "" for t in part.column(1).to_pylist()])
                blob = []
                for k, doc_id in enumerate(part.column(0).to_pylist()):
                    own = ids[offsets[k]:offsets[k + 1]]
                    own = own if end_id is None else np.append(own, np.uint32(end_id))
                    blob.append(frame(serialize(doc_id, own, width)))
                    entries.append((doc_id or 0, doc_id is not None, at, len(blob[-1]), len(own)))
                    at += len(blob[-1])
                    n_ids += len(own)
                if out is None:
                    store, path = _open(f"{name}.rec")
                    if isinstance(store, pafs.LocalFileSystem):
                        store.create_dir(path.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(path)
                out.write(b"".join(blob))
        if out is not None:
            out.close()
            store, path = _open(f"{name}.idx")
            with store.open_output_stream(path) as f:
                f.write(np.array(entries, dtype=ENTRY).tobytes())
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "data_file": [f"{name}.rec"], "index_file": [f"{name}.idx"],
                "n_docs": [len(entries)], "n_ids": [n_ids], "n_bytes": [at]})

    sorted_docs.mapInArrow(write, SHARDS).write.mode("errorifexists").parquet(f"{folder.rstrip('/')}/_manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The shards with ``first_id``, the number of ids in all shards before."""
    shards = spark.read.schema(SHARDS).parquet(f"{folder.rstrip('/')}/_manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)   # one row per shard file
    return shards.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def _spread(manifest: DataFrame) -> DataFrame:
    """The manifest dealt to about as many tasks as it has shards. The number is
    given since rows that name files are tiny: by their size all would be one."""
    return manifest.repartition(max(1, manifest.count()), F.col("shard"))


def read_records(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Read the files back in order, checking both checksums of each frame.

    One row per document: doc_id, ``start`` (ids of all documents before it),
    n_tokens, ids_crc32 (of the ids as little-endian u32), the shard and row,
    and the ids themselves as u32 bytes unless ``with_ids`` is false.
    """
    ship_package(spark)
    manifest = read_manifest(spark, folder).select("shard", "data_file", "first_id")
    spread = _spread(manifest)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path, first in zip(*(c.to_pylist() for c in batch.columns)):
                store, local = _open(path)
                with store.open_input_stream(local) as f:
                    yield from _documents(f, shard, first, with_ids)

    return spread.mapInArrow(read, DOCS.replace("start_in_shard", "start")).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "shard", "row", *(["ids"] if with_ids else []))


def _documents(stream, shard: int, first: int, with_ids: bool, block: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of documents of one data file, read block by block."""
    rest, row, start, ended = b"", 0, first, False
    while not ended:
        more = stream.read(block)
        ended = not more
        data, at, cols = memoryview(rest + more), 0, [[] for _ in range(7)]
        while at + 12 <= len(data):
            length = int.from_bytes(data[at:at + 8], "little")
            if not ended and at + 16 + length > len(data):
                break
            payload, at = unframe(data, at)
            doc_id, ids = deserialize(payload)
            wide = ids.astype("<u4").tobytes()
            for col, value in zip(cols, (shard, row, doc_id, start, len(ids), wide if with_ids else None, zlib.crc32(wide))):
                col.append(value)
            row, start = row + 1, start + len(ids)
        rest = bytes(data[at:])
        if cols[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
                names=["shard", "row", "doc_id", "start", "n_tokens", "ids", "ids_crc32"])
    if rest:
        raise ValueError(f"truncated record at the end of shard {shard}")


def shuffled_records(spark: SparkSession, folder: str, seed: int, partitions: int | None = None) -> DataFrame:
    """Every record once, in a seeded random order: entries of the offset index
    are shuffled (24 bytes a document) and each record is read by one seek.
    Columns: position (within its partition), doc_id, ids (u32 bytes)."""
    ship_package(spark)
    manifest = read_manifest(spark, folder).select("shard", "data_file", "index_file")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data, index in zip(*(c.to_pylist() for c in batch.columns)):
                store, local = _open(index)
                with store.open_input_stream(local) as f:
                    table = np.frombuffer(f.read(), ENTRY)
                yield pa.RecordBatch.from_pydict({
                    "data_file": [data] * len(table), "shard": pa.array([shard] * len(table), pa.int32()),
                    "offset": table["offset"].astype(np.int64), "length": table["length"].astype(np.int64)})

    index = _spread(manifest).mapInArrow(entries, "data_file string, shard int, offset long, length long")
    at = F.xxhash64(F.lit(seed), F.col("shard"), F.col("offset"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.withColumn("at", at).repartitionByRange(n, "at").sortWithinPartitions("at")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[str, object] = {}
        position = 0
        for batch in batches:
            cols: list[list] = [[], [], []]
            for path, _, offset, length, _ in zip(*(c.to_pylist() for c in batch.columns)):
                if path not in files:
                    if len(files) >= 256:
                        files.pop(next(iter(files))).close()
                    store, local = _open(path)
                    files[path] = store.open_input_file(local)
                payload, _ = unframe(memoryview(files[path].read_at(length, offset)), 0)
                doc_id, ids = deserialize(payload)
                for col, value in zip(cols, (position, doc_id, ids.astype("<u4").tobytes())):
                    col.append(value)
                position += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary()))],
                                             names=["position", "doc_id", "ids"])

    return dealt.mapInArrow(read, "position long, doc_id long, ids binary")
