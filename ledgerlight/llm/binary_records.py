"""Token ids as length-delimited binary records, with a separate offset index.

A shard holds neighbouring documents in ascending order of their ids. Its file
``shard-N.rec`` has one record per document::

    length   u64   bytes of the payload
    check    u32   masked CRC-32 of the length
    payload        the token ids, 2 or 4 bytes each (``u2`` or ``u4`` in the file name), little-endian
    check    u32   masked CRC-32 of the payload

A CRC is masked as ``(crc >> 15 | crc << 17) + 0xA282EAD8`` modulo 2**32, so that a
checksum of data that itself holds checksums stays telling. ``shard-N.idx`` has
one entry per record (id, whether there is an id, byte offset, number of ids)
and ends with its own masked CRC, so a reader fetches any record without reading
the others. Files come into being under a name of their attempt and are renamed
when complete: a lost or doubled task leaves no half file behind.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlight.llm.storage import Workspace, map_batches, shuffle_files_dropped
from ledgerlight.llm.text_arrays import blocks
from ledgerlight.llm.tokens import encoder

INDEX_ENTRY = np.dtype([("id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("n", "<u8")])
FRAME = 16  # bytes around a payload
READ_BYTES = 4 << 20
MOST_READERS = 20_000  # tasks; each then reads several shards

MANIFEST = "shard int, path string, width int, records long, tokens long, bytes long"
RECORDS = "id long, position long, ids binary"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(data: bytes, at: int = 0) -> bytes:
    """The payload of the record at a place; raises on any damage."""
    length = data[at : at + 8]
    (size,), (check,) = struct.unpack("<Q", length), struct.unpack("<I", data[at + 8 : at + 12])
    if masked_crc(length) != check:
        raise ValueError(f"damaged length at byte {at}")
    payload = data[at + 12 : at + 12 + size]
    if len(payload) != size or masked_crc(payload) != struct.unpack("<I", data[at + 12 + size : at + FRAME + size])[0]:
        raise ValueError(f"damaged payload at byte {at}")
    return payload


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _shard_writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        code = encoder(tokenizer)
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        name = f"{base}/shard-{shard:06d}-u{code.dtype.itemsize}"
        own = f"{base}/_attempt-{uuid.uuid4().hex}"
        entries, offset, tokens = [], 0, 0
        with system.open_output_stream(f"{own}.rec") as out:
            for batch in batches:
                ids = batch.column(0)
                for block in blocks(batch.column(1)):
                    flat, counts = code.encode(block)
                    begin, framed = 0, []
                    entry = np.zeros(len(block), dtype=INDEX_ENTRY)
                    part = ids.slice(block.first, len(block))
                    entry["id"], entry["has_id"] = part.fill_null(0), part.is_valid()
                    entry["n"] = counts + 1
                    end = np.array([end_id], dtype=code.dtype).tobytes()
                    for n in counts.tolist():
                        framed.append(frame(flat[begin : begin + n].tobytes() + end))
                        begin += n
                    sizes = np.fromiter(map(len, framed), dtype=np.int64, count=len(framed))
                    entry["offset"] = offset + np.cumsum(sizes) - sizes
                    out.write(b"".join(framed))
                    offset += int(sizes.sum())
                    tokens += int(entry["n"].sum())
                    entries.append(entry)
        index = np.concatenate(entries) if entries else np.zeros(0, dtype=INDEX_ENTRY)
        if not len(index):
            system.delete_file(f"{own}.rec")
            return
        with system.open_output_stream(f"{own}.idx") as out:
            out.write(index.tobytes() + struct.pack("<I", masked_crc(index.tobytes())))
        system.move(f"{own}.rec", f"{name}.rec")
        system.move(f"{own}.idx", f"{name}.idx")
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard], pa.int32()),
                "path": [f"{folder}/shard-{shard:06d}-u{code.dtype.itemsize}"],
                "width": pa.array([code.dtype.itemsize], pa.int32()),
                "records": [len(index)],
                "tokens": [tokens],
                "bytes": [offset],
            }
        )

    return write


def write_records(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    folder: str | None = None,
) -> DataFrame:
    """Encodes each text, appends ``end_id`` and writes the ids; gives the manifest, one row per shard.

    Shards are ranges of ids, in order, and rows within a shard ascend too. A
    null text is empty, a null id comes first, rows that share an id stand in
    the order of their texts' hashes, an empty table gives no shard; other columns are
    ignored. ``start`` counts the ids in all earlier shards.
    """
    work = Workspace(docs.sparkSession, "records")
    folder = folder or f"{work.folder}/shards"
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    with shuffle_files_dropped(docs.sparkSession):
        shards = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
        manifest = work.write(map_batches(shards, _shard_writer(folder, tokenizer, end_id), MANIFEST), "manifest")
    earlier = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("start", F.coalesce(earlier, F.lit(0)).cast("long"))


def read_index(path: str) -> np.ndarray:
    system, base = file_system(path)
    with system.open_input_stream(f"{base}.idx") as source:
        data = source.read()
    if struct.unpack("<I", data[-4:])[0] != masked_crc(data[:-4]):
        raise ValueError(f"damaged index of {path}")
    return np.frombuffer(data[:-4], dtype=INDEX_ENTRY)


def read_some(path: str, entries: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Payloads of chosen index entries, in the order given; neighbours are fetched together."""
    system, base = file_system(path)
    width = int(path[-1])
    with system.open_input_file(f"{base}.rec") as source:
        a = 0
        sizes = entries["n"].astype(np.int64) * width + FRAME
        ends = entries["offset"].astype(np.int64) + sizes
        joined = np.append(ends[:-1] == entries["offset"][1:].astype(np.int64), False)
        while a < len(entries):
            b = a + 1
            while b < len(entries) and joined[b - 1] and ends[b] - int(entries["offset"][a]) <= READ_BYTES:
                b += 1
            begin = int(entries["offset"][a])
            data = source.read_at(int(ends[b - 1]) - begin, begin)
            yield entries[a:b], [unframe(data, int(o) - begin) for o in entries["offset"][a:b]]
            a = b


def _shard_reader(seed: int | None):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                index = read_index(shard["path"])
                starts = shard["start"] + np.cumsum(index["n"]).astype(np.int64) - index["n"].astype(np.int64)
                order = np.arange(len(index))
                if seed is not None:
                    order = np.random.default_rng([seed, shard["shard"]]).permutation(order)
                at = 0
                for entries, payloads in read_some(shard["path"], index[order]):
                    positions = starts[order[at : at + len(entries)]]
                    at += len(entries)
                    if shard["width"] != 4:
                        payloads = [np.frombuffer(p, dtype="<u2").astype("<u4").tobytes() for p in payloads]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(entries["id"], pa.int64(), mask=entries["has_id"] == 0),
                            pa.array(positions, pa.int64()),
                            pa.array(payloads, pa.binary()),
                        ],
                        names=["id", "position", "ids"],
                    )

    return read


def read_records(manifest: DataFrame, seed: int | None = None) -> DataFrame:
    """All records with their place in the whole run of ids (``position``), ids as unsigned 32-bit integers.

    With a seed, each shard's records come in a random order, fetched through the index.
    """
    shards = manifest.select("shard", "path", "width", "start")
    # A stated number of partitions: left to itself, Spark would join these small rows into one task.
    tasks = min(max(shards.count(), 1), MOST_READERS)
    return map_batches(shards.repartition(tasks, "path"), _shard_reader(seed), RECORDS)
