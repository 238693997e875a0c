"""Token-ID files: fixed-width bit packing in blocks, in ascending id order.

File layout, all numbers little-endian:

    blocks     each of ``ids_per_block`` ids (the last may hold fewer), ``width`` bits an id
    index      u64 offset of each block, i64 id and u8 null flag of each document,
               u64 first id of each document and the end of the last
    trailer    u64 ids, u64 documents, u64 blocks, u32 ids a block, u32 width, u64 index
               offset, 8 bytes of magic

A reader takes any run of ids by reading the blocks that hold it. Documents are
range-partitioned by id; a task writes its range as files of bounded size, each under a
temporary name first. The manifest, one row per file, is a table in the shared folder.

Null texts are empty, null ids come first, rows with equal ids follow one another in the
order of a hash of their texts, and an empty table gives no file and no row.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import bits, common, tokens
from kindred.session import stage, work_path

MAGIC = b"KNDBITS1"
TRAILER = struct.Struct("<QQQIIQ8s")
IDS_PER_BLOCK = 1 << 16
IDS_PER_FILE = 1 << 23

MANIFEST = "part long, file long, path string, n_ids long, n_docs long, file_bytes long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Writer:
    """One file. Ids are buffered up to a block; the index grows with the documents."""

    def __init__(self, uri: str, width: int, ids_per_block: int = IDS_PER_BLOCK):
        self.uri, self.temporary = uri, f"{uri}.{uuid.uuid4().hex}.tmp"
        files, path = common.shared_file(self.temporary)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(path)
        self.width, self.ids_per_block = width, ids_per_block
        self.buffer, self.buffered, self.n_ids, self.written = [], 0, 0, 0
        self.offsets, self.doc_ids, self.nulls, self.starts = [], [], [], [0]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.buffer.append(ids)
        self.buffered += len(ids)
        self.n_ids += len(ids)
        self.starts.append(self.n_ids)
        if self.buffered >= self.ids_per_block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.buffer) if self.buffer else np.empty(0, np.uint32)
        whole = len(ids) if last else len(ids) // self.ids_per_block * self.ids_per_block
        for at in range(0, whole, self.ids_per_block):
            data = bits.pack(ids[at : min(at + self.ids_per_block, whole)], self.width)
            self.offsets.append(self.written)
            self.out.write(data)
            self.written += len(data)
        self.buffer, self.buffered = [ids[whole:]], len(ids) - whole

    def close(self) -> int:
        self._flush(True)
        index = self.written
        for array in (
            np.array(self.offsets, "<u8"), np.array(self.doc_ids, "<i8"),
            np.array(self.nulls, "u1"), np.array(self.starts, "<u8"),
        ):
            self.out.write(array.tobytes())
            self.written += array.nbytes
        self.out.write(
            TRAILER.pack(self.n_ids, len(self.doc_ids), len(self.offsets), self.ids_per_block, self.width, index, MAGIC)
        )
        self.out.close()
        common.commit_file(self.uri, self.temporary)
        return self.written + TRAILER.size


class Reader:
    """Random access to one file."""

    def __init__(self, uri: str):
        files, path = common.shared_file(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        trailer = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        self.n_ids, docs, blocks, self.ids_per_block, self.width, index, magic = trailer
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        raw = self.file.read_at(size - TRAILER.size - index, index)
        self.offsets = np.frombuffer(raw, "<u8", blocks)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, 8 * blocks)
        self.nulls = np.frombuffer(raw, "u1", docs, 8 * (blocks + docs))
        self.starts = np.frombuffer(raw, "<u8", docs + 1, 8 * (blocks + docs) + docs).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        n = min(self.ids_per_block, self.n_ids - k * self.ids_per_block)
        data = self.file.read_at(bits.packed_bytes(n, self.width), int(self.offsets[k]))
        return bits.unpack(data, n, self.width)

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids number ``start`` to ``end`` of the file, the end excluded."""
        if end <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.ids_per_block, (end - 1) // self.ids_per_block
        ids = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return ids[start - first * self.ids_per_block : end - first * self.ids_per_block]

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.starts[k]), int(self.starts[k + 1]))

    def documents(self):
        """All documents in order, each block read once."""
        held, block = np.empty(0, np.uint32), 0
        for k in range(len(self.doc_ids)):
            need = int(self.starts[k + 1] - self.starts[k])
            parts, have = [held], len(held)
            while have < need:
                parts.append(self.block(block))
                have += len(parts[-1])
                block += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield (None if self.nulls[k] else int(self.doc_ids[k])), held[:need]
            held = held[need:]

    def close(self) -> None:
        self.file.close()


def write(
    docs: DataFrame,
    folder: str | None = None,
    vocabulary: str | None = None,
    ids_per_block: int = IDS_PER_BLOCK,
    ids_per_file: int = IDS_PER_FILE,
) -> DataFrame:
    """Encode every text, write the files, and return the manifest, one row per file."""
    folder = folder or work_path(docs.sparkSession, "tokens")
    vocabulary = vocabulary or tokens.default_vocabulary()
    rows = (
        common.texts(docs)
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
    )
    schema = pa.schema(
        [("part", pa.int64()), ("file", pa.int64()), ("path", pa.string())]
        + [(c, pa.int64()) for c in ("n_ids", "n_docs", "file_bytes")]
    )

    def run(batches):
        part, number, writer = TaskContext.get().partitionId(), 0, None
        encoder = tokens.encoder(vocabulary)
        width = bits.bits_for(max(encoder.vocabulary, tokens.END_ID + 1))

        def done():
            size = writer.close()
            return pa.RecordBatch.from_pylist(
                [dict(part=part, file=number, path=writer.uri, n_ids=writer.n_ids,
                      n_docs=len(writer.doc_ids), file_bytes=size)], schema
            )

        for batch in common.slices(batches):
            encoded = encoder.encode(batch.column("text").cast(pa.binary()).to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                if writer is None:
                    writer = Writer(f"{folder}/part-{part:06d}-{number:05d}.ids", width, ids_per_block)
                writer.add(doc_id, np.frombuffer(ids, "<u4"))
                if writer.n_ids >= ids_per_file:
                    yield done()
                    writer, number = None, number + 1
        if writer is not None:
            yield done()

    return stage(rows.mapInArrow(run, MANIFEST), "tokens-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, start, n_tokens, ids_crc32``, from the files."""
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file of some million ids; the texts are not among them.
    placed = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    spread = placed.repartition(
        int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part", "file"
    )
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches):
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                reader = Reader(path)
                crcs = [zlib.crc32(ids.astype("<u4", copy=False)) for _, ids in reader.documents()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.doc_ids, pa.int64(), mask=reader.nulls.astype(bool)),
                        pa.array(reader.starts[:-1] + first, pa.int64()),
                        pa.array(np.diff(reader.starts), pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    schema=schema,
                )
                reader.close()

    return spread.select("path", "first").mapInArrow(run, DOCUMENTS)


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    return read(write(common.table(spark, sf_dir, "documents")))
