"""Token ids as Arrow files of equal-length sequences (operator 9).

``write`` orders the documents by doc_id, encodes every whole text, appends the
end id, and lets each range of ids fill its own shard: one Arrow IPC file of
fixed-size-list batches (``input_ids`` and a bit mask of real positions; only a
shard's last sequence is padded) and one index file (document, first id, number
of ids).  Both are uncompressed, so a reader maps a file and addresses any
sequence without a copy.  Ids take two bytes when the vocabulary allows it.

A task writes under a name of its own and reports it in the manifest, a stored
table; files of attempts that failed are in no manifest and are removed when it
is complete.  ``read`` maps the shards of a manifest back and gives one row per
document: it takes a document's sequences from the map one batch at a time and
checks the mask.

Null or empty text: the end id alone.  Null doc_id: sorts first.  Equal
doc_ids: ordered by a hash of the text; equal rows are interchangeable.  Empty
table: no shards, no rows.  Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import column_values, documents, fresh_path, ready, stored
from stockflow.llm.tokens import encoder

END_ID = 0
SEQUENCE_LENGTH = 2048
# Sequences in one record batch.
BATCH_SEQUENCES = 256

MANIFEST = "shard int, name string, n_docs long, n_tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def sequence_schema(length: int, id_type: pa.DataType) -> pa.Schema:
    return pa.schema([pa.field("input_ids", pa.list_(id_type, length)), pa.field("mask", pa.list_(pa.bool_(), length))])


class _Shard:
    def __init__(self, base: str, length: int, id_type: pa.DataType):
        from pyarrow import fs

        self.files, folder = fs.FileSystem.from_uri(base)
        self.files.create_dir(folder, recursive=True)
        self.name = uuid.uuid4().hex
        self.schema = sequence_schema(length, id_type)
        self.length, self.dtype = length, id_type.to_pandas_dtype()
        self.out = self.files.open_output_stream(f"{folder}/{self.name}.arrow")
        self.index_out = self.files.open_output_stream(f"{folder}/{self.name}.index.arrow")
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.index = pa.ipc.new_file(self.index_out, INDEX)
        self.rest = np.empty(0, dtype=self.dtype)
        self.tokens = self.docs = 0

    def add(self, doc_ids: list, ids: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        starts = self.tokens + np.cumsum(sizes) - sizes
        self.index.write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(sizes)],
                                               schema=INDEX))
        self.tokens += int(sizes.sum())
        self.docs += len(ids)
        self.rest = np.concatenate([self.rest, *[x.astype(self.dtype) for x in ids]])
        block = self.length * BATCH_SEQUENCES
        whole = len(self.rest) // block * block
        for k in range(0, whole, block):
            self._write(self.rest[k:k + block], block)
        self.rest = self.rest[whole:]

    def _write(self, ids: np.ndarray, size: int) -> None:
        padded = np.zeros(size, dtype=self.dtype)
        padded[:len(ids)] = ids
        mask = np.arange(size) < len(ids)
        self.writer.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(padded), self.length),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> None:
        if len(self.rest):
            self._write(self.rest, -(-len(self.rest) // self.length) * self.length)
        self.writer.close()
        self.index.close()
        self.out.close()
        self.index_out.close()


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Write the shards below ``folder``; return the manifest with each shard's
    first global position (``shard_start``)."""
    spark = docs.sparkSession
    ready(spark)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, out = encoder(vocabulary), None
        id_type = pa.uint16() if tool.vocabulary_size <= 1 << 16 else pa.uint32()
        end = np.array([END_ID], dtype="<u4")
        for batch in batches:
            if batch.num_rows:
                out = out or _Shard(folder, length, id_type)
                texts = column_values(batch, "text")
                out.add(column_values(batch, "doc_id"), [np.concatenate((x, end)) for x in tool.encode(texts)])
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([TaskContext.get().partitionId()], pa.int32()), "name": [out.name],
                 "n_docs": [out.docs], "n_tokens": [out.tokens]})

    tie = F.xxhash64("text")
    ordered = (documents(docs).repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie))
    manifest = stored(ordered.mapInArrow(shard, MANIFEST), "manifest")
    sweep(manifest, folder)
    # One row per shard: a window over all of them is as small as the job's number of partitions.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("shard_start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def open_shard(folder: str, name: str) -> tuple[pa.ipc.RecordBatchFileReader, pa.ipc.RecordBatchFileReader]:
    """The shard's sequence file and its index; local files are memory-mapped."""
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(folder)
    put = pa.memory_map if isinstance(files, fs.LocalFileSystem) else files.open_input_file
    return tuple(pa.ipc.open_file(put(f"{path}/{name}{kind}")) for kind in (".arrow", ".index.arrow"))


def sequence(reader: pa.ipc.RecordBatchFileReader, n: int) -> tuple[np.ndarray, pa.BooleanArray]:
    """Sequence ``n`` of a shard, and its mask: every batch but the last holds
    BATCH_SEQUENCES sequences, so its place follows from ``n``.  Both are views."""
    batch = reader.get_batch(n // BATCH_SEQUENCES)
    ids, mask = (batch.column(c)[n % BATCH_SEQUENCES].values for c in (0, 1))
    return ids.to_numpy(), mask


class _Ids:
    """The ids of a shard by position; one mapped batch at a time."""

    def __init__(self, reader: pa.ipc.RecordBatchFileReader, length: int, tokens: int):
        self.reader, self.size, self.tokens = reader, length * BATCH_SEQUENCES, tokens
        self.k, self.ids = -1, np.empty(0)

    def _batch(self, k: int) -> np.ndarray:
        if k != self.k:
            batch = self.reader.get_batch(k)
            self.k, self.ids = k, batch.column(0).flatten().to_numpy()
            real = min(len(self.ids), self.tokens - k * self.size)
            mask = batch.column(1).flatten()
            if mask.true_count != real or not mask[:real].true_count == real:
                raise ValueError(f"batch {k}: the mask does not mark its {real} ids")
        return self.ids

    def crc32(self, start: int, n: int) -> int:
        crc, end = 0, start + n
        while start < end:
            k = start // self.size
            upto = min(end, (k + 1) * self.size)
            crc = zlib.crc32(self._batch(k)[start - k * self.size:upto - k * self.size].astype("<u4"), crc)
            start = upto
        return crc


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, from the files alone."""
    spark = manifest.sparkSession

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sequences, index = open_shard(folder, row["name"])
                ids = _Ids(sequences, sequences.schema.field("input_ids").type.list_size, row["n_tokens"])
                for k in range(index.num_record_batches):
                    docs = index.get_batch(k)
                    start, size = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                    crc = [ids.crc32(s, n) for s, n in zip(start.tolist(), size.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [docs.column(0), pa.array(start + row["shard_start"]), docs.column(2), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # The manifest is tiny and the files are not: deal the shards out one by one.
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.repartition(tasks).mapInArrow(digests, ROWS)


def sweep(manifest: DataFrame, folder: str) -> None:
    """Remove files of shards that are not in the complete manifest."""
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(folder)
    if files.get_file_info(path).type == fs.FileType.NotFound:
        return
    kept = {r["name"] for r in manifest.select("name").toLocalIterator()}   # a name a task
    for info in files.get_file_info(fs.FileSelector(path)):
        if info.base_name.split(".")[0] not in kept:
            files.delete_file(info.path)


def encode_to_files(docs: DataFrame, vocabulary: str | None = None, length: int = SEQUENCE_LENGTH) -> DataFrame:
    folder = fresh_path(docs.sparkSession, "arrow")
    return read(write(docs, folder, vocabulary, length), folder)
