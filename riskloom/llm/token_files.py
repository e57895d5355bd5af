"""Token ids in Arrow files of fixed-size lists, read back without copying.

Documents are range-partitioned by id (ties by a hash of the text), sorted,
encoded, and each partition streams its ids into one Arrow file: record
batches of ``fixed_size_list`` sequences of equal length with a mask that
is false on the padding of the file's last sequence. A second small file
holds (doc_id, first id within the file, number of ids). Files of successive
partitions continue one another: the ids of a file begin where the ids of
all files before it end (a running sum over the manifest, one row a file).

Reading maps the file into memory; sequence k of a batch is a view of the
buffer. Ids are unsigned 16-bit where the vocabulary allows, else 32-bit.

Defined results: a null or empty text has only the end id; a null doc_id
comes first; repeated ids keep a row each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import store, tokens
from riskloom.llm.frames import written
from riskloom.session import shared_dir

LENGTH = 2048
BATCH = 128

MANIFEST = T.StructType([
    T.StructField("part", T.LongType(), False), T.StructField("ids_file", T.StringType(), False),
    T.StructField("docs_file", T.StringType(), False), T.StructField("n_docs", T.LongType(), False),
    T.StructField("n_ids", T.LongType(), False), T.StructField("n_sequences", T.LongType(), False)])
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Streams ids into one Arrow file of (ids, mask) fixed-size-list batches."""

    def __init__(self, uri: str, dtype: np.dtype, length: int = LENGTH, batch: int = BATCH):
        self.length, self.room, self.dtype = length, length * batch, dtype
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)),
                                 ("mask", pa.list_(pa.bool_(), length))])
        self.sink = store.create(uri)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.held = self.total = self.sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.total += len(ids)
        while len(ids):
            head = ids[:self.room - self.held]
            self.parts.append(head)
            self.held += len(head)
            ids = ids[len(head):]
            if self.held == self.room:
                self._flush()

    def _flush(self) -> None:
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, self.dtype)
        pad = -len(ids) % self.length
        mask = np.arange(len(ids) + pad) < len(ids)
        full = np.concatenate([ids, np.zeros(pad, self.dtype)])
        self.file.write_batch(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(full), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))
        self.sequences += len(full) // self.length
        self.parts, self.held = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        self.file.close()
        self.sink.close()


class SequenceReader:
    """Random access to the sequences of one file; ids come as views of the mapped file."""

    def __init__(self, uri: str):
        self.source = store.mapped(uri)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0
        self._at, self._ids = -1, np.zeros(0)

    def batch_ids(self, k: int) -> np.ndarray:
        """Ids of batch k, padding included."""
        if self._at != k:
            column = self.file.get_batch(k).column(0)
            self._at, self._ids = k, column.flatten().to_numpy(zero_copy_only=True)
        return self._ids

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence k."""
        batch = self.file.get_batch(k // self.rows)
        at = k % self.rows
        ids = self.batch_ids(k // self.rows)[at * self.length:(at + 1) * self.length]
        return ids, batch.column(1)[at].values.to_numpy(zero_copy_only=False)

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Ids [start, start + n) of the file, batch by batch."""
        room = self.rows * self.length
        while n:
            k, off = divmod(start, room)
            part = self.batch_ids(k)[off:off + n]
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        self.source.close()


def write_sequences(docs: DataFrame, vocabulary: str, end_id: int | None = 0, id_col: str = "doc_id",
                    text_col: str = "text", length: int = LENGTH, folder: str | None = None) -> DataFrame:
    """Write the files of docs in ascending id order; returns the manifest (one row a file)."""
    folder = folder or shared_dir(docs.sparkSession, "token-files")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
    rows = rows.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary)
        end = np.array([] if end_id is None else [end_id], dtype=encoder.dtype)
        out = index = sink = None
        part, n_docs = TaskContext.get().partitionId(), 0
        ids_uri, docs_uri = (store.attempt_uri(folder, f"{k}-{part:06d}", ".arrow") for k in ("ids", "docs"))
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                piece, found = batch.slice(lo, 512), []
                if out is None:
                    out, sink = SequenceWriter(ids_uri, encoder.dtype, length), store.create(docs_uri)
                    index = pa.ipc.new_file(sink, _DOCS)
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    at = out.total
                    out.add(encoder.ids(text or ""))
                    out.add(end)
                    found.append({"doc_id": doc_id, "start": at, "n_tokens": out.total - at})
                n_docs += len(found)
                index.write_batch(pa.RecordBatch.from_pylist(found, schema=_DOCS))
        if out is not None:
            out.close()
            index.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "ids_file": ids_uri, "docs_file": docs_uri,
                                               "n_docs": n_docs, "n_ids": out.total, "n_sequences": out.sequences}])
    return written(rows.mapInArrow(run, MANIFEST), "token-manifest")


DOC_ROW = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType(), False),
                        T.StructField("n_tokens", T.LongType(), False), T.StructField("ids_crc32", T.LongType(), False),
                        T.StructField("ids_file", T.StringType(), False),
                        T.StructField("first_sequence", T.LongType(), False)])


def read_documents(manifest: DataFrame, length: int = LENGTH) -> DataFrame:
    """A row per document, from the files: global start, ids with the end id, their crc32, place."""
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("part", "ids_file", "docs_file", F.coalesce(before, F.lit(0)).alias("base"))
    files = files.repartition(max(1, min(manifest.count(), 65536)), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                ids = SequenceReader(f["ids_file"])
                with store.random_access(f["docs_file"]) as source:
                    index = pa.ipc.open_file(source)
                    for k in range(index.num_record_batches):
                        rows = index.get_batch(k).to_pylist()
                        for row in rows:
                            crc = 0
                            for part in ids.span(row["start"], row["n_tokens"]):
                                crc = zlib.crc32(part.astype("<u4"), crc)
                            row.update(ids_crc32=crc, ids_file=f["ids_file"], first_sequence=row["start"] // length)
                            row["start"] += f["base"]
                        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                            *_DOCS, ("ids_crc32", pa.int64()), ("ids_file", pa.string()), ("first_sequence", pa.int64())]))
                ids.close()
    return files.mapInArrow(run, DOC_ROW)
