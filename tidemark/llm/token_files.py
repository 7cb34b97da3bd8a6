"""Token ids of whole corpora in Arrow stream files, read back without copying.

Documents are range-partitioned and sorted by id, encoded, ended by an end id and laid
head to tail. Each task writes one file pair into the shared folder:

* ``part-N.arrow``, an Arrow stream of batches of ``BATCH`` sequences, each a fixed-size
  list of ``SEQUENCE`` ids and one of as many mask bits (set: an id; unset: padding after
  the file's last). Ids take two bytes if the vocabulary allows. Sequence i of a file is
  row i % BATCH of batch i // BATCH: a memory map gives any sequence without a copy.
* ``part-N.docs.arrow``, the ids and token counts of its documents, in order.

Files are written under another name and renamed, so a task that is run again replaces its
file by an equal one. The folder may be on any file system that Arrow reaches by its address.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_pairs import byte_pairs
from tidemark.llm.common import id_and_text, map_rows
from tidemark.llm.components import stored
from tidemark.session import shared_folder

SEQUENCE = 2048
BATCH = 64


class SequenceWriter:
    """Cuts a stream of ids into equal sequences and writes them in batches."""

    def __init__(self, sink: pa.NativeFile, dtype: np.dtype) -> None:
        self.kind = pa.from_numpy_dtype(dtype)
        self.dtype = dtype
        self.schema = pa.schema(
            [("ids", pa.list_(self.kind, SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))]
        )
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.waiting = bytearray()
        self.size = BATCH * SEQUENCE * dtype.itemsize

    def write(self, ids: bytes) -> None:
        self.waiting += ids
        while len(self.waiting) >= self.size:
            self._batch(bytes(self.waiting[: self.size]))
            del self.waiting[: self.size]

    def close(self) -> None:
        if self.waiting:
            self._batch(bytes(self.waiting))
        self.writer.close()

    def _batch(self, ids: bytes) -> None:
        values = np.frombuffer(ids, self.dtype)
        mask = np.zeros(-(-len(values) // SEQUENCE) * SEQUENCE, bool)
        mask[: len(values)] = True
        padded = np.zeros(len(mask), self.dtype)
        padded[: len(values)] = values
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), SEQUENCE) for x in (padded, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))


class SequenceFile:
    """Random access to a written file through a memory map; ids are views of its batches."""

    def __init__(self, folder: str, part: int) -> None:
        system, path = fs.FileSystem.from_uri(f"{folder}/part-{part:06d}.arrow")
        local = isinstance(system, fs.LocalFileSystem)
        source = pa.memory_map(path) if local else system.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(source))  # of a memory map, none is read yet

    def sequence(self, i: int) -> np.ndarray:
        at = i % BATCH * SEQUENCE
        return self._ids(i // BATCH)[at : at + SEQUENCE]

    def mask(self, i: int) -> pa.Array:
        return self.batches[i // BATCH].column("mask")[i % BATCH].values

    def _ids(self, batch: int) -> np.ndarray:
        return self.batches[batch].column("ids").flatten().to_numpy(zero_copy_only=True)


def _batches(folder: str, name: str) -> Iterator[pa.RecordBatch]:
    """The batches of a file in turn, one in memory."""
    system, path = fs.FileSystem.from_uri(f"{folder}/{name}")
    local = isinstance(system, fs.LocalFileSystem)
    source = pa.memory_map(path) if local else system.open_input_stream(path)
    yield from pa.ipc.open_stream(source)


class IdStream:
    """The ids of a file from its start, in views of its batches."""

    def __init__(self, folder: str, part: int) -> None:
        self.batches = _batches(folder, f"part-{part:06d}.arrow")
        self.view = np.zeros(0, np.uint8)

    def take(self, n: int) -> Iterator[np.ndarray]:
        """The next ``n`` ids, a view for each batch they lie in."""
        while n:
            if not len(self.view):
                self.view = next(self.batches).column("ids").flatten().to_numpy(zero_copy_only=True)
            found, self.view = self.view[:n], self.view[n:]
            n -= len(found)
            yield found


def _as_uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("/") else folder.replace("file:/", "file:///", 1)


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[str, DataFrame]:
    """Encode ``docs`` into files; the folder, and (part, start, tokens, docs) of each file.

    ``start`` is the number of ids in the files before. Ids ascend from file to file; null
    ids come first, equal ids in the order of their texts' hash. Null and empty texts are the
    end id alone; repeated rows are encoded repeatedly; an empty table gives no files.
    ``tokenizer`` is a file every worker can open. Runs when called.
    """
    folder = _as_uri(folder or shared_folder(docs.sparkSession))
    ordered = (
        id_and_text(docs, id_col, text_col)
        .withColumn("mark", F.xxhash64("text"))
        .repartitionByRange("doc_id", "mark")
        .sortWithinPartitions("doc_id", "mark")
    )
    schema = pa.schema([("part", pa.int64()), ("tokens", pa.int64()), ("docs", pa.int64())])

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        with_library = byte_pairs(tokenizer)
        end = np.array([end_id], with_library.dtype).tobytes()
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root)
        names = [f"{root}/part-{part:06d}{kind}" for kind in (".arrow", ".docs.arrow")]
        made = [f"{name}.{context.taskAttemptId()}" for name in names]
        index = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
        tokens = count = 0
        with system.open_output_stream(made[0]) as ids_sink, system.open_output_stream(made[1]) as docs_sink:
            sequences = SequenceWriter(ids_sink, with_library.dtype)
            rows = pa.ipc.new_stream(docs_sink, index)
            for batch in batches:
                lengths = []
                for text in batch.column("text").to_pylist():
                    ids = with_library.ids(text).astype(with_library.dtype).tobytes() + end
                    sequences.write(ids)
                    lengths.append(len(ids) // with_library.dtype.itemsize)
                columns = [batch.column("doc_id"), pa.array(lengths, pa.int64())]
                rows.write_batch(pa.RecordBatch.from_arrays(columns, schema=index))
                tokens += sum(lengths)
                count += len(lengths)
            sequences.close()
            rows.close()
        for old, new in zip(made, names):
            if count:
                system.move(old, new)
            else:
                system.delete_file(old)
        if count:
            yield pa.RecordBatch.from_pylist([{"part": part, "tokens": tokens, "docs": count}], schema=schema)

    parts = stored(ordered.mapInArrow(write, "part long, tokens long, docs long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return folder, parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"), "tokens", "docs")


def read_documents(folder: str, parts: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files alone.

    ``start`` counts all ids before the document; the CRC is of its ids as little-endian
    32-bit integers. One file is one task, which holds a batch of it at a time.
    """

    def one(part: int, start: int) -> Iterator[tuple]:
        ids = IdStream(folder, part)
        at = 0
        for batch in _batches(folder, f"part-{part:06d}.docs.arrow"):
            for doc_id, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                crc = 0
                for view in ids.take(n):
                    crc = zlib.crc32(view.astype("<u4"), crc)
                yield doc_id, start + at, n, crc
                at += n

    files = max(1, parts.count())
    table = parts.select("part", "start").repartitionByRange(files, "part")  # a file for each task
    return map_rows(table, lambda: one, "doc_id long, start long, n_tokens long, ids_crc32 long")
