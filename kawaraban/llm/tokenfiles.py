"""Token ids in seekable Zstandard files, one per range of document ids.

A file is a row of independent Zstandard frames of whole documents, then a
skippable frame with the documents' index (an Arrow stream of doc_id, n_tokens,
frame), then the seek table of the public Zstandard seekable format: a skippable
frame with the compressed size, the plain size and the XXH64 checksum (low 32
bits) of every frame before it, and a footer. A reader takes the footer, the
index and then only the frames of the documents it wants. Ids are little-endian,
16 bits wide where the vocabulary allows it.

Tasks write under a name of their own and rename, so a task that runs twice
leaves one file. Files go to a folder that all executors share.

Defined results: null text is empty; every document gets the end id. Documents
are ordered by doc_id (null first), those of one id by text; repeated rows are
all written. An empty table gives no files. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kawaraban.llm.tokens import before_words, encoder
from kawaraban.llm.words import pieces, small_batches
from kawaraban.session import staged

END = 2
FRAME = 256 << 10
LEVEL = 3

# Fixed values of the public Zstandard seekable format.
SEEK_TABLE_MAGIC = 0x184D2A5E
INDEX_MAGIC = 0x184D2A50
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80


class Writer:
    """Adds documents to an open file, frame by frame."""

    def __init__(self, out, kind: pa.DataType, dtype: str):
        self._out, self._kind, self._dtype = out, kind, dtype
        self._pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self._waiting: list[bytes] = []
        self._held = 0
        self._frames: list[tuple[int, int, int]] = []
        self._index: tuple[list, list, list] = ([], [], [])
        self.n_tokens = 0

    @property
    def n_docs(self) -> int:
        return len(self._index[0])

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        for column, x in zip(self._index, (doc_id, len(ids), len(self._frames)), strict=True):
            column.append(x)
        self._waiting.append(ids.astype(self._dtype).tobytes())
        self._held += len(self._waiting[-1])
        self.n_tokens += len(ids)
        if self._held >= FRAME:
            self._flush()

    def _flush(self) -> None:
        if self._waiting:
            plain = b"".join(self._waiting)
            packed = self._pack.compress(plain)
            self._out.write(packed)
            self._frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
            self._waiting, self._held = [], 0

    def close(self) -> None:
        self._flush()
        types = (self._kind, pa.int64(), pa.int32())
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(self._index, types, strict=True)], ["doc_id", "n_tokens", "frame"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema.with_metadata({"dtype": self._dtype})) as stream:
            stream.write_batch(batch)
        index = self._pack.compress(sink.getvalue().to_pybytes())
        self._out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        entries = [*self._frames, (len(index) + 8, 0, 0)]
        table = b"".join(struct.pack("<III", *e) for e in entries) + struct.pack("<IBI", len(entries), CHECKSUM_FLAG, FOOTER_MAGIC)
        self._out.write(struct.pack("<II", SEEK_TABLE_MAGIC, len(table)) + table)


class Reader:
    """Documents of a file; only the frames asked for are read and unpacked."""

    def __init__(self, file: pa.NativeFile):
        self._file, size = file, file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table")
        entries = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self._frames = entries[:-1]
        self._starts = np.concatenate([[0], np.cumsum(entries[:, 0].astype(np.int64))])
        self._unpack = zstandard.ZstdDecompressor()
        index = self._at(int(self._starts[-2]) + 8, int(entries[-1, 0]) - 8)
        with pa.ipc.open_stream(self._unpack.decompress(index)) as stream:
            self.dtype = stream.schema.metadata[b"dtype"].decode()
            self.index = stream.read_all()

    def _at(self, start: int, size: int) -> bytes:
        self._file.seek(start)
        return self._file.read(size)

    def frame(self, number: int) -> np.ndarray:
        size, plain_size, checksum = (int(x) for x in self._frames[number])
        plain = self._unpack.decompress(self._at(int(self._starts[number]), size), max_output_size=plain_size) if plain_size else b""
        if len(plain) != plain_size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} is damaged")
        return np.frombuffer(plain, self.dtype)

    def documents(self, wanted: set | None = None) -> Iterator[tuple[object, int, np.ndarray]]:
        """(doc_id, ids before it in the file, ids), of the wanted documents or all, in file order."""
        ids, counts, frames = (self.index.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame"))
        before = in_frame = 0
        number, plain = -1, None
        for doc_id, n, frame in zip(ids, counts, frames, strict=True):
            if frame != number:
                number, plain, in_frame = frame, None, 0
            if wanted is None or doc_id in wanted:
                plain = self.frame(frame) if plain is None else plain
                yield doc_id, before, plain[in_frame : in_frame + n]
            before, in_frame = before + n, in_frame + n


def write(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Write all documents (doc_id, text) below `folder`; the manifest: number, file, n_docs, n_tokens.

    Files follow each other in ascending doc_id, in the order of their numbers.
    """

    def write_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        encode = encoder(path, before_words)
        end = np.uint32(END)
        system, base = pafs.FileSystem.from_uri(folder)
        file, out, writer = f"part-{task.partitionId():06d}.ids.zst", None, None
        unfinished = f"{base}/.{file}.{task.taskAttemptId()}"
        for part in pieces(batches, size=4 << 20):
            if writer is None:
                system.create_dir(base, recursive=True)
                out = system.open_output_stream(unfinished, compression=None)
                writer = Writer(out, part.schema.field("doc_id").type, "<u2" if encode.vocabulary <= 1 << 16 else "<u4")
            ids, bounds = encode.encode(part.column("text"))
            for doc_id, a, b in zip(part.column("doc_id").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                writer.add(doc_id, np.append(ids[a:b], end))
        if writer is not None:
            writer.close()
            out.close()
            system.move(unfinished, f"{base}/{file}")
            yield pa.RecordBatch.from_pydict({"number": [task.partitionId()], "file": [f"{folder}/{file}"], "n_docs": [writer.n_docs], "n_tokens": [writer.n_tokens]})

    small_batches(docs.sparkSession)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return staged(ordered.mapInArrow(write_partition, "number long, file string, n_docs long, n_tokens long"), "token-files")


def read(manifest: DataFrame, kind: str = "bigint") -> DataFrame:
    """The documents read back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))

    def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, at = pafs.FileSystem.from_uri(row["file"])
                with system.open_input_file(at) as file:
                    reader = Reader(file)
                    found = [(d, row["start"] + before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, before, ids in reader.documents()]
                    types = (reader.index.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array([x[i] for x in found], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = files.repartition(max(1, manifest.count()))  # a file is a task's work
    return spread.mapInArrow(read_files, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
