"""Token files: independent zstandard frames with a trailing seek table, and a checksum for every frame.

A file is a sequence of data frames, one index frame and a seek table, and any zstandard reader can decompress it. A data
frame holds the ids of whole documents as little-endian numbers; the index frame holds, for each document, its id, its
frame, its place there and its number of ids. The seek table is the skippable frame of zstandard's seekable format: for
each frame its compressed size, its size and the low half of its XXH64, then the number of frames and a magic number. A
reader fetches the end of the file, the index, and then only the frames of the documents asked for.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathproof.llm.common import map_arrow, scratch, stored, text_key
from pathproof.llm.tokens import word_bpe

#: Fixed by zstandard's seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A5E, 0x8F92EAB1, 0x80
#: A frame is closed once it holds so many bytes; a longer document fills a frame alone.
FRAME_BYTES = 1 << 18
LEVEL = 1
_INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("frame", "<u4"), ("at", "<u8"), ("n", "<u8")])
_ENTRY, _FOOTER = struct.Struct("<III"), struct.Struct("<IBI")


class BadFrame(ValueError):
    """A frame or a seek table that is not what was written."""


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class Writer:
    """Writes documents one after the other to ``uri``; the file appears under that name when it is complete."""

    def __init__(self, uri: str, dtype: np.dtype):
        self.files, self.path = _open(uri)
        self.files.create_dir(self.path.rpartition("/")[0])
        self.temporary = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.temporary)
        self.dtype, self.squeeze = dtype, zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int, int, int]] = []
        self.block: list[bytes] = []
        self.filled = 0

    def _frame(self, data: bytes) -> None:
        packed = self.squeeze.compress(data)
        self.out.write(packed)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def _close_frame(self) -> None:
        if self.block:
            self._frame(b"".join(self.block))
            self.block, self.filled = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.filled and self.filled + len(ids) > FRAME_BYTES:
            self._close_frame()
        n = len(ids) // self.dtype.itemsize
        at = self.filled // self.dtype.itemsize
        self.index.append((doc_id or 0, doc_id is not None, len(self.entries), at, n))
        self.block.append(ids)
        self.filled += len(ids)

    def close(self) -> None:
        self._close_frame()
        self._frame(self.dtype.str.encode().ljust(8) + np.array(self.index, dtype=_INDEX).tobytes())
        table = b"".join(_ENTRY.pack(*e) for e in self.entries)
        table += _FOOTER.pack(len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        self.files.move(self.temporary, self.path)


class Reader:
    """Reads single documents of a token file; every frame is checked against its checksum when it is read."""

    def __init__(self, uri: str):
        files, path = _open(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        if size < _FOOTER.size + 8:
            raise BadFrame(f"{uri}: too short")
        frames, flags, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG or not frames:
            raise BadFrame(f"{uri}: no seek table with checksums at its end")
        length = frames * _ENTRY.size + _FOOTER.size
        head = self.file.read_at(8, size - length - 8)
        if struct.unpack("<II", head) != (SKIPPABLE_MAGIC, length):
            raise BadFrame(f"{uri}: the seek table does not fit")
        table = np.frombuffer(self.file.read_at(frames * _ENTRY.size, size - length), dtype="<u4").reshape(-1, 3)
        self.table = table
        self.starts = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
        self.unpack = zstandard.ZstdDecompressor()
        index = self.frame(frames - 1)
        self.dtype = np.dtype(index[:8].decode().strip())
        self.index = np.frombuffer(index[8:], dtype=_INDEX)
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        packed, size, checksum = (int(x) for x in self.table[number])
        try:
            data = self.unpack.decompress(self.file.read_at(packed, int(self.starts[number])), max_output_size=size)
        except zstandard.ZstdError as error:
            raise BadFrame(f"frame {number}: {error}") from error
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise BadFrame(f"frame {number}: checksum differs")
        return data

    def document(self, row: int) -> np.ndarray:
        """The ids of the document in this row of the index; only its frame is read."""
        entry = self.index[row]
        if self._last[0] != entry["frame"]:
            self._last = (int(entry["frame"]), self.frame(int(entry["frame"])))
        at, n = int(entry["at"]), int(entry["n"])
        return np.frombuffer(self._last[1], dtype=self.dtype, count=n, offset=at * self.dtype.itemsize)

    def documents(self, wanted: Iterable[int | None] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in the file, ids) of all documents, or of those whose id is wanted, in file order."""
        starts = np.cumsum(self.index["n"], dtype=np.int64) - self.index["n"].astype(np.int64)
        chosen = None if wanted is None else set(wanted)
        for row in range(len(self.index)):
            doc_id = int(self.index["doc_id"][row]) if self.index["known"][row] else None
            if chosen is None or doc_id in chosen:
                yield doc_id, int(starts[row]), self.document(row)


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Writes the ids of all ``docs`` (doc_id, text), in ascending doc_id order over all files; returns (file, path, n_ids).

    Ids of a null or empty text are the end id alone. Null doc_ids come first; rows of one id follow the order of their
    texts' keys, by which an id with very many rows is also dealt over several files. Further columns are left out. A
    file is named by its place in the order and moved there when complete, so a repeated task writes it again.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(tokenizer)
        number = TaskContext.get().partitionId()
        uri, writer, total = f"{folder}/part-{number:07d}.ids.zst", None, 0
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                writer = writer or Writer(uri, encoder.dtype)
                ids = encoder.encode(text or "") + end
                writer.add(doc_id, ids)
                total += len(ids) // encoder.dtype.itemsize
        if writer:
            writer.close()
            yield pa.record_batch(
                [pa.array([number]), pa.array([uri]), pa.array([total])], names=["file", "path", "n_ids"]
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("k", text_key(F.col("text")))
    ordered = slim.repartitionByRange("doc_id", "k").sortWithinPartitions("doc_id", "k").select("doc_id", "text")
    return stored(map_arrow(ordered, work, "file long, path string, n_ids long"))


def read(files: DataFrame) -> DataFrame:
    """Every document of the written ``files``: (doc_id, start, n_tokens, ids_crc32), read from the files themselves.

    ``start`` counts the ids of all documents before it, over all files in order.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [
                    (doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, start, ids in Reader(path).documents()
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                kinds = [pa.int64()] * 4
                yield pa.record_batch(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names
                )

    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select("path", "base")
    dealt = placed.repartition(files.sparkSession.sparkContext.defaultParallelism * 4, "path")
    return map_arrow(dealt, work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_tokenfile(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    return read(write(docs.select("doc_id", "text"), tokenizer, end_id, scratch(docs.sparkSession)))
