"""Vector bin packing of training examples into sequences of limited tokens, segments and loss-bearing tokens.

Each task packs the examples of its partition as they come, so nothing is shuffled and memory is a pool of examples. A
sequence is filled from the pool by the dot-product heuristic: of the examples that still fit in every dimension, the one
whose demand has the largest scalar product with what is left of the limits, both as shares of the limits. When nothing
fits, an example that may be cut fills the sequence to the last token.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathproof.llm.common import map_arrow
from pathproof.llm.tokens import byte_bpe

#: Examples that a task holds to choose from; all are packed in the end.
POOL = 256


@dataclass
class Example:
    """What is left of an example: its ids, which of them bear loss, and where its next id stands in the whole."""

    key: object
    ids: np.ndarray
    loss: np.ndarray | None  # None: all
    cuttable: bool
    start: int = 0

    def demand(self) -> tuple[int, int, int]:
        n = len(self.ids)
        return n, 1, n if self.loss is None else int(self.loss.sum())

    def cut(self, n: int) -> Example:
        """Takes the first ``n`` ids away."""
        head = Example(self.key, self.ids[:n], None if self.loss is None else self.loss[:n], False, self.start)
        self.ids, self.start = self.ids[n:], self.start + n
        self.loss = None if self.loss is None else self.loss[n:]
        return head


@dataclass(frozen=True)
class Limits:
    tokens: int
    segments: int
    loss_tokens: int


class Packer:
    """Packs a stream of examples; ``add`` and ``finish`` give complete sequences, each a list of pieces."""

    def __init__(self, limits: Limits, pool: int = POOL):
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=float)
        self.limits, self.size = limits, pool
        self.pool: list[Example] = []

    def _largest_cut(self, e: Example, left: np.ndarray) -> int:
        """How many of the first ids of ``e`` fit into what is left."""
        n = int(min(left[0], len(e.ids)))
        if left[1] < 1:
            return 0
        if e.loss is not None:
            n = min(n, int(np.searchsorted(np.cumsum(e.loss), left[2], side="right")))
        return min(n, int(left[2])) if e.loss is None else n

    def _fill(self, tokens: int) -> list[Example]:
        """One sequence of at most ``tokens`` tokens out of the pool."""
        left = self.caps.copy()
        left[0] = tokens
        demands = np.array([e.demand() for e in self.pool], dtype=float).reshape(-1, 3)
        free = np.ones(len(self.pool), dtype=bool)
        pieces: list[Example] = []
        while free.any() and left[0] >= 1:
            fits = free & (demands <= left).all(axis=1)
            worth = (demands / self.caps) @ (left / self.caps)
            if fits.any():
                k = int(np.argmax(np.where(fits, worth, -1)))
                pieces.append(self.pool[k])
                left -= demands[k]
                free[k] = False
                continue
            for k in np.argsort(np.where(free, -worth, np.inf), kind="stable")[: int(free.sum())]:
                if self.pool[k].cuttable and (n := self._largest_cut(self.pool[k], left)):
                    pieces.append(self.pool[k].cut(n))
                    left -= np.array(pieces[-1].demand())
                    demands[k] = self.pool[k].demand()
                    break
            else:
                break
        self.pool = [e for e, f in zip(self.pool, free, strict=True) if f]
        return pieces

    def add(self, example: Example) -> Iterator[list[Example]]:
        """Raises ValueError for an example over a limit that may not be cut."""
        while example.cuttable and len(example.ids) >= self.limits.tokens:
            n = self._largest_cut(example, self.caps)
            yield [example.cut(n)]
        if not len(example.ids):
            return
        if not example.cuttable and (np.array(example.demand()) > self.caps).any():
            raise ValueError(f"example {example.key} exceeds the limits and may not be cut")
        self.pool.append(example)
        if len(self.pool) >= self.size:
            yield self._fill(self.limits.tokens)

    def finish(self) -> Iterator[list[Example]]:
        """What is left; the last tokens that can be cut go to sequences as long as a power of two, without padding."""
        while self.pool:
            rest = sum(len(e.ids) for e in self.pool)
            exact = all(e.cuttable for e in self.pool)
            whole = rest >= self.limits.tokens or not exact
            yield self._fill(self.limits.tokens if whole else 1 << (rest.bit_length() - 1))


def pack(
    examples: DataFrame,
    encode: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray | None]]],
    limits: Limits,
    cuttable: bool = True,
    with_ids: bool = False,
) -> DataFrame:
    """Packs every row of ``examples``, whose first column is its integer key; all columns go to ``encode``.

    ``encode`` gives, for each row of a batch, its ids and which of them bear loss (None: all). One row per piece: key,
    start (ids of the example before it), length, ids_crc32, key_tokens (ids of the whole example), sequence_id, offset
    in the sequence, and with ``with_ids`` the ids. Every id lies in exactly one piece. An example without ids gives no
    row; null keys and repeated rows are packed as they are; an empty table gives an empty result. Sequence ids grow
    with the partition and are the same when a task is repeated, as its partition's rows come in the same order.
    """
    key = examples.columns[0]
    schema = f"`{key}` long, start long, length long, ids_crc32 long, key_tokens long, sequence_id long, offset long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, sequence, totals = Packer(limits), TaskContext.get().partitionId() << 40, {}
        rows: list[tuple] = []
        ids: list[np.ndarray] = []

        def keep(sequences: Iterator[list[Example]]) -> None:
            nonlocal sequence
            for pieces in sequences:
                offset = 0
                for piece in pieces:
                    n = len(piece.ids)
                    crc = zlib.crc32(piece.ids.astype("<u4").tobytes())
                    place, doc_key = piece.key
                    rows.append((doc_key, piece.start, n, crc, totals[place], sequence, offset))
                    ids.append(piece.ids)
                    offset += n
                    if piece.start + n == totals[place]:
                        del totals[place]
                sequence += 1

        def out() -> pa.RecordBatch:
            names = [key, "start", "length", "ids_crc32", "key_tokens", "sequence_id", "offset"]
            columns: list[pa.Array] = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                names = [*names, "ids"]
            rows.clear()
            ids.clear()
            return pa.record_batch(columns, names=names)

        place = 0
        for batch in batches:
            for doc_key, (found, loss) in zip(batch.column(0).to_pylist(), encode(batch), strict=True):
                totals[place] = len(found)
                keep(packer.add(Example((place, doc_key), found, loss, cuttable)))
                place += 1
            yield out()
        keep(packer.finish())
        yield out()

    return map_arrow(examples, work, schema + (", ids array<int>" if with_ids else ""))


#: Documents bear loss on every token; so many of them share a sequence at most.
DOCUMENT_LIMITS = Limits(tokens=2048, segments=256, loss_tokens=2048)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) as pieces of sequences; a null or empty text is its end id alone."""

    def encode(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, None]]:
        encoder = byte_bpe(tokenizer)
        for text in batch.column(1).to_pylist():
            yield np.append(encoder.ids(text or ""), np.uint32(end_id)), None

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return pack(slim, encode, DOCUMENT_LIMITS, with_ids=with_ids).withColumnRenamed("key_tokens", "doc_tokens")


def pack_conversations(
    turns: DataFrame, tokenizer: str, limits: Limits, end_id: int = 1, loss_role: str = "assistant"
) -> DataFrame:
    """Whole conversations of ``turns`` (conv_id, turn, role, text); only turns of ``loss_role`` bear loss.

    Turns are put in the order of their number, null numbers first, ties by role and text. A conversation over a limit
    is cut. A null text is its end id alone, a null role bears no loss.
    """
    turn = F.struct("turn", "role", "text")
    whole = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )

    def encode(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        encoder = byte_bpe(tokenizer)
        for conversation in batch.column(1).to_pylist():
            parts = [np.append(encoder.ids(t["text"] or ""), np.uint32(end_id)) for t in conversation]
            loss = [np.full(len(p), t["role"] == loss_role) for p, t in zip(parts, conversation, strict=True)]
            yield np.concatenate(parts), np.concatenate(loss)

    return pack(whole, encode, limits, with_ids=True)


def op3_packing(docs: DataFrame, tokenizer: str) -> DataFrame:
    return pack_documents(docs.select("doc_id", "text"), tokenizer)
