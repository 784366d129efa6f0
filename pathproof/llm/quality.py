"""Quality of documents: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

A text is a run of words, numbers and runs of marks. Its features are the hashes of single ones and of pairs, and of
triples of their shapes (lower or upper case, capital, number, mark, the same as the one before), which also tell of
words that training has not seen. Either kind is weighed by the square root of its counts and has the length 1.

Training takes a bounded sample of the labelled rows, in parts. Each part goes through its rows a few times; a step
changes the features of one row only, at a rate that falls with what the feature has moved before, and weights stay 0
until the evidence exceeds a bound. The weights of the parts are averaged, each feature's by how much the parts have
seen of it. A score is one sparse dot product.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathproof.llm.common import map_arrow, stored

#: The classifier is fitted on so many labelled rows at most, chosen by a hash of their id.
TRAIN_ROWS = 30_000
#: Rows that one task trains on, on average.
PART_ROWS = 5_000
#: Passes of a part through its rows.
PASSES = 4
#: Bits of a feature's number.
BITS = 18
#: Rate of learning, its start, and the weights of both penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
#: Documents with this score or more are good.
GOOD = 0.3
#: Words whose hashes a task remembers.
_REMEMBERED = 500_000

_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")
_SAME = 5


def held_out(doc_id: Column) -> Column:
    """Rows that training must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _shape(token: bytes) -> int:
    """0 lower case, 1 upper case, 2 a capital first, 3 a number, 4 marks; letters beyond ASCII are as they are there."""
    word = token.decode()
    if not (word[0].isalpha() or token[0] >= 128):
        return 3 if token[:1].isdigit() else 4
    if len(word) > 1 and word.isupper():
        return 1
    return 2 if word[0].isupper() else 0


class _Known(dict):
    """Tokens to hashes with the shape in the lowest three bits."""

    def __missing__(self, token: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[token] = h = xxhash.xxh64_intdigest(token) & ~7 | _shape(token)
        return h


def _slots(h: np.ndarray) -> np.ndarray:
    return (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: bytes | None, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the features, their values) of a UTF-8 text; a text without tokens has none."""
    tokens = _TOKEN.findall(text or b"")
    h = np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    shape = h & np.uint64(7)
    shape[1:][h[1:] == h[:-1]] = _SAME
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:]
    edge = np.full(1, 6, dtype=np.uint64)
    shape = np.concatenate([edge, shape, edge]) if len(shape) else shape
    triples = shape[:-2] << np.uint64(6) | shape[1:-1] << np.uint64(3) | shape[2:]
    found = []
    for slots in (np.concatenate([_slots(h), _slots(pairs)]), _slots(triples * np.uint64(0x9E3779B97F4A7C15))):
        each, counts = np.unique(slots, return_counts=True)
        found.append((each, np.sqrt(counts / max(1, len(slots)))))
    return np.concatenate([x for x, _ in found]), np.concatenate([v for _, v in found])


class Leader:
    """State of follow-the-regularised-leader: sums ``z`` and squares ``n`` of the gradients; the last place is the bias."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """One step; a feature that stands in ``at`` twice moves by the later value."""
        w = self.weights(at)
        g = (_sigmoid(float(w @ x)) - label) * x
        n = self.n[at]
        moved = n + g * g
        self.z[at] += g - (np.sqrt(moved) - np.sqrt(n)) / ALPHA * w
        self.n[at] = moved


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


@dataclass(frozen=True)
class Model:
    """Weights of the features; the last one is the bias."""

    weights: np.ndarray

    def score(self, text: bytes | None, known: dict[bytes, int]) -> float:
        at, x = features(text, known)
        return _sigmoid(float(self.weights[at] @ x + self.weights[-1]))


def train(texts: list[bytes], labels: list[int]) -> Leader:
    """Passes through the rows, in their order."""
    known, leader = _Known(), Leader()
    rows = []
    for text in texts:
        at, x = features(text, known)
        rows.append((np.append(at, len(leader.z) - 1), np.append(x, 1.0)))
    for _ in range(PASSES):
        for (at, x), label in zip(rows, labels, strict=True):
            leader.learn(at, x, label)
    return leader


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learns from ``labels`` (doc_id, quality) and the texts of ``docs`` (doc_id, text), held-out ids left out.

    Labels other than 0 and 1 and labels without a document are passed over; an id labelled twice counts as 0 if one
    label says so, and of several texts under one id the least one is learnt. Without training rows all scores are 0.5.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    labelled = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    labelled = labelled.groupBy(doc_id).agg(F.min("quality").cast("int").alias("label"))
    chosen = stored(labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    parts = max(1, math.ceil(chosen.count() / PART_ROWS))
    # ``chosen`` is bounded by ``train_rows``
    rows = docs.select(doc_id, F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = rows.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part"), F.xxhash64(F.lit(1), "doc_id").alias("at"), "label", "text"
    )

    def learn(part: pa.Table) -> pa.Table:
        part = part.sort_by("at")
        leader = train(part["text"].cast(pa.binary()).to_pylist(), part["label"].to_pylist())
        seen = np.flatnonzero(leader.n)
        n = leader.n[seen]
        return pa.table({"slot": seen, "n": n, "sum": leader.weights(seen) * n})

    each = rows.groupBy("part").applyInArrow(learn, "slot long, n double, sum double")
    found = each.groupBy("slot").agg((F.sum("sum") / F.sum("n")).alias("weight")).toArrow()  # 2 ** BITS + 1 rows at most
    weights = np.zeros((1 << BITS) + 1)
    weights[found["slot"].to_numpy()] = found["weight"].to_numpy()
    return Model(weights)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text); higher scores make label 1 likelier.

    A null or empty text, or one of white space, has the score of the bias alone. Null ids and repeated rows are scored
    like others, further columns are left out, an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        for batch in batches:
            scores = [sent.value.score(t, known) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(slim, work, "doc_id long, score double")


def op13_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )
