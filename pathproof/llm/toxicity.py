"""Toxic passages: maximum-scoring segments over token log-odds, aggregated by extreme-value calibration.

Training compares in how many toxic and in how many clean documents a token occurs. The log-odds are shrunk by a Dirichlet
prior centred on the pooled shares, so a token seen a few times proves little. A token is a word or its first letters: of
those, a word takes the one with the strongest evidence. Words without evidence weigh ``DRIFT``, less than zero.

A document's segments are all maximal ones, found in one pass (Ruzzo and Tompa); the k-th hit of one token weighs 1/k, as
words come in bursts. Under clean text the largest score of n words follows an extreme-value law with
K n exp(-lambda s): lambda solves E[exp(lambda weight)] = 1 over the words of clean training documents, K is fitted to
their largest scores. The scores of a document's segments combine into one p-value by the law of their sum, and a
logistic curve makes a probability of it. Law and curve are fitted with weights learnt from the other half of the rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathproof.llm.common import map_arrow, stored

#: The classifier is fitted on so many labelled rows at most, chosen by a hash of their id.
TRAIN_ROWS = 50_000
#: Weight of a word without evidence: a passage ends where evidence stops for long.
DRIFT = -0.1
#: Tokens enter the model if their log-odds exceed so many standard errors that chance alone would let in this many of all
#: tokens tried; the strongest are kept.
CHANCE_TOKENS, MOST_TOKENS = 1.0, 20_000
#: A whole word seen in so many documents keeps its own weight, even if its first letters have strong evidence.
OWN_WEIGHT_FROM = 5
#: Share of their toxic documents from which on first letters are taken for a single word.
ONE_WORD = 0.9
#: Strength of the prior, as a share of the tokens counted.
PRIOR_SHARE = 0.2
#: Hash functions by which near copies among the training rows are told.
SKETCHES = 4
#: Lengths of the first letters that count as tokens beside the whole word.
HEADS = (4, 5)
#: Documents with this score or more are rejected.
REJECT = 0.7

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def tokens_of(word: str) -> list[str]:
    """The whole word, marked by a blank at its end, and its first letters, the longest first."""
    return [word + " ", *(word[:k] for k in sorted(HEADS, reverse=True) if len(word) >= k)]


def held_out(doc_id: Column) -> Column:
    """Rows that training must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass(frozen=True)
class Segment:
    """Words ``first`` to ``last``, the last included."""

    first: int
    last: int
    score: float


def maximal_segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[Segment]:
    """All maximal scoring segments of a sequence that weighs ``drift`` but for ``hits`` (place, weight), in order.

    One pass: a segment is kept with the total before it and the total at its end. A new one that reaches higher than
    an earlier one with a lower start swallows all from there on.
    """
    found: list[tuple[float, float, int, int]] = []
    total, at = 0.0, -1
    for place, weight in hits:
        total += drift * (place - at - 1)
        before, total, at = total, total + weight, place
        if weight <= 0:
            continue
        start, first = before, place
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][0] >= start:
                k -= 1
            if k < 0 or found[k][1] >= total:
                break
            start, first = found[k][0], found[k][2]
            del found[k:]
        found.append((start, total, first, place))
    return [Segment(first, last, high - low) for low, high, first, last in found]


@dataclass(frozen=True)
class Model:
    """Weights of tokens, and how scores become probabilities."""

    weights: dict[str, float]
    heads: frozenset[str]
    scale: float = 1.0
    k: float = 1.0
    curve: tuple[float, float] = (0.0, 0.0)

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        heads, weights, least = self.heads, self.weights, min(HEADS)
        out, seen = [], Counter()
        for i, word in enumerate(words):
            if word[:least] in heads:
                token = next((t for t in tokens_of(word) if t in weights), None)
                if token is not None:
                    seen[token] += 1
                    out.append((i, weights[token] / seen[token]))
        return out

    def normal(self, score: float, n: int) -> float:
        return self.scale * score - math.log(self.k * n)

    def p_value(self, scores: list[float], n: int) -> float:
        """Of a document of ``n`` words: the smallest over its r best segments, with a price for the choice of r."""
        if not scores:
            return 1.0
        normal = sorted((self.normal(s, n) for s in scores), reverse=True)
        least, total = _at_least_one(normal[0]), 0.0
        for r, x in enumerate(normal, 1):
            if x <= 0:
                break
            total += x
            if r > 1:
                log_p = r * math.log(2) - total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
                least = min(least, math.exp(min(0.0, log_p)))
        return max(least, 1e-300)

    def probability(self, p: float) -> float:
        return 1 / (1 + math.exp(-self.curve[0] - self.curve[1] * _surprise(p)))

    def score(self, text: str | None) -> tuple[float, list[tuple[Segment, float]]]:
        """(probability, significant segments with their p-values); a text without words has the probability 0."""
        words = words_of(text)
        if not words:
            return 0.0, []
        segments = maximal_segments(self.hits(words))
        each = [(s, _at_least_one(self.normal(s.score, len(words)))) for s in segments]
        p = self.p_value([s.score for s in segments], len(words))
        return self.probability(p), [(s, p) for s, p in each if p < 0.01]


def _at_least_one(normal: float) -> float:
    """Chance of a segment with this normalised score in clean text."""
    return -math.expm1(-math.exp(min(50.0, -normal)))


def _surprise(p: float) -> float:
    return math.log1p(-math.log(max(p, 1e-300)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton's method, with a little shrinkage so that separable rows have a solution."""
    design, beta = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    shrink = np.diag([1e-3, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - shrink @ beta
        curvature = (design * (p * (1 - p))[:, None]).T @ design + shrink
        step = np.linalg.solve(curvature, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(0.0, beta[1]))


def _sketch(text: str | None) -> list[int]:
    """Smallest hashes of the runs of five words, by ``SKETCHES`` hash functions: near copies mostly share one."""
    words = words_of(text)
    runs = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    hashes = np.fromiter((xxhash.xxh64_intdigest(r) for r in runs), dtype=np.uint64, count=len(runs))
    return [int((hashes * np.uint64(2 * k + 1) ^ np.uint64(k) << np.uint64(60)).min() >> np.uint64(1)) for k in range(SKETCHES)]


def _training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(half, toxic, text) of at most ``rows`` labelled rows outside the held-out part; of near copies one row.

    A passage that was copied a hundred times proves as much as one.
    """
    labelled = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    labelled = labelled.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_sketch(t) for t in batch.column(2).to_pylist()]
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(SKETCHES)]
            yield pa.record_batch([*batch.columns[:2], *columns], names=["doc_id", "toxic", *keys])

    keys = [f"k{k}" for k in range(SKETCHES)]
    # ``chosen`` is bounded by ``rows``, so it can be sent to all, and so can what is left of it
    sample = keyed.join(F.broadcast(chosen), "doc_id").select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text")
    left = map_arrow(sample, sketch, "doc_id long, toxic int, " + ", ".join(f"{k} long" for k in keys))
    for k in keys:
        left = left.groupBy(k, "toxic").agg(F.min(F.struct("doc_id", *(x for x in keys if x != k))).alias("m"))
        left = left.select(k, "toxic", "m.*")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")
    left = stored(left.select("doc_id", half, "toxic").dropDuplicates(["doc_id"]).limit(rows))
    return keyed.join(F.broadcast(left), "doc_id").select("half", "toxic", "text")


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learns from ``labels`` (doc_id, toxic) and the texts of ``docs`` (doc_id, text), held-out ids left out.

    Labels other than 0 and 1 and labels without a document are passed over; an id labelled twice counts as toxic if
    one label says so. Without toxic or clean training rows no word has evidence and all scores are the prior.
    """
    rows = _training_rows(docs, labels, train_rows)
    kinds = [(half, label) for half in (0, 1) for label in (0, 1)]
    names = [f"n{half}{label}" for half, label in kinds]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {kind: Counter[str]() for kind in kinds}

        def out() -> pa.RecordBatch:
            tokens = list(set().union(*counts.values()))
            columns = [pa.array([counts[kind][t] for t in tokens], pa.int64()) for kind in kinds]
            for c in counts.values():
                c.clear()
            return pa.record_batch([pa.array(tokens, pa.string()), *columns], names=["token", *names])

        for batch in batches:
            for half, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts[half, label].update({t for w in set(words_of(text)) for t in tokens_of(w)})
            if sum(map(len, counts.values())) > 500_000:
                yield out()
        yield out()

    counts = map_arrow(rows, count, "token string, " + ", ".join(f"{n} long" for n in names))
    counts = stored(counts.groupBy("token").agg(*(F.sum(n).alias(n) for n in names)))
    whole = _weights(counts, F.col("n01") + F.col("n11"), F.col("n00") + F.col("n10"))
    halves = [_weights(counts, F.col(f"n{half}1"), F.col(f"n{half}0")) for half in (0, 1)]
    return _calibrated(whole, halves, rows) if whole.weights else whole


def _weights(counts: DataFrame, toxic: Column, clean: Column) -> Model:
    """The tokens whose counts prove that toxic documents have them more often; their number is bounded."""
    counts = counts.select("token", toxic.alias("toxic"), clean.alias("clean"))
    n1, n0 = counts.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    if not n1 or not n0:
        return Model({}, frozenset())
    strength = PRIOR_SHARE * (n1 + n0)
    prior = strength * (F.col("toxic") + F.col("clean")) / (n1 + n0)
    odds = [F.log((F.col(y) + prior) / (n + strength - F.col(y) - prior)) for y, n in (("toxic", n1), ("clean", n0))]
    error = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    seen = counts.where("toxic + clean > 0").withColumn("weight", odds[0] - odds[1])
    seen = seen.withColumn("z", F.col("weight") / error)
    tried = seen.where(F.col("toxic") >= 2)
    least_z = NormalDist().inv_cdf(1 - CHANCE_TOKENS / max(100, tried.count()))
    strong = tried.where(F.col("z") >= least_z).orderBy(F.desc("z"), "token")
    found = {r.token: r for r in strong.limit(MOST_TOKENS).collect()}
    # first letters prove nothing of their own if one word accounts for nearly all their toxic documents
    single = {
        t[:k]
        for t, r in found.items()
        for k in HEADS
        if t.endswith(" ") and t[:k] in found and r.toxic >= ONE_WORD * found[t[:k]].toxic
    }
    weights = {t: r.weight for t, r in found.items() if t not in single}
    heads = [t for t in weights if not t.endswith(" ")]
    under = [F.substring("token", 1, k).isin([t for t in heads if len(t) == k]) for k in HEADS]
    own = (
        seen.where(F.col("token").endswith(" ") & (F.col("toxic") + F.col("clean") >= OWN_WEIGHT_FROM))
        .where(reduce(Column.__or__, under))
        .orderBy(F.desc(F.col("toxic") + F.col("clean")), "token")
    )
    weights = {r.token: r.weight for r in own.limit(MOST_TOKENS).collect()} | weights
    return Model(weights, frozenset(t.rstrip()[: min(HEADS)] for t in weights))


def _calibrated(model: Model, halves: list[Model], rows: DataFrame) -> Model:
    """Fits the extreme-value law to the clean training rows, whose number is bounded, each with the other half's weights."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for half, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                if words:
                    hits = halves[1 - half].hits(words)
                    scores = [s.score for s in maximal_segments(hits)]
                    out.append((label, len(words), scores, [] if label else [w for _, w in hits]))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            yield pa.record_batch(columns, names=["toxic", "n", "scores", "hits"])

    found = map_arrow(rows, measure, "toxic long, n long, scores array<double>, hits array<double>").toPandas()
    clean = found[found["toxic"] == 0]
    if not len(clean):
        return model
    n = clean["n"].to_numpy(dtype=float)
    one_more = [[np.mean(list(model.weights.values()))]]
    hits = np.concatenate([np.asarray(h, dtype=float) for h in clean["hits"]] + one_more)
    others = max(1.0, n.sum() - len(hits))

    def excess(scale: float) -> float:
        chance = others * math.exp(scale * DRIFT) + np.exp(np.minimum(700, scale * hits)).sum()
        return chance / (others + len(hits)) - 1

    low, high = 1e-6, 50.0
    if excess(low) >= 0:  # evidence is so common in clean text that chance alone could go on for ever
        low = high = 0.01
    while high - low > 1e-6:
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    best = np.array([max(x, default=0.0) for x in clean["scores"]])
    k = len(clean) / float((n * np.exp(-low * best)).sum())
    law = Model(model.weights, model.heads, low, k)
    p = [law.p_value(list(x), m) for x, m in zip(found["scores"], found["n"], strict=True)]
    curve = _logistic(np.array([_surprise(x) for x in p]), (found["toxic"] == 1).to_numpy(dtype=float))
    return Model(model.weights, model.heads, low, k, curve)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, segments) of every row of ``docs`` (doc_id, text).

    ``segments`` are the significant passages: first and last word, score, p-value. The score is 0 to 1; a null or empty
    text, or one without words, has 0. Null ids and repeated rows are scored like others, further columns are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MOST_TOKENS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("p", pa.float64())])
        )
        for batch in batches:
            scores, passages = [], []
            for text in batch.column(1).to_pylist():
                value, segments = sent.value.score(text)
                scores.append(value)
                passages.append([{"first": s.first, "last": s.last, "score": s.score, "p": p} for s, p in segments])
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, kind)]
            yield pa.record_batch(columns, names=["doc_id", "score", "segments"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(
        slim, work, "doc_id long, score double, segments array<struct<first:int,last:int,score:double,p:double>>"
    )


def clean_documents(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that score less than ``reject``, with all their columns; null and empty texts stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = [sent.value.score(t)[0] < reject for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return map_arrow(docs, work, docs.schema)


def op4_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
        "segments",
    )
