"""Ranked lexical search over a length-stratified index.

Documents with an equal normaliser m (a whole number that grows with the length) form a stratum. Its postings are kept by
term and, within a term, by frequency tf: as the impact of a posting depends on m and tf alone, it is computed once for
each tf. The largest tf of each term bounds what any document of the stratum can score. Strata are visited from the
highest bound on, and an item is compared with a stratum only if the bound reaches its k-th best score so far.

The index is a table of strata, in the order of m; a stratum of many documents has several rows. It holds the terms that
the items at hand ask for. Each task visits the strata it holds, for all items of a block, and hands on k rows for each
item; these meet in one window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathproof.llm.common import map_arrow, stored

#: Documents from which on a row of the index is closed; a batch of ``BATCH_ROWS`` documents more may be in it.
STRATUM_DOCS = 1024
#: Terms of the items that are searched for at a time (an item's own terms stay together).
BLOCK_TERMS = 1_000_000
#: Postings that are summed at a time.
_SUMMED = 1 << 21
#: Strata that a task orders by their bounds at a time.
_ORDERED = 256
#: Stands for a null doc_id, so that it comes first among equal scores.
_NULL_ID = -(1 << 63)

# A-Z are lower-cased; whatever else of ASCII is no letter or digit separates terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in their order, repeats included; a null text has none."""
    return (text or b"").translate(_FOLD).split()


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    """What a term that occurs ``tf`` times adds to a score, before its weight; grows with ``tf``."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Index:
    """``strata`` (m, docs, terms, tfs, starts, members): the members of posting list i are those from starts[i] on.

    ``terms`` are places in ``vocabulary``, ``df`` their numbers of documents, of which there are ``documents`` in all.
    """

    strata: DataFrame
    vocabulary: dict[bytes, int]
    documents: int
    df: np.ndarray


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of each row of ``docs`` that has a term; of its terms those in ``vocabulary``."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by BLOCK_TERMS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = sent.value.get
        for batch in batches:
            rows, sizes, ends, terms, tfs = [], [], [0], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for row, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                found = terms_of(text)
                if found:
                    known = [t for t in map(place, found) if t is not None]
                    each, often = np.unique(np.array(known, dtype=np.int64), return_counts=True)
                    rows.append(row)
                    sizes.append(len(found))
                    ends.append(ends[-1] + len(each))
                    terms.append(each)
                    tfs.append(often)
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x).astype(np.int32)))
                for x in (terms, tfs)
            ]
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.record_batch([ids, pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(slim, work, "doc_id long, n long, terms array<int>, tfs array<int>")


def build(docs: DataFrame, vocabulary: dict[bytes, int], stratum_docs: int = STRATUM_DOCS) -> Index:
    """Index of every row of ``docs`` (doc_id, text) for the terms of ``vocabulary`` (term to its place from 0 on).

    A row of the index has ``stratum_docs`` documents or few more.
    """
    counted = stored(_counted(docs, vocabulary))
    documents, words = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row for each term at most
        df[r[0]] = r[1]
    m = F.expr(f"CAST(100 - 90 + (90 * n * {documents}) DIV {max(1, words)} AS BIGINT)")
    order = ["m", "doc_id"]
    rows = counted.where(F.size("terms") > 0).withColumn("m", m).select("m", "doc_id", "terms", "tfs")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "m long, docs array<long>, terms array<int>, tfs array<int>, starts array<int>, members array<int>"
    return Index(stored(map_arrow(rows, partial(_strata, stratum_docs), schema)), vocabulary, documents, df)


def _strata(stratum_docs: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents, in the order of m, as rows of strata."""
    left: tuple[int, list[np.ndarray]] | None = None  # of the last m: ids, and (member, term, tf) of its postings

    def row(m: int, ids: np.ndarray, at: np.ndarray, term: np.ndarray, tf: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((at, tf, term))
        at, term, tf = at[order], term[order], tf[order]
        new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])]))
        parts = [(ids, pa.int64()), (term[new], pa.int32()), (tf[new], pa.int32()), (new, pa.int32()), (at, pa.int32())]
        columns = [pa.array([m], pa.int64()), *(pa.array([x], pa.list_(kind)) for x, kind in parts)]
        return pa.record_batch(columns, names=["m", "docs", "terms", "tfs", "starts", "members"])

    def joined(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
        return [np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1] + len(a[0])]), *map(np.concatenate, zip(a[2:], b[2:], strict=True))]

    for batch in batches:
        m = batch.column(0).to_numpy()
        ids = batch.column(1).fill_null(_NULL_ID).to_numpy()
        sizes = np.diff(batch.column(2).offsets.to_numpy())
        ends = np.concatenate([[0], np.cumsum(sizes)])
        term, tf = (batch.column(k).flatten().to_numpy() for k in (2, 3))
        cuts = np.concatenate([[0], np.flatnonzero(m[1:] != m[:-1]) + 1, [len(m)]])
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            if first == last:
                continue
            own = slice(ends[first], ends[last])
            part = [ids[first:last], np.repeat(np.arange(last - first), sizes[first:last]), term[own], tf[own]]
            if left is not None and (left[0] != m[first] or len(left[1][0]) >= stratum_docs):
                yield row(left[0], *left[1])
                left = None
            left = (int(m[first]), part if left is None else joined(left[1], part))
    if left is not None:
        yield row(left[0], *left[1])


class _Best:
    """The k best documents of each item so far; of equal scores the smaller id."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.found: list[list[tuple[int, int]]] = [[] for _ in range(items)]  # (-score, id), in order
        self.floors = np.ones(items, dtype=np.int64)  # scores below these are of no use

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        both = self.found[item] + list(zip((-scores).tolist(), ids.tolist(), strict=True))
        self.found[item] = best = sorted(both)[: self.k]
        if len(best) == self.k:
            self.floors[item] = -best[-1][0]


def search(index: Index, items: list[list[int]], k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of each of ``items``, lists of distinct places in the vocabulary."""
    weights = np.array([weight(index.documents, int(x)) for x in index.df], dtype=np.int64)
    sizes = np.array([len(x) for x in items], dtype=np.int64)
    flat = np.array([t for x in items for t in x], dtype=np.int64)
    sent = index.strata.sparkSession.sparkContext.broadcast((weights, sizes, flat))  # bounded by BLOCK_TERMS

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, sizes, flat = sent.value
        owner = np.repeat(np.arange(len(sizes)), sizes)
        best = _Best(len(sizes), k)
        rows: list[tuple[int, ...]] = []

        def flush() -> None:
            ceilings = np.empty((len(rows), len(sizes)), dtype=np.int64)
            for i, (m, _, term, tf, _, _) in enumerate(rows):
                most = np.zeros(len(weights), dtype=np.int64)
                np.maximum.at(most, term, tf)
                sums = np.concatenate([[0], np.cumsum(weights[flat] * impacts(most, m)[flat])])
                ceilings[i] = sums[np.cumsum(sizes)] - sums[np.cumsum(sizes) - sizes]
            for i in np.argsort(-ceilings.max(axis=1, initial=0), kind="stable"):
                _visited(rows[i], ceilings[i] >= best.floors, weights, owner, flat, best, _SUMMED)
            rows.clear()

        for batch in batches:
            for m, *lists in zip(*(batch.column(c).to_pylist() if c == 0 else _arrays(batch.column(c)) for c in range(6)), strict=True):
                rows.append((m, *lists))
                if len(rows) == _ORDERED:
                    flush()
        flush()
        found = [(item, doc, -score) for item, pairs in enumerate(best.found) for score, doc in pairs]
        columns = [pa.array([f[c] for f in found], pa.int64()) for c in range(3)]
        columns[1] = pa.array([f[1] for f in found], pa.int64(), mask=np.array([f[1] == _NULL_ID for f in found], bool))
        yield pa.record_batch(columns, names=["item", "doc_id", "score"])

    return map_arrow(index.strata, visit, "item long, doc_id long, score long")


def _arrays(column: pa.ListArray) -> Iterator[np.ndarray]:
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
    return (flat[a:b].astype(np.int64) for a, b in zip(ends[:-1], ends[1:], strict=True))


def _visited(
    row: tuple, wanted: np.ndarray, weights: np.ndarray, owner: np.ndarray, flat: np.ndarray, best: _Best, summed: int
) -> None:
    """Adds the documents of one row of the index that are good enough for the ``wanted`` items."""
    m, ids, term, tf, starts, members = row
    each, back = np.unique(tf, return_inverse=True)
    value = np.repeat(impacts(each, m)[back], np.diff(np.append(starts, len(members))))
    # postings of a term are those from first[t] to first[t + 1]
    first = np.append(starts, len(members))[np.searchsorted(term, np.arange(len(weights) + 1))]
    use = wanted[owner]
    item, t = owner[use], flat[use]
    counts = first[t + 1] - first[t]
    # items one after the other, so many at a time that their postings stay few
    group = np.zeros(len(wanted), dtype=np.int64)
    np.add.at(group, item, counts)
    group = np.cumsum(group) // summed
    for g in np.unique(group[wanted]):
        mine = group[item] == g
        some, c, x = item[mine], counts[mine], t[mine]
        if not c.sum():
            continue
        low = some.min()
        at = np.repeat(first[x] - np.cumsum(c) + c, c) + np.arange(c.sum())
        scores = np.zeros((some.max() - low + 1) * len(ids), dtype=np.int64)
        np.add.at(scores, np.repeat((some - low) * len(ids), c) + members[at], np.repeat(weights[x], c) * value[at])
        scores = scores.reshape(-1, len(ids))
        enough = scores >= best.floors[low : low + len(scores), None]
        for i in np.flatnonzero(enough.any(axis=1)):
            good = np.flatnonzero(enough[i])
            best.add(low + i, scores[i, good], ids[good])


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, stratum_docs: int = STRATUM_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` rows of ``docs`` (doc_id, text) that score highest for each of ``items``.

    ``items`` has the columns item_id and text; rows of one item_id (null is one, too) are one item with the terms of
    all. An item without terms, or whose terms no document holds, has no row; scores of 0 give none either. Equal scores
    are ranked by doc_id, null first. Repeated rows of ``docs`` count and rank like any others, null and empty texts have
    no terms, further columns are left out, and empty tables give an empty result. The items are searched for in blocks
    of about ``BLOCK_TERMS`` terms, only one of which is held at a time.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            terms = pa.array(found, pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            yield pa.record_batch([batch.column(0), terms], names=["item_id", "terms"])

    each = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    each = map_arrow(each, work, "item_id long, terms array<string>")
    each = stored(each.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")))
    total = each.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / BLOCK_TERMS))
    found = [_block(docs, each.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b), k, stratum_docs) for b in range(blocks)]
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out


def _block(docs: DataFrame, items: DataFrame, k: int, stratum_docs: int) -> DataFrame:
    chosen = items.where(F.size("terms") > 0).toArrow()
    vocabulary: dict[bytes, int] = {}
    lists = [[vocabulary.setdefault(t.encode(), len(vocabulary)) for t in ts] for ts in chosen["terms"].to_pylist()]
    found = stored(search(build(docs, vocabulary, stratum_docs), lists, k))
    names = items.sparkSession.createDataFrame(
        [(i, x) for i, x in enumerate(chosen["item_id"].to_pylist())], "item long, item_id long"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def op11_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    return ranked(docs, items)


ORACLE_SQL = r"""
    WITH terms AS (
        SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
        FROM documents
    ),
    held AS (SELECT doc_id, d, t, len(t) AS n FROM terms WHERE len(t) > 0),
    sums AS (SELECT count(*) AS docs, CAST(coalesce(sum(n), 0) AS BIGINT) AS words FROM held),
    each AS (SELECT doc_id, d, n, unnest(t) AS term FROM held),
    tfs AS (SELECT d, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM each GROUP BY d, term),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM tfs, sums GROUP BY term, docs
    ),
    asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ),
    scores AS (
        SELECT item_id, d, any_value(doc_id) AS doc_id,
               CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)))) AS BIGINT) AS score
        FROM asked JOIN tfs USING (term) JOIN weights USING (term), sums
        GROUP BY item_id, d
    ),
    ordered AS (
        SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
        FROM scores WHERE score > 0
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ordered WHERE rank <= 10
"""
