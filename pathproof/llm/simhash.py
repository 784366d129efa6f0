"""SimHash near-duplicates: links between fingerprints that differ in few bits, found by pigeonring filtering.

A fingerprint is cut into ``radius + 1`` segments that lie on a ring. If two fingerprints differ in at most ``radius``
bits, there is a segment from which every chain of ``l`` consecutive segments has at most ``l * radius / (radius + 1)``
differing bits, rounded down. The first segment of such a chain is therefore equal and the second has one differing
bit at most. Both make the join key: each fingerprint is stored once per segment under (segment, its bits, the next
segment's bits) and looked up under that key and under the key with each single bit of the next segment flipped. The
budgets of longer chains prune the pairs within the join, before the full count of differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathproof.llm.common import components, map_arrow, stored, text_key

BITS = 64
#: Shingles whose bits are counted at a time.
_SLICE = 1 << 16


def simhash(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if over half of the shingles' XXH64 have it.

    A-Z are lower-cased, words end at ASCII white space, shingles are joined by one space and count as often as they
    occur. A text of fewer words is one shingle; a null text or one without words has the fingerprint 0.
    """
    split = (text or "").encode().lower().split()
    if not split:
        return 0
    n = max(1, len(split) - words + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _SLICE):
        hashes = [
            xxhash.xxh64_intdigest(b" ".join(split[i : i + words]), seed) for i in range(at, min(n, at + _SLICE))
        ]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, text_key, fingerprint) of every row of ``docs`` (doc_id, text); the fingerprint is a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([simhash(t, words) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))],
                names=["doc_id", "text_key", "fingerprint"],
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    return map_arrow(slim, work, "doc_id long, text_key string, fingerprint long")


def _segments(radius: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    n = radius + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _budgets_hold(differing: Column, segment: Column, radius: int) -> Column:
    """Whether all chains of three and more segments from ``segment`` on stay within their budgets."""
    ring = _segments(radius)
    n = len(ring)
    holds = F.bit_count(differing) <= radius
    for length in range(n - 1, 2, -1):
        masks = []
        for start in range(n):
            chain = [ring[(start + k) % n] for k in range(length)]
            masks.append(F.lit(_signed(sum(((1 << w) - 1) << lo for lo, w in chain))).cast("long"))
        mask = F.element_at(F.array(*masks), segment + 1)
        holds = (F.bit_count(differing.bitwiseAND(mask)) <= length * radius // n) & holds
    return holds


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (a, b), a < b, of distinct ``prints`` (fingerprint) that differ in 1 to ``radius`` bits.

    ``radius`` is 1 to 15. Every pair is found; one is repeated if several chains show it.
    """
    ring = _segments(radius)
    n = len(ring)
    fp = F.col("fingerprint")

    def bits(lo: int, width: int) -> Column:
        return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    ends = []
    for i, (lo, width) in enumerate(ring):
        next_lo, next_width = ring[(i + 1) % n]
        ends.append(
            F.struct(
                F.lit(i).alias("segment"),
                bits(lo, width).alias("first"),
                bits(next_lo, next_width).alias("second"),
                F.array(*(F.lit(m).cast("long") for m in [0, *(1 << k for k in range(next_width))])).alias("flips"),
            )
        )
    each = prints.select(fp, F.explode(F.array(*ends)).alias("s")).select("fingerprint", "s.*")
    index = each.select("segment", "first", "second", fp.alias("b"))
    each = each.withColumn("flip", F.explode("flips"))
    probe = each.select(
        "segment",
        "first",
        F.col("second").bitwiseXOR(F.col("flip")).alias("second"),
        fp.alias("a"),
    )
    pair = probe.join(index, ["segment", "first", "second"])
    differing = F.col("a").bitwiseXOR(F.col("b"))
    found = pair.where((F.col("a") < F.col("b")) & _budgets_hold(differing, F.col("segment"), radius))
    return found.select("a", "b")


def groups(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """Rows (doc_id, text_key, fingerprint, root, component_id) for every row of ``docs`` (doc_id, text).

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the smallest doc_id
    that links reach, the document's own included, ``root`` a fingerprint that names the component. Equal fingerprints are one node, so copies cost one row each. A
    null or empty text has the fingerprint 0 and is linked like any other. Null ids are passed over by the minimum; a
    component of null ids alone has a null id. Repeated rows stay repeated, further columns are left out, an empty
    table gives an empty result.
    """
    prints = stored(fingerprints(docs, words))
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("fingerprint"), radius))
    roots = roots.withColumnsRenamed({"node": "fingerprint", "component": "root"})
    reach = nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    ids = stored(reach.groupBy("root").agg(F.min("least").alias("component_id")))
    reach = reach.join(ids, "root").select("fingerprint", "root", "component_id")
    return prints.join(reach, "fingerprint").select("doc_id", "text_key", "fingerprint", "root", "component_id")


def one_of_each_group(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each of the ``groups`` the document with the smallest id.

    All columns are kept. Ties (one id with several texts of a group) are settled by the text key; fully repeated rows of
    the document that stays count as one, and one stays. Null ids come last. Texts without words are one group.
    """
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    chosen = groups(docs.select("doc_id", "text"), words, radius).groupBy("root").agg(F.min(order).alias("m")).select("m.*")
    chosen = stored(chosen.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")))
    keyed = docs.withColumn("__key2", text_key(F.col("text")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__key2") == F.col("__key"))
    kept = keyed.join(chosen, same, "left_semi")
    return kept.dropDuplicates(["doc_id", "__key2"]).drop("__key2")


def op6_simhash(docs: DataFrame) -> DataFrame:
    member = groups(docs.select("doc_id", "text"))
    return member.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
