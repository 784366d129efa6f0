"""Token counts that follow edits: a segment tree of pre-token runs for each document.

A document is cut into leaves of about ``LEAF`` characters at single blanks between two other signs, where every byte-level
pre-tokenizer cuts, whatever stands further away. A tree over the leaves holds the sums of characters and tokens below
each node. An edit descends to the leaves it touches, takes in a neighbour where the three signs around a cut are no
longer what they were, encodes that region anew and updates the sums on its paths. The rest is never encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathproof.llm.common import map_arrow
from pathproof.llm.tokens import ByteBpe, byte_bpe

#: Characters from which on a leaf ends at the next blank between two other signs.
LEAF = 256
_CUT = re.compile(r"(?<=\S) (?=\S)")
_TREE = "tree array<struct<chars:int,tokens:int>>"
_NODE = pa.list_(pa.struct([("chars", pa.int32()), ("tokens", pa.int32())]))


def leaves_of(text: str) -> list[str]:
    out, at = [], 0
    while at < len(text):
        cut = _CUT.search(text, at + LEAF)
        end = cut.start() if cut else len(text)
        out.append(text[at:end])
        at = end
    return out


class TokenTree:
    """``sums[1]`` is the root, ``sums[k]`` has the children 2k and 2k + 1, leaves start at half the length."""

    def __init__(self, text: str, sums: np.ndarray, encoder: ByteBpe):
        self.text, self.sums, self.encoder = text, sums, encoder
        self.half = len(sums) // 2
        self.encoded = 0  # characters encoded by edits so far

    @classmethod
    def build(cls, text: str, encoder: ByteBpe) -> TokenTree:
        leaves = leaves_of(text)
        half = 1
        while half < len(leaves):
            half *= 2
        sums = np.zeros((2 * half, 2), dtype=np.int64)
        for k, leaf in enumerate(leaves):
            sums[half + k] = len(leaf), len(encoder.ids(leaf))
        width = half
        while width > 1:
            width //= 2
            sums[width : 2 * width] = sums[2 * width : 4 * width].reshape(width, 2, 2).sum(axis=1)
        return cls(text, sums, encoder)

    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place``, and where it starts; behind the end, the last that holds any."""
        place = min(place, int(self.sums[1, 0]) - 1)
        node, start = 1, 0
        while node < self.half:
            node *= 2
            if place - start >= self.sums[node, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return node, start

    def _set(self, node: int, chars: int, tokens: int) -> None:
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def edit(self, start: int, deleted: int, inserted: str) -> None:
        """Replaces ``deleted`` characters from ``start`` on; both are cut to the text."""
        size = len(self.text)
        start = min(max(start, 0), size)
        end = min(start + max(deleted, 0), size)
        if size == 0:
            first, low, high = self.half, 0, 0
        else:
            first, low = self._find(start)
            while low and start < low + 2:  # the signs around the cut before the leaf are touched
                first, low = self._find(low - 1)
            last, at = self._find(max(start, end - 1))
            high = at + int(self.sums[last, 0])
            while high < size and end > high - 1:  # those around the cut behind it
                last, at = self._find(high)
                high = at + int(self.sums[last, 0])
            for node in range(first + 1, last + 1):
                if self.sums[node].any():
                    self._set(node, 0, 0)
        region = self.text[low:start] + inserted + self.text[end:high]
        self._set(first, len(region), len(self.encoder.ids(region)))
        self.encoded += len(region)
        self.text = self.text[:low] + region + self.text[high:]


def _nodes(trees: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(t) for t in trees])]).astype(np.int32)
    flat = np.concatenate([np.empty((0, 2), np.int64), *trees]).astype(np.int32)
    nodes = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(_NODE.value_type))
    return pa.ListArray.from_arrays(pa.array(ends), nodes)


def build(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The columns of ``docs`` and the tree of each text, with n_tokens; a null or empty text has no tokens.

    Null ids and repeated rows are counted like others, an empty table gives an empty result. A column of ``docs`` that
    is called tree or n_tokens is replaced.
    """
    docs = docs.drop("tree", "n_tokens")
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [TokenTree.build(t or "", byte_bpe(tokenizer)) for t in batch.column(at).to_pylist()]
            counts = pa.array([t.tokens() for t in trees], pa.int64())
            columns = [*batch.columns, _nodes([t.sums for t in trees]), counts]
            yield pa.record_batch(columns, names=[*batch.schema.names, "tree", "n_tokens"])

    return map_arrow(docs, work, _schema(docs) + f", {_TREE}, n_tokens long")


def update(state: DataFrame, tokenizer: str, edits: str = "edits") -> DataFrame:
    """``state`` (as built, with a column ``edits``: an array of (start, deleted, inserted)) after all edits, in order.

    Each edit refers to the text that the ones before it left; places behind its end mean its end, a null insertion
    inserts nothing, null places and lengths are 0. The column of edits goes, text, tree and n_tokens follow, and
    encoded_chars says how much was encoded for it. A null array leaves the row as it is.
    """
    kept = [c for c in state.columns if c not in (edits, "text", "tree", "n_tokens")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index
            texts = batch.column(place("text")).to_pylist()
            nodes = batch.column(place("tree"))
            flat = np.stack([nodes.flatten().field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1)
            ends = np.cumsum(nodes.value_lengths().to_numpy(zero_copy_only=False))
            trees = np.split(flat.astype(np.int64), ends[:-1]) if len(texts) else []
            new_texts, new_trees, counts, encoded = [], [], [], []
            for text, sums, changes in zip(texts, trees, batch.column(place(edits)).to_pylist(), strict=True):
                tree = TokenTree(text or "", sums, byte_bpe(tokenizer))
                for e in changes or []:
                    tree.edit(e["start"] or 0, e["deleted"] or 0, e["inserted"] or "")
                new_texts.append(tree.text if changes else text)
                new_trees.append(tree.sums)
                counts.append(tree.tokens())
                encoded.append(tree.encoded)
            columns = [batch.column(place(c)) for c in kept]
            columns += [pa.array(new_texts, pa.string()), _nodes(new_trees)]
            columns += [pa.array(counts, pa.int64()), pa.array(encoded, pa.int64())]
            yield pa.record_batch(columns, names=[*kept, "text", "tree", "n_tokens", "encoded_chars"])

    schema = _schema(state.select(*kept)) + ", " if kept else ""
    return map_arrow(state, work, schema + f"text string, {_TREE}, n_tokens long, encoded_chars long")


def with_edits(state: DataFrame, edits: DataFrame) -> DataFrame:
    """``state`` with the array of its ``edits`` (doc_id, seq, start, deleted, inserted), in the order of seq.

    Edits of unknown or null ids have no effect; rows that share an id get the same edits. Ties of seq follow the other
    columns.
    """
    each = F.struct("seq", "start", "deleted", "inserted")
    by_doc = edits.where("doc_id is not null").groupBy("doc_id").agg(F.array_sort(F.collect_list(each)).alias("edits"))
    return state.join(by_doc, "doc_id", "left")


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def sample_edits(text: Column) -> Column:
    """Three edits that any text can have: its beginning again after a third, ten signs for two words, a gap, at its end."""
    size = F.length(F.coalesce(text, F.lit("")))

    def edit(start: Column, deleted: int, inserted: Column) -> Column:
        return F.struct(
            start.cast("int").alias("start"), F.lit(deleted).alias("deleted"), inserted.alias("inserted")
        )

    return F.array(
        edit(F.floor(size / 3), 0, F.substring(F.coalesce(text, F.lit("")), 1, 40)),
        edit(F.floor(size / 2), 10, F.lit(" amended text")),
        edit(size - 30, 25, F.lit("")),
    )


def op2_tokencount(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, edited_tokens, edited_chars, encoded_chars) of every document, before and after three edits."""
    state = build(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), tokenizer)
    state = state.withColumn("before", F.col("n_tokens")).withColumn("edits", sample_edits(F.col("text")))
    after = update(state, tokenizer)
    return after.select(
        "doc_id",
        F.col("before").alias("n_tokens"),
        F.col("n_tokens").alias("edited_tokens"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("edited_chars"),
        "encoded_chars",
    )
