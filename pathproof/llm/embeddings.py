"""Embedding near-duplicates: int8 tile products with rigorous error bounds, and full precision where they leave doubt.

Every unit vector x is stored as a scale s and integers q in -127..127 with x = s q + e. For two vectors
x·y = s_x s_y (q_x·q_y) + s_x q_x·e_y + e_x·y, so the product of the integers is off by no more than
(1 + |e_x|) |e_y| + |e_x|, whatever the vectors. Pairs that may reach the threshold within that bound are recomputed in
double precision. Equal vectors are one node. Nodes are dealt to strips of bounded size, and each pair of strips is one
group: a vector is sent once to each strip's group, no pair leaves a group, only the sums of links and a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathproof.llm.common import components, stored

#: Vectors of a strip; two strips and one tile's products are all that a task holds.
STRIP = 4096
TILE = 1024
#: Products of so many dimensions stay below 2 ** 24, where single precision adds integers without rounding.
EXACT_DIMS = (1 << 24) // (127 * 127)
#: More than double precision can lose in a product of unit vectors.
SLACK = 1e-9


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(integers, scales, error norms) of unit vectors, one a row."""
    scale = np.abs(vectors).max(axis=1) / 127
    whole = np.rint(vectors / scale[:, None]).astype(np.int8)
    return whole, scale, np.linalg.norm(vectors - scale[:, None] * whole, axis=1)


def tile_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, in the fast single-precision kernel."""
    out = np.zeros((len(left), len(right)), dtype=np.float64 if left.shape[1] > EXACT_DIMS else np.float32)
    for at in range(0, left.shape[1], EXACT_DIMS):
        part = slice(at, at + EXACT_DIMS)
        out += left[:, part].astype(np.float32) @ right[:, part].astype(np.float32).T
    return out


def linked_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine >= threshold of rows of two arrays of finite vectors that are not zero, tile by tile."""

    def unit(x: np.ndarray) -> np.ndarray:
        x = x / np.abs(x).max(axis=1, keepdims=True)  # neither squares of tiny nor of huge components leave the range
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    left_unit, right_unit = unit(left), unit(right)
    ql, sl, el = quantise(left_unit)
    qr, sr, er = quantise(right_unit)
    for i in range(0, len(left), TILE):
        rows = slice(i, i + TILE)
        for j in range(0, len(right), TILE):
            columns = slice(j, j + TILE)
            # x·y >= threshold needs  q_x·q_y >= (threshold - bound) / (s_x s_y); the bound at its largest in the tile
            bound = (1 + el[rows].max()) * er[columns].max() + el[rows].max() + SLACK
            room = threshold - bound
            room -= 1e-6 * abs(room)  # single precision rounds by less
            least = np.float32(room) / np.outer(sl[rows], sr[columns]).astype(np.float32)
            products = tile_products(ql[rows], qr[columns])
            x, y = np.nonzero(products >= least)
            if not len(x):
                continue
            x, y = x + i, y + j
            own = (1 + el[x]) * er[y] + el[x] + SLACK
            near = products[x - i, y - j] * sl[x] * sr[y] >= threshold - own
            x, y = x[near], y[near]
            exact = np.concatenate(
                [_cosine(left[x[k : k + TILE]], right[y[k : k + TILE]]) for k in range(0, len(x), TILE)] or [[]]
            )
            yield x[exact >= threshold], y[exact >= threshold]


def _cosine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """In double precision, row by row."""
    scale_l, scale_r = np.abs(left).max(axis=1, keepdims=True), np.abs(right).max(axis=1, keepdims=True)
    left, right = left / scale_l, right / scale_r
    product = np.einsum("ij,ij->i", left, right)
    return product / np.sqrt(np.einsum("ij,ij->i", left, left) * np.einsum("ij,ij->i", right, right))


class Forest:
    """Merges the ends of links into sets; holds one number for each row."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            a, b = self.label[x], self.label[y]
            if (open_ := a != b).sum() == 0:
                return
            x, y = x[open_], y[open_]
            low, high = np.minimum(a, b)[open_], np.maximum(a, b)[open_]
            np.minimum.at(self.label, high, low)
            while (shorter := self.label[self.label]).tolist() != self.label.tolist():
                self.label = shorter


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Two rows are linked if the cosine of their vectors, in double precision, is at least ``threshold`` (over 0).
    ``n_links`` counts the other rows linked with a row, its equal copies included; ``component_id`` is the smallest
    vec_id that links reach, the row's own included; ``kept`` says that the row has this id. A vector that is null,
    empty, zero or that has null or non-finite components is linked with nothing, nor are vectors of unlike lengths.
    Null ids are passed over by the minimum; a component of null ids alone has a null id and its rows are not kept.
    Repeated rows stay repeated and count as links of each other. Further columns are left out.
    """
    rows = stored(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        .withColumn(
            "usable",
            F.coalesce(
                F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
                & F.exists("v", lambda x: x != 0),
                F.lit(False),
            ),
        )
        .withColumn("node", F.when(F.col("usable"), F.sha2(F.array_join(F.transform("v", _text_of), ","), 256)))
    )
    # equal vectors are one node; nodes are dealt to strips of at most STRIP by their place, not by their values
    nodes = rows.where("usable").groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    shapes = rows.where("usable").select("node", "v").dropDuplicates(["node"])
    nodes = stored(nodes.join(shapes, "node"))
    n = nodes.count()
    strips = max(1, math.ceil(n / (STRIP * 0.8)))
    links = stored(_node_links(nodes, strips, threshold))
    sums = links.where("other is null").groupBy("node").agg(F.sum("linked").alias("linked"))
    edges = links.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    roots = components(edges).withColumnsRenamed({"component": "root"})
    reach = nodes.select("node", "copies", "least").join(sums, "node", "left").join(roots, "node", "left")
    reach = reach.withColumn("root", F.coalesce("root", "node")).withColumn(
        "n_links", F.coalesce("linked", F.lit(0)) + F.col("copies") - 1
    )
    reach = stored(reach)
    ids = reach.groupBy("root").agg(F.min("least").alias("component_id"))
    reach = reach.join(ids, "root").select("node", "n_links", "component_id")
    lone = rows.where("node is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = rows.where("node is not null").join(reach, "node").select("vec_id", "n_links", "component_id").union(lone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _text_of(x):
    """0.0 and -0.0 are one value."""
    return (x + F.lit(0.0)).cast("string")


def _node_links(nodes: DataFrame, strips: int, threshold: float) -> DataFrame:
    """(node, linked, other): the copies linked with a node (other is null), and edges that span all links."""

    def work(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        high, low = int(group["high"].iloc[0]), int(group["low"].iloc[0])
        group = group.sort_values(["strip", "node"], kind="stable")
        for _, alike in group.groupby(group["v"].map(len), sort=False):  # vectors of unlike lengths have no cosine
            left, right = alike[alike["strip"] == low], alike[alike["strip"] == high]
            names = left["node"].tolist() + ([] if high == low else right["node"].tolist())
            copies = np.concatenate([left["copies"], right["copies"]]) if high != low else left["copies"].to_numpy()
            if not len(left) or not len(right):
                continue
            shift = 0 if high == low else len(left)
            linked, forest = np.zeros(len(names), dtype=np.int64), Forest(len(names))
            for x, y in linked_pairs(np.stack(left["v"].tolist()), np.stack(right["v"].tolist()), threshold):
                if high == low:
                    x, y = x[x < y], y[x < y]
                y = y + shift
                linked += np.bincount(x, copies[y], len(names)).astype(np.int64)
                linked += np.bincount(y, copies[x], len(names)).astype(np.int64)
                forest.add(x, y)
            some = np.nonzero(linked)[0]
            own = [names[k] for k in some]
            out += zip(own, linked[some].tolist(), [None] * len(own), strict=True)
            tree = np.nonzero(forest.label != np.arange(len(names)))[0]
            ends = [names[k] for k in forest.label[tree]]
            out += zip([names[k] for k in tree], [0] * len(tree), ends, strict=True)
        return pd.DataFrame(out, columns=["node", "linked", "other"])

    strip = F.pmod(F.xxhash64("node"), F.lit(strips)).cast("int")
    dealt = nodes.select("node", "copies", "v", strip.alias("strip"))
    others = F.transform(F.sequence(F.lit(0), F.lit(strips - 1)), lambda k: F.struct(
        F.least(F.col("strip"), k).alias("low"), F.greatest(F.col("strip"), k).alias("high")
    ))
    sent = dealt.withColumn("pair", F.explode(others)).select("node", "copies", "v", "strip", "pair.low", "pair.high")
    return sent.groupBy("low", "high").applyInPandas(work, "node string, linked long, other string")


def op10_embeddings(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors.select("vec_id", "embedding"))
