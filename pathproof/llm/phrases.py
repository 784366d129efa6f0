"""Phrase collocations from FM-indexes of shards over word ids.

A shard holds the words of some documents of one language as numbers, pieces of text apart from each other. Its index
has two Burrows-Wheeler transforms, of the words and of the words in reverse. Rows are ordered by their first ``DEPTH``
words, which is enough for phrases of that many. A phrase is an interval of rows in either order: the symbols before the
rows of the one are its left extensions, those of the other its right ones, and the counts of both orders move together.
So all words extend to the left into pairs, and pairs to the right into triples, each with its count. Counts are then
summed across shards.

A phrase occurs as often as its parts at most. Pairs that are frequent over all shards therefore mark a bitmap of fixed
size, and a shard extends only pairs with a mark, to triples that end in one. The bitmap spares work; with many pairs it
spares less, and the counts stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathproof.llm.common import map_arrow, stored

#: Words of the longest phrases, and of the order of an index.
DEPTH = 3
#: A task closes its shards when they hold so many words.
SHARD_WORDS = 1 << 22
#: Bits of the map of frequent pairs (a power of two).
MARKS = 1 << 26
#: A language's candidates are ranked in so many parts first.
PARTS = 64
#: Rows of an Arrow batch of counts.
_ROWS = 1 << 16

# A-Z are lower-cased, the marks that end a piece become line feeds; words end at blanks and tabs.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(10 if c in _ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text in their order; the word ``.`` stands where a piece ends."""
    return (text or b"").translate(_FOLD).replace(b"\n", b" . ").split()


class _Numbers(dict):
    """Words to numbers from 1 on; 0 ends a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _order(a: np.ndarray, symbols: int) -> np.ndarray:
    """Places of ``a``, ordered by the ``DEPTH`` symbols that begin there; beyond the end are zeros."""
    padded = np.append(a, np.zeros(DEPTH, a.dtype)).astype(np.int64)
    keys = [padded[k : k + len(a)] for k in range(DEPTH)]
    width = max(1, symbols.bit_length())
    if DEPTH * width > 62:
        return np.lexsort(keys[::-1])
    packed = keys[0]
    for k in keys[1:]:
        packed = packed << width | k
    return np.argsort(packed, kind="stable")


def transform(a: np.ndarray, symbols: int) -> np.ndarray:
    """The symbol before each place of ``a``, in the order of places; before the first one is a zero."""
    return np.append(a[-1:] * 0, a[:-1])[_order(a, symbols)]


@dataclass(frozen=True)
class Phrases:
    """Phrases (a row of ``words`` each): where their rows begin in either order, and how many there are."""

    words: np.ndarray
    rows: np.ndarray
    back: np.ndarray
    counts: np.ndarray


@dataclass(frozen=True)
class Extensions:
    """Phrase ``parent`` with ``symbol`` beside it: its count, and the occurrences with a smaller symbol there."""

    parent: np.ndarray
    symbol: np.ndarray
    counts: np.ndarray
    smaller: np.ndarray

    def chosen(self, keep: np.ndarray) -> Extensions:
        return Extensions(self.parent[keep], self.symbol[keep], self.counts[keep], self.smaller[keep])


class FmIndex:
    """Bidirectional index of the words ``forward`` and ``backward`` are the transforms of."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray) -> None:
        self.forward, self.backward = forward, backward
        self.first = np.concatenate([[0], np.cumsum(np.bincount(forward, minlength=1))])

    @classmethod
    def of(cls, a: np.ndarray) -> FmIndex:
        """``a`` begins and ends with a zero."""
        symbols = int(a.max(initial=0))
        return cls(transform(a, symbols), transform(a[::-1], symbols))

    def singles(self) -> Phrases:
        words = np.arange(1, len(self.first) - 1)
        return Phrases(words[:, None], self.first[words], self.first[words], self.first[words + 1] - self.first[words])

    def _before(self, which: np.ndarray, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before a row of a transform."""
        n = len(which)
        places = np.sort(which.astype(np.int64) * n + np.arange(n))
        return np.searchsorted(places, symbol * n + row) - self.first[symbol]

    @staticmethod
    def _extended(which: np.ndarray, start: np.ndarray, counts: np.ndarray, symbols: int) -> Extensions:
        owner = np.repeat(np.arange(len(start)), counts)
        at = np.repeat(start - np.cumsum(counts) + counts, counts) + np.arange(len(owner))
        key, often = np.unique(owner * symbols + which[at], return_counts=True)
        parent, symbol = key // symbols, key % symbols
        so_far = np.cumsum(often) - often
        smaller = so_far - (np.cumsum(counts) - counts)[parent]
        return Extensions(parent, symbol, often, smaller).chosen(symbol > 0)

    def left(self, p: Phrases) -> Extensions:
        return self._extended(self.forward, p.rows, p.counts, len(self.first))

    def right(self, p: Phrases) -> Extensions:
        return self._extended(self.backward, p.back, p.counts, len(self.first))

    def to_left(self, p: Phrases, e: Extensions) -> Phrases:
        """The phrases of ``e = left(p)``, or of some of it, with their intervals."""
        rows = self.first[e.symbol] + self._before(self.forward, e.symbol, p.rows[e.parent])
        words = np.concatenate([e.symbol[:, None], p.words[e.parent]], axis=1)
        return Phrases(words, rows, p.back[e.parent] + e.smaller, e.counts)

    def to_right(self, p: Phrases, e: Extensions) -> Phrases:
        back = self.first[e.symbol] + self._before(self.backward, e.symbol, p.back[e.parent])
        words = np.concatenate([p.words[e.parent], e.symbol[:, None]], axis=1)
        return Phrases(words, p.rows[e.parent] + e.smaller, back, e.counts)


def _packed(a: np.ndarray) -> bytes:
    """Numbers below 2^32 as compressed byte planes."""
    planes = a.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, n, words, forward, backward): the index of each shard of ``docs`` (lang, text) and its number of words.

    A null lang is ``und``; null texts are empty. A document is in one shard.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shards: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        held = 0

        def close() -> Iterator[pa.RecordBatch]:
            for lang, (numbers, parts) in open_shards.items():
                a = np.concatenate([*parts, np.zeros(1, np.uint32)])
                index = FmIndex.of(a)
                words = pa.array([list(numbers)[1:]], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
                columns = [pa.array([lang]), pa.array([int((a > 0).sum())], pa.int64()), words]
                columns += [pa.array([_packed(x)], pa.binary()) for x in (index.forward, index.backward)]
                yield pa.record_batch(columns, names=["lang", "n", "words", "forward", "backward"])
            open_shards.clear()

        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                tokens = tokens_of(text)
                if lang not in open_shards:
                    open_shards[lang] = _Numbers({b".": 0}), []
                numbers, parts = open_shards[lang]
                parts.append(np.zeros(1, np.uint32))
                parts.append(np.fromiter(map(numbers.__getitem__, tokens), dtype=np.uint32, count=len(tokens)))
                held += len(tokens)
                if held >= shard_words:
                    yield from close()
                    held = 0
        yield from close()

    slim = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return map_arrow(slim, work, "lang string, n long, words array<string>, forward binary, backward binary")


def _rotated(h: Column, bits: int) -> Column:
    return F.shiftleft(h, bits).bitwiseOR(F.shiftrightunsigned(h, 64 - bits))


def _marks(pairs: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the hashes of ``pairs`` (lang, phrase): ``bits`` bits, a power of two, in words of 64."""
    part = F.split("phrase", " ")
    h = _rotated(F.xxhash64(part[0]), 17).bitwiseXOR(F.xxhash64(part[1])).bitwiseXOR(_rotated(F.xxhash64("lang"), 31))
    at = h.bitwiseAND(F.lit(bits - 1).cast("long"))
    bit = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    set_bits = pairs.select(at.alias("at")).select(F.shiftright("at", 6).alias("slot"), bit.alias("bit"))
    found = set_bits.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()  # bits / 64 rows at most
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _marked(marks: np.ndarray, lang: np.uint64, h: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether the pair of words ``first`` and ``second``, whose hashes are in ``h``, has a mark."""
    key = _turned(h[first - 1], 17) ^ h[second - 1] ^ _turned(lang, 31)
    at = key & np.uint64(64 * len(marks) - 1)
    return (marks[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    return h << np.uint64(bits) | h >> np.uint64(64 - bits)


def _hash(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words], dtype=np.uint64)


def _counted(index: DataFrame, marks: np.ndarray | None) -> DataFrame:
    """(lang, phrase, f) of each shard: words and pairs, or if there are ``marks`` the triples made of marked pairs."""
    sent = index.sparkSession.sparkContext.broadcast(marks)  # of a fixed size

    def out(lang: str, words: pa.Array, columns: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(counts), _ROWS):
            parts = [words.take(pa.array(c[at : at + _ROWS] - 1)) for c in columns]
            phrase = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
            f = pa.array(counts[at : at + _ROWS])
            yield pa.record_batch([pa.array([lang] * len(f), pa.string()), phrase, f], names=["lang", "phrase", "f"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lang = batch.column(0)[row].as_py()
                words = batch.column(1)[row].values
                index = FmIndex(*(_unpacked(batch.column(c)[row].as_py()) for c in (2, 3)))
                singles = index.singles()
                pairs = index.left(singles)
                if sent.value is None:
                    yield from out(lang, words, [singles.words[:, 0]], singles.counts)
                    yield from out(lang, words, [pairs.symbol, pairs.parent + 1], pairs.counts)
                    continue
                h, own = _hash(words.to_pylist()), _hash([lang])[0]
                some = pairs.chosen(_marked(sent.value, own, h, pairs.symbol, pairs.parent + 1))
                held = index.to_left(singles, some)
                triples = index.right(held)
                x, y, z = held.words[triples.parent, 0], held.words[triples.parent, 1], triples.symbol
                keep = _marked(sent.value, own, h, y, z)
                yield from out(lang, words, [x[keep], y[keep], z[keep]], triples.counts[keep])

    return map_arrow(index.select("lang", "words", "forward", "backward"), work, "lang string, phrase string, f long")


def _summed(counts: DataFrame, least: int) -> DataFrame:
    """Counts over all shards, from ``least`` on. A shard has a phrase once, so rows need no sum before the shuffle."""
    total = counts.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return total.where(F.col("f") >= least)


def _score(a: str, part: str, rest: str) -> Column:
    """floor(1000000 a a / (part rest)), exact."""
    x, y, z = (f"CAST({c} AS DECIMAL(15,0))" for c in (a, part, rest))
    return F.expr(f"CAST((CAST(1000000 AS DECIMAL(7,0)) * {x} * {x}) DIV ({y} * {z}) AS BIGINT)")


def collocations(
    docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000, shard_words: int = SHARD_WORDS, marks: int = MARKS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to ``DEPTH`` words of each language of ``docs``.

    A phrase occurs ``a >= least`` times, of ``n`` words in its language. Cut in two, its parts occur ``l`` and ``r``
    times; of all cuts the one with the lowest ``score`` = floor(1000000 a a / (l r)) counts, the first if they tie. A
    phrase goes if a longer one that holds it occurs in ``share`` of 100 of its cases or more. ``rank`` is by score and
    ``a``, the highest first, then by the phrase in the order of UTF-8 bytes; ``top`` phrases stay.

    ``docs`` has the columns lang (null: ``und``) and text (null: empty); words are lower-cased in A-Z, and no phrase
    goes beyond a mark or line end. ``shard_words`` and ``marks`` change the work, not the result. Repeated rows count again, further columns are left out, an empty table gives an
    empty result.
    """
    index = stored(shards(docs, shard_words))
    common = stored(_summed(_counted(index, None), least))
    gaps = F.length("phrase") - F.length(F.replace("phrase", F.lit(" ")))
    singles, pairs = common.where(gaps == 0), common.where(gaps == 1)
    triples = stored(_summed(_counted(index, _marks(pairs, marks)), least))

    def f(name: str, of: DataFrame) -> DataFrame:
        return of.select("lang", F.col("phrase").alias(name), F.col("f").alias(f"f_{name}"))

    word = F.split("phrase", " ")
    two = pairs.select("lang", "phrase", F.col("f").alias("a"), word[0].alias("x"), word[1].alias("y"))
    two = two.join(f("x", singles), ["lang", "x"]).join(f("y", singles), ["lang", "y"])
    two = two.select("lang", "phrase", "a", F.col("f_x").alias("l"), F.col("f_y").alias("r"), _score("a", "f_x", "f_y").alias("score"))

    xy, yz = F.concat_ws(" ", word[0], word[1]), F.concat_ws(" ", word[1], word[2])
    three = triples.select("lang", "phrase", F.col("f").alias("a"), word[0].alias("x"), yz.alias("yz"), xy.alias("xy"), word[2].alias("z"))
    for name, of in (("x", singles), ("yz", pairs), ("xy", pairs), ("z", singles)):
        three = three.join(f(name, of), ["lang", name])
    cuts = F.array(
        *(
            F.struct(_score("a", f"f_{p}", f"f_{q}").alias("score"), F.lit(k).alias("k"), F.col(f"f_{p}").alias("l"), F.col(f"f_{q}").alias("r"))
            for k, (p, q) in enumerate((("x", "yz"), ("xy", "z")), 1)
        )
    )
    three = three.select("lang", "phrase", "a", F.array_min(cuts).alias("c"), "xy", "yz")
    holders = three.select("lang", F.explode(F.array("xy", "yz")).alias("phrase"), "a")
    holders = holders.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    gone = F.coalesce(100 * F.col("longer") >= share * F.col("a"), F.lit(False))
    two = two.join(holders, ["lang", "phrase"], "left").where(~gone).drop("longer")
    found = two.unionByName(three.select("lang", "phrase", "a", "c.l", "c.r", "c.score"))
    return _best(found, index.groupBy("lang").agg(F.sum("n").alias("n")), top)


def _best(found: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = found.withColumn("part", part)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    first = first.where(F.col("rank") <= top).drop("part", "rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    out = ranked.where(F.col("rank") <= top).join(sizes, "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE_SQL = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    grams AS (
        SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
    ),
    counts AS (
        SELECT lang, g AS phrase, len(string_split(g, ' ')) AS k, count(*)::HUGEINT AS f
        FROM (
            SELECT lang, w[i] AS g FROM grams
            UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] FROM grams WHERE i + 1 <= len(w)
            UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM grams WHERE i + 2 <= len(w)
        )
        GROUP BY lang, g
    ),
    sizes AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS p FROM counts WHERE k >= 2 AND f >= 10),
    cuts AS (
        SELECT lang, phrase, k, a, cut,
               array_to_string(p[1:cut], ' ') AS x, array_to_string(p[cut + 1:k], ' ') AS y
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)
    ),
    scored AS (
        SELECT c.lang, c.phrase, c.k, a, cut, x.f AS l, y.f AS r, (1000000 * a * a) // (x.f * y.f) AS score
        FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.x JOIN counts y ON y.lang = c.lang AND y.phrase = c.y
    ),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    longer AS (
        SELECT lang, sub AS phrase, max(a) AS most
        FROM (
            SELECT lang, a, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS sub FROM candidates WHERE k = 3
        )
        GROUP BY lang, sub
    ),
    kept AS (
        SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase)
        WHERE NOT coalesce(k = 2 AND 100 * most >= 50 * a, false)
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
           CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
           CAST(score AS BIGINT) AS score
    FROM kept JOIN sizes USING (lang)
    QUALIFY rank <= 2000
"""
