"""I-Match fingerprints with several randomised lexicons, made of DataFrame operations alone.

The lexicon holds the terms whose document share lies within a band, that is, whose inverse document frequency is neither
small (words of the language) nor large (names, misspellings). It cannot outgrow (terms of a mean document) / (smallest
share), however many documents there are, which is why it may be broadcast. A document's terms that lie in the lexicon
are sorted, and random subsets of the lexicon each hash the terms they contain. A subset of a level holds one term in
``PER_LEVEL * 2 ** level``. A document uses the ``LEVELS`` levels from that on whose subsets hold one or two of its
terms each, so short and long texts alike have subsets that an edit leaves alone. Two documents are alike by the share of
subsets, out of those of common levels that hold a term of either, for which both hashes agree.

Each document also meets its successor in descending order of ids. The ids are cut into buckets of consecutive ids; the
first document of a bucket is sent to the bucket above, too, so one window per bucket gives every row its successor,
and the same partitioning serves the terms' aggregation and the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathproof.llm.common import text_key

#: Shares of documents between which a term is in the lexicon: inverse document frequencies of 2.3 to 6.9.
SHARES = (0.001, 0.1)
LEVELS, PER_LEVEL, HIGHEST_LEVEL = 3, 32, 20
#: With fewer lexicon terms the first terms of the text are taken in, whatever their frequency.
FEW_TERMS, FIRST_TERMS = 4, 8
#: Documents of a bucket, and the number of buckets from which on they hold more; a window spills what does not fit.
BUCKET_ROWS, MOST_BUCKETS = 512, 1 << 14
_STEP = 64
#: Spark's hash of an empty array is its seed.
_EMPTY = 42
_NULL_ID = -(1 << 63)


def terms(text: Column) -> Column:
    """64-bit hashes of the distinct lower-cased runs of letters and digits, in the order of their first place."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(F.array_distinct(words), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, n_docs: int, shares: tuple[float, float] = SHARES) -> DataFrame:
    """(term): hashes of the terms whose document share lies within the band; two documents at least."""
    counts = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return counts.where(F.col("n").between(max(2.0, shares[0] * n_docs), max(2.0, shares[1] * n_docs))).select("term")


def _with_fingerprint(df: DataFrame, found: Column, out: str) -> DataFrame:
    """Adds ``out``, the first level, and ``out`` + "_hashes", a short hash for each subset, empty if it has no term."""
    low = f"cast(least({HIGHEST_LEVEL}, greatest(0, floor(log2(greatest(1, size(found)) / {PER_LEVEL})))) as int)"

    def place(level: str) -> str:
        return f"shiftrightunsigned(h, 20 * (({level}) % 3)) & (shiftleft({PER_LEVEL}L, {level}) - 1)"

    members = f"filter(found, h -> ({place('l')}) < {PER_LEVEL})"
    subset = f"filter(s, h -> ({place(f'{out} + k')}) = j)"
    short = "lpad(hex(x & 4294967295L), 8, '0')"
    return (
        df.withColumn("found", F.sort_array(F.array_distinct(found)))
        .withColumn(out, F.expr(low))
        .withColumn("levels", F.expr(f"transform(sequence({out}, {out} + {LEVELS - 1}), l -> {members})"))
        .withColumn(
            "all",
            F.expr(f"flatten(transform(levels, (s, k) -> transform(sequence(0, {PER_LEVEL - 1}), j -> xxhash64({subset}))))"),
        )
        .withColumn(f"{out}_hashes", F.expr(f"transform(all, x -> if(x = {_EMPTY}L, '', {short}))"))
        .drop("found", "levels", "all")
    )


def _with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Adds ``out``, the likeness of two fingerprints; where no common subset holds a term, whether both are equal."""
    shift = F.col(b) - F.col(a)
    width = (F.lit(LEVELS) - F.least(F.abs(shift), F.lit(LEVELS))) * PER_LEVEL

    def common(name: str, skipped: Column) -> Column:
        first = F.least(F.greatest(skipped, F.lit(0)), F.lit(LEVELS)) * PER_LEVEL + 1
        return F.slice(f"{name}_hashes", first, width)

    equal = (F.col(a) == F.col(b)) & (F.col(f"{a}_hashes") == F.col(f"{b}_hashes"))
    return (
        df.withColumn("pairs", F.zip_with(common(a, shift), common(b, -shift), _held_and_same))
        .withColumn("held", F.size(F.filter("pairs", lambda x: x >= 1)))
        .withColumn("same", F.size(F.filter("pairs", lambda x: x == 2)))
        .withColumn(out, F.when(F.col("held") > 0, F.col("same") / F.col("held")).otherwise(equal.cast("double")))
        .drop("pairs", "held", "same")
    )


def _held_and_same(x: Column, y: Column) -> Column:
    """0: neither subset holds a term, 1: the hashes differ, 2: they agree."""
    return F.when((x == "") & (y == ""), 0).when(x == y, 2).otherwise(1)


def _below(bounds: list[int], value: Column) -> Column:
    """How many of the sorted ``bounds`` are less than ``value``; looks at a few of them only."""
    if not bounds:
        return F.lit(0)
    coarse = F.array(*(F.lit(b).cast("long") for b in bounds[_STEP - 1 :: _STEP])).cast("array<bigint>")
    steps = F.size(F.filter(coarse, lambda x: x < value))
    fine = F.slice(F.array(*(F.lit(b).cast("long") for b in bounds)), steps * _STEP + 1, F.lit(_STEP))
    return steps * _STEP + F.size(F.filter(fine, lambda x: x < value))


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` (doc_id, text) in buckets, each row with the next one's text, and the number of documents.

    Rows (bucket, place, doc_id, text, next_text, ghost): next in descending doc_id, null ids last, rows of one id by
    their texts' keys; the last is followed by the first. ``ghost`` rows end a bucket as a copy of the next one's first.
    """
    ident = F.coalesce(F.col("doc_id"), F.lit(_NULL_ID).cast("long"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = rows.count()
    buckets = max(1, min(MOST_BUCKETS, n // BUCKET_ROWS))
    cuts = [k / buckets for k in range(1, buckets)]
    found = rows.agg(F.percentile_approx(ident, cuts or [0.5], 100 * buckets), F.max(ident)).first()
    last = found[1]
    bounds = sorted(set(found[0] or []) - {last}) if cuts else []
    own = _below(bounds, F.col("ident"))

    def place(bucket: Column, ghost: bool, wrapped: bool) -> Column:
        return F.struct(bucket.alias("bucket"), F.lit(ghost).alias("ghost"), F.lit(wrapped).alias("wrapped"))

    places = F.array(
        place(own, False, False),
        F.when(_is_bound(bounds), place(own + 1, True, False)),
        F.when(F.col("ident") == F.lit(last), place(F.lit(0), True, True)),
    )
    placed = rows.withColumn("ident", ident).withColumn("p", F.explode(F.filter(places, lambda x: x.isNotNull())))
    placed = placed.select("doc_id", "text", "ident", "p.*")
    order = Window.partitionBy("bucket").orderBy("wrapped", F.desc("ident"), text_key(F.col("text")))
    placed = placed.withColumn("place", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))
    return placed.drop("ident", "wrapped"), n


def _is_bound(bounds: list[int]) -> Column:
    if not bounds:
        return F.lit(False)
    above = F.array(*(F.lit(b).cast("long") for b in bounds))
    at = _below(bounds, F.col("ident"))
    return F.coalesce(F.get(above, at) == F.col("ident"), F.lit(False))


def match_next(docs: DataFrame, shares: tuple[float, float] = SHARES) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text), of its edited text, and their likenesses.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many, or all, of the next
    document in descending doc_id; after the last comes the first. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (first level and the subsets' hashes, joined by points), near_edited and near_next (likeness to
    the edited text and to the next document, 0 to 1). A null text counts as empty; texts without any term have no
    hashes, are alike by 1 with each other and by 0 with all others. Repeated rows stay repeated, further columns are left
    out, an empty table gives an empty result.
    """
    rows, n = with_next(docs)
    band = F.broadcast(lexicon(docs, n, shares))
    text, size = F.col("text"), F.length("text")
    half = F.floor(size / 2).cast("int")
    # a ghost may lack a next text; none is needed
    edited = F.concat(F.substring(text, F.lit(1), size - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = rows.select(
        "bucket", "place", "doc_id", "ghost", size.cast("long").alias("n_chars"), "text", edited.alias("edited")
    )
    rows = rows.select(
        "bucket", "place",
        F.struct("doc_id", "ghost", "n_chars", F.sha2("edited", 256).alias("sha")).alias("doc"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("which"), terms(F.col("text")).alias("terms")),
                F.struct(F.lit(1).alias("which"), F.when(~F.col("ghost"), terms(F.col("edited"))).alias("terms")),
            )
        ).alias("v"),
    )
    each = rows.select("bucket", "place", "doc", F.col("v.which"), F.posexplode_outer("v.terms").alias("at", "term"))
    first = F.coalesce("at", F.lit(0)) == 0
    each = each.select("bucket", "place", F.when(first, F.col("doc")).alias("doc"), "which", "at", "term")
    each = each.join(band.withColumn("known", F.lit(True)), "term", "left").where(
        F.col("known") | F.col("at").isNull() | (F.col("at") < FIRST_TERMS)
    )
    gathered = each.groupBy("bucket", "place").agg(
        F.max("doc").alias("doc"),
        *(
            F.collect_list(F.when((F.col("which") == w) & condition, F.col("term"))).alias(f"{name}{w}")
            for w in (0, 1)
            for name, condition in (("known", F.col("known")), ("first", F.col("at") < FIRST_TERMS))
        ),
    )
    for w, name in ((0, "print"), (1, "edited_print")):
        few = F.size(f"known{w}") < FEW_TERMS
        chosen = F.when(few, F.concat(f"known{w}", f"first{w}")).otherwise(F.col(f"known{w}"))
        gathered = _with_fingerprint(gathered, chosen, name)
    order = Window.partitionBy("bucket").orderBy("place")
    prints = [f"{name}{part}" for name in ("print", "edited_print") for part in ("", "_hashes")]
    near = gathered.select("bucket", "place", "doc", *prints)
    for part in ("", "_hashes"):
        near = near.withColumn(f"next_print{part}", F.lead(f"print{part}").over(order))
    near = near.where(~F.col("doc.ghost"))
    near = _with_likeness(near, "print", "edited_print", "near_edited")
    near = _with_likeness(near, "print", "next_print", "near_next")
    return near.select(
        "doc.doc_id",
        "doc.n_chars",
        F.col("doc.sha").alias("edited_sha256"),
        *(
            F.concat_ws(".", F.col(a), F.array_join(f"{a}_hashes", ".")).alias(b)
            for a, b in (("print", "fingerprint"), ("edited_print", "edited_fingerprint"))
        ),
        "near_edited",
        "near_next",
    )


def op5_imatch(docs: DataFrame) -> DataFrame:
    return match_next(docs.select("doc_id", "text"))
