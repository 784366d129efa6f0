"""Language identification by Bayesian evidence fusion.

The posterior of a page's language multiplies the likelihood of its text, the likelihood of the language that its markup
declares, and a prior of its host. The text model counts byte trigrams of all labelled documents in hashed slots. How far
a declaration is to be trusted, and which languages a host has, is learnt from the pages themselves: sums of the text's
own posteriors, grouped by declaration and by host. A host's prior is smoothed by its domain's, that by the address
suffix's, and that by all pages'; what a page itself added is taken off before its own prior is formed.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathproof.llm.common import map_arrow, stored, text_key

#: Hashed trigram slots, and the most languages that are told apart (the most frequent ones).
SLOTS, MOST_LANGUAGES = 1 << 18, 64
#: Each letter lies in three trigrams, which therefore count for a third.
TEMPER = 1 / 3
#: Pages that a level of the hierarchy is worth for the level below.
LEVEL_WEIGHT = 5.0
#: Pages that the belief in declarations is worth, and the belief.
DECLARED_WEIGHT, DECLARED_TRUST = 20.0, 0.8
#: Accepted: at least this probability, and a trigram mean not below the language's median by more than both this and so
#: many deviations.
LEAST_PROBABILITY, ODD_BY, ODD_DEVIATIONS = 0.5, 4.0, 12.0
#: Means of texts of fewer trigrams deviate more, by the root of their number; languages of fewer documents have no bar.
STEADY, LEAST_DOCUMENTS = 100, 20

#: Address suffixes of countries with one main written language; fixed values.
SUFFIX_LANGUAGE = {
    "at": "de", "br": "pt", "cn": "zh", "cz": "cs", "de": "de", "dk": "da", "es": "es", "fi": "fi", "fr": "fr",
    "gr": "el", "hu": "hu", "ie": "en", "it": "it", "jp": "ja", "kr": "ko", "mx": "es", "nl": "nl", "no": "no",
    "pl": "pl", "pt": "pt", "ro": "ro", "ru": "ru", "se": "sv", "tr": "tr", "ua": "uk", "uk": "en", "us": "en",
}

_NOT_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()
_HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_DECLARED = re.compile(r"<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)


def visible_text(page: str) -> str:
    return html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page)))


def slots(text: str | None) -> np.ndarray:
    """Slots of the byte trigrams of a text, letters lower-cased, all other ASCII as blanks; blanks alone give none."""
    octets = np.frombuffer((" " + (text or "").lower() + " ").encode().translate(_NOT_LETTERS), dtype=np.uint8)
    octets = octets[np.concatenate([[True], (octets[1:] != 32) | (octets[:-1] != 32)])].astype(np.uint32)
    if len(octets) < 3:
        return np.empty(0, dtype=np.uint32)
    code = octets[:-2] << 16 | octets[1:-1] << 8 | octets[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - 18)


@dataclass(frozen=True)
class Model:
    """Log-probabilities of slots by language; trigrams, and median and deviation of the documents' means, of each."""

    languages: list[str]
    table: np.ndarray
    totals: np.ndarray
    bars: np.ndarray

    def likelihood(self, text: str | None) -> tuple[np.ndarray, int]:
        """Log-likelihood of the text by language, and its number of trigrams."""
        found = slots(text)
        total = np.zeros(len(self.languages))
        for at in range(0, len(found), 1 << 20):
            total += self.table[found[at : at + (1 << 20)]].sum(axis=0, dtype=np.float64)
        return total, len(found)

    def mean_without_own(self, text: str | None, which: int) -> float:
        """Mean of a text's trigrams in the language that its own ones were counted for, as if they had not been."""
        slot, n = np.unique(slots(text), return_counts=True)
        counts = np.exp(self.table[slot].astype(np.float64)) * (self.totals + 1) - 0.501
        counts[:, which] -= n
        seen = (counts > 0.5).any(axis=1)
        share = np.maximum(counts[:, which], 0) + 0.5 * seen + 1e-3
        return float((n * np.log(share / max(self.totals[which] - n.sum() + 1, 1))).sum() / n.sum())

    def odd(self, means: np.ndarray, n: int) -> bool:
        """Whether a text of ``n`` trigrams with these means by language is unlike the documents of the likeliest one."""
        if not n or not len(means):
            return True
        median, deviation = self.bars[int(means.argmax())]
        return bool(median - means.max() > max(ODD_BY, ODD_DEVIATIONS * deviation) * _spread(n))


def _spread(n: np.ndarray | int) -> np.ndarray | float:
    return np.sqrt(1 + STEADY / n)


def train(docs: DataFrame) -> Model:
    """From all ``docs`` (text, lang) with a language; without any, a model that knows no language."""
    named = docs.where(F.col("lang").isNotNull()).select("lang", "text")
    top = named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    languages = sorted(r["lang"] for r in top)
    if not languages:
        return Model([], np.zeros((SLOTS, 0), dtype=np.float32), np.zeros(0), np.zeros((0, 2)))
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), SLOTS), dtype=np.int64)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name in place:
                    counts[place[name]] += np.bincount(slots(text), minlength=SLOTS)
        which, slot = np.nonzero(counts)
        columns = [pa.array(which), pa.array(slot), pa.array(counts[which, slot])]
        yield pa.record_batch(columns, names=["which", "slot", "n"])

    summed = map_arrow(named, count, "which long, slot long, n long").groupBy("which", "slot").agg(F.sum("n").alias("n"))
    found = summed.toArrow()  # bounded: a row for each language and slot at most, as columns and not as rows of Python
    counts = np.zeros((SLOTS, len(languages)))
    counts[found["slot"].to_numpy(), found["which"].to_numpy()] = found["n"].to_numpy()
    share = (counts + 0.5 * (counts.sum(axis=1, keepdims=True) > 0) + 1e-3) / (counts.sum(axis=0) + 1)
    table = np.log(share).astype(np.float32)
    model = Model(languages, table, counts.sum(axis=0), np.zeros((len(languages), 2)))
    return Model(languages, table, model.totals, _bars(named, model))


def _bars(named: DataFrame, model: Model) -> np.ndarray:
    """(median, deviation) of the means of each language's documents, less what each of them added to the counts.

    The deviation is the median one, of a text of many trigrams. A few odd documents move neither, nor does the number
    of documents. Languages of fewer than ``LEAST_DOCUMENTS`` have an endless deviation.
    """
    sent = named.sparkSession.sparkContext.broadcast(model)  # of no use once the means are stored
    place = {name: i for i, name in enumerate(model.languages)}

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = len(slots(text))
                if n and name in place:
                    rows.append((place[name], sent.value.mean_without_own(text, place[name]), float(_spread(n))))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            kinds = (pa.int64(), pa.float64(), pa.float64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["which", "mean", "spread"])

    means = stored(map_arrow(named, mean, "which long, mean double, spread double"))
    sent.destroy()
    middle = means.groupBy("which").agg(F.percentile_approx("mean", 0.5).alias("median"), F.count("*").alias("n"))
    off = F.abs(F.col("mean") - F.col("median")) / F.col("spread")
    both = means.join(F.broadcast(middle), "which").groupBy("which", "median", "n")
    bars = np.tile([0.0, math.inf], (len(model.languages), 1))
    for r in both.agg(F.percentile_approx(off, 0.5).alias("off")).collect():  # bounded by MOST_LANGUAGES
        if r["n"] >= LEAST_DOCUMENTS:
            bars[r["which"]] = r["median"], 1.4826 * r["off"]
    return bars


def page_evidence(pages: DataFrame, model: Model) -> DataFrame:
    """(id, declared, suffix, domain, host, odd, n, p0 ...) of ``pages`` (page_id, url, html)."""

    def parts(url: str | None, page: str | None) -> tuple[str | None, str | None, str | None, str | None, str]:
        declared = _DECLARED.search(page or "")
        found = _HOST.match(url or "")
        labels = found[1].lower().rstrip(".").split(".") if found else []
        host = ".".join(labels) or None
        return (
            declared[1].lower() if declared else None,
            labels[-1] if labels else None,
            ".".join(labels[-2:]) or None,
            host,
            visible_text(page or ""),
        )

    return _evidence(
        pages.select(F.col("page_id").cast("long").alias("id"), "url", "html"),
        lambda batch: [parts(u, h) for u, h in zip(*(c.to_pylist() for c in batch.columns[1:3]), strict=True)],
        model,
    )


def document_evidence(docs: DataFrame, model: Model) -> DataFrame:
    """The same of ``docs`` (doc_id, text, source), whose source takes the host's place, with (text_key).

    If ``docs`` have a lang, they are those that the model was trained on, and are odd without their own counts.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        "text",
        F.col("source").cast("string").alias("source"),
        *(["lang"] if "lang" in docs.columns else []),
    )
    return _evidence(
        slim.withColumn("text_key", text_key(F.col("text"))),
        lambda batch: [
            (None, None, None, source, text or "")
            for text, source in zip(*(c.to_pylist() for c in batch.columns[1:3]), strict=True)
        ],
        model,
    )


def _evidence(rows: DataFrame, parts, model: Model) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(model)  # bounded by SLOTS and MOST_LANGUAGES
    keep = [c for c in rows.columns if c in ("id", "text_key")]
    names = ["declared", "suffix", "domain", "host"]
    chances = [f"l{i}" for i in range(len(model.languages))]
    place = {name: i for i, name in enumerate(model.languages)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = parts(batch)
            scored = [sent.value.likelihood(f[4]) for f in found]
            totals = np.array([s[0] for s in scored]).reshape(len(found), len(chances)) * TEMPER
            n = np.array([s[1] for s in scored], dtype=np.int64)
            means = totals / TEMPER / np.maximum(n, 1)[:, None]
            at = batch.schema.get_field_index("lang")
            for i, name in enumerate(batch.column(at).to_pylist() if at >= 0 else []):
                if n[i] and name in place:
                    means[i, place[name]] = sent.value.mean_without_own(found[i][4], place[name])
            odd = [sent.value.odd(m, k) for m, k in zip(means, n, strict=True)]
            totals = np.where(n[:, None] > 0, totals - totals.max(axis=1, initial=-np.inf, keepdims=True), 0)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            columns += [pa.array([f[i] for f in found], pa.string()) for i in range(len(names))]
            columns += [pa.array(odd, pa.bool_()), pa.array(n)]
            columns += [pa.array(np.maximum(totals[:, i], -700.0)) for i in range(len(chances))]
            yield pa.record_batch(columns, names=[*keep, *names, "odd", "n", *chances])

    kinds = {"id": "long", "text_key": "string"}
    schema = [f"{c} {kinds[c]}" for c in keep] + [f"{c} string" for c in names] + ["odd boolean", "n long"]
    return map_arrow(rows, work, ", ".join([*schema, *(f"{c} double" for c in chances)]))


def _with_chances(rows: DataFrame, logs: dict[str, Column]) -> DataFrame:
    """``rows`` with a chance for each of the ``logs``, under its name: their powers divided by the sum of them.

    Each step names its columns for the next one. Stated in one, every chance would repeat all logs, and those
    every number that they are made of: the plan would grow with the cube of the languages, in the driver's memory.
    """
    rows = rows.withColumns({f"__log_{c}": x for c, x in logs.items()})
    top = F.greatest(*(f"__log_{c}" for c in logs)) if len(logs) > 1 else F.col(f"__log_{next(iter(logs))}")
    rows = rows.withColumn("__top", top)
    rows = rows.withColumns({f"__power_{c}": F.exp(F.col(f"__log_{c}") - F.col("__top")) for c in logs})
    rows = rows.withColumn("__sum", reduce(Column.__add__, [F.col(f"__power_{c}") for c in logs]))
    rows = rows.withColumns({c: F.col(f"__power_{c}") / F.col("__sum") for c in logs})
    return rows.drop("__top", "__sum", *(f"__{kind}_{c}" for c in logs for kind in ("log", "power")))


def fuse(evidence: DataFrame, languages: list[str]) -> DataFrame:
    """Adds text_lang, lang, probability and accepted to the rows of ``evidence``.

    Rows without letters have no text likelihood; the other evidence decides. A missing declaration, host, domain or
    suffix says nothing: its level passes on the level above. Equal probabilities go to the first language by name.
    ``accepted`` is false for rows without letters, for rows whose trigrams are unlike those of the likeliest language's
    labelled documents, and where no language has ``LEAST_PROBABILITY``. Without any language to choose from, nothing is told or accepted.
    """
    n = len(languages)
    if not n:
        nothing = {c: F.lit(None).cast(kind) for c, kind in (("text_lang", "string"), ("lang", "string"), ("probability", "double"))}
        unknown = evidence.withColumns(nothing | {"accepted": F.lit(False)})
        return unknown.select(
            *(c for c in ("id", "text_key") if c in evidence.columns), "host", "declared", *nothing, "accepted"
        )
    logs = [f"l{i}" for i in range(n)]
    own = [f"p{i}" for i in range(n)]
    rows = _with_chances(evidence, {c: F.col(x) for c, x in zip(own, logs, strict=True)})
    rows = rows.withColumns({c: F.when(F.col("n") > 0, F.col(c)).otherwise(F.lit(0.0)) for c in own})
    rows = stored(rows.withColumn("one", F.when(F.col("n") > 0, 1.0).otherwise(0.0)))

    def sums(frame: DataFrame, mark: str) -> list[Column]:
        return [F.sum(c).alias(f"{mark}{c}") for c in [*own, "one"]]

    hosts = stored(rows.where("host is not null").groupBy("host", "domain", "suffix").agg(*sums(rows, "host_")))
    up = [F.sum(f"host_{c}").alias(f"domain_{c}") for c in [*own, "one"]]
    domains = hosts.where("domain is not null").groupBy("domain", "suffix").agg(*up)
    up = [F.sum(f"domain_{c}").alias(f"suffix_{c}") for c in [*own, "one"]]
    suffixes = domains.where("suffix is not null").groupBy("suffix").agg(*up)
    whole = rows.agg(*sums(rows, "")).first()
    total = (whole["one"] or 0.0) + n
    general = [((whole[c] or 0.0) + 1) / total for c in own]
    # one row for each host, with all levels
    levels = hosts.join(domains.drop("suffix"), "domain", "left").join(suffixes, "suffix", "left")
    levels = levels.drop("domain", "suffix")
    joined = rows.join(levels, "host", "left")
    declared = rows.where("declared is not null").groupBy("declared").agg(*sums(rows, "declared_"))
    joined = joined.join(declared, "declared", "left")

    def less_own(column: str, level: str) -> Column:
        """A level's sum without the row's own part; nothing if the row has no such level."""
        left = F.greatest(F.col(f"{level}_{column}") - F.col(column), F.lit(0.0))
        return F.coalesce(left, F.lit(0.0))

    known = [s for s, name in SUFFIX_LANGUAGE.items() if name in languages]
    posterior = []
    for i, (language, chance) in enumerate(zip(languages, general, strict=True)):
        matches = F.col("suffix").isin([s for s in known if SUFFIX_LANGUAGE[s] == language]).cast("double")
        prior = F.when(F.col("suffix").isin(known), (chance + matches) / 2).otherwise(F.lit(chance))
        for level in ("suffix", "domain", "host"):
            prior = (less_own(f"p{i}", level) + LEVEL_WEIGHT * prior) / (less_own("one", level) + LEVEL_WEIGHT)
        trust = F.when(F.col("declared") == language, DECLARED_TRUST).otherwise((1 - DECLARED_TRUST) / n)
        said = (less_own(f"p{i}", "declared") + DECLARED_WEIGHT * trust) / ((whole[f"p{i}"] or 0.0) + DECLARED_WEIGHT)
        said = F.when(F.col("declared").isNull(), 1.0).otherwise(said)
        posterior.append(F.col(f"l{i}") + F.log(prior) + F.log(said))
    finals = [f"f{i}" for i in range(n)]
    final = _with_chances(joined, dict(zip(finals, posterior, strict=True)))

    def best(columns: list[str]) -> Column:
        top = F.greatest(*columns) if n > 1 else F.col(columns[0])
        return F.coalesce(*(F.when(F.col(c) == top, F.lit(name)) for c, name in zip(columns, languages, strict=True)))

    final = final.withColumn("__top", F.greatest(*finals) if n > 1 else F.col("f0"))
    top = F.col("__top")
    return final.select(
        *(c for c in ("id", "text_key") if c in rows.columns),
        "host",
        "declared",
        F.when(F.col("n") > 0, best(own)).alias("text_lang"),
        best(finals).alias("lang"),
        top.alias("probability"),
        (~F.col("odd") & (top >= LEAST_PROBABILITY)).alias("accepted"),
    )


def identify_pages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, host, declared, text_lang, lang, probability, accepted) of every row of ``pages`` (page_id, url, html).

    Null addresses and markup are pages without that evidence; null ids and repeated rows are judged like others;
    further columns are left out. The text model comes from ``docs`` (text, lang).
    """
    model = train(docs)
    return fuse(page_evidence(pages, model), model.languages).withColumnRenamed("id", "page_id")


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source, any others) whose language is accepted, all columns kept."""
    if docs.where(F.col("lang").isNotNull()).limit(1).count() == 0:
        return docs
    model = train(docs)
    found = fuse(document_evidence(docs, model), model.languages)
    gone = stored(
        found.where(~F.col("accepted")).select(F.col("id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (text_key(F.col("text")) == F.col("__key"))
    return docs.join(gone, same, "left_anti")


def identify_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, host, declared, text_lang, lang, probability, accepted) of every row of ``docs`` (doc_id, text, source)."""
    found = fuse(document_evidence(docs, model), model.languages)
    return found.drop("text_key").withColumnRenamed("id", "doc_id")


def op7_langid(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Every page and every document, with a page_id or a doc_id; a document's source is its host."""
    model = train(docs)
    found = fuse(page_evidence(pages, model), model.languages).withColumnRenamed("id", "page_id")
    return found.unionByName(identify_documents(docs, model), allowMissingColumns=True)
