"""Language ID by Bayesian evidence fusion (operator 1).

The posterior of a document's language combines

* the text: hashed byte trigrams under one smoothed model per language, and one model of no
  language (single bytes), over the whole text, tempered because neighbouring trigrams depend
  on each other;
* the declared language (a markup `lang` attribute or a column), with a reliability estimated
  from the corpus by grouped counts;
* the address suffix (a country domain or a language code as the first path part), likewise;
* the host's prior, smoothed hierarchically: host over suffix over the whole corpus, from
  grouped sums of the text posteriors.

Models are fitted on at most TRAIN_ROWS labelled documents per language (those with the smallest
hashes of their ids); all counts for reliabilities and priors cover all documents.

Defined results: null or blank texts, and texts that the model of no language explains best, are
`und` and rejected; a text of one or two bytes is decided by what is declared and the prior; declared languages that no model knows count as not declared; a null host or
address is its own group; rows are judged one by one, repeated or not; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from skyledger.llm.common import passing, register, staged, table
from skyledger.llm.kernels import LOWER, released, text_slices

TRAIN_ROWS = 500                 # labelled documents per language that the models are fitted on
TABLE = 1 << 15                  # hashed trigrams
TEMPER = 0.25                    # weight of one trigram's evidence
MOST_EVIDENCE = 40.0             # nats by which a text can favour one language over another
MAX_LANGUAGES = 256              # labels that get a model: those with the most documents
MAX_BROADCAST = 16 << 20         # bytes of host priors that every task is given; more are dealt with salt
SALT = 16
HOST_WEIGHT = 20.0               # documents that a host's parent counts for
ACCEPT = 0.5                     # least posterior
UNKNOWN = "und"


class Models:
    """Log probabilities of hashed trigrams, one row per language and a last one for no language."""

    def __init__(self, languages: list[str], table_: np.ndarray):
        self.languages, self.table = languages, table_


def trigrams(data: np.ndarray) -> np.ndarray:
    """The hashed trigram that starts at each byte (letters and white space as they are; digits and marks as one class)."""
    x = _CLASS[data].astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64)
    return (((x[:-2] * np.uint32(0x9E3779B1) + x[1:-1]) * np.uint32(0x85EBCA6B) + x[2:]) * np.uint32(0xC2B2AE35) >> np.uint32(17)).astype(np.int64)


_CLASS = LOWER.copy()
_CLASS[:0x41] = 0x20
_CLASS[0x5B:0x61] = 0x20
_CLASS[0x7B:0x80] = 0x20


def _inside(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First trigram of each text and the end of its trigrams."""
    return offsets[:-1], np.maximum(offsets[1:] - 2, offsets[:-1])


def fit(docs: DataFrame, text_col: str, label_col: str, id_col: str, train_rows: int = TRAIN_ROWS) -> Models:
    """Models from a bounded sample: `train_rows` documents per label at most, of the MAX_LANGUAGES labels with the most documents."""
    counts = docs.filter(f"`{label_col}` IS NOT NULL").groupBy(F.col(label_col).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    admitted = [r["label"] for r in counts.orderBy(F.desc("n"), "label").limit(MAX_LANGUAGES).collect()]
    labelled = docs.filter(F.col(label_col).cast("string").isin(admitted) & (F.length(text_col) > 0)).select(
        F.col(label_col).cast("string").alias("label"), F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text"))
    place = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    last = labelled.select("label", "h").withColumn("place", place).filter(F.col("place") <= train_rows).groupBy("label").agg(F.max("h").alias("h"))
    chosen = F.lit(False)
    for r in last.toLocalIterator():                         # one row per language
        chosen = chosen | ((F.col("label") == r["label"]) & (F.col("h") <= r["h"]))
    sample = labelled.filter(chosen).select("label", "text")

    @released
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for row, _, data, offsets in text_slices(batch.column(1)):
                grams = trigrams(data)
                for i, (s, e) in enumerate(zip(*_inside(offsets), strict=True)):
                    if e > s and labels[row + i] is not None:
                        totals.setdefault(labels[row + i], np.zeros(TABLE)).__iadd__(np.bincount(grams[s:e], minlength=TABLE))
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals)), pa.array([v.tolist() for v in totals.values()], pa.list_(pa.float64()))], ["label", "counts"])

    languages: dict[str, np.ndarray] = {}
    for r in sample.mapInArrow(count, "label string, counts array<double>").toLocalIterator():
        languages[r["label"]] = languages.get(r["label"], 0) + np.array(r["counts"])
    names = sorted(x for x in languages if x != UNKNOWN)
    rows = [np.log((languages[x] + 0.2) / (languages[x].sum() + 0.2 * TABLE)) for x in names]
    rows.append(np.full(TABLE, -np.log(TABLE / 8)))          # no language: an even draw among an eighth of all trigrams
    return Models(names, np.stack(rows).astype(np.float32).T.copy())


def text_evidence(docs: DataFrame, models: Models, text_col: str, keep: list) -> DataFrame:
    """`keep` and `evidence`: the tempered log likelihoods (last: no language), even (zeros) for a text of one or two bytes, which has no
    trigram, and null for a null or blank one."""
    shared = docs.sparkSession.sparkContext.broadcast(models.table)      # TABLE rows of one number per language
    selected = docs.select(*keep, F.col(text_col).alias("__text"))
    names = selected.columns[:-1]

    @released
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p = shared.value
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(len(names)), 1 << 20):
                grams = trigrams(data)
                starts, ends = _inside(offsets)
                sums = np.zeros((len(starts), log_p.shape[1]))
                for k in range(log_p.shape[1]):
                    total = np.r_[0.0, np.cumsum(log_p[:, k][grams], dtype=np.float64)]
                    sums[:, k] = total[np.minimum(ends, len(total) - 1)] - total[np.minimum(starts, len(total) - 1)]
                some = ends > starts
                for i in np.flatnonzero(~some & (offsets[1:] > offsets[:-1])).tolist():
                    some[i] = bool(data[offsets[i]:offsets[i + 1]].tobytes().strip())      # decided by declaration and prior
                sums[ends <= starts] = 0.0
                ratio = np.clip(TEMPER * (sums - sums.max(axis=1, keepdims=True)), -MOST_EVIDENCE, 0)
                evidence = pa.array([r.tolist() if ok else None for r, ok in zip(ratio, some, strict=True)], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(row, end - row) for i in range(len(names))] + [evidence], [*names, "evidence"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in selected.schema if f.name != "__text")
    return selected.mapInArrow(run, f"{schema}, evidence array<double>")


def _softmax(scores):
    """Posterior from an array column of logarithms."""
    shifted = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def _mean_by(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Sums of the text posteriors by group: one partial aggregate per group and language."""
    return df.groupBy(*keys).agg(F.array(*[F.sum(F.col("p")[k]) for k in range(n)]).alias("sums"), F.count(F.lit(1)).cast("double").alias("n"))


def _smoothed(sums, total, parent, weight: float):
    return F.transform(F.zip_with(sums, parent, lambda s, q: s + weight * q), lambda x: x / (total + weight))


def identify(docs: DataFrame, models: Models, *, text_col: str, keep: list[str], declared: object = None, host: object = None,
             suffix: object = None) -> DataFrame:
    """`keep`, language, confidence, accepted for every row. `declared`, `host` and `suffix` are columns or None."""
    none = F.lit(None).cast("string")
    names = models.languages
    known = F.array(*[F.lit(x) for x in names]) if names else F.array().cast("array<string>")
    columns = [F.col(c) for c in keep] + [(none if c is None else c).alias(n) for n, c in (("__declared", declared), ("__host", host), ("__suffix", suffix))]
    scored = staged(text_evidence(docs, models, text_col, columns), "language-evidence")
    even = F.array(*[F.lit(1.0 / (len(names) + 1))] * (len(names) + 1))
    scored = scored.withColumn("p", F.when(F.col("evidence").isNotNull(), _softmax(F.col("evidence"))).otherwise(even))
    seen = scored.filter("evidence IS NOT NULL AND array_min(evidence) < 0")     # texts that say something
    size = len(names) + 1
    corpus = _mean_by(seen, [], size).select(F.coalesce(_smoothed(F.col("sums"), F.col("n"), even, 1.0), even).alias("q0"))
    by_suffix = _mean_by(seen, ["__suffix"], size).withColumn("q0", corpus.scalar()).select(
        F.col("__suffix").alias("s"), _smoothed(F.col("sums"), F.col("n"), F.col("q0"), HOST_WEIGHT).alias("q1"))
    by_host = _mean_by(seen, ["__host", "__suffix"], size)
    by_host = by_host.join(by_suffix, by_host["__suffix"].eqNullSafe(by_suffix["s"])).select(
        F.col("__host").alias("h"), "s", _smoothed(F.col("sums"), F.col("n"), F.col("q1"), HOST_WEIGHT).alias("prior"))
    # reliability of a declaration: how often text and declaration agree, over all documents that have both
    agreement = F.get("p", (F.array_position(known, F.col("__declared")) - 1).cast("int"))
    declared_known = F.array_contains(known, F.col("__declared"))
    of_suffix = F.array_contains(known, F.col("__suffix"))
    agreed = F.get("p", (F.array_position(known, F.col("__suffix")) - 1).cast("int"))
    trust = seen.agg(F.struct(
        *[F.least(F.lit(0.99), F.greatest(F.lit(1.0 / size), (F.sum(F.when(ok, a)) + 1) / (F.sum(F.when(ok, 1.0)) + 2))).alias(n)
          for n, ok, a in (("declared_trust", declared_known, agreement), ("suffix_trust", of_suffix, agreed))]).alias("t"))
    fused = _with_priors(scored, staged(by_host, "language-priors"), size)
    fused = fused.withColumn("q0", corpus.scalar()).withColumn("trust", trust.scalar())

    def vote(column: str, ok, reliability: str):
        each = [F.when(F.lit(x) == F.col(column), F.log(F.col(reliability))).otherwise(F.log((1 - F.col(reliability)) / (size - 1))) for x in names]
        each.append(F.log((1 - F.col(reliability)) / (size - 1)))
        return F.when(F.coalesce(ok, F.lit(False)), F.array(*each)).otherwise(F.array(*[F.lit(0.0)] * size))

    prior = F.coalesce(F.col("prior"), F.col("q0"))
    total = F.transform(prior, lambda q: F.log(q))
    for part in (F.col("evidence"), vote("__declared", declared_known, "trust.declared_trust"), vote("__suffix", of_suffix, "trust.suffix_trust")):
        total = F.zip_with(total, part, lambda a, b: a + b)
    posterior = fused.withColumn("posterior", F.when(F.col("evidence").isNotNull(), _softmax(total)))
    best = F.array_max("posterior")
    label = F.get(F.concat(known, F.array(F.lit(UNKNOWN))), (F.array_position("posterior", best) - 1).cast("int"))
    result = posterior.select(*keep, F.coalesce(label, F.lit(UNKNOWN)).alias("language"), F.round(F.coalesce(best, F.lit(0.0)), 6).alias("confidence"))
    return result.withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("confidence") >= ACCEPT))


def _with_priors(scored: DataFrame, priors: DataFrame, size: int) -> DataFrame:
    """Each row with the prior of its host and suffix. Rows stay where they are while the priors are small enough to be sent to all; else the
    priors are repeated for SALT parts of each host, so that no host's rows meet in one task."""
    if priors.count() * (8 * size + 128) <= MAX_BROADCAST:
        return scored.join(F.broadcast(priors), scored["__host"].eqNullSafe(priors["h"]) & scored["__suffix"].eqNullSafe(priors["s"]), "left")
    dealt = scored.withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.lit(SALT)))
    many = priors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return dealt.join(many, dealt["__host"].eqNullSafe(many["h"]) & dealt["__suffix"].eqNullSafe(many["s"]) & (dealt["__part"] == many["part"]), "left").drop("__part", "part")


def address_parts(url) -> dict:
    """Host and suffix of an address column: the first path part if it is a two-letter code, else the host's last label."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    code = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+/([A-Za-z]{2})(?:[/?#\-_]|$)", 1))
    last = F.regexp_extract(host, r"\.([a-z]+)$", 1)
    return {"host": host, "suffix": F.when(code != "", code).otherwise(last)}


def markup_language(html):
    """The language that an html element declares, without its region."""
    return F.nullif(F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1)), F.lit(""))


def visible_text(html):
    """Markup, scripts and styles out; enough for trigrams."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")
    return bare


def identified_documents(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Documents: `lang` is the declaration, `source` the host; sources have no address suffix."""
    models = fit(docs, "text", "lang", "doc_id")
    return identify(docs, models, text_col="text", keep=keep, declared=F.col("lang"), host=F.col("source"))


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose language is accepted, as they are. A row is found again by its id and a hash of
    what the decision depends on."""
    key = F.xxhash64("text", "lang", "source")
    with passing(docs.sparkSession, "language"):
        judged = identified_documents(docs.withColumn("__key", key), ["doc_id", "__key"])
        rejected = staged(judged.filter(~F.col("accepted")).select(F.col("doc_id").alias("__id"), F.col("__key").alias("__rejected")).distinct(),
                          "language-rejected", lasting=True)
    return docs.join(rejected, docs["doc_id"].eqNullSafe(rejected["__id"]) & (key == rejected["__rejected"]), "left_anti")


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str):
    return identified_documents(table(spark, sf_dir, "documents"), ["doc_id"])


@register("language_id_pages")
def language_id_pages(spark: SparkSession, sf_dir: str):
    """Web pages: markup language, address suffix and host, with models fitted on the documents."""
    models = fit(table(spark, sf_dir, "documents"), "text", "lang", "doc_id")
    pages = table(spark, sf_dir, "pages")
    return identify(pages.withColumn("__visible", visible_text(F.col("html"))), models, text_col="__visible", keep=["page_id"],
                    declared=markup_language(F.col("html")), **address_parts(F.col("url")))
