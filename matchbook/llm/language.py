"""Language of web pages by Bayesian fusion of evidence.

Three kinds of evidence are multiplied: how likely the text is in each language (letter trigrams), how likely
the declared markup language is, and how common each language is at the page's host. The host's shares are
smoothed towards those of its address suffix, and these towards those of all pages; all are grouped sums of
what text and markup alone say. How far a declaration can be trusted is estimated the same way, from how often
pages whose text points to one language declare another.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchbook.llm.store import share, shared, slices, stored

#: Labelled documents per language that the trigram model is fitted on (texts up to FIT_CHARS first, then longer ones),
#: and the most languages: a bound on the model's size only, beyond the number of written languages with web pages.
FIT_DOCS, FIT_CHARS, LANGUAGES = 400, 4000, 512
#: A language's short texts are counted in 2 ** RANGE_BITS ranges of their hash.
RANGE_BITS = 12
BUCKETS = 1 << 16
#: Trigrams of one text count as so many independent ones at most: those that follow each other are not.
INDEPENDENT = 60.0
#: Pages that the wider group's shares count as, for a suffix and for a host.
SUFFIX_WEIGHT, HOST_WEIGHT = 20.0, 10.0

TAGS = re.compile(r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def visible(page: str) -> str:
    """The text of a page without scripts, styles, comments and tags."""
    return html.unescape(TAGS.sub(" ", page))


def declared(column: str) -> Column:
    """The primary language that the markup declares: the lang attribute of <html>, else a content-language."""
    tag = F.regexp_extract(column, r"(?is)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    meta = F.regexp_extract(column, r"(?is)<meta[^>]*content-language[^>]*content\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    found = F.lower(F.when(tag != "", tag).when(meta != "", meta))
    return F.coalesce(found, F.lit(""))


def host_of(url: str) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*)$", 1)


@dataclass
class Trigrams:
    names: list[str]
    log: np.ndarray  # bucket, language

    @staticmethod
    def buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashed letter trigrams of all texts, and the text each is in."""
        plain = [" " + " ".join(re.findall(r"[^\W\d_]+", t.lower())) + " " for t in texts]
        points = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in plain])
        if len(points) < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        mixed = (points[:-2] * np.uint64(961748927) + points[1:-1] * np.uint64(49979687) + points[2:]) * np.uint64(0x9E3779B97F4A7C15)
        whole = owner[:-2] == owner[2:]
        return (mixed >> np.uint64(48)).astype(np.int64)[whole], owner[:-2][whole]

    @classmethod
    def fit(cls, langs: np.ndarray, buckets: np.ndarray, counts: np.ndarray) -> Trigrams:
        """From how often each bucket was seen in texts of each language; buckets of -1 only name the language."""
        names, at = np.unique(langs.astype(str), return_inverse=True)
        seen = np.full((BUCKETS, len(names)), 0.05)
        real = buckets >= 0
        np.add.at(seen, (buckets[real], at[real]), counts[real])
        return cls(names.tolist(), np.log(seen / seen.sum(axis=0)).astype(np.float32))

    def evidence(self, texts: list[str]) -> np.ndarray:
        """The log likelihood of each text in each language, less that of the likeliest; 0 for a text without letters."""
        bucket, owner = self.buckets(texts)
        total = np.zeros((len(texts), len(self.names)))
        for k in range(len(self.names)):
            total[:, k] = np.bincount(owner, self.log[bucket, k], minlength=len(texts))
        n = np.maximum(np.bincount(owner, minlength=len(texts)), 1)[:, None]
        total *= np.minimum(1.0, INDEPENDENT / n)
        return total - total.max(axis=1, keepdims=True)


def train(docs: DataFrame) -> Trigrams | None:
    """A trigram model from labelled documents (doc_id, text, lang): a bounded sample of each language.

    Within a language, texts of up to FIT_CHARS characters come first, by a hash of id and text, then the
    shortest of the longer ones, whole. Languages beyond LANGUAGES go by falling count, ties by name. Rows without
    a language or text teach nothing. None without any labelled text.
    """
    n = F.length("text")
    usable = docs.where(F.col("lang").isNotNull() & (n > 0)).select(
        "lang", F.xxhash64("doc_id", "text").alias("h"), "text", F.greatest(n, F.lit(FIT_CHARS)).alias("long")
    )
    # Ranges along the order (long, h), fine enough that one holds a small part of a language: a language's rows are
    # counted by range, and only those up to the range in which the last chosen one lies are put in order.
    short = F.shiftright("h", 64 - RANGE_BITS) + (1 << RANGE_BITS - 1)
    place = F.when(F.col("long") == FIT_CHARS, short).otherwise((1 << RANGE_BITS) + F.floor(F.log2("long") * 64))
    usable = usable.withColumn("place", place)
    ranges = usable.select("lang", "place", "long", "h").distinct().groupBy("lang", "place").agg(F.count("*").alias("n"))
    ranges = stored(ranges, "fit_ranges")
    past = F.sum("n").over(Window.partitionBy("lang").orderBy("place")) - F.col("n")
    cuts = ranges.withColumn("past", past).where(F.col("past") < FIT_DOCS).groupBy("lang").agg(F.max("place").alias("cut"))
    sizes = ranges.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang")
    cuts = cuts.join(F.broadcast(sizes), "lang", "left_semi")  # both have at most LANGUAGES rows
    near = usable.join(F.broadcast(cuts), "lang").where(F.col("place") <= F.col("cut"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("long", "h"))
    chosen = near.select("lang", "long", "h").distinct().withColumn("rank", rank).where(F.col("rank") <= FIT_DOCS)
    chosen = stored(chosen.drop("rank"), "fit_rows")  # at most LANGUAGES * FIT_DOCS rows
    rows = near.join(F.broadcast(chosen), ["lang", "long", "h"], "left_semi").dropDuplicates(["lang", "long", "h"])
    counts = _counted(rows.select("lang", "text")).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    if not counts.num_rows:
        return None
    return Trigrams.fit(*[counts.column(c).to_numpy() for c in ("lang", "bucket", "n")])


def _counted(rows: DataFrame) -> DataFrame:
    """(lang, bucket, n): the trigrams of each text, counted where it lies; and a row of bucket -1 for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                found, n = np.unique(Trigrams.buckets([text.as_py()])[0], return_counts=True)
                found, n = np.append(found, -1), np.append(n, 1)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(found), pa.array(n)], names=["lang", "bucket", "n"])

    return rows.mapInArrow(run, "lang string, bucket long, n long")


def _text_evidence(pages: DataFrame, model: Trigrams) -> DataFrame:
    sent = share(pages.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared(sent)
        for batch in batches:
            for part in slices(batch, "html", 1 << 20):
                logs = own.evidence([visible(t or "") for t in part.column("html").to_pylist()])
                kept = [part.column(n) for n in ("page_id", "host", "declared")]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(logs.ravel()), logs.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*kept, lists], names=["page_id", "host", "declared", "logs"])

    return pages.mapInArrow(run, "page_id long, host string, declared string, logs array<double>")


def _softmax(logs: Column) -> Column:
    e = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def identify(pages: DataFrame, model: Trigrams | None) -> DataFrame:
    """page_id, host, suffix, declared, text_lang (text alone), lang and its probability, for each page.

    Pages (page_id, url, html) without text, markup or URL are judged by what is left; null counts as missing.
    Rows that repeat each give a row and count each. Without a model, lang and probability are null. An empty
    table gives no rows; further columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of("url").alias("host"), declared("html").alias("declared"), "html")
    if model is None:
        unknown = F.lit(None).cast("string")
        return rows.select(
            "page_id", "host", suffix_of(F.col("host")).alias("suffix"), "declared",
            unknown.alias("text_lang"), unknown.alias("lang"), F.lit(None).cast("double").alias("probability"),
        )
    names, k = model.names, len(model.names)
    at = lambda column, i: F.element_at(column, F.lit(i + 1))
    seen = stored(_text_evidence(rows, model), "text_evidence").withColumn("suffix", suffix_of(F.col("host")))
    shares = [f"s{i}" for i in range(k)]

    def grouped(frame: DataFrame, by: list[str], weights: Column) -> DataFrame:
        return frame.withColumn("w", weights).groupBy(*by).agg(*[F.sum(at(F.col("w"), i)).alias(shares[i]) for i in range(k)])

    # Trust in declarations: for each language that text points to, the share of each declared one or none.
    trust = np.full((k, k + 1), 0.5)
    known = F.when(F.col("declared").isin(*names), F.col("declared")).otherwise("")
    for r in grouped(seen.withColumn("known", known), ["known"], _softmax(F.col("logs"))).collect():
        trust[:, names.index(r.known) if r.known else k] += [r[s] for s in shares]
    trust = np.log(trust / trust.sum(axis=1, keepdims=True))
    table = F.create_map(*[x for j, name in enumerate([*names, ""]) for x in (F.lit(name), F.array(*[F.lit(float(v)) for v in trust[:, j]]))])
    with_markup = F.zip_with("logs", table[known], lambda a, b: a + b)
    seen = stored(seen.withColumn("logs2", with_markup), "evidence")

    # Shares by host, by suffix and of all pages, each smoothed towards the wider group's.
    hosts = stored(grouped(seen, ["host", "suffix"], _softmax(F.col("logs2"))), "hosts")
    suffixes = stored(hosts.groupBy("suffix").agg(*[F.sum(s).alias(s) for s in shares]), "suffixes")
    total = suffixes.agg(*[F.sum(s) for s in shares]).first()
    all_pages = np.array([x or 0.0 for x in total]) + 1.0
    all_pages /= all_pages.sum()

    def smooth(own: list[Column], wide: list[Column], weight: float) -> list[Column]:
        n = sum(own[1:], own[0])
        return [(o + weight * w) / (n + weight) for o, w in zip(own, wide, strict=True)]

    wide = suffixes.select("suffix", F.array(*smooth([F.col(s) for s in shares], [F.lit(float(x)) for x in all_pages], SUFFIX_WEIGHT)).alias("wide"))
    prior = hosts.join(wide, "suffix").select(
        "host", F.array(*smooth([F.col(s) for s in shares], [at(F.col("wide"), i) for i in range(k)], HOST_WEIGHT)).alias("prior")
    )
    fused = seen.join(stored(prior, "priors"), "host").withColumn(
        "p", _softmax(F.zip_with("logs2", "prior", lambda a, b: a + F.log(b)))
    )
    named = F.array(*[F.lit(n) for n in names])
    best = lambda column: F.element_at(named, F.array_position(F.col(column), F.array_max(column)).cast("int"))
    return fused.select(
        "page_id", "host", "suffix", "declared", best("logs").alias("text_lang"), best("p").alias("lang"), F.array_max("p").alias("probability")
    )
