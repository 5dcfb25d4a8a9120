"""Language of web pages by Bayesian fusion of evidence.

Four pieces are combined per page: the likelihood of its visible text under byte-trigram models of labelled
documents (tempered: long texts count as at most TEXT_WEIGHT trigrams), the language its markup declares, the
last label of its host, and a prior of its host. How far declarations and suffixes can be trusted, and the
priors, are learned from the pages themselves by grouped sums of the text posteriors; the host's prior is
smoothed by its domain's, and that by the prior over all pages; a page's own share is left out of all these
sums. No group is gathered: every sum is combined before it is shuffled.

Results for odd input: null or empty markup has no text evidence and no declaration; a null URL or one
without `://` has an empty host; a null id is carried; repeated rows are judged alike; an empty table of
pages gives an empty result; labelled documents without language are not trained on, and without any the
languages are null; pages are scanned whole, in time that grows with their length whatever their markup; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import column_of, map_texts, text_slices, texts
from larder.llm.extract import attributes_at, blocks_of
from larder.sources.tables import staged

BUCKETS = 1 << 14
SMOOTHING = 0.5
TEXT_WEIGHT = 100
# Weights, in pages, of the wider group's prior in a narrower one's, and of an even spread in the tables.
HOST_STRENGTH = 5.0
DOMAIN_STRENGTH = 20.0
TABLE_STRENGTH = 1.0

_DOCUMENT = re.compile(r"<(?=html[\s/>])", re.IGNORECASE)
_PRIMARY = re.compile(r"\s*([a-zA-Z]{2,3})(?![a-zA-Z0-9])")


def visible_text(markup: str) -> str:
    """Text of the page's blocks outside its frame, found in one scan."""
    return "\n".join([block.text for block in blocks_of(markup)])


def declared_language(markup: str) -> str:
    """Primary subtag of the document element's `lang`; empty if there is none."""
    begins = _DOCUMENT.search(markup)
    for name, value in attributes_at(markup, begins.end()) if begins else ():
        if name == "lang":
            found = _PRIMARY.match(value)
            return found[1].lower() if found else ""
    return ""


def trigrams(text: str) -> np.ndarray:
    """Hash bucket of each byte trigram of the text in lower case; digits and symbols are blanks."""
    letters = "".join([c if c.isalpha() else " " for c in text.lower()])
    data = np.frombuffer(f" {' '.join(letters.split())} ".encode(), np.uint8).astype(np.uint32)
    if len(data) < 4:
        return np.zeros(0, np.int64)
    mixed = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(0x9E3779B1)
    return (mixed >> np.uint32(18)).astype(np.int64)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-probability of each trigram bucket in each: a table of fixed width."""
    labelled = docs.filter(F.col("lang").isNotNull()).select("lang", "text")
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in text_slices(batches):
            for lang, text in zip(column_of(batch, "lang").to_pylist(), texts(batch)):
                counts = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                counts += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, counts in sums.items():
            met = np.flatnonzero(counts)
            if len(met):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(met)), pa.array(met.astype(np.int32)), pa.array(counts[met])],
                                                 names=schema.names)

    counts = labelled.mapInArrow(run, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    table = np.full((len(languages), BUCKETS), SMOOTHING)
    for row, lang in enumerate(languages):
        mine = counts[counts["lang"] == lang]
        table[row, mine["bucket"]] += mine["n"]
    return languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def read_pages(pages: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """Per page: id, host, domain, suffix, declared, the text's log-likelihoods and posterior by language."""
    arrays = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("likelihood", "posterior")]
    schema = T.StructType([pages.select("page_id").schema[0], T.StructField("url", T.StringType()),
                           T.StructField("declared", T.StringType()), *arrays])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        markup = texts(batch, "html")
        scores = np.zeros((len(markup), len(languages)))
        for row, source in enumerate(markup):
            found = trigrams(visible_text(source))
            if len(found):
                scores[row] = table[:, found].mean(axis=1) * min(len(found), TEXT_WEIGHT)
        chance = np.exp(scores - scores.max(axis=1, keepdims=True)) if languages else scores
        chance /= np.maximum(chance.sum(axis=1, keepdims=True), 1e-300)
        ends = pa.array(np.arange(len(markup) + 1, dtype=np.int32) * len(languages))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (scores, chance)]
        return pa.RecordBatch.from_arrays([column_of(batch, "page_id"), column_of(batch, "url"),
                                           pa.array([declared_language(m) for m in markup]), *lists], names=schema.names)

    read = map_texts(pages.select("page_id", "url", "html"), run, schema, "html")
    rest = F.when(F.col("url").contains("://"), F.regexp_replace("url", r"(?s)^.*?://", "")).otherwise("")
    host = F.lower(F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#:]*", 0))
    return read.withColumn("host", host).withColumn("domain", F.substring_index("host", ".", -2)) \
        .withColumn("suffix", F.substring_index("host", ".", -1)).drop("url")


def _sums(pages: DataFrame, by: list[str], n: int, name: str) -> DataFrame:
    """Sum of the text posteriors of each group, as one array."""
    return pages.groupBy(*by).agg(F.array(*[F.sum(F.col("posterior")[i]) for i in range(n)]).alias(name))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, host, declared, text_lang, lang and confidence of every page."""
    languages, table = train(docs)
    n = len(languages)
    if not n:
        read = read_pages(pages, languages, table)
        none = F.lit(None).cast("string")
        return read.select("page_id", "host", "declared", none.alias("text_lang"), none.alias("lang"), F.lit(None).cast("double").alias("confidence"))
    read = staged(read_pages(pages, languages, table), "pages")
    # One row of n sums.
    whole = read.agg(*[F.coalesce(F.sum(F.col("posterior")[i]), F.lit(0.0)) for i in range(n)]).first()
    spread = sum(whole)
    everywhere = F.array(*[F.lit((x + 1) / (spread + n)) for x in whole])
    totals = F.array(*[F.lit(float(x)) for x in whole])
    joined, kinds = read, {}
    for group, name in (("host", "at_host"), ("domain", "at_domain"), ("suffix", "at_suffix"), ("declared", "at_declared")):
        sums = staged(_sums(read, [group], n, name), name)
        kinds[group] = max(1, sums.count())
        joined = joined.join(sums, group)

    def evidence(name: str, group: str) -> Column:
        """Log of the chance of the page's suffix or declaration in each language, as the other pages have them."""
        return F.zip_with(others(name), others(totals), lambda here, all_of: F.ln(
            (here + TABLE_STRENGTH / kinds[group]) / (all_of + TABLE_STRENGTH)))

    def others(sums: str | Column) -> Column:
        return F.zip_with(sums, "posterior", lambda here, own: F.greatest(here - own, F.lit(0.0)))

    def smoothed(sums: Column, wider: Column, strength: float) -> Column:
        size = _total(sums)
        return F.zip_with(sums, wider, lambda here, prior: (here + strength * prior) / (size + strength))

    domain = joined.withColumn("domain_prior", smoothed(others("at_domain"), everywhere, DOMAIN_STRENGTH))
    host = domain.withColumn("host_prior", smoothed(others("at_host"), F.col("domain_prior"), HOST_STRENGTH))
    parts = [F.col("likelihood"), F.transform("host_prior", lambda p: F.ln(p)), evidence("at_suffix", "suffix")]
    parts.append(F.transform(evidence("at_declared", "declared"), lambda x: F.when(F.col("declared") == "", 0.0).otherwise(x)))
    total = parts[0]
    for part in parts[1:]:
        total = F.zip_with(total, part, lambda a, b: a + b)
    names = F.array(*map(F.lit, languages))

    def best(values: str) -> Column:
        return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))

    fused = host.withColumn("fused", total)
    top = F.array_max("fused")
    return fused.select("page_id", "host", "declared",
                        F.when(_total(F.transform("likelihood", lambda x: F.abs(x))) > 0, best("likelihood")).alias("text_lang"),
                        best("fused").alias("lang"), (1 / _total(F.transform("fused", lambda x: F.exp(x - top)))).alias("confidence"))
