"""Quality rules: repetition and length, then how far a document's letters and words are from its language's.

The language references are sums over all documents of a language: shares of character classes, and shares of twenty
common words and all others. A document's own shares are compared with them by the Jensen-Shannon distance, from 0
(equal) to 1 (nothing in common). Short documents have no steady shares, so a comparison needs a minimum length.

Everything is DataFrame expressions within a row; the only shuffle is that of the references' sums, one row per
language and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agrospark.llm import common
from agrospark.sources.files import store

WINDOW = 5
LEAST_COMMON = 0.26  # documents labelled good come up to 0.25; a language with fewer common words cannot be told by them
REACH = 0.9  # of the distance of a text without any common word
BROADCAST_LANGUAGES = 10_000  # rows of some hundred bytes
# Common words by language; the bins of the word histogram.
COMMON = {
    "en": "the of and to in is that for it as with was on are by be at from this or",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au plus avec",
    "es": "de la que el en y a los se del las un por con no una su para es al",
}
# Characters by class; what is in none of them is a small letter, a letter outside A-Z or another sign.
CLASSES = {"upper": "[A-Z]+", "digit": "[0-9]+", "blank": rf"[{common.BREAKS}]+",
           "stop": "[.,;:!?'\"()-]+", "symbol": r"[#*$%&|<>@^~_=+/\\\[\]{}]+"}


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def measured(docs: DataFrame) -> DataFrame:
    """`row` (all columns of docs), lang, the base counts, and both histograms, one row for each row."""
    text = F.col("text")
    d = docs.select(F.struct(*docs.columns).alias("row")).select(
        "row", F.col("row.lang").cast("string").alias("lang"),
        F.coalesce(F.col("row.text"), F.lit("")).alias("text"))
    d = d.withColumn("words", common.words(text)).withColumn(
        "lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{common.BREAKS}]")))
    known = F.filter("words", lambda w: w.isin(sorted({w for ws in COMMON.values() for w in ws.split()})))
    bins = F.lit(None).cast("array<string>")
    for lang, listed in COMMON.items():
        bins = F.when(F.col("lang") == lang, F.array(*map(F.lit, listed.split()))).otherwise(bins)
    d = d.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).withColumn("known", known)
    n = F.size("words")
    gram = lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)])
    d = d.withColumn("grams", F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), gram)))
    d = d.withColumn("sorted", F.when(
        F.size(F.array_distinct("grams")) < F.size("grams"),
        F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("sorted")
    same = lambda x, k: F.get(s, k)["h"].eqNullSafe(x["h"])
    d = d.withColumn("repeats", F.sort_array(F.transform(
        F.filter(s, lambda x, k: ((k > 0) & same(x, F.greatest(k - 1, F.lit(0)))) | same(x, k + 1)), lambda x: x["i"])))
    r = F.col("repeats")
    covered = F.aggregate(
        F.transform(r, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(r, k + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    total = F.length(text)
    shares = [total - _without(text, p) for p in CLASSES.values()]
    d = d.select(
        "row", "lang", n.cast("bigint").alias("n_words"),
        _without(text, CLASSES["blank"]).cast("bigint").alias("word_chars"),
        (total - _without(text, "[#*$%&|<>]+")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        total.alias("n_chars"), F.array(*shares).alias("classes"),
        F.transform(bins, lambda b: F.size("known") - F.size(F.array_remove("known", b))).alias("common"))
    rest = lambda whole, parts: F.concat(
        F.col(parts), F.array(F.col(whole).cast("int") - F.aggregate(parts, F.lit(0), lambda a, x: a + x)))
    return d.withColumn("classes", rest("n_chars", "classes")).withColumn("common", rest("n_words", "common"))


def references(docs: DataFrame) -> DataFrame:
    """lang, ref_classes and ref_common: shares over all documents of a language, one row per language.

    Languages without a list of common words have a null word reference; a null language is a language.
    """
    m = measured(docs)
    sizes = {"classes": len(CLASSES) + 1, "common": len(next(iter(COMMON.values())).split()) + 1}
    sums = m.groupBy("lang").agg(*[
        F.sum(F.get(F.col(c), F.lit(i))).alias(f"{c}{i}") for c, k in sizes.items() for i in range(k)])
    share = lambda c: F.array(*[
        F.col(f"{c}{i}") / F.nullif(sum(F.col(f"{c}{j}") for j in range(sizes[c])), F.lit(0)) for i in range(sizes[c])])
    return sums.select(F.col("lang").alias("ref_lang"), share("classes").alias("ref_classes"), F.when(
        F.col("common0").isNotNull(), share("common")).alias("ref_common"))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance between counts and shares; null where either is missing or empty."""
    whole = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    terms = F.zip_with(counts, reference, lambda c, q: part(c / whole, (c / whole + q) / 2) + part(q, (c / whole + q) / 2))
    return F.when(whole > 0, F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2)))


def judged(docs: DataFrame, max_class: float = 0.28, max_common: float = 0.5, min_words_class: int = 50,
           min_words_common: int = 100, reach: float | None = REACH) -> DataFrame:
    """`row` with the base counts, base_failed, both distances and kept.

    A document fails the base rule with fewer than 10 words, or if more than a fifth of its words stand in windows
    of five that it holds twice. A null or empty text has no words and fails. One that passes is kept unless it is long enough
    to be compared and further than the limit from its language. The limit of the words is, for each
    language, the share `reach` of the distance of a text without any common word, if that is less than max_common.
    """
    ref = store(references(docs), "language-references")
    if ref.count() <= BROADCAST_LANGUAGES:  # else documents meet their language's row by a join on it
        ref = F.broadcast(ref)
    m = measured(docs)
    j = m.join(ref, m["lang"].eqNullSafe(ref["ref_lang"]), "left")
    n = F.col("n_words")
    failed = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    j = j.withColumn("base_failed", failed) \
        .withColumn("js_classes", distance(F.col("classes"), F.col("ref_classes"))) \
        .withColumn("js_common", distance(F.col("common"), F.col("ref_common")))
    limit = F.lit(max_common)
    if reach is not None:
        none = F.array(*[F.lit(0)] * len(COMMON["en"].split()), F.lit(1))
        limit = F.least(limit, F.greatest(F.lit(LEAST_COMMON), reach * distance(none, F.col("ref_common"))))
    far = ((n >= min_words_class) & (F.col("js_classes") > max_class)) \
        | ((n >= min_words_common) & (F.col("js_common") > limit))
    return j.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))


def quality_filter(docs: DataFrame, **limits) -> DataFrame:
    """The rows of docs that are kept, with their columns. Long texts without common words of their language go."""
    # Stored first: a filter on the verdict would be pushed below, where each part of it computes all of it again.
    return store(judged(docs, **limits).select("row", "kept"), "judged").where("kept").select("row.*")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(common.table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("js_classes", 4).alias("js_classes"), F.round("js_common", 4).alias("js_common"))
