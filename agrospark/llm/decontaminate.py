"""Benchmark decontamination by spaced seeds.

A seed is the hash of some of the tokens of a span; which of them is said by a fixed mask. Tokens at the other places
may differ, so a passage with substituted words still shares seeds with the item it was taken from. All seeds of all
documents are joined with those of the benchmark. A hit gives an alignment of document and item; the tokens of both
are then compared along it, and it counts if some stretch of `window` tokens is equal in at least `percent` of its
places (the whole item, if that is shorter, from `least` tokens on). Items of `shortest` to `least` - 1 tokens count
where they stand word for word; fewer tokens than that are common speech and tell nothing.

The masks are complete for the defaults: wherever three of 15 or 16 tokens, or two of 11 to 14, are substituted, some
mask at some place of the stretch takes equal tokens only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agrospark.llm import common
from agrospark.sources.files import store

# Places of a span of eleven tokens that a seed takes; found by a search for few masks that leave no pattern out.
MASKS = ("11001010011", "10110001101", "10100110110", "11011101000", "01101100101", "00011011110", "00010111011")
SHORT = "11111"  # the beginning of an item that must be there word for word
#: Seeds of the benchmark that may be sent to all executors (about 32 bytes each); beyond, Spark chooses the join.
BROADCAST_SEEDS = 1_000_000


def tokens(text: Column) -> Column:
    """Hashes of the runs of letters and digits, in lower case."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(rows: DataFrame, masks: Sequence[str], *keep: str) -> DataFrame:
    """`keep`, place and seed of every span of the hashes in `tokens`, once per mask."""
    n, place = F.size("tokens"), F.col("place")
    placed = rows.where(n >= min(map(len, masks))).withColumn(
        "place", F.explode(F.sequence(F.lit(0), n - min(map(len, masks)))))
    hashed = [F.when(place <= n - len(mask), F.xxhash64(F.lit(mask), *[
        F.get("tokens", place + i) for i, c in enumerate(mask) if c == "1"])) for mask in masks]
    return placed.select(*keep, "place", F.explode(F.array(*hashed)).alias("seed")).where(F.col("seed").isNotNull())


def overlaps(
    docs: DataFrame, benchmark: DataFrame, window: int = 16, percent: int = 80, least: int = 11,
    shortest: int = len(SHORT),
) -> DataFrame:
    """doc_id, h (the text's hash), item_id, and of the best stretch: where it begins, its length and its equal tokens.

    One row per document and item that overlap. Null or empty texts, and items of fewer tokens than `shortest` (at least
    five), overlap with nothing. Copies of a document, repeated rows included, have the same rows, each once per
    (doc_id, h). Other limits than the defaults change what is accepted, not where the seeds look.
    """
    items = benchmark.select("item_id", tokens(F.col("text")).alias("tokens")) \
        .where(F.size("tokens") >= max(shortest, len(SHORT))).dropDuplicates(["item_id", "tokens"])
    own = items.withColumn("item", F.xxhash64("tokens")).withColumn("length", F.size("tokens"))
    whole, brief = own.where(F.col("length") >= least), own.where(F.col("length") < least)
    columns = ["item_id", "item", "length"]
    known = seeds(whole, MASKS, *columns).unionByName(seeds(brief, [SHORT], *columns).where("place = 0")) \
        .withColumnRenamed("place", "item_place").distinct()
    if known.count() <= BROADCAST_SEEDS:
        known = F.broadcast(known)
    masks = MASKS if brief.isEmpty() else (*MASKS, SHORT)
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), tokens(F.col("text")).alias("tokens"))
    # Only places and seeds go into the join; the tokens of the few documents with a hit are fetched afterwards.
    hits = store(seeds(rows, masks, "doc_id", "h").join(known, "seed").select(
        "doc_id", "h", "item_id", "item", "length", (F.col("place") - F.col("item_place")).alias("shift")).distinct(), "seed-hits")
    d, w = rows.alias("d"), hits.alias("w")
    shift = F.col("w.shift")
    aligned = d.join(w, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.h") == F.col("w.h"))).select(
        "w.doc_id", "w.h", "w.item_id", "w.item", "w.shift",
        F.slice("d.tokens", F.greatest(shift, F.lit(0)) + 1, F.col("w.length") + F.least(shift, F.lit(0))).alias("there"))
    # Both sides from the first token that they may have in common, as far as the document goes.
    mine = F.slice("tokens", F.greatest(-F.col("shift"), F.lit(0)) + 1, F.size("there"))
    same = F.zip_with(mine, "there", lambda a, b: (a == b).cast("int"))
    compared = aligned.join(own.drop("length"), ["item_id", "item"]).select(
        "doc_id", "h", "item_id", "shift", same.alias("same"), F.least(F.size("tokens"), F.lit(window)).alias("size"),
        F.when(F.size("tokens") < least, 100).otherwise(percent).alias("percent"))
    compared = store(compared, "aligned")  # else the filter below would repeat the comparison for each stretch
    starts = F.when(F.size("same") >= F.col("size"), F.sequence(F.lit(0), F.size("same") - F.col("size"))) \
        .otherwise(F.array().cast("array<int>"))
    equal = lambda s: F.aggregate(F.slice("same", s + 1, F.col("size")), F.lit(0), lambda a, x: a + x)
    best = F.array_max(F.transform(starts, lambda s: F.struct(equal(s).alias("equal"), (-s).alias("at"))))
    scored = compared.withColumn("best", best).where(100 * F.col("best.equal") >= F.col("percent") * F.col("size"))
    place = F.greatest(F.col("shift"), F.lit(0)) - F.col("best.at")
    return scored.select("doc_id", "h", "item_id", F.struct(
        F.col("best.equal").alias("equal"), (-place).alias("at"), F.col("size")).alias("found")) \
        .groupBy("doc_id", "h", "item_id").agg(F.max("found").alias("found")).select(
        "doc_id", "h", "item_id", (-F.col("found.at")).cast("bigint").alias("first_token"),
        F.col("found.size").cast("bigint").alias("n_tokens"), F.col("found.equal").cast("bigint").alias("n_equal"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The rows of docs that overlap with no item, with their columns, whatever the names of those."""
    found = overlaps(docs, benchmark, **limits).select("doc_id", "h").distinct().alias("f")
    packed = docs.select(F.struct(*docs.columns).alias("row")).withColumn(
        "h", F.xxhash64(F.coalesce("row.text", F.lit("")))).alias("d")
    same = F.col("d.row.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.h") == F.col("f.h"))
    return packed.join(found, same, "left_anti").select("row.*")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlaps(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.drop("h")
