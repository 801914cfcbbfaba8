"""Line dedup by a log-template tree: lines are parsed to templates, and templates that recur across documents go.

The tree has a fixed depth: the number of tokens, then the first `depth` tokens, where a token with a digit is a
variable field already. Below a leaf, a line's words are ordered by their support, the lines of the leaf that have the
word at its place; lines found in `min_docs` documents are no part of it. A template is the words of a support and more,
all other tokens are variable. A line has one such template for each support, one inside the other, so a small template
is found beside large ones. A template recurs if `min_docs` documents hold it, enough of it is fixed, and its words
belong together: they are a whole line of `min_docs` documents, or the share `agreed` of the leaf has each of them, or
they stand together well more often (1 / `agreed` times) than words that fall there by chance. That keeps prose, whose
lines may begin alike and hold the same small words. The share `min_fixed` is that of a line's words: fields and tokens
without letters do not count, but one word at least must be fixed. So rows of numbers are no template; like every line,
they go if their text itself is found in `min_docs` documents, or in two if it is a passage of twenty tokens. All lines of a recurring template or text are dropped but
those of the first document.

Lines with the same tokens are counted once with the number of their documents before tokens are looked at, so a line
that a third of all documents share is one row. Texts are told apart by their hash: exact copies count as one
document, and are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agrospark.llm import common
from agrospark.sources.files import store

FIELD = "<*>"
LONG = 20  # tokens of a line that is a passage: two documents do not write it independently


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def prepared_lines(text: Column) -> Column:
    """The lines of a text, tokens with a digit as variable fields, one blank between tokens.

    The whole text is prepared at once, and only where there is something to do.
    """
    field = f"(?<![^{common.BREAKS}])[^{common.BREAKS}0-9]*+[0-9][^{common.BREAKS}]*+"
    masked = F.when(text.rlike("[0-9]"), F.regexp_replace(text, field, FIELD)).otherwise(text)
    return F.split(F.regexp_replace(masked, r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+", " "), "\n", -1)


def parsed_lines(docs: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """doc_id, h (the text's hash), line (number), the hash of its tokens, its leaf, of a line with fields the text's hash, and if it is long."""
    text = _text(F.col("text"))
    raw = F.when(text.rlike("[0-9]"), F.split(text, "\n", -1)).otherwise(F.array().cast("array<string>"))
    lines = docs.select("doc_id", F.xxhash64(text).alias("h"), F.posexplode(
        F.arrays_zip(prepared_lines(text).alias("said"), raw.alias("raw"))).alias("line", "both"))
    lines = lines.select("doc_id", "h", "line", F.trim("both.said").alias("said"), F.col("both.raw").alias("raw")).withColumn(
        "size", F.length("said") - F.length(F.replace("said", F.lit(" "), F.lit(""))) + 1)
    return lines.where((F.col("said") != "") & (F.col("size") >= min_tokens)).select(
        "doc_id", "h", "line", F.xxhash64("said").alias("same"),
        F.xxhash64("size", F.substring_index("said", " ", depth)).alias("leaf"),
        F.when(F.contains("said", F.lit(FIELD)), F.xxhash64(F.trim(F.regexp_replace("raw", f"[{common.BREAKS}]+", " "))))
        .alias("raw"), (F.col("size") >= LONG).alias("long"))


def tokens_of(docs: DataFrame, kinds: DataFrame) -> DataFrame:
    """The tokens of each kind of line, read where it was found first. Texts are placed by their hash, at any size."""
    cuts = kinds.groupBy("at.doc_id", "at.h").agg(F.collect_list(F.struct("same", "at.line")).alias("cuts"))
    text = _text(F.col("text"))
    d, w = docs.select("doc_id", F.xxhash64(text).alias("h"), "text").alias("d"), cuts.alias("w").hint("merge")
    found = d.join(w, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.h") == F.col("w.h")))
    lines = found.select("w.cuts", prepared_lines(_text(F.col("d.text"))).alias("lines"))
    each = lines.select("lines", F.explode("cuts").alias("cut"))
    return each.select("cut.same", F.split(F.trim(F.get("lines", F.col("cut.line"))), " ").alias("tokens")).dropDuplicates(["same"])


def candidates(marked: DataFrame, min_docs: int, min_fixed: float, agreed: float) -> DataFrame:
    """The templates that a line may have: its words of a support and more, for each power of two and for a share of the leaf.

    `sure` ones are a line found in min_docs documents or words that the share of the leaf agrees on; for the others,
    `chance` is the number of lines that would hold all their words if words stood there independently.
    """
    word = F.struct("place", F.xxhash64("token").alias("token"), F.coalesce("seen", F.lit(0)).alias("seen"))
    lines = marked.groupBy("same", "leaf", "n", "loose", "all", "home").agg(
        F.max(F.col("token") == FIELD).alias("masked"), F.sort_array(F.collect_list(F.when(F.col("token").rlike(r"\p{L}"), word))).alias("words"))
    supports = F.transform(F.filter("words", lambda w: w["seen"] > 0), lambda w: F.pow(F.lit(2.0), F.floor(F.log2(w["seen"]))))
    verbatim, half = F.col("n") >= min_docs, F.greatest(agreed * F.col("all"), F.lit(1.0 * min_docs))
    lines = lines.withColumn("supports", F.array_distinct(
        F.concat(supports, F.array(half, F.when(verbatim, 0.0).otherwise(half)))))
    held = F.transform("supports", lambda s: F.filter("words", lambda w: w["seen"] >= s))
    whole = lambda h: verbatim & (F.size(h) == F.size("words"))
    lines = lines.withColumn("held", F.explode(F.array_distinct(
        F.filter(held, lambda h: F.when(F.size(h) > 0, F.size(h) >= min_fixed * F.size("words")).otherwise(
            whole(h) & ~F.col("masked"))))))
    return lines.select(
        "same", "leaf", "n", "loose", "home",
        F.when(F.size("held") == 0, F.col("same")).otherwise(
            F.xxhash64(F.transform("held", lambda w: F.struct(w["place"], w["token"])))).alias("template"),
        (whole("held") | F.forall("held", lambda w: w["seen"] >= half)).alias("sure"),
        F.aggregate("held", F.col("all").cast("double"), lambda a, w: a * F.try_divide(w["seen"], F.col("all"))).alias("chance"))


def recurring_lines(docs: DataFrame, min_docs: int, depth: int, min_tokens: int, min_fixed: float, agreed: float) -> DataFrame:
    """(h, lines): the numbers of the lines that go, by text."""
    lines = store(parsed_lines(docs, depth, min_tokens), "lines")
    # A line and its documents; the first of them, by doc_id, keeps its lines.
    kinds = lines.groupBy("same", "leaf", "h").agg(F.min("doc_id").alias("doc_id"), F.min("line").alias("line")) \
        .groupBy("same", "leaf").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "line")).alias("at"))
    loose = F.when(F.col("n") < min_docs, F.col("n")).otherwise(F.lit(0))
    kinds = store(kinds.withColumn("home", F.struct("at.doc_id", "at.h")).withColumn("loose", loose), "line-kinds")
    busy = kinds.groupBy("leaf").agg(F.sum("n").alias("whole"), F.sum("loose").alias("all")).where(F.col("whole") >= min_docs)
    kinds = store(kinds.join(busy.drop("whole"), "leaf"), "busy-lines")
    known = store(tokens_of(docs, kinds), "line-texts")
    placed = store(kinds.join(known, "same").select(
        "same", "leaf", "n", "loose", "all", "home", F.posexplode("tokens").alias("place", "token")), "line-tokens")
    fixed = placed.groupBy("leaf", "place", "token").agg(F.sum("loose").alias("seen")).where(F.col("seen") >= min_docs)
    marked = placed.join(store(fixed, "fixed-tokens"), ["leaf", "place", "token"], "left")
    possible = store(candidates(marked, min_docs, min_fixed, agreed), "templates")
    strong = (F.col("others") * agreed >= F.col("chance")) & (F.col("others") >= F.col("chance") + 2 * F.sqrt("chance"))
    recurring = possible.groupBy("leaf", "template").agg(
        F.sum("n").alias("docs"), F.sum("loose").alias("others"), F.max("sure").alias("sure"), F.max("chance").alias("chance")) \
        .where((F.col("docs") >= min_docs) & (F.col("sure") | strong)).select("leaf", "template", "docs")
    # Of a line's templates that recur, the one of most lines takes it; its first document is sought among those lines.
    taken = store(possible.join(recurring, ["leaf", "template"]).groupBy("same", "leaf", "home").agg(
        F.max(F.struct("docs", "template"))["template"].alias("template")), "taken-lines")
    first = taken.groupBy("leaf", "template").agg(F.min("home")["h"].alias("kept_in"))
    gone = store(taken.join(first, ["leaf", "template"]).select("same", "kept_in"), "recurring-lines")
    dropped = lines.join(gone, "same").where("h != kept_in").select("h", "line")
    # Lines with fields and no word are no template, but go if the text itself is found again; long ones go at once.
    texts = lines.where("raw is not null or long").select("doc_id", "h", "line", "long", F.coalesce("raw", "same").alias("said"))
    again = texts.groupBy("said", "long", "h").agg(F.min("doc_id").alias("doc_id")).groupBy("said", "long").agg(
        F.count("*").alias("docs"), F.min(F.struct("doc_id", "h"))["h"].alias("kept_in"))
    again = again.where(F.col("docs") >= F.when(F.col("long"), F.least(F.lit(2), F.lit(min_docs))).otherwise(min_docs))
    again = store(again.select("said", "kept_in"), "recurring-texts")
    dropped = dropped.unionByName(texts.join(again, "said").where("h != kept_in").select("h", "line"))
    return store(dropped.groupBy("h").agg(F.collect_set("line").alias("lines")), "dropped-lines")


def drop_recurring_lines(docs: DataFrame, min_docs: int = 5, depth: int = 3, min_tokens: int = 3,
                         min_fixed: float = 0.6, agreed: float = 0.5) -> DataFrame:
    """docs with `text` without the lines of recurring templates, and n_dropped; n_chars follows if docs has it.

    Every row stays, also one that loses all its lines (it has an empty text then). Lines with fewer tokens than
    `min_tokens` are never dropped. A null text stays null. A row without doc_id comes first among the documents.
    Other columns are kept; a column n_dropped that docs has already is replaced.
    """
    gone = recurring_lines(docs, min_docs, depth, min_tokens, min_fixed, agreed) \
        .select(F.col("h").alias("_h"), F.col("lines").alias("_lines"))
    columns = [c for c in docs.columns if c != "n_dropped"]
    rows = docs.select(F.struct(*columns).alias("row"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_h"))
    rows = rows.join(gone.hint("merge"), "_h", "left")
    lines = F.split(F.col("row.text"), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size("said") - 1), "_lines")
    rows = rows.withColumn("said", F.when(F.col("_lines").isNotNull(), lines))
    text = F.when(F.col("_lines").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("said", i)), "\n"))
    rows = rows.select("row", text.alias("_text"), F.coalesce(F.size("_lines"), F.lit(0)).cast("bigint").alias("n_dropped"))
    rows = rows.withColumn("n_dropped", F.greatest("n_dropped", F.lit(0)))
    new = {"text": F.col("_text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("_text")).otherwise(F.col("row.n_chars"))
           if "n_chars" in columns else None}
    return rows.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"row.`{c}`").alias(c)
                         for c in columns], "n_dropped")


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs).select(
        "doc_id", "n_dropped", F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
