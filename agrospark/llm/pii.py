"""Personal data: candidate spans by generators, boosted trees on their form and context, calibrated thresholds.

Base generators are strict patterns with checks (address parts, Luhn sum, number of digits); what passes is always a
span. Loose generators propose everything that resembles such data: no leading plus, other separators, words in place
of signs, keys and long digit strings. Boosted trees learn, from all candidates, to tell base spans, and secrets
that stand behind an assignment to a key, from all other candidates by form and context, not by the generator that
proposed them. Since some of the others are personal data as
well, the scores are calibrated on base spans that the trees have not seen: a score divided by their mean score is the probability of
being personal data (learning from positive and unlabelled cases), and a candidate is added where it reaches
`threshold`. Candidates that overlap a base span, or a better candidate, are not added.

Everything is DataFrame expressions and the trees of Spark ML; texts are not shuffled, only candidates are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from agrospark.llm import common
from agrospark.sources.files import store

KINDS = ("email", "ip", "card", "phone", "secret")  # in the order in which spans at one place are listed
_LOCAL = "[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Generator:
    kind: str
    pattern: str
    base: bool = False


# A run of characters is entered at its first one (or where the last match ended), and never given back: the matches
# are those of the plain patterns, without the time that long runs would take.
GENERATORS = {
    "email": Generator("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True),
    "ip": Generator("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True),
    "card": Generator("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", True),
    "phone": Generator("phone", r"\+[0-9][\x20().0-9-]+[0-9]", True),
    "email_words": Generator("email", rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[({{](?i:at)[\])}}] ?[A-Za-z0-9-]++"
                                      r"(?: ?(?:\.|[\[({](?i:dot)[\])}]) ?[A-Za-z0-9-]++)++"),
    "ip_six": Generator("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}+[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "digits": Generator("card", r"(?<![0-9])[0-9](?:[./_]?[0-9]){11,18}+(?![0-9])"),
    "phone_plain": Generator("phone", r"(?<![0-9+.-])(?:\([0-9]{2,5}\) ?|0[0-9]{1,4}[ ./-]|[0-9]{3}[ ./-])[0-9]{3,4}[ ./-]?[0-9]{3,4}(?![0-9])"),
    "key": Generator("secret", r"(?<![A-Za-z0-9_-])(?:(?:sk|pk|ghp|xox[abp]|AKIA|key|token)[A-Za-z0-9_-]{16,}+|[0-9a-f]{32,}+)(?![A-Za-z0-9_-])"),
}
CONTEXT = {"mail": "mail|contact|write", "phone": "phone|tel|call|fax|mobil", "card": "card|visa|pay|credit|iban|account",
           "host": "\\bip\\b|host|server|login|from", "key": "key|secret|token|passw|api"}
# A secret has no base pattern. What stands right behind an assignment to such a word, or begins as keys of well-known
# services do, is taken for one when the trees learn.
ASSIGNED = r"(?i)(?:key|secret|token|passw[a-z]*|api)[\"']?\s*[:=]+\s*[\"']?$"
ISSUED = r"^(?:sk|pk)[_-]|^ghp_|^xox[abp]-|^AKIA"


def _digits(said: Column) -> Column:
    return F.regexp_replace(said, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether 12 to 19 digits pass the Luhn sum; other runs, however long, are not walked through."""
    values = F.transform(F.reverse(F.split(digits, "(?<=.)(?=.)")), lambda d, i: d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
    total = F.aggregate(values, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)


def _passes(kind: Column, said: Column) -> Column:
    """Whether what a base pattern found passes its check."""
    n, digits = F.length(_digits(said)), _digits(said)
    small = F.forall(F.split(said, r"\."), lambda x: (F.length(F.ltrim(x, F.lit("0"))) <= 3) & (
        F.lpad(F.right(x, F.lit(3)), 3, "0") <= "255"))
    return F.when(kind == "ip", small).when(kind == "card", _luhn(digits)) \
        .when(kind == "phone", n.between(9, 15)).otherwise(True)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, h (the text's hash), generator, start, end, what is said, and the text before and after."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text",
                       *[F.regexp_extract_all("text", F.lit(g.pattern), F.lit(0)).alias(f"m_{n}") for n, g in GENERATORS.items()])
    some = F.greatest(*[F.size(f"m_{n}") for n in GENERATORS])
    rows = rows.where(some > 0).select("*", *[
        F.when(F.size(f"m_{n}") > 0, F.split("text", g.pattern, -1)).alias(f"p_{n}") for n, g in GENERATORS.items()])

    def found(n: str) -> Column:
        piece = lambda i: F.get(F.col(f"p_{n}"), i)
        return F.transform(f"m_{n}", lambda s, i: F.struct(
            F.lit(n).alias("generator"), i.alias("i"), F.length(piece(i)).alias("gap"), s.alias("said"),
            F.right(piece(i), F.lit(40)).alias("before"), F.left(piece(i + 1), F.lit(10)).alias("after")))

    every = F.flatten(F.filter(F.array(*map(found, GENERATORS)), lambda x: x.isNotNull()))
    each = rows.select("doc_id", "h", F.explode(every).alias("c")).select("doc_id", "h", "c.*")
    # Rows that the table holds twice are one document here.
    each = each.dropDuplicates(["doc_id", "h", "generator", "i"])
    upto = F.sum(F.col("gap") + F.length("said")).over(Window.partitionBy("doc_id", "h", "generator").orderBy("i"))
    return each.select("doc_id", "h", "generator", (upto - F.length("said")).alias("start"), upto.alias("end"),
                       "said", "before", "after")


def features(found: DataFrame) -> DataFrame:
    """Adds kind, base (a base pattern's span that passes), seed (a secret by its context or beginning) and the numbers
    that the trees see.

    Signs that a base pattern demands (at, leading plus) are not among them: the trees would learn the pattern.
    """
    kind = F.coalesce(*[F.when(F.col("generator") == n, g.kind) for n, g in GENERATORS.items()])
    strict = F.col("generator").isin([n for n, g in GENERATORS.items() if g.base])
    said, n = F.col("said"), F.length("said")
    share = lambda p: F.regexp_count("said", F.lit(p)) / n
    numbers = {
        "f_length": n, "f_digits": F.length(_digits(said)), "f_digit_share": F.length(_digits(said)) / n,
        "f_letter_share": share("[A-Za-z]"), "f_blank_share": share(" "), "f_dot_share": share(r"\."), "f_dash_share": share("-"),
        "f_round": said.contains("("), "f_colon": said.contains(":"),
        "f_luhn": _luhn(_digits(said)),
        "f_word_before": F.col("before").rlike(r"[\p{L}\p{N}]$"), "f_word_after": F.col("after").rlike(r"^[\p{L}\p{N}]"),
        "f_line_start": F.col("before").rlike(r"(^|\n)\s*$"),
        **{f"f_{c}": F.lower("before").rlike(words) for c, words in CONTEXT.items()},
    }
    rows = found.withColumn("kind", kind).withColumn("base", strict & _passes(kind, said))
    rows = rows.withColumn("seed", (F.col("kind") == "secret") & (F.col("before").rlike(ASSIGNED) | said.rlike(ISSUED)))
    return rows.withColumns({k: v.cast("double") for k, v in numbers.items()})


def beside_base(rows: DataFrame) -> DataFrame:
    """The base spans, and the candidates that overlap none of them."""
    document, before = Window.partitionBy("doc_id", "h"), (Window.unboundedPreceding, -1)
    behind = document.orderBy("start", "end", "generator").rowsBetween(*before)
    # Read backwards: a frame that ends with the last row would be gone through anew for every row.
    ahead = document.orderBy(F.desc("start"), F.desc("end"), F.desc("generator")).rowsBetween(*before)
    own = F.col("base")
    clear = (F.coalesce(F.max(F.when(own, F.col("end"))).over(behind), F.lit(-1)) <= F.col("start")) \
        & (F.coalesce(F.min(F.when(own, F.col("start"))).over(ahead), F.col("end")) >= F.col("end"))
    return rows.withColumn("clear", clear).where("base or clear").drop("clear")


def added(rows: DataFrame, threshold: float = 0.5, least: float = 0.3, rounds: int = 20, depth: int = 4) -> DataFrame:
    """The candidates beside the base spans whose calibrated score reaches the threshold, with that score.

    Fitted on all candidates, in two halves: trees score what the other half was fitted on, so none has seen what it
    judges. Calibrated on all base spans and seeds, per kind. A score of less than `least` before calibration is never enough: it says that
    base spans of the kind look like everything else. Without base spans or without other candidates nothing is added.
    """
    known = F.col("base") | F.col("seed")
    counts = rows.agg(F.count("*"), F.sum(known.cast("int"))).first()
    total, positive = counts[0], counts[1] or 0
    if not positive or positive == total:
        return rows.limit(0).withColumn("score", F.lit(0.0))
    names = [c for c in rows.columns if c.startswith("f_")]
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    fold = F.pmod(F.xxhash64(F.lit(1), "h"), F.lit(2))  # by text: copies are scored by trees that saw none of them
    labelled = store(rows.select("kind", *names, known.cast("double").alias("label"), fold.alias("fold")), "labelled-spans")
    sides = {(r["fold"], r["label"]) for r in labelled.select("fold", "label").distinct().collect()}
    if len(sides) < 4:
        return rows.limit(0).withColumn("score", F.lit(0.0))
    # A third of the features per node: where several tell the spans apart, all have a say, context as well as form.
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, featureSubsetStrategy="onethird", seed=7)
    models = [trees.fit(vectors.transform(labelled.where(F.col("fold") != k))) for k in (0, 1)]

    def scored(df: DataFrame) -> DataFrame:
        parts = [m.transform(vectors.transform(df.where(F.col("fold") == k))) for k, m in enumerate(models)]
        return parts[0].unionByName(parts[1]).withColumn("raw", vector_to_array("probability")[1]) \
            .drop("features", "rawPrediction", "probability", "prediction", "fold")

    held = scored(labelled.where("label = 1")).groupBy("kind").agg(F.avg("raw").alias("mean")).collect()
    means = {r["kind"]: r["mean"] for r in held}  # one row per kind
    usual = sum(means.values()) / len(means) if means else 1.0
    mean = F.coalesce(*[F.when(F.col("kind") == k, F.lit(means.get(k, usual))) for k in KINDS])
    score = F.least(F.lit(1.0), F.col("raw") / F.greatest(mean, F.lit(1e-6)))
    return scored(rows.where("not base").withColumn("fold", fold)).withColumn("score", score) \
        .where((F.col("score") >= threshold) & (F.col("raw") >= least)).drop("raw")


def personal_spans(docs: DataFrame, **options) -> DataFrame:
    """doc_id, h, kind, start, end, base, score: base spans and added ones, of (doc_id, text) without null texts."""
    rows = store(beside_base(features(candidates(docs))), "span-candidates")
    columns = ("doc_id", "h", "kind", "start", "end", "base")
    spans = rows.where("base").select(*columns, F.lit(1.0).alias("score")) \
        .unionByName(added(rows, **options).select(*columns, "score"))
    document = Window.partitionBy("doc_id", "h")
    behind = document.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("base")
    # Added spans that overlap each other are one island, of which the best stays.
    reach = F.max(F.when(~own, F.col("end"))).over(behind)
    spans = spans.withColumn("new", (~own & (F.coalesce(reach, F.lit(-1)) <= F.col("start"))).cast("int"))
    spans = spans.withColumn("island", F.sum("new").over(document.orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, 0)))
    rank = F.row_number().over(Window.partitionBy("doc_id", "h", "base", "island").orderBy(F.desc("score"), F.desc("end"), "start", "kind"))
    return spans.withColumn("rank", rank).where("base or rank = 1").select(*columns, "score")


def find_personal_data(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of docs: counts of base spans by kind, a digest of them, and all spans as text.

    Places are code points, the end exclusive. A null or empty text has no spans; repeated rows each have all theirs.
    """
    texts = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    spans = personal_spans(texts, **options)
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    item = F.struct(F.col("start"), rank.alias("rank"), F.col("end"), F.col("kind"))
    listed = lambda c: F.array_join(F.transform(F.sort_array(c), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    per_doc = store(spans.groupBy("doc_id", "h").agg(
        *[F.sum((F.col("base") & (F.col("kind") == k)).cast("bigint")).alias(f"n_{k}") for k in KINDS[:4]],
        F.collect_list(F.when(F.col("base"), item)).alias("own"), F.collect_list(item).alias("every")), "document-spans")
    d, w = texts.select("doc_id", F.xxhash64("text").alias("h")).alias("d"), per_doc.alias("w")
    joined = d.join(w, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.h") == F.col("w.h")), "left")
    text = lambda c: F.coalesce(listed(F.col(c)), F.lit(""))
    return joined.select("d.doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in KINDS[:4]],
                         F.sha2(text("own"), 256).alias("base_sha256"), text("every").alias("spans"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(common.table(spark, sf_dir, "documents"))
