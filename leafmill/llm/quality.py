"""Quality rules [native]: counts of each text, and a log-likelihood ratio of hashed n-grams.

Two multinomials over BUCKETS hashed 1- and 2-grams of lower-cased words are counted: one over every
row of the raw corpus, one over the trusted target (documents labelled as good). A document's score
is the mean over its n-grams of log p_target - log p_raw; it is kept if no base rule fails and the
score is at least THRESHOLD. All of it is DataFrame expressions; the only table that reaches the
driver has BUCKETS rows.

Null or empty texts have no words: all counts 0, base_failed true, kept false, score 0. Repeated
rows are scored row by row, each alike. Without any trusted document every weight is 0 and the base
rules alone decide. Other columns of the input pass through unless they have the name of a result
column, which then wins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.shared import WS, packed, unpacked, whole_text

#: Hash buckets of the two multinomials.
BUCKETS = 16384
#: Documents of the trusted target at most: those whose hashed id is least. A bounded fit, the same at every size.
TRUSTED = 20000
#: Added to each bucket's count, as a share of the mean count.
SMOOTHING = 0.05
#: Least score of a document that is kept.
THRESHOLD = -0.04

RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def ngram_buckets(lower_words: Column) -> Column:
    """Bucket of each 1-gram and 2-gram, in no particular order."""
    at = lambda i: F.get(lower_words, i)
    bucket = lambda *w: F.pmod(F.xxhash64(*w), F.lit(BUCKETS)).cast("int")
    two = F.when(F.size(lower_words) >= 2, F.transform(F.sequence(F.lit(0), F.greatest(F.size(lower_words) - 2, F.lit(0))), lambda i: bucket(at(i), at(i + 1)))).otherwise(F.array().cast("array<int>"))
    return F.concat(F.transform(lower_words, lambda w: bucket(w)), two)


def repeat_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are sorted with their places, so that equal ones are neighbours; the places kept are
    sorted again, and each adds the words that the one before it doesn't cover.
    """
    grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(_covered(grams)).cast("long")


def _covered(grams: Column) -> Column:
    # The arrays are bound by one-element transforms, so that each is computed once for a row.
    def bind(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def starts(sorted_grams: Column) -> Column:
        same = lambda i, j: F.get(sorted_grams, i)["h"] == F.get(sorted_grams, j)["h"]
        keep = F.filter(
            F.transform(
                sorted_grams,
                lambda g, i: F.when(F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)), g["i"]),
            ),
            lambda p: p.isNotNull(),
        )
        return bind(F.sort_array(keep), lambda p: F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"]))

    return bind(
        grams,
        lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(
            bind(F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), starts)
        ),
    )


def trusted_ids(labelled: DataFrame, limit: int = TRUSTED) -> DataFrame:
    """doc_id of at most `limit` rows with quality 1, least hashed ids first."""
    good = labelled.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labelled: DataFrame, limit: int = TRUSTED) -> list[float]:
    """Weight of each bucket: log p_target - log p_raw, from every document."""
    target = F.broadcast(trusted_ids(labelled, limit).withColumn("t", F.lit(1)))  # at most `limit` ids
    counts = (
        docs.select("doc_id", F.lower(whole_text()).alias("text"))
        .join(target, "doc_id", "left")
        .select("t", words(F.col("text")).alias("w"))  # a column of its own: an expression would be computed for each n-gram
        .select("t", F.explode(ngram_buckets(F.col("w"))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("t").alias("target"))
        .collect()
    )
    raw, trusted = [0] * BUCKETS, [0] * BUCKETS
    for r in counts:
        raw[r["bucket"]], trusted[r["bucket"]] = r["raw"], r["target"]
    if not sum(trusted):
        return [0.0] * BUCKETS

    def logs(counted: list[int]) -> list[float]:
        total = sum(counted)
        add = SMOOTHING * total / BUCKETS
        return [math.log((c + add) / (total + add * BUCKETS)) for c in counted]

    return [round(t - r, 6) for t, r in zip(logs(trusted), logs(raw), strict=True)]


def judged(docs: DataFrame, weights: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """`row` (the columns of docs) and the columns RESULT."""
    table = F.expr(f"cast(split('{','.join(f'{x:g}' for x in weights)}', ',') as array<float>)")  # folds to one literal
    grams = F.col("grams")
    rows = (
        docs.select(packed(docs), whole_text().alias("text"))
        .select("row", "text", words(F.col("text")).alias("w"), words(F.lower("text")).alias("lower"))
        .select(
            "row",
            F.size("w").cast("long").alias("n_words"),
            F.length(F.translate("text", WS, "")).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            _dup_lines(F.col("text")).alias("n_dup_lines"),
            repeat_words(F.col("w")).alias("n_repeat_words"),
            ngram_buckets(F.col("lower")).alias("grams"),
        )
    )
    score = F.coalesce(F.aggregate(grams, F.lit(0.0), lambda a, b: a + F.get(table, b).cast("double")) / F.nullif(F.size(grams), F.lit(0)), F.lit(0.0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("score", F.round(score, 9)).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).drop("grams")


def apply_rules(docs: DataFrame, weights: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """docs with the columns RESULT."""
    others = [x for x, c in zip(unpacked(docs.columns), docs.columns, strict=True) if c.lower() not in RESULT]
    return judged(docs, weights, threshold).select(*others, *RESULT)


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, WS, "")) > 0)
    return F.element_at(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), 1).cast("long")


def score_quality(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    return apply_rules(docs, fit(docs, labelled))


def keep(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with their columns.

    The task number holds the filter above the projection that computes the verdict: pushed below it,
    each lambda of the rules would compute the arrays that it reads anew.
    """
    held = judged(docs, fit(docs, labelled)).select("row", "kept", F.spark_partition_id().alias("task"))
    return held.where("kept and task >= 0").select(*unpacked(docs.columns))
