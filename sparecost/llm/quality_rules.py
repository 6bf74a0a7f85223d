"""Quality rules: counted signals, and the likelihood of a text under trusted against raw n-gram counts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost.llm.common import Scratch

_SPLIT = r"'[\\x20\\x09-\\x0D]+'"
_BLANK = r"' \t\n\u000b\u000c\r'"
REPEAT_WINDOW = 8


def with_words(docs: DataFrame, text_col: str) -> DataFrame:
    """Add __text (null as empty), __words, and __hashes, a 64-bit hash per word."""
    df = docs.withColumn("__text", F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn("__words", F.expr(f"filter(split(__text, {_SPLIT}), w -> w <> '')"))
    return df.withColumn("__hashes", F.expr("transform(__words, w -> xxhash64(w))"))


def _grams(buckets: int) -> str:
    """Buckets of all words and all pairs of neighbours."""
    return (
        f"concat(transform(__hashes, h -> cast(pmod(h, {buckets}) as int)), transform(slice(__hashes, 2, size(__hashes)), "
        f"(h, i) -> cast(pmod(xxhash64(__hashes[i], h), {buckets}) as int)))"
    )


def _let(value: str, name: str, body: str) -> str:
    """SQL in which `name` stands for a value that is computed once per row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def repeat_words() -> str:
    """SQL: words covered by an 8-word window that stands twice or more in the text, the first one included."""
    n = REPEAT_WINDOW
    window = ", ".join(f"__hashes[i + {k}]" for k in range(n))
    windows = f"transform(sequence(0, size(__hashes) - {n}), i -> xxhash64({window}))"
    order = "sort_array(transform(v, (h, i) -> struct(h, i)))"
    starts = "sort_array(transform(filter(o, (x, k) -> coalesce(x.h = get(o, k - 1).h, false) or coalesce(x.h = get(o, k + 1).h, false)), x -> x.i))"
    covered = f"aggregate(transform(s, (a, k) -> least({n}, coalesce(get(s, k + 1) - a, {n}))), 0L, (x, y) -> x + y)"
    found = _let(order, "o", _let(starts, "s", covered))
    return f"case when size(__hashes) < {n + 1} then 0L else " + _let(windows, "v", f"case when size(array_distinct(v)) = size(v) then 0L else {found} end") + " end"


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: int) -> list[float]:
    """Per bucket the log of its share in trusted texts over its share in all texts.

    All documents are counted, with partial sums over a fixed number of buckets; the driver gets one row per bucket. The
    trusted counts are shrunk towards the raw ones by as many pseudo-counts as there are buckets, so without trusted
    texts all ratios are 0.
    """
    marked = docs.join(
        F.broadcast(trusted.select(F.col(trusted.columns[0]).alias("__trusted"))), F.col(id_col) == F.col("__trusted"), "left"
    ).select(text_col, F.col("__trusted").isNotNull().cast("long").alias("__target"))
    grams = with_words(marked, text_col).select("__target", F.explode(F.expr(_grams(buckets))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("__target").alias("target")).collect()
    all_raw, all_target = sum(r["raw"] for r in counts), sum(r["target"] for r in counts)
    ratios = [0.0] * buckets
    for r in counts:
        share = r["raw"] / all_raw
        ratios[r["bucket"]] = math.log((r["target"] + buckets * share) / ((all_target + buckets) * share))
    return ratios


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 1 << 14,
    threshold: float = -0.1, trusted_rows: int = 50_000,
) -> DataFrame:
    """Counted signals of every document and a verdict by n-gram likelihood ratio.

    The trusted target is the text of documents labelled with quality 1: at most `trusted_rows` ids, those with the
    smallest hash, which bounds what is broadcast. Words and pairs of words are hashed to `buckets` buckets. The score is
    the mean over all n-grams of a document of log(trusted share / raw share); a document is kept if it passes the base
    rules and its score is at least `threshold`.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept, one row per row
    given. Null and empty texts have no words and fail the base rules; their score is 0. Texts may be of any length. Repeated
    rows are scored alike, and each counts. Other columns are not read, so their names cannot clash. No rows give no rows.
    """
    trusted = (
        labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_rows).select("doc_id")
    )
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = log_ratios(own, trusted, "doc_id", "text", buckets)
    ratios = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    found = with_words(own, "text").select(
        "doc_id",
        F.expr("cast(size(__words) as long)").alias("n_words"),
        F.expr(f"cast(length(translate(__text, {_BLANK}, '')) as long)").alias("word_chars"),
        F.expr("cast(length(__text) - length(translate(__text, '#*$%&|<>', '')) as long)").alias("n_symbols"),
        F.expr(_let(f"filter(split(__text, '\\n'), l -> translate(l, {_BLANK}, '') <> '')", "ls", "cast(size(ls) - size(array_distinct(ls)) as long)")).alias("n_dup_lines"),
        F.expr(repeat_words()).alias("n_repeat_words"),
        F.expr(_grams(buckets)).alias("__grams"),
    )
    total = F.aggregate("__grams", F.lit(0.0), lambda a, b: a + F.get(ratios, b))
    found = found.withColumn("score", F.when(F.size("__grams") == 0, 0.0).otherwise(total / F.size("__grams")))
    found = found.withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))
    found = found.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).drop("__grams")
    # stored, as a filter on the verdict would be pushed below the arrays of words and compute them for every word again
    return Scratch(docs.sparkSession, "rules").keep(found, "result")
