"""Resampling of a corpus towards a target distribution: importance weights of hashed n-grams, and an exact draw by score.

Weights come from two arrays of counts of fixed length (corpus and target); texts are read twice and never shuffled.
The draw needs the k-th highest score. A quantile sketch brackets it, exact counts on both sides prove the bracket or
widen it, and only the rows inside the bracket are sorted to find the cutoff.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost.llm.common import Scratch, task

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_crc = zlib.crc32
_SHIFT = 33  # monotonically_increasing_id: partition above, place within it below


def words_of(text: str | None) -> list[bytes]:
    """Words of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z became a-z, as UTF-8; bytes.lower touches A-Z only."""
    return _WORD.findall(text.encode().lower()) if text else []


def feature_hashes(words: list[bytes]) -> list[int]:
    """crc32 of every word and of every two neighbours joined by a space."""
    single = [_crc(w) for w in words]
    return single + [_crc(w, _crc(b" ", before)) for before, w in zip(single, words[1:])]


def _counts(batches, buckets: int):
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for text in batch.column("__text"):
            found = np.array(feature_hashes(words_of(text.as_py())), np.int64)
            total += np.bincount(found % buckets, minlength=buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Features of all rows per bucket: at most `buckets` rows leave a task, and as many reach the driver."""
    parts = texts.select("__text").mapInArrow(task(_counts, buckets), "bucket int, n long")
    total = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def gains_of(raw: np.ndarray, target: np.ndarray) -> list[int]:
    """Per bucket the floored thousandfold logarithm of its share in the target over its share in the corpus, add-one smoothed."""
    buckets, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    return [
        math.floor(1000 * math.log((t + 1.0) * (all_raw + buckets) / ((s + 1.0) * (all_target + buckets))))
        for s, t in zip(raw.tolist(), target.tolist())
    ]


def _weights(batches, gains: np.ndarray):
    buckets = len(gains)
    for batch in batches:
        words, features, weights = [], [], []
        for text in batch.column("__text"):
            found = words_of(text.as_py())
            hashes = np.array(feature_hashes(found), np.int64)
            words.append(len(found))
            features.append(len(hashes))
            weights.append(int(gains[hashes % buckets].sum()) // len(hashes) if len(hashes) else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("__row"), batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in (words, features, weights)]],
            names=["__row", "doc_id", "__words", "n_features", "weight"])


def noise(id_col: str, seed: int) -> Column:
    """Floored thousandfold Gumbel noise from the id alone; a null id counts as no characters."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(uniform))).cast("long")


def score_documents(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    buckets: int = 10_000, seed: int = 7,
) -> DataFrame:
    """__row, doc_id, __words, n_features, weight and score of every document; `target` gives the wanted distribution."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text")).withColumn("__row", F.monotonically_increasing_id())
    raw = bucket_counts(texts, buckets)
    wanted = bucket_counts(target.select(F.col(target_col).alias("__text")), buckets)
    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = texts.mapInArrow(
        task(_weights, np.array(gains_of(raw, wanted), np.int64)),
        f"__row long, doc_id {kind}, __words long, n_features long, weight long")
    return scored.withColumn("score", F.col("weight") + noise("doc_id", seed))


def bracket(scores: DataFrame, column: str, rank: int, rows: int, accuracy: int = 10_000, error: float = 2e-4):
    """Two values between which the rank-th highest value lies, and how many are above: (low, high, rows above high).

    A mergeable quantile sketch proposes them. Exact counts then decide: if the rank is not within, both sides move out by
    twice the distance, until they hold it; beyond the first or last value a side is open (None).
    """
    share = 1.0 - rank / rows
    while True:
        ends = [max(0.0, share - error), min(1.0, share + error)]
        low, high = scores.agg(F.percentile_approx(column, ends, accuracy)).first()[0]
        low, high = (None if ends[0] <= 0.0 else low), (None if ends[1] >= 1.0 else high)
        beyond = F.lit(False) if high is None else F.col(column) > high
        inside = F.lit(True) if low is None else F.col(column) >= low
        above, reached = scores.agg(F.count_if(beyond), F.count_if(inside)).first()
        if above < rank <= reached:
            return low, high, above
        error *= 2


def numbered(rows: DataFrame, scratch: Scratch, name: str, *order: Column) -> tuple[DataFrame, list[int]]:
    """Rows sorted over all partitions and stored with their place, and the number of rows before each partition.

    The sort is by ranges, so a frequent value that later columns tell apart is spread. One count per partition reaches the
    driver.
    """
    # as an expression of the sorted rows: the partition and the place in it follow the order
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    ordered = scratch.keep(ordered, name)
    counts = dict(ordered.groupBy(F.shiftright("__at", _SHIFT).cast("int").alias("part")).count().collect())
    before = [0]
    for part in range(max(counts, default=-1) + 1):
        before.append(before[-1] + counts.get(part, 0))
    return ordered, before


def _place(before: list[int]) -> Column:
    starts = F.split(F.lit(",".join(map(str, before))), ",").cast("array<long>")
    return F.get(starts, F.shiftright("__at", _SHIFT).cast("int")) + F.col("__at").bitwiseAND((1 << _SHIFT) - 1) + 1


def draw(scored: DataFrame, scratch: Scratch, percent: int, min_words: int) -> DataFrame:
    """Add `rank` to stored rows of score_documents: 1, 2, ... for the drawn ones by falling score, null for the others."""
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("__row").asc())
    able = scored.filter(F.col("__words") >= min_words)
    rows = able.count()
    wanted = percent * rows // 100
    undrawn = scored.withColumn("rank", F.lit(None).cast("long"))
    if not wanted:
        return undrawn
    low, high, above = bracket(able, "score", wanted, rows)
    inside = able if low is None else able.filter(F.col("score") >= low)
    inside = inside if high is None else inside.filter(F.col("score") <= high)
    ordered, before = numbered(inside.select("score", "doc_id", "__row"), scratch, "bracket", *order)
    part = next(i for i in range(len(before) - 1) if before[i + 1] >= wanted - above)
    last = ordered.filter(F.col("__at") == (part << _SHIFT) + wanted - above - before[part] - 1).first()

    score, doc_id, row = F.col("score"), F.col("doc_id"), F.lit(last["__row"])
    if last["doc_id"] is None:
        smaller, equal = F.lit(False), doc_id.isNull()
    else:
        smaller, equal = doc_id.isNull() | (doc_id < F.lit(last["doc_id"])), F.coalesce(doc_id == F.lit(last["doc_id"]), F.lit(False))
    tied = smaller | (equal & (F.col("__row") <= row))
    drawn = (F.col("__words") >= min_words) & ((score > last["score"]) | ((score == last["score"]) & tied))
    ranked, starts = numbered(scored.filter(drawn), scratch, "drawn", *order)
    return ranked.withColumn("rank", _place(starts)).drop("__at").unionByName(undrawn.filter(~drawn))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    buckets: int = 10_000, seed: int = 7, percent: int = 25, min_words: int = 20,
) -> DataFrame:
    """Draw `percent` of the documents with `min_words` words or more towards the distribution of the target texts.

    Returns doc_id, n_features, weight, score and rank (null if not drawn), one row per row given. Other columns of the
    tables are not read, so their names cannot clash. Null and empty texts have no features and weight 0. Texts are taken
    whole, of any length. Equal scores rank by the smaller id, null first; rows that share both rank in an order that is
    fixed once they are scored. An empty target or corpus counts as no features; without able rows nothing is drawn.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    scored = scratch.keep(score_documents(docs, target, id_col, text_col, target_col, buckets, seed), "scored")
    found = draw(scored, scratch, percent, min_words).select("doc_id", "n_features", "weight", "score", "rank")
    return scratch.done(found, "scored", "bracket", "drawn")
