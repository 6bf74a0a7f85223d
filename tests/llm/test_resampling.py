"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparecost.llm import resampling
from sparecost.llm.common import Scratch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, target, buckets=10_000, percent=25, seed=7):
    """(doc_id, n_features, weight, score, rank) per row."""
    def features(text):
        w = WORD.findall((text or "").translate(LOWER))
        return [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]], len(w)

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[0])
    for text in target:
        t.update(features(text)[0])
    total, wanted = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        found, n = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


TARGET = ["w1 w2 W3 w7919", None, "", "w15838 w23757 é"]


@pytest.mark.parametrize("percent,buckets", [(25, 10_000), (100, 16), (1, 16), (60, 10_000)])
def test_draw(spark, docs, texts, percent, buckets):
    target = spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")
    found = resampling.resample(docs, target, percent=percent, buckets=buckets).collect()
    assert Counter(map(tuple, found)) == expected(texts, TARGET, buckets, percent)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(None, text), (None, text), (3, text), (3, text), (3, text + " more"), (4, None), (5, "Zwölf ÄÖ 12ab_c")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, score long, __row int").repartition(3)
    target = spark.createDataFrame([(0, "word1 word2")], "item_id long, text string")
    found = resampling.resample(docs, target, percent=70).collect()
    # equal rows may take each other's ranks, so they are compared as sets of rows
    assert Counter(map(tuple, found)) == expected(rows, ["word1 word2"], percent=70)


def test_empty_tables(spark, nothing, docs):
    target = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(nothing, target).count() == 0
    found = resampling.resample(docs, target).collect()
    assert len(found) == docs.count() and any(r["rank"] == 1 for r in found)


@pytest.mark.parametrize("rank", [1, 2, 400, 999, 1000])
def test_bracket_holds_the_rank(spark, rank):
    """Ties, and a sketch so coarse that the first bracket has to be widened."""
    scores = spark.range(1000).select((F.col("id") % 7 * F.col("id") % 50).alias("score"))
    ordered = sorted((r["score"] for r in scores.collect()), reverse=True)
    low, high, above = resampling.bracket(scores, "score", rank, 1000, accuracy=5, error=1e-4)
    assert (low is None or low <= ordered[rank - 1]) and (high is None or ordered[rank - 1] <= high)
    assert above == sum(s > high for s in ordered) if high is not None else above == 0


def test_numbering_is_gapless(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("score"), F.col("id").alias("doc_id")).repartition(7)
    ordered, before = resampling.numbered(rows, Scratch(spark, "numbers"), "n", F.col("score").desc(), F.col("doc_id").asc())
    found = ordered.withColumn("rank", resampling._place(before)).orderBy("rank").collect()
    assert [r["rank"] for r in found] == list(range(1, 501))
    assert [(r["score"], r["doc_id"]) for r in found] == sorted(((i % 3, i) for i in range(500)), key=lambda x: (-x[0], x[1]))
