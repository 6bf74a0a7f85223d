"""Benchmark decontamination against brute force."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from sparecost.llm import positional_index as index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def windows(text, n):
    w = words(text)
    return [w[k:k + n] for k in range(max(1, len(w) - n + 1))] if w else []


def expected(rows, tests, n):
    out, known = [], [(item, tuple(window)) for item, test in tests for window in windows(test, n)]
    sizes = {len(window) for _, window in known}
    for i, text in rows:
        w, hit, items, places = words(text), set(), set(), defaultdict(list)
        for size in sizes:
            for k in range(len(w) - size + 1):
                places[tuple(w[k:k + size])].append(k)
        for item, window in known:
            for k in places.get(window, ()):
                hit |= set(range(k, k + len(window)))
                items.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), tuple(sorted(items)), bool(hit)))
    return Counter(out)


def sample_tests(texts):
    by = dict(texts)
    passage = " ".join(by[20].split()[35:60])
    return [
        (1, passage), (2, "x " + passage.upper() + " y"), (10, None), (11, ""), (12, "--- !!!"), (3, "Hello, WORLD"), (3, "na"), (None, "é€ß"),
        (4, " ".join(by[100].split()[5:17])), (5, " ".join(by[7].split()[100:5200])), (6, "w0 nowhere w7919"), (7, passage), (7, passage), (8, "same line, same")]


@pytest.mark.parametrize("block,group", [(1 << 22, 1 << 22), (500, 20_000)])
def test_contamination(spark, docs, texts, block, group):
    tests = sample_tests(texts)
    table = spark.createDataFrame([(i, t, 1, 2, None) for i, t in tests], "item_id long, text string, __row int, doc_id int, spans string")
    found = index.contamination(docs, table, block_bytes=block, group_bytes=group).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found) == expected(texts, tests, 10)
    assert all(r.n_hit == sum(s.b - s.a for s in r.spans) and all(x.b < y.a for x, y in zip(r.spans, r.spans[1:])) for r in found)


def test_repeated_rows_and_null_ids(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (1, "a b c d"), (1, "x a b"), (2, None), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tests = [(1, "B c"), (1, "a B c"), (2, "q")]
    found = index.contamination(docs, spark.createDataFrame(tests, "item_id long, text string"), window=3).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found) == expected(rows, tests, 3)


def test_empty_tables(spark, nothing, docs, texts):
    tests = spark.createDataFrame(sample_tests(texts), "item_id long, text string")
    assert index.contamination(nothing, tests).count() == 0 and index.find_phrases(nothing, tests).count() == 0
    found = index.contamination(docs, tests.limit(0)).collect()
    assert len(found) == len(texts) and not any(r.contaminated for r in found)


def in_order(w, window, slop):
    """Shortest in-order occurrences that hold no other one, by brute force over all first and last places."""
    def fits(a, b):
        at = a
        for term in window[1:-1]:
            at = next((k for k in range(at + 1, b) if w[k] == term), None)
            if at is None:
                return False
        return True

    last = len(window) - 1
    pairs = [(a, b) for a in range(len(w)) for b in range(a + last, len(w)) if w[a] == window[0] and w[b] == window[-1] and (last or a == b) and fits(a, b)]
    tight = [p for p in pairs if not any(q != p and p[0] <= q[0] and q[1] <= p[1] for q in pairs)]
    return [(a, b) for a, b in tight if b - a + 1 <= len(window) + slop]


def test_candidates_in_portions(monkeypatch):
    """Few candidates at a time give the matches of all at once."""
    random.seed(4)
    rows = [" ".join(random.choice("abc") for _ in range(60)) for _ in range(5)]
    block = index._block(list(range(5)), list(range(5)), pa.int64(), [w for t in rows for w in index.words_of(t)], [0, 60, 120, 180, 240, 300])
    phrases = index.phrases_of([("i", 0, b"a b c a b a c b a b c c a"), ("j", 0, b"b b a")], 3)
    lists = index._Lists(block.to_pylist()[0], phrases.vocabulary)

    def every(slop):
        return sorted(zip(*[part.tolist() for part in index._search(lists, phrases, slop)]))

    whole = [every(slop) for slop in (0, 2)]
    monkeypatch.setattr(index, "_CANDIDATES", 30)
    assert [every(slop) for slop in (0, 2)] == whole and len(whole[0]) > 20


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_proximity(spark, slop):
    random.seed(slop)
    rows = [(i, " ".join(random.choice("abcd") for _ in range(random.randint(0, 25)))) for i in range(40)]
    tests = [(100 + i, " ".join(random.choice("abcd") for _ in range(random.randint(1, 6)))) for i in range(12)]
    want = Counter()
    for i, text in rows:
        for item, test in tests:
            for begin, window in enumerate(windows(test, 3)):
                want.update((i, str(item), begin, a, b) for a, b in in_order(words(text), window, slop))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = index.find_phrases(docs, spark.createDataFrame(tests, "item_id long, text string"), window=3, slop=slop).collect()
    assert Counter(map(tuple, found)) == want


def test_tasks_hold_few_blocks(spark, tmp_path):
    """Row groups of the index and the batches of workers do not grow with the rows of a task."""
    docs = spark.createDataFrame([(i, f"w{i} x y z") for i in range(60)], "doc_id long, text string").coalesce(1)
    scratch = index.Scratch(spark, "few")
    stored = index._stored(index.build_index(docs, block_bytes=1), scratch)
    group = spark.sparkContext._jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    sizes = [b.getRowCount() for f in stored.inputFiles() for b in group(conf, path(f)).getBlocks()]
    assert sum(sizes) == 60 and max(sizes) <= index._GROUP

    given, rows = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"), spark.range(1000).selectExpr("repeat('x', 1000) AS t").coalesce(1)
    with index.small_batches(spark, 100_000):
        found = rows.mapInArrow(lambda batches: (b.select([]).from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
    assert sum(r.n for r in found) == 1000 and max(r.n for r in found) < 200
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == given
