"""The document operators against brute force on a small table with ties, nulls, empty and long texts."""

import array
import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash

from sparecost.llm import exact_dedup, jaccard_join, packing, phrase_dedup, quality_cnn, quality_rules, sharding, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def normal(text):
    return (text or "").translate(LOWER)


@pytest.mark.parametrize("hash_bits", [64, 3])
def test_exact(docs, texts, hash_bits):
    groups = defaultdict(list)
    for i, t in texts:
        groups[normal(t)].append(i)
    expected = {
        i: (max(g := groups[normal(t)]), len(g), i == max(g), hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in texts}
    found = exact_dedup.exact_dedup(docs, bits=6, hash_bits=hash_bits).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found} == expected and len(found) == len(texts)


def test_exact_without_ids(no_ids):
    found = exact_dedup.exact_dedup(no_ids).collect()
    assert len(found) == 4 and all(r.keep_id is None and r.kept and r.group_size == 2 for r in found)


def components(texts, n, percent):
    sets = {}
    for i, t in texts:
        w = WORD.findall(normal(t))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("n,percent,boundary", [(3, 90, None), (3, 90, 60), (3, 90, 10 ** 6), (5, 80, None), (1, 80, 12)])
def test_jaccard(docs, texts, n, percent, boundary):
    found = jaccard_join.jaccard_components(docs, n, percent, boundary=boundary).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components(texts, n, percent)


def test_postings_are_shuffled_once(spark):
    """The lists and their join use one exchange of the postings, and return the rows of lists that hold more than one set."""
    rows = [(i, bytearray([65 + i]), 5, [1, 2, 10 + i], [i, 1, 2], None) for i in range(4)] + [(9, bytearray(b"z"), 5, [99], [0], None)]
    schema = "doc_id long, node binary, n int, signatures array<long>, places array<int>, sketch array<long>"
    found = jaccard_join._shared(spark.createDataFrame(rows, schema))
    assert Counter((r.sig, bytes(r.node), r.pos, bytes(r.h_node)) for r in found.collect()) == Counter(
        (sig, bytes([65 + i]), i if sig == 1 else 1, b"A") for sig in (1, 2) for i in (1, 2, 3))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = jaccard_join._shared(spark.createDataFrame(rows, schema))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(re.findall("[+:]- Exchange hashpartitioning", plan)) == 1 and "ReusedExchange" in plan


def test_jaccard_boundary_follows_cost():
    sizes = [0] * 10 + [5] * 200
    import numpy as np

    assert jaccard_join.choose_boundary(np.array(sizes), 90, 1.0) < jaccard_join.choose_boundary(np.array(sizes), 90, 30.0)


def test_shards(docs, texts):
    found = sharding.shard_documents(docs, 7, bucket_bytes=5000).collect()
    again = sharding.shard_documents(docs, 7, bucket_bytes=5000).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in found} == {(r.doc_id, r.shard, r.slot) for r in again}
    slots = defaultdict(list)
    for r in found:
        raw = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        slots[r.shard].append(r.slot)
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in texts) and len(slots) == 7
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert [r.doc_id for r in sorted(found, key=lambda r: (r.shard, r.slot))] != sorted(i for i, _ in texts)


def test_written_shards_keep_their_order(docs, texts, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(sharding.shard_documents(docs, 5, bucket_bytes=5000), path)
    back = docs.sparkSession.read.parquet(path).collect()
    assert Counter(r.doc_id for r in back) == Counter(i for i, _ in texts) and {r.shard for r in back} == set(range(5))


def test_every_bucket_is_its_own_partition(docs, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(sharding, "_GROUP", 3)
    rows = docs.select("doc_id", "text", F.lit(10).alias("size"))
    order = sharding.shuffled(rows, ["doc_id"], F.col("size"), bucket_bytes=60)
    found = order.withColumn("part", F.spark_partition_id()).select("bucket", "part").distinct().collect()
    assert len(found) > 10 and all(r.bucket == r.part for r in found)
    before = {r.bucket: (r.before, r.total) for r in sharding._before(order).collect()}
    counts = {r["bucket"]: r["count"] for r in order.groupBy("bucket").count().collect()}
    assert before == {b: (sum(n for c, n in counts.items() if c < b), sum(counts.values())) for b in counts}


def test_shards_keep_repeated_rows(docs, texts):
    found = sharding.shard_documents(docs.union(docs), 3).collect()
    assert Counter(r.doc_id for r in found) == {i: 2 for i, _ in texts}


def test_suffixes(docs, texts):
    first, expected = set(), {}
    for i, t in sorted(texts):
        raw = (t or "").encode()
        covered = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if raw[k:k + 100] in first:
                covered[k:k + 100] = b"\1" * 100
            first.add(raw[k:k + 100])
        rest = bytes(b for b, c in zip(raw, covered) if not c)
        expected[i] = (len(raw), len(raw) - len(rest), len(re.findall(b"\1+", bytes(covered))), hashlib.sha256(rest).hexdigest())
    for bits in (22, 26):
        found = suffix_dedup.suffix_dedup(docs, bits=bits).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == expected


def shared_ids(texts):
    """Repeated rows, rows that share an id with other texts, and null ids, beside the texts."""
    by = dict(texts)
    long = "".join(f"{i:03d}" for i in range(120))
    return texts + [(20, by[20]), (20, by[20]), (7, by[7]), (21, "z " + by[22]), (300, long), (300, long), (300, long + long), (301, long), (None, long), (None, by[20])]


def brute_suffixes(rows, length=100):
    """Per row (id, bytes, removed, runs, hash): a string counts if a smaller id, or the row itself earlier, has it."""
    least, out = {}, []
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - length + 1) if i is not None else ():
            w = raw[k:k + length]
            least[w] = min(least.get(w, i), i)
    for i, t in rows:
        raw, own = (t or "").encode(), set()
        covered = bytearray(len(raw))
        for k in range(len(raw) - length + 1) if i is not None else ():
            w = raw[k:k + length]
            if least[w] < i or w in own:
                covered[k:k + length] = b"\1" * length
            own.add(w)
        rest = bytes(b for b, c in zip(raw, covered) if not c)
        out.append((i, len(raw), len(raw) - len(rest), len(re.findall(b"\1+", bytes(covered))), hashlib.sha256(rest).hexdigest()))
    return Counter(out)


def test_suffixes_of_rows_that_share_an_id(spark, texts):
    rows = shared_ids(texts)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix_dedup.suffix_dedup(table, bits=22).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == brute_suffixes(rows)


def test_phrases_of_rows_that_share_an_id(spark, texts):
    rows, least, expected = shared_ids(texts), {}, []
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - 12) if i is not None else ():
            least[tuple(w[k:k + 13])] = min(least.get(tuple(w[k:k + 13]), i), i)
    for i, t in rows:
        w = WORD.findall(t or "")
        covered = [False] * len(w)
        for k in range(len(w) - 12) if i is not None else ():
            if least[tuple(w[k:k + 13])] < i:
                covered[k:k + 13] = [True] * 13
        rest = [x for x, c in zip(w, covered) if not c]
        expected.append((i, len(w), len(w) - len(rest), hashlib.sha256(" ".join(rest).encode()).hexdigest()))
    found = phrase_dedup.phrase_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), bits=22).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == Counter(expected)


def test_phrases_with_equal_hashes_are_told_apart(monkeypatch):
    import numpy as np

    from sparecost.llm import grams

    monkeypatch.setattr(grams, "window_hash", lambda values, n: np.zeros(max(0, len(values) - n + 1), np.uint64))
    words, ends = np.array([1, 2, 3, 4, 1, 2, 9, 9, 2, 3, 4, 1]), np.array([3, 6, 8, 12])
    phrases = phrase_dedup.recurring_phrases(np.array([5, 6, 7, 8]), words, ends, 2)
    assert phrases == {(1, 2): 5, (2, 3): 5, (4, 1): 6}
    letters = phrase_dedup.Letters(10)
    assert [(end, doc) for end, doc in phrase_dedup.automaton(phrases, letters).iter(letters.text(words))] == [(3, 5), (5, 5), (9, 6), (11, 5), (19, 5), (23, 6)]


def test_phrases(docs, texts):
    first, expected = {}, {}
    for i, t in sorted(texts):
        w = WORD.findall(t or "")
        covered = [False] * len(w)
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k:k + 13]), i) < i:
                covered[k:k + 13] = [True] * 13
        rest = [x for x, c in zip(w, covered) if not c]
        expected[i] = (len(w), len(w) - len(rest), hashlib.sha256(" ".join(rest).encode()).hexdigest())
    found = phrase_dedup.phrase_dedup(docs, bits=22).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == expected


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def expected_scores(rows, trusted, buckets):
    """Mean log ratio of hashed words and pairs of words, as the engine's 64-bit hash gives them."""
    def grams(text):
        h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in WORD.findall(text or "")]
        chained = [signed(xxhash.xxh64_intdigest(struct.pack("<q", b), xxhash.xxh64_intdigest(struct.pack("<q", a), 42))) for a, b in zip(h, h[1:])]
        return [x % buckets for x in h + chained]

    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        target.update(grams(t) if i in trusted else [])
    all_raw, all_target = sum(raw.values()), sum(target.values())
    ratio = {b: math.log((target[b] + buckets * (n / all_raw)) / ((all_target + buckets) * (n / all_raw))) for b, n in raw.items()}
    return [sum(ratio[g] for g in grams(t)) / len(grams(t)) if grams(t) else 0.0 for _, t in rows]


def test_rules(docs, texts, labels):
    buckets = 512
    scores = dict(zip([i for i, _ in texts], expected_scores(texts, {7, 8, 100}, buckets)))
    found = {r.doc_id: r for r in quality_rules.quality_rules(docs, labels, buckets=buckets).collect()}
    assert len(found) == len(texts)
    for i, t in texts:
        text = t or ""
        w, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        places = defaultdict(list)
        for k in range(len(w) - 7):
            places[tuple(w[k:k + 8])].append(k)
        repeat = len({x for p in places.values() if len(p) > 1 for k in p for x in range(k, k + 8)})
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), repeat)
        assert r.base_failed == (len(w) < 20 or 100 * repeat > 30 * len(w))
        assert r.score == pytest.approx(scores[i], abs=1e-9) and r.kept == (not r.base_failed and scores[i] >= -0.1)


def test_rules_of_repeated_rows(spark, texts, labels):
    rows = texts + texts[6:12] + [(None, texts[10][1])]
    found = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), labels, buckets=512).collect()
    want = Counter((i, round(s, 9)) for (i, _), s in zip(rows, expected_scores(rows, {7, 8, 100}, 512)))
    assert Counter((r.doc_id, round(r.score, 9)) for r in found) == want


def test_rules_without_labels(docs, labels):
    assert all(r.score == 0 for r in quality_rules.quality_rules(docs, labels.limit(0)).collect())


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    tokenizer, capacity = Tokenizer.from_file(BPE), 64
    found = packing.pack_documents(docs, BPE, capacity).collect()
    by, bins = defaultdict(list), defaultdict(list)
    for r in found:
        by[r.doc_id].append(r), bins[r.sequence_id].append(r)
    for i, t in texts:
        ids, at = tokenizer.encode(t or "", add_special_tokens=False).ids + [0], 0
        for k, r in enumerate(sorted(by[i], key=lambda r: r.piece)):
            part = ids[at:at + r.length]
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity) and r.ids_crc32 == zlib.crc32(array.array("I", part).tobytes())
            at += r.length
        assert at == len(ids)
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert len(bins) <= 1.02 * sum(r.length for r in found) / capacity


def test_words_in_use_stay_in_a_full_cache(monkeypatch):
    """Words of several ids that every batch holds are encoded once, however many others pass; ids are those of whole texts."""
    monkeypatch.setattr(packing, "_CACHED", 40)
    encoder, asked = packing.WordEncoder(BPE), Counter()
    new = encoder._new
    monkeypatch.setattr(encoder, "_new", lambda words: (asked.update(words), new(words))[1])
    for k in range(20):
        texts = [f"a Zyxqwv{j}kjhgf " + " ".join(f"q{k}x{i}z" for i in range(20)) + f" Zyxqwv{j}kjhgf" for j in range(5)] + ["", "one", " b", "two  spaces "]
        assert encoder.encode(texts) == [e for t in texts for e in encoder._ids([t])]
    assert all(asked[f"Zyxqwv{j}kjhgf"] == 1 for j in range(5))
    assert encoder.encode([]) == [] and encoder.encode([""]) == [b""]


def test_tokenizer_gets_few_texts_at_once(monkeypatch):
    """What the tokenizer makes of many texts, all of odd spaces or of new words, never stands in memory together; ids stay those of each text."""
    encoder, given = packing.WordEncoder(BPE), []
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda texts: (given.append(len(texts)), encode(texts))[1])
    texts = [f"two  spaces {i}" for i in range(50)] + [" ".join(f"q{i * 1000 + j}x" for j in range(400)) for i in range(20)]
    assert encoder.encode(texts) == [encoder._ids([t])[0] for t in texts]
    assert max(given) <= packing._TOGETHER


def test_packing_plan_pairs_large_pieces():
    rows = packing.packing_plan({60: 3, 40: 3, 50: 3, 10: 4, 33: 1}, 100)
    at = defaultdict(list)
    for size, first, per, n, start, offset in rows:
        for k in range(per * n):
            at[start + k // per].append((offset + k % per * size, size))
    assert sum(len(v) for v in at.values()) == 14
    for items in at.values():
        end = 0
        for offset, size in sorted(items):
            assert offset == end
            end += size
        assert end <= 100 and sum(3 * s > 100 for _, s in items) <= 2
    assert len(at) == 6


def test_sequences_hold_all_ids(docs, texts):
    pieces = packing.token_pieces(docs, BPE, 64, keep_ids=True)
    found = packing.sequences(packing.pack_pieces(pieces, 64)).collect()
    assert sum(len(r.ids) for r in found) == sum(r.length for r in pieces.collect()) and max(len(r.ids) for r in found) <= 64


def test_network_scores_whole_texts(docs, texts, labels):
    found = {r.doc_id: r for r in quality_cnn.quality_scores(docs, labels).collect()}
    assert len(found) == len(texts)
    for i, _ in texts:
        r = found[i]
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert found[3].score == found[4].score


def test_forward_pass(texts):
    """The table form against the plain sum over filters, windows, chunks and documents."""
    import numpy as np

    network, some = quality_cnn.Network(3), [t or "" for _, t in texts[:12]] + ["ab", "abcd" * 300]
    raw = [t.encode()[:3000] for t in some]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    got = network.scores(np.frombuffer(b"".join(raw), np.uint8), offsets, network._pairs())
    for text, score in zip(raw, got):
        values, start = [], 0
        while True:
            chunk = text[start:start + quality_cnn.CHUNK]
            chunk = chunk + b"\0" * max(0, quality_cnn.WIDTH - len(chunk))
            best = np.max([sum(network.filters[k][chunk[p + k]] for k in range(quality_cnn.WIDTH)) for p in range(len(chunk) - quality_cnn.WIDTH + 1)], axis=0)
            values.append(float(np.maximum(best + network.bias, 0) @ network.weights + network.offset[0]))
            start += quality_cnn.STEP
            if start + quality_cnn.CHUNK - quality_cnn.STEP >= len(text):
                break
        assert score == pytest.approx(1 / (1 + math.exp(-np.mean(values))), abs=1e-5)


def test_network_with_repeated_rows(spark, texts, labels):
    rows = texts[:20] + texts[5:9] * 3
    found = quality_cnn.quality_scores(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows) and len({(r.doc_id, r.score) for r in found}) == 20


def test_jaccard_of_repeated_rows(spark, texts):
    rows = texts + texts[9:30] * 2 + [(None, texts[9][1])]
    found = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = components(texts, 3, 90)
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in found if r.doc_id is not None)
    assert [r.component_id for r in found if r.doc_id is None] == [None]


def test_chunks_cover_the_text():
    import numpy as np

    doc, start = quality_cnn.chunk_positions(np.array([0, 1, 512, 513, 5000]))
    assert list(np.bincount(doc)) == [1, 1, 1, 2, 12] and start[doc == 4].max() + quality_cnn.CHUNK >= 5000


def test_empty_tables(nothing, labels):
    for df in (
        exact_dedup.exact_dedup(nothing), jaccard_join.jaccard_components(nothing), sharding.shard_documents(nothing),
        suffix_dedup.suffix_dedup(nothing, bits=22), phrase_dedup.phrase_dedup(nothing, bits=22), quality_rules.quality_rules(nothing, labels),
        packing.pack_documents(nothing, BPE), quality_cnn.quality_scores(nothing, labels),
    ):
        assert df.count() == 0


def test_null_ids(no_ids, labels):
    for df in (
        jaccard_join.jaccard_components(no_ids), sharding.shard_documents(no_ids), suffix_dedup.suffix_dedup(no_ids, bits=22),
        phrase_dedup.phrase_dedup(no_ids, bits=22), quality_rules.quality_rules(no_ids, labels), packing.pack_documents(no_ids, BPE),
        quality_cnn.quality_scores(no_ids, labels),
    ):
        assert df.count() == 4
