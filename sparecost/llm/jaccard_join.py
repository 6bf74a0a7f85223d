"""Similarity join of documents by the Jaccard similarity of their word shingles."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecost.llm import grams
from sparecost.llm.common import Scratch, runs_of, task, text_buffer
from sparecost.llm.components import components

_SLICE = 2 << 20
_CELL_BITS = 22
_CHUNK_BITS = 16
_MOST = 1024
_SKETCH = 1024
_BITMAP = 1 << 27
_U = np.uint64


def _shingles(data: np.ndarray, offsets: np.ndarray, words: int):
    """Hash of every shingle and the range of them that each document has; a shorter text is one shingle as a whole."""
    starts, ends, doc = grams.word_spans(data, offsets)
    n_docs = len(offsets) - 1
    h = grams.span_hash(grams.prefix_sums(data), starts, ends)
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    counts = np.diff(first)
    every = grams.window_hash(h, words)
    inside = doc[:len(every)] == doc[words - 1:words - 1 + len(every)]
    short = np.flatnonzero((counts > 0) & (counts < words))
    whole = np.array([grams.window_hash(h[first[d]:first[d + 1]], int(counts[d]))[0] for d in short], np.uint64)
    values = np.concatenate([every[inside], grams.mix(whole ^ _U(0x5851F42D4C957F2D)) if len(short) else whole])
    of = np.concatenate([doc[:len(every)][inside], short])
    order = np.argsort(of, kind="stable")
    return values[order], np.searchsorted(of[order], np.arange(n_docs + 1))


def _sets(column, words: int, ranks: np.ndarray | None):
    """Each document's sorted set of shingles; with `ranks`, in order of the load of their cells, lightest first."""
    data, offsets = text_buffer(column)
    for a, b in runs_of(offsets, _SLICE):
        at = offsets[a:b + 1] - offsets[a]
        values, first = _shingles(grams.LOWER[data[offsets[a]:offsets[b]]], at, words)
        if ranks is not None:
            cells = (values & _U((1 << _CELL_BITS) - 1)).astype(np.int64)
            values = ranks[cells].astype(np.uint64) << _U(64 - _CELL_BITS) | (values >> _U(_CELL_BITS))
        for i in range(b - a):
            yield a + i, np.unique(values[first[i]:first[i + 1]])


def _loads(batches, words: int):
    """Elements per cell, up to 255 of a task, in compressed chunks of cells; and documents per size, in a chunk of its own."""
    cells, sizes = np.zeros(1 << _CELL_BITS, np.uint8), np.zeros(_MOST + 1, np.int64)
    held, count = [], 0

    def flush():
        if held:
            own, more = np.unique(np.concatenate(held), return_counts=True)
            cells[own] = np.minimum(cells[own] + more, 255)
            held.clear()

    for batch in batches:
        for _, values in _sets(batch.column("__text"), words, None):
            sizes[min(len(values), _MOST)] += 1
            held.append((values & _U((1 << _CELL_BITS) - 1)).astype(np.int32))
            count += len(values)
            if count > 1 << 20:
                flush()
                count = 0
    flush()
    chunks = cells.reshape(-1, 1 << _CHUNK_BITS)
    rows = [(k, zlib.compress(chunk.tobytes(), 1)) for k, chunk in enumerate(chunks) if chunk.any()] + [(-1, zlib.compress(sizes.tobytes(), 1))]
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([r for _, r in rows], pa.binary())], names=["chunk", "counts"])


def _summed(batches):
    """One row per chunk: the sum of its counts; rows come sorted by chunk."""
    at, total = None, None
    for batch in batches:
        for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            counts = np.frombuffer(zlib.decompress(raw.as_py()), np.int64 if chunk < 0 else np.uint8).astype(np.int64)
            if chunk != at:
                if at is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "counts"])
                at, total = chunk, counts
            else:
                total = total + counts
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "counts"])


def cell_loads(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Load of each cell and number of documents of each size. A fixed number of cells: 32 MB reach the driver."""
    parts = texts.mapInArrow(task(_loads, words), "chunk int, counts binary").repartition(1 << (_CELL_BITS - _CHUNK_BITS), "chunk")
    merged = parts.sortWithinPartitions("chunk").mapInArrow(task(_summed), "chunk int, counts binary")
    cells, sizes = np.zeros(1 << _CELL_BITS, np.int64), np.zeros(_MOST + 1, np.int64)
    width = 1 << _CHUNK_BITS
    for row in merged.toLocalIterator():
        counts = np.frombuffer(row["counts"], np.int64)
        if row["chunk"] < 0:
            sizes += counts
        else:
            cells[row["chunk"] * width:(row["chunk"] + 1) * width] = counts
    return cells, sizes


def prefix(n: int, percent: int, common: int) -> int:
    """Elements of which two sets that reach the similarity share `common` ones, the smaller n - overlap being left out."""
    return min(n, n + (-percent * n // 100) + common)


def choose_boundary(sizes: np.ndarray, percent: int, load: float) -> int:
    """Size from which scanning lists costs less than enumerating subsets.

    A small set costs one row per pair of its prefix; a large one a row per element of its prefix and `load` rows met on
    its list, load being that of the lighter cells against the mean. Sets just below the boundary cost both.
    """
    n = np.arange(len(sizes))
    p1 = np.array([prefix(int(k), percent, 1) for k in n])
    p2 = np.array([prefix(int(k), percent, 2) for k in n])
    small, large = sizes * p2 * (p2 - 1) / 2, sizes * p1 * (1 + load)
    costs = []
    for x in n[1:]:
        costs.append(small[:x].sum() + large[x:].sum() + large[x * percent // 100:x].sum())
    return int(np.argmin(costs)) + 1


def _least(percent: int) -> int:
    """Smaller sets reach the similarity only with equal ones."""
    return -(-percent // (100 - percent))


def _name(keys: np.ndarray) -> bytes:
    """A set is named by 128 bits of its elements, so that no two sets of a corpus are expected to share a name."""
    return hashlib.blake2b(keys.tobytes(), digest_size=16).digest()


def _sketch(keys: np.ndarray) -> np.ndarray:
    """Bits that the elements of a set fall on, as 64-bit numbers. A bit that another set lacks is an element it lacks."""
    bits = np.zeros(_SKETCH, bool)
    bits[(keys & _U(_SKETCH - 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64)


def _postings(batches, words: int, percent: int, boundary: int, ranks):
    seen, ranks = set(), ranks.value
    pairs: dict = {}
    for batch in batches:
        ids = batch.column("doc_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        node, size, sketches, lists, signatures, places = [], [], [], [0], [], []
        for i, keys in _sets(batch.column("__text"), words, ranks):
            n, count = len(keys), 0
            own = _name(keys) if n else None
            if n >= _least(percent) and known[i] and own not in seen:
                seen.add(own)
                if n < boundary:
                    p = prefix(n, percent, 2)
                    if p not in pairs:
                        pairs[p] = np.triu_indices(p, 1)
                    u, v = pairs[p]
                    signatures.append(grams.mix(keys[u] * _U(0x9E6C63D0876A9A99) + grams.mix(keys[v])))
                    places.append((v - 1).astype(np.int32))
                    count += len(u)
                if n >= boundary * percent // 100:
                    p = prefix(n, percent, 1)
                    signatures.append(grams.mix(keys[:p]))
                    places.append(np.arange(p, dtype=np.int32))
                    count += p
            node.append(own), size.append(n), lists.append(lists[-1] + count)
            sketches.append(_sketch(keys) if count else None)
        at = pa.array(np.array(lists, np.int32))
        flat = np.concatenate(signatures).view(np.int64) if signatures else np.zeros(0, np.int64)
        place = np.concatenate(places) if places else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(node, pa.binary()), pa.array(size, pa.int32()), pa.ListArray.from_arrays(at, pa.array(flat)),
             pa.ListArray.from_arrays(at, pa.array(place)), pa.array(sketches, pa.list_(pa.int64()))],
            names=["doc_id", "node", "n", "signatures", "places", "sketch"])


def _elements(batches, words: int, ranks, bitmap):
    """Names and sorted sets of the documents whose cell is in the bitmap, each set once a task; the others are not looked at."""
    bits, ranks, seen = bitmap.value, ranks.value, set()
    for batch in batches:
        cell = batch.column("__cell").to_numpy()
        batch = batch.filter(pa.array((bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0))
        node, found = [], []
        for _, keys in _sets(batch.column("__text"), words, ranks):
            name = _name(keys)
            if name not in seen:
                seen.add(name)
                node.append(name), found.append(keys.view(np.int64))
        at = np.concatenate([[0], np.cumsum([len(k) for k in found])]).astype(np.int32)
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node, pa.binary()), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], names=["node", "keys"])


def _bitmap(cells: DataFrame) -> np.ndarray:
    """One bit for each of _BITMAP cells, whatever the number of rows: 16 MB at most reach the driver."""
    place = F.col("cell") + 1  # these functions count from 1
    parts = cells.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    found = np.zeros(_BITMAP // 8, np.uint8)
    for row in parts.toLocalIterator():
        found[(row["bucket"] - 1) * 4096:row["bucket"] * 4096] = np.frombuffer(row["bits"], np.uint8)
    return found


def _shared(base: DataFrame) -> DataFrame:
    """The rows of all lists that hold more than one set, each with the row where the element stands earliest on its list."""
    posts = base.filter(F.size("signatures") > 0).select("node", "n", F.explode(F.arrays_zip("signatures", "places")).alias("p")).select(
        F.col("p.signatures").alias("sig"), "node", "n", F.col("p.places").alias("pos"))
    # one shuffle of the postings, for the lists and for the join with them: neither is ever null, but the join would
    # say so for the nodes on its side only, and the two shuffles would no longer be the same
    posts = posts.filter("sig IS NOT NULL AND node IS NOT NULL").repartition("sig")
    hubs = posts.groupBy("sig").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.min(F.struct("pos", "node", "n")).alias("hub"))
    hubs = hubs.filter("low <> high").select("sig", F.col("hub.node").alias("h_node"), F.col("hub.n").alias("h_n"), F.col("hub.pos").alias("h_pos"))
    return posts.join(hubs, "sig").filter("node <> h_node")


def _can_reach(percent: int, left: str, right: str) -> Column:
    """Whether the elements from the common one on can still reach the similarity."""
    rest = F.least(F.col(f"{left}n") - F.col(f"{left}pos"), F.col(f"{right}n") - F.col(f"{right}pos"))
    return 100 * rest >= percent * (F.col(f"{left}n") + F.col(f"{right}n") - rest)


def _close(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that may reach the similarity: the elements known to be missing on either side bound the overlap from above."""
    sides = [sketches.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("sketch").alias(f"s{s}")) for s in ("a", "b")]
    both = pairs.join(sides[0], "a").join(sides[1], "b")

    def missing(x, y):
        return F.aggregate(F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseAND(F.bitwise_not(v)))), F.lit(0), lambda t, c: t + c)

    overlap = F.least(F.col("na") - missing("sa", "sb"), F.col("nb") - missing("sb", "sa"))
    return both.filter(100 * overlap >= percent * (F.col("na") + F.col("nb") - overlap)).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("keys").alias("ka")), "a")
    both = one.join(sets.select(F.col("node").alias("b"), F.col("keys").alias("kb")), "b")
    both = both.withColumn("common", F.size(F.array_intersect("ka", "kb")))
    return both.filter(100 * F.col("common") >= percent * (F.size("ka") + F.size("kb") - F.col("common"))).select("a", "b").distinct()


def jaccard_components(
    docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text",
    boundary: int | None = None,
) -> DataFrame:
    """Documents linked by Jaccard similarity of their shingles, as components.

    Sets of equal shingles collapse to one node first. Elements are ordered by the load of their cell in a sketch of all
    documents, lightest first, so passages that many documents share come last. Sets below `boundary` (chosen by cost
    unless given) enumerate the pairs of their prefix, larger ones go through the list of each element of theirs; both
    find every pair that reaches the similarity. On each list all sets are first compared with the one where the element
    stands earliest; then, by list, the pairs that are not yet in one component and can still reach the similarity by
    their sizes and places. Pairs whose sketches rule the similarity out are dropped, the others are compared exactly on
    their whole sets; no text is moved, and only the sets of such pairs are. Pairs within a component are not enumerated.

    Returns doc_id, n_shingles, component_id (smallest doc_id of the component), one row per row given. Texts without
    words have no shingles and stand alone. A null doc_id is linked with nothing and has no component. Rows that share a
    doc_id and a text are one document; rows that share a doc_id only are linked by their own texts. Texts may be of any
    length. Other columns are not read, so their names cannot clash. No rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"))
    cells, sizes = cell_loads(given.select("__text"), words)
    ranks = np.empty(len(cells), np.uint32)
    ranks[np.argsort(cells, kind="stable")] = np.arange(len(cells), dtype=np.uint32)
    if boundary is None:
        # a prefix takes its elements from the lighter cells
        light = np.sort(cells)[:len(cells) // 2]
        boundary = choose_boundary(sizes, percent, float(light.mean() / max(1e-9, cells.mean())))
    ranks = spark.sparkContext.broadcast(ranks)  # 16 MB
    base = scratch.keep(given.mapInArrow(
        task(_postings, words, percent, boundary, ranks),
        "doc_id long, node binary, n int, signatures array<long>, places array<int>, sketch array<long>"), "base")
    members = scratch.keep(base.select("doc_id", "node", "n"), "members")

    # of the documents with equal sets the one of the smallest id stands for all
    nodes = scratch.keep(base.filter("sketch is not null").groupBy("node").agg(F.min(F.struct("doc_id", "n", "sketch")).alias("m")).select("node", "m.*"), "nodes")

    def candidates(pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Pairs that pass the sketches, and the whole sets of their nodes, made again from one document each."""
        close = scratch.keep(_close(pairs.distinct(), nodes, percent), name)
        ends = close.select(F.col("a").alias("node")).union(close.select("b")).distinct()
        cell = F.pmod(F.xxhash64("doc_id"), F.lit(_BITMAP))
        bitmap = spark.sparkContext.broadcast(_bitmap(nodes.join(ends, "node").select(cell.alias("cell"))))
        texts = given.filter("doc_id is not null").select("__text", cell.alias("__cell"))
        # a cell may let a few other sets through; they meet no pair, or the same pair again
        sets = scratch.keep(texts.mapInArrow(task(_elements, words, ranks, bitmap), "node binary, keys array<long>"), f"{name}-sets")
        bitmap.destroy()
        return close, sets

    shared = scratch.keep(_shared(base), "shared")
    scratch.drop("base")
    del base
    scratch.release()
    own = shared.select("sig", "node", "n", "pos", "h_node", "h_n", "h_pos")
    stars = own.filter(_can_reach(percent, "", "h_"))
    stars = stars.select(F.least("node", "h_node").alias("a"), F.greatest("node", "h_node").alias("b"))
    links = scratch.keep(_verified(*candidates(stars, "stars"), percent), "links")
    scratch.drop("stars", "stars-sets")
    del stars
    scratch.release()
    labels, used = components(scratch, links, "first")
    placed = own.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sides = [placed.select("sig", *[F.col(c).alias(f"{s}{c}") for c in ("node", "n", "pos", "label")]) for s in ("a_", "b_")]
    open_ = sides[0].alias("x").join(
        sides[1].alias("y"), (F.col("x.sig") == F.col("y.sig")) & (F.col("a_node") < F.col("b_node"))
        & (F.col("a_label") != F.col("b_label")) & _can_reach(percent, "a_", "b_"))
    open_ = open_.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    more = scratch.keep(_verified(*candidates(open_, "open"), percent), "more")
    ranks.destroy()
    if not more.isEmpty():
        labels, again = components(scratch, links.union(more), "second")
        used += again
    grouped = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = grouped.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    result = grouped.join(smallest, "label", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))
    return scratch.done(result, "members", "nodes", "shared", "links", "open", "open-sets", "more", *used)
