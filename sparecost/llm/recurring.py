"""Places of texts that may stand elsewhere too, found by anchors and routed to where equal ones meet.

Every window of `length` units is given the position of its smallest hash of `k` consecutive units as its anchor, so equal
windows have equal anchors at the same distance. Anchors are about half as many as there are hashes in a window. A bitmap of fixed
size tells which anchors may occur twice: an anchor whose cell was met once cannot. Only the segments around the others
are shuffled, by the hash of the anchor. With more anchors than cells the bitmap lets more segments pass, up to all of
them; that costs a larger shuffle and changes no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparecost.llm import grams
from sparecost.llm.common import runs_of, task, text_buffer

_SLICE = 1 << 20
_GROUP_BITS = 22
_U = np.uint64


def cells_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Cells of anchors. A hash that was the least of its window is small, so it is mixed again before its top bits are taken."""
    return grams.mix(hashes ^ _U(0x5851F42D4C957F2D)) >> _U(64 - bits)


def anchors(hashes: np.ndarray, doc: np.ndarray, length: int, k: int):
    """Hash and position of each anchor, and the first and last start of the windows that it stands for."""
    n = len(doc) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    bits = _U(max(20, len(doc).bit_length()))
    marked = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    at = (grams.sliding_min(marked, length - k + 1) & ((_U(1) << bits) - _U(1))).astype(np.int64)[:n]
    starts = np.flatnonzero(doc[:n] == doc[length - 1:length - 1 + n])
    at = at[starts]
    if not len(at):
        return np.zeros(0, np.uint64), at, at, at
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return hashes[at[first]], at[first], starts[first], starts[last]


def units(data: np.ndarray, offsets: np.ndarray, words: bool, k: int):
    """Hashes of k consecutive units, the document of each unit, and for words their byte spans."""
    if words:
        starts, ends, doc = grams.word_spans(data, offsets)
        sums = grams.prefix_sums(data)
        return grams.window_hash(grams.span_hash(sums, starts, ends), k), doc, starts, ends
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(max(0, len(data) - k + 1))
    return grams.span_hash(grams.prefix_sums(data), at, at + k), doc, None, None


def _cells(batches, words: bool, length: int, k: int, bits: int):
    found = []
    for batch in batches:
        data, offsets = text_buffer(batch.column("__text"))
        for a, b in runs_of(offsets, _SLICE):
            hashes, doc, *_ = units(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words, k)
            found.append(cells_of(anchors(hashes, doc, length, k)[0], bits).astype(np.uint32))
    cells, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint32), return_counts=True)
    group, low = cells >> _GROUP_BITS, np.uint32((1 << _GROUP_BITS) - 1)
    for g in np.unique(group):
        own = group == g
        yield pa.RecordBatch.from_arrays([
            pa.array([int(g)], pa.int32()), pa.array([(cells[own] & low).tobytes()], pa.large_binary()),
            pa.array([(cells[own & (counts > 1)] & low).tobytes()], pa.large_binary())], names=["group", "once", "twice"])


def _merge(batches):
    at, once, twice = None, None, None

    def bitmap():
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.large_binary())], names=["group", "bits"])

    for batch in batches:
        for group, seen, more in zip(*[batch.column(c).to_pylist() for c in ("group", "once", "twice")]):
            if group != at:
                if at is not None:
                    yield bitmap()
                at, once, twice = group, np.zeros(1 << _GROUP_BITS, bool), np.zeros(1 << _GROUP_BITS, bool)
            cells = np.frombuffer(seen, np.uint32)
            twice[cells[once[cells]]] = True
            twice[np.frombuffer(more, np.uint32)] = True
            once[cells] = True
    if at is not None:
        yield bitmap()


def repeated_cells(spark: SparkSession, docs: DataFrame, words: bool, length: int, k: int, bits: int):
    """Broadcast bitmap of 2^bits cells: those that two or more anchors fall into."""
    blobs = docs.select("__text").mapInArrow(task(_cells, words, length, k, bits), "group int, once binary, twice binary")
    merged = blobs.repartition("group").sortWithinPartitions("group").mapInArrow(task(_merge), "group int, bits binary")
    bitmap = np.zeros(max(1 << bits, 1 << _GROUP_BITS) // 8, np.uint8)
    size = (1 << _GROUP_BITS) // 8
    for row in merged.toLocalIterator():  # 2^bits / 8 bytes in all
        bitmap[row["group"] * size:(row["group"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(bitmap)


def given_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, __text, and __key, which tells rows that share an id apart by their text; equal rows share it and fare alike."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("__text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("__key"))


SEGMENT = ("h", "doc_id", "key", "start", "anchor", "n", "segment")
_SCHEMA = "h long, doc_id long, key long, start long, anchor int, n int, segment binary"


def _segments(batches, words: bool, length: int, k: int, bits: int, bitmap, other_docs: bool):
    repeated, seen = bitmap.value, {}
    for batch in batches:
        ids, keys = batch.column("doc_id").to_pylist(), batch.column("__key").to_pylist()
        data, offsets = text_buffer(batch.column("__text"))
        for a, b in runs_of(offsets, _SLICE):
            part, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            hashes, doc, w_starts, w_ends = units(part, at, words, k)
            h, pos, s0, s1 = anchors(hashes, doc, length, k)
            cell = cells_of(h, bits).astype(np.int64)
            keep = (repeated[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
            h, pos, s0, s1 = h[keep], pos[keep], s0[keep], s1[keep]
            of = doc[s0] if len(s0) else s0
            origin = np.searchsorted(doc, np.arange(b - a)) if words else at[:-1]
            if words:
                lo, hi = w_starts[s0], w_ends[s1 + length - 1]
                values = grams.span_hash(grams.prefix_sums(part), w_starts, w_ends)
                sums = np.zeros(len(values) + 1, np.uint64)
                # as the words are compared and not the spaces between them
                np.cumsum(values * grams._power(grams._BASE, len(values)), out=sums[1:])
                whole = (sums[s1 + length] - sums[s0]) * grams._power(grams._INVERSE, len(sums))[s0]
            else:
                lo, hi = s0, s1 + length
                whole = grams.span_hash(grams.prefix_sums(part), lo, hi)
            raw = part.tobytes()
            rows, decided = [], {}
            for x, p, first, last, d, u, v, w in zip(*[c.tolist() for c in (h, pos, s0, s1, of, lo, hi, whole)]):
                doc_id = ids[a + d]
                if doc_id is None:
                    continue
                start, name, here = first - int(origin[d]), (x, w, p - first, last - first), (doc_id, keys[a + d])
                before = seen.get(name)
                if before is not None and (before[0] < doc_id or (not other_docs and before[:2] == here and before[2] < start)):
                    decided.setdefault(d, []).append((start, start + last - first + length))
                    continue
                if before is None or (*here, start) < before:
                    seen[name] = (*here, start)
                rows.append((x, *here, start, p - first, last - first + length, b" ".join(raw[u:v].split()) if words else raw[u:v]))
            for d, spans in decided.items():
                here = (ids[a + d], keys[a + d])
                rows += [(hash((*here, first)) & 0xFFFFFFFFFFFFFFFF, *here, first, 0, last - first, None) for first, last in merged_spans(spans)]
            if len(seen) > 400_000:
                seen.clear()
            if rows:
                x, *rest, segs = zip(*rows)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(x, np.uint64).view(np.int64)), *[pa.array(c, t) for c, t in zip(rest, kinds)], pa.array(segs, pa.binary())],
                    names=list(SEGMENT))


def segments(docs: DataFrame, words: bool, length: int, k: int, bits: int, bitmap, other_docs: bool) -> DataFrame:
    """One row per anchor that may occur twice: h, doc_id, key, start (of the first window, in units of the document), anchor
    (distance of the anchor from there), n (units covered), segment (their bytes; words joined by one space).

    Where a task has met the same segment earlier in the order of documents, all windows of the later one are repeats. Such
    a segment is decided at once: what is decided of a document is merged and sent as spans without a segment, under a hash
    of their place instead of the anchor's. So a passage in very many documents meets in one place once per task only. The same
    segment means equal hashes of the anchor and of the whole, 128 bits together; bytes are compared where segments meet.
    """
    return docs.mapInArrow(task(_segments, words, length, k, bits, bitmap, other_docs), _SCHEMA)


def grouped(rows, limit: int):
    """Lists of rows of whole anchors, from batches sorted by h, of about `limit` bytes of segments each."""
    held, size, last = [], 0, None
    for batch in rows:
        for row in zip(*[batch.column(c).to_pylist() for c in SEGMENT]):
            if size >= limit and row[0] != last:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row[6] or b"") + 64
            last = row[0]
    if held:
        yield held


SPANS = "doc_id long, key long, a long, b long"


def span_batch(spans: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*spans)], names=["doc_id", "key", "a", "b"])


def with_spans(given: DataFrame, spans: DataFrame) -> DataFrame:
    """Documents with the list of their spans. A document has at most as many as it has units, and few once they are merged."""
    listed = spans.groupBy("doc_id", F.col("key").alias("__key")).agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    return given.join(listed, ["doc_id", "__key"], "left")


def merged_spans(spans) -> list[tuple[int, int]]:
    """Overlapping or adjacent ranges as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
