"""Benchmark decontamination with a positional inverted index that is dealt by documents.

The index is stored once: one row per block of documents of about `_BLOCK` bytes, with every term of the block and the
places of its occurrences. The test phrases are a stated query set and go over the blocks in groups of bounded size. Within
a block the places of the rarest term of a phrase, moved back by the offset of the term, are the candidates; they are
intersected with the lists of the other terms, rarer ones first. So no list of a frequent term is ever joined or
shuffled, whatever share of the corpus holds it, and terms are compared as bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost.llm.common import Scratch, small_batches, task
from sparecost.llm.resampling import words_of

_BLOCK = 2 << 20
_TESTS = 4 << 20
_PIECE = 4096
_CANDIDATES = 4 << 20
# what a worker gets at once, and blocks in a row group: readers hold a whole group, and Parquet looks at bytes every 100 rows only
_BATCH = 4 << 20
_GROUP = 4


# ---- the index ----------------------------------------------------------------------------------------

def _block(rows: list, ids: list, id_type: pa.DataType, words: list[bytes], first: list[int]) -> pa.RecordBatch:
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    terms = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    places = np.argsort(terms, kind="stable").astype(np.int32)
    starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(number)))])
    return pa.RecordBatch.from_arrays([
        pa.array([rows], pa.list_(pa.int64())), pa.array([ids], pa.list_(id_type)), pa.array([first], pa.list_(pa.int32())),
        pa.array([list(number)], pa.list_(pa.binary())), pa.array([starts], pa.list_(pa.int32())), pa.array([places.tobytes()], pa.binary()),
    ], names=["rows", "ids", "first", "terms", "starts", "places"])


def _postings(batches, block_bytes: int):
    rows, ids, words, first, size, kind = [], [], [], [0], 0, None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for row, doc_id, text in zip(batch.column("__row"), batch.column("doc_id"), batch.column("__text")):
            text = text.as_py()
            if rows and size + len(text or "") > block_bytes:
                yield _block(rows, ids, kind, words, first)
                rows, ids, words, first, size = [], [], [], [0], 0
            rows.append(row.as_py())
            ids.append(doc_id.as_py())
            words += words_of(text)
            first.append(len(words))
            size += len(text or "")
    if rows:
        yield _block(rows, ids, kind, words, first)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = _BLOCK) -> DataFrame:
    """One row per block: rows and ids of its documents, the first word of each, its terms, and their places.

    places holds the word numbers (32 bits, little-endian) of all terms one after the other, starts where each term's list
    begins. A block holds at least one document, and whole documents.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        task(_postings, block_bytes),
        f"rows array<long>, ids array<{kind}>, first array<int>, terms array<binary>, starts array<int>, places binary")


def _stored(index: DataFrame, scratch: Scratch) -> DataFrame:
    """The index on disk; tasks hold a few blocks of it at a time, however large their share of the input is."""
    with small_batches(index.sparkSession, _BATCH):
        return scratch.keep(index, "index", **{"parquet.block.row.count.limit": _GROUP})


def indexed_documents(index: DataFrame) -> DataFrame:
    """__row, doc_id and n_words of every document of an index."""
    sizes = F.expr("transform(rows, (r, i) -> struct(r AS __row, ids[i] AS doc_id, cast(first[i + 1] - first[i] AS long) AS n_words))")
    return index.select(F.explode(sizes).alias("d")).select("d.*")


# ---- the test phrases ---------------------------------------------------------------------------------

@dataclass
class Phrases:
    """A group of test phrases: terms per phrase (-1 beyond its end), its items, and where in each item it begins."""

    vocabulary: dict[bytes, int]
    terms: np.ndarray
    lengths: np.ndarray
    owner_from: np.ndarray
    owners: np.ndarray
    begins: np.ndarray
    items: list[str]


def _pieces(batches, window: int):
    for batch in batches:
        items, begins, texts = [], [], []
        for item, text in zip(batch.column("item").to_pylist(), batch.column("__text")):
            words = words_of(text.as_py())
            for at in range(0, max(1, len(words) - window + 1), _PIECE) if words else ():
                items.append(item)
                begins.append(at)
                texts.append(b" ".join(words[at:at + _PIECE + window - 1]))
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(begins, pa.int64()), pa.array(texts, pa.binary())], names=["item", "begin", "words"])


def phrases_of(rows, window: int) -> Phrases:
    """The windows of pieces (item, begin, words); a piece of fewer words than a window is one phrase."""
    vocabulary: defaultdict[bytes, int] = defaultdict()
    vocabulary.default_factory = vocabulary.__len__
    names: dict[str, int] = {}
    terms, owners, begins = [np.zeros((0, window), np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for item, begin, words in rows:
        ids = np.fromiter(map(vocabulary.__getitem__, bytes(words).split(b" ")), np.int32)
        ids = np.concatenate([ids, np.full(max(0, window - len(ids)), -1, np.int32)])
        found = np.lib.stride_tricks.sliding_window_view(ids, window)
        terms.append(found)
        owners.append(np.full(len(found), names.setdefault(item, len(names))))
        begins.append(begin + np.arange(len(found)))
    table, which = np.unique(np.concatenate(terms), axis=0, return_inverse=True)
    which, order = which.ravel(), np.argsort(which.ravel(), kind="stable")
    return Phrases(
        dict(vocabulary), table, (table >= 0).sum(axis=1), np.searchsorted(which[order], np.arange(len(table) + 1)),
        np.concatenate(owners)[order], np.concatenate(begins)[order], list(names))


def phrase_groups(tests: DataFrame, scratch: Scratch, window: int, item_col: str, text_col: str, group_bytes: int = _TESTS) -> Iterator[Phrases]:
    """The phrases of all tests in groups of about `group_bytes`; long items are cut into overlapping pieces before.

    The number of groups follows the size of the tests, so what is broadcast at once does not grow with them.
    """
    items = F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item")
    pieces = tests.select(items, F.col(text_col).alias("__text")).mapInArrow(task(_pieces, window), "item string, begin long, words binary")
    pieces = scratch.keep(pieces.distinct(), "pieces")
    size = pieces.agg(F.sum(F.length("words"))).first()[0] or 0
    groups = -(-size // group_bytes)
    group = F.pmod(F.xxhash64("item", "begin"), F.lit(max(1, groups)))
    for n in range(groups):
        yield phrases_of(pieces.filter(group == n).collect(), window)


# ---- search -------------------------------------------------------------------------------------------

def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... for count[i] numbers each, one after the other."""
    total = np.cumsum(count)
    return np.repeat(first - total + count, count) + np.arange(total[-1] if len(total) else 0)


class _Lists:
    """The posting lists of one block, addressed by the terms of the test phrases."""

    def __init__(self, row: dict, vocabulary: dict[bytes, int]):
        self.first = np.array(row["first"], np.int64)
        self.places = np.frombuffer(row["places"], np.int32).astype(np.int64)
        starts, self.span = np.array(row["starts"], np.int64), max(1, len(self.places))
        self.known, self.count, self.begin = (np.zeros(len(vocabulary) + 1, np.int64) for _ in range(3))
        numbers = [(vocabulary[t], i) for i, t in enumerate(row["terms"]) if t in vocabulary]
        if numbers:
            test, own = np.array(numbers, np.int64).T
            self.known[test], self.count[test], self.begin[test] = own, starts[own + 1] - starts[own], starts[own]
        # ascending, as lists stand one after the other and each ascends
        self.keys = np.repeat(np.arange(len(starts) - 1), np.diff(starts)) * self.span + self.places

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, "right") - 1

    def holds(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether the list of a term has a place of this block."""
        wanted = self.known[terms] * self.span + places
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return (self.keys[at] == wanted) & (places >= 0) & (places < self.span)

    def neighbour(self, terms: np.ndarray, places: np.ndarray, step: int) -> np.ndarray:
        """The next place of a term behind (step 1) or before (-1) a place; -1 if there is none."""
        at = np.searchsorted(self.keys, self.known[terms] * self.span + places, "right" if step > 0 else "left") - (step < 0)
        inside = (at >= self.begin[terms]) & (at < self.begin[terms] + self.count[terms])
        return np.where(inside, self.places[np.clip(at, 0, len(self.places) - 1)], -1)


def _search(lists: _Lists, phrases: Phrases, slop: int):
    """Phrase, first and last place of every match in a block, for as many phrases at once as have _CANDIDATES candidates."""
    none = np.zeros(0, np.int64)
    count = np.where(phrases.terms >= 0, lists.count[phrases.terms], np.iinfo(np.int64).max)
    able = np.flatnonzero((count > 0).all(axis=1)) if len(lists.places) else none
    found = [(none, none, none)]
    share = np.cumsum(count[able].min(axis=1)) // _CANDIDATES if len(able) else none
    for own in np.split(able, np.flatnonzero(np.diff(share)) + 1) if len(able) else ():
        found.append(_intersected(lists, phrases, own, count[own], slop))
    return tuple(np.concatenate(part) for part in zip(*found))


def _intersected(lists: _Lists, phrases: Phrases, able: np.ndarray, count: np.ndarray, slop: int):
    """Matches of some phrases, all of whose terms the block has; count has the lengths of their lists."""
    terms, lengths = phrases.terms[able].astype(np.int64), phrases.lengths[able]
    by_rarity = np.argsort(count, axis=1, kind="stable")
    offset = by_rarity[:, 0]
    rarest = terms[np.arange(len(able)), offset]
    of = np.repeat(np.arange(len(able)), lists.count[rarest])
    places = lists.places[_spread(lists.begin[rarest], lists.count[rarest])]
    document = lists.document(places)
    low, high = lists.first[document], lists.first[document + 1]
    if slop == 0:
        starts = places - offset[of]
        keep = (starts >= low) & (starts + lengths[of] <= high)
        of, starts = of[keep], starts[keep]
        for k in range(1, terms.shape[1]):
            column = by_rarity[of, k]
            more = lengths[of] > k  # columns beyond the end of a phrase come last, as the most frequent
            keep = ~more
            keep[more] = lists.holds(terms[of[more], column[more]], starts[more] + column[more])
            of, starts = of[keep], starts[keep]
        return able[of], starts, starts + lengths[of] - 1
    edges = [places, places]
    for side, step in enumerate((-1, 1)):
        column = offset[of] + step
        while (more := (column >= 0) & (column < lengths[of])).any():
            edge = edges[side].copy()
            edge[more] = lists.neighbour(terms[of[more], column[more]], edge[more], step)
            keep = (edge >= low) & (edge < high)
            edges[side] = edge
            of, column, low, high, *edges = (v[keep] for v in (of, column + step, low, high, *edges))
    first, last = edges
    return _tightest(able[of], first, last, phrases.lengths + slop)


def _tightest(phrase: np.ndarray, first: np.ndarray, last: np.ndarray, most: np.ndarray):
    """Matches that hold no other match of their phrase and are no longer than allowed."""
    order, kept, before, least = np.lexsort((last, -first, phrase)), [], -1, 0
    for i in order.tolist():
        if phrase[i] != before:
            before, least = phrase[i], np.iinfo(np.int64).max
        if last[i] < least:
            least = last[i]
            if last[i] - first[i] + 1 <= most[phrase[i]]:
                kept.append(i)
    kept = np.array(kept, np.int64)
    return phrase[kept], first[kept], last[kept]


def _blocks(batches):
    """The blocks of an index one by one, so that one at a time is held as Python objects."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _matches(batches, broadcast, slop: int):
    """Every match: __row, item, begin in the item, first and last word in the document."""
    phrases: Phrases = broadcast.value
    for row in _blocks(batches):
        lists = _Lists(row, phrases.vocabulary)
        phrase, first, last = _search(lists, phrases, slop)
        owners = phrases.owner_from[phrase + 1] - phrases.owner_from[phrase]
        at = _spread(phrases.owner_from[phrase], owners)
        document = np.repeat(lists.document(first), owners)
        origin = lists.first[document]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.array(row["rows"], np.int64)[document]), pa.array([phrases.items[i] for i in phrases.owners[at]], pa.string()),
            pa.array(phrases.begins[at]), pa.array(np.repeat(first, owners) - origin), pa.array(np.repeat(last, owners) - origin),
        ], names=["__row", "item", "begin", "first", "last"])


def _hits(batches, broadcast):
    """Per document with a match: the covered ranges of words, merged, and the items."""
    phrases: Phrases = broadcast.value
    for row in _blocks(batches):
        lists = _Lists(row, phrases.vocabulary)
        phrase, first, last = _search(lists, phrases, 0)
        document = lists.document(first)
        rows, spans, items = [], [], []
        for d in np.unique(document).tolist():
            own = document == d
            covered = np.zeros(int(lists.first[d + 1] - lists.first[d]) + 1, np.int64)
            np.add.at(covered, first[own] - lists.first[d], 1)
            np.add.at(covered, last[own] + 1 - lists.first[d], -1)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(covered) > 0, [0]]).astype(np.int8)))
            of = np.unique(phrase[own])
            owners = np.unique(phrases.owners[_spread(phrases.owner_from[of], phrases.owner_from[of + 1] - phrases.owner_from[of])])
            rows.append(row["rows"][d])
            spans.append([{"a": a, "b": b} for a, b in edges.reshape(-1, 2).tolist()])
            items.append([phrases.items[i] for i in owners])
        yield pa.RecordBatch.from_arrays([
            pa.array(rows, pa.int64()), pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
            pa.array(items, pa.list_(pa.string())),
        ], names=["__row", "spans", "items"])


def _each_group(index: DataFrame, groups, scratch: Scratch, func, schema: str, *args) -> tuple[DataFrame, list[str]]:
    """func over the whole index for each group of phrases, stored; one table of all results."""
    spark, names = index.sparkSession, []
    found = spark.createDataFrame([], schema)
    for n, phrases in enumerate(groups):
        broadcast = spark.sparkContext.broadcast(phrases)
        names.append(f"found-{n}")
        matches = index.select("rows", "first", "terms", "starts", "places").mapInArrow(task(func, broadcast, *args), schema)
        with small_batches(spark, _BATCH):
            found = found.union(scratch.keep(matches, names[-1]))
        broadcast.destroy()
    return found, names


def find_phrases(
    docs: DataFrame, tests: DataFrame, window: int = 10, slop: int = 0, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", test_col: str = "text",
) -> DataFrame:
    """All places where a window of a test item stands in a document: doc_id, item, begin, first, last (word numbers).

    slop 0: the words of the window follow each other. slop n: they follow in this order with at most n other words
    between them, and only occurrences that hold no other occurrence of the window are returned. Words and windows, and
    what null, empty or repeated rows give, are as in `contamination`; a row of each pair of equal rows is searched.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    index = _stored(build_index(docs, id_col, text_col), scratch)
    groups = phrase_groups(tests, scratch, window, item_col, test_col)
    found, names = _each_group(index, groups, scratch, _matches, "__row long, item string, begin long, first long, last long", slop)
    own = indexed_documents(index).select("__row", "doc_id")
    return scratch.done(found.join(own, "__row").select("doc_id", "item", "begin", "first", "last"), "index", "pieces", *names)


def contamination(
    docs: DataFrame, tests: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", test_col: str = "text", block_bytes: int = _BLOCK, group_bytes: int = _TESTS,
) -> DataFrame:
    """Words of each document inside any occurrence of a window of the test items, and the items that occur.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z became a-z. A window is `window` consecutive words of an item;
    an item of fewer words is one window. Returns doc_id, n_words, n_hit, spans (merged ranges of hit words, last one
    excluded), items (ids as text, sorted), contaminated; one row per row given. Null and empty texts have no words: such
    a document is clean, such an item never occurs. Rows that share an item id are one item, a null id is the empty
    text. Repeated documents are each returned; texts are taken whole, of any length. Other columns are not read, so
    their names cannot clash. An empty table of tests leaves all documents clean; without documents there are no rows.
    """
    scratch = Scratch(docs.sparkSession, "contamination")
    index = _stored(build_index(docs, id_col, text_col, block_bytes), scratch)
    groups = phrase_groups(tests, scratch, window, item_col, test_col, group_bytes)
    found, names = _each_group(index, groups, scratch, _hits, "__row long, spans array<struct<a: long, b: long>>, items array<string>")
    # one row per document and group of tests; a document's merged ranges are fewer than its words
    found = found.groupBy("__row").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = F.expr("""aggregate(spans, cast(array() AS array<struct<a: long, b: long>>), (m, s) -> CASE
      WHEN size(m) > 0 AND s.a <= m[size(m) - 1].b
      THEN concat(slice(m, 1, size(m) - 1), array(named_struct('a', m[size(m) - 1].a, 'b', greatest(m[size(m) - 1].b, s.b))))
      ELSE concat(m, array(s)) END)""") if len(names) > 1 else F.col("spans")
    result = indexed_documents(index).join(found.withColumn("spans", merged), "__row", "left").select(
        "doc_id", "n_words",
        F.coalesce(F.expr("aggregate(spans, 0L, (n, s) -> n + s.b - s.a)"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<a: long, b: long>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("spans").isNotNull().alias("contaminated"))
    return scratch.done(result, "index", "pieces", *names)
