"""SentencePiece encoding and decoding by a relational lattice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparecost.llm.common import Scratch, runs_of, task, text_buffer

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
_LETTERS = 1 << 16
_lattices: dict = {}


def _pieces_of(model: str) -> tuple[list[str], list[int], list[float], dict]:
    """Pieces that match text, their ids and scores, and what else encoding needs."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    pieces, scores = [sp.id_to_piece(i) for i in plain], [sp.get_score(i) for i in plain]
    about = {
        "longest": max(map(len, pieces)), "unknown": sp.unk_id(), "unknown_score": min(scores) - UNKNOWN_PENALTY,
        "byte": sp.piece_to_id("<0x00>") if sp.is_byte(sp.piece_to_id("<0x00>")) else None,
    }
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("a piece crosses words")
    return pieces, plain, scores, about


def piece_table(spark: SparkSession, model: str) -> tuple[DataFrame, dict]:
    """Pieces that match text (piece, id, score) from a model file, and what else encoding needs."""
    pieces, ids, scores, about = _pieces_of(model)
    rows = pa.table({"piece": pieces, "id": pa.array(ids, pa.int32()), "score": pa.array(scores, pa.float64())})
    return spark.createDataFrame(rows), about


def words_of(text: str = "__text") -> str:
    """SQL: the words of a text with a space put before it; a word keeps the spaces before it, so words joined are the text."""
    return f"regexp_extract_all(concat('{SPACE}', replace({text}, ' ', '{SPACE}')), '{SPACE}*[^{SPACE}]+|{SPACE}+$', 0)"


class Lattice:
    """Best segmentations of many words at once.

    Every substring up to the longest piece is an edge if it equals a piece; a character that is no piece is an unknown edge.
    The edges that end at a place are found by a walk backwards through the letters of the pieces, and the best score and last
    edge of a place follow from those before it. All words take a step together, longest first, so the work is linear in their
    letters, and edges are held for `_LETTERS` places at once. The earlier start wins between equal scores.
    """

    def __init__(self, model: str):
        pieces, ids, scores, self.about = _pieces_of(model)
        letters = {c: i for i, c in enumerate(sorted(set("".join(pieces))), 1)}
        self.known = np.array([ord(c) for c in letters], np.uint32)
        step: dict = {}
        ends, self.base = {}, len(letters) + 1
        for number, piece in enumerate(pieces):
            at = 0
            for c in reversed(piece):
                at = step.setdefault(at * self.base + letters[c], len(step) + 1)
            ends[at] = number
        # steps from a node by a letter, in order of their keys; those from the first node by the letter alone
        self.keys = np.array(sorted(step), np.int64)
        self.next = np.array([step[k] for k in self.keys.tolist()], np.int32)
        self.first = np.zeros(self.base, np.int32)
        self.first[self.keys[self.keys < self.base]] = self.next[self.keys < self.base]
        self.score, self.id = np.full(len(step) + 1, -np.inf), np.full(len(step) + 1, -1, np.int32)
        self.score[list(ends)], self.id[list(ends)] = np.array(scores)[list(ends.values())], np.array(ids, np.int32)[list(ends.values())]

    def _edges(self, letters: np.ndarray, at: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the edge of each length that ends at each place; `most` is the number of letters up to there."""
        score, ids = np.full((len(at), self.about["longest"]), -np.inf), np.full((len(at), self.about["longest"]), -1, np.int32)
        score[:, 0] = self.about["unknown_score"]
        rows, node = np.arange(len(at)), self.first[letters[at]]
        for n in range(self.about["longest"]):
            if n:
                rows = rows[node > 0]
                node = node[node > 0]
                rows, node = rows[most[rows] > n], node[most[rows] > n]
                key = node.astype(np.int64) * self.base + letters[at[rows] - n]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                node = np.where(self.keys[place] == key, self.next[place], 0)
            found = self.id[node] >= 0
            score[rows[found], n], ids[rows[found], n] = self.score[node[found]], self.id[node[found]]
        return score, ids

    def _best(self, letters: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length and id of the last edge of the best path to each place."""
        length, ids = np.zeros(len(letters), np.int16), np.zeros(len(letters), np.int32)
        order = np.argsort(-size, kind="stable")
        # a word has a score for each of its places and one for its start
        best, own = np.zeros(len(letters) + len(size)), (start + np.arange(len(size)))[order]
        start, size = start[order], size[order]
        shorter = np.sort(size)
        first = 0
        while first < (size[0] if len(size) else 0):
            words = len(size) - np.searchsorted(shorter, first, "right")
            steps = int(min(max(1, _LETTERS // words), size[0] - first))
            holds = np.arange(first, first + steps)[:, None] < size[None, :words]
            k, word = np.nonzero(holds)
            at = start[word] + first + k
            score, found = self._edges(letters, at, first + k + 1)
            row = 0
            for k, n in enumerate(holds.sum(axis=1).tolist(), first):
                some, rows = min(k + 1, self.about["longest"]), slice(row, row + n)
                before = own[:n, None] + np.arange(k + 1 - some, k + 1)
                each = best[before] + score[rows, :some][:, ::-1]
                chosen = each.argmax(axis=1)
                best[own[:n] + k + 1] = each[np.arange(n), chosen]
                length[at[rows]], ids[at[rows]] = some - chosen, found[rows][np.arange(n), some - chosen - 1]
                row += n
            first += steps
        return length, ids

    def encode(self, words: list[str]) -> pa.Array:
        """The ids of each word, a list each."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        place = np.minimum(np.searchsorted(self.known, points), len(self.known) - 1)
        letters = np.where(self.known[place] == points, place + 1, 0)
        start = np.cumsum(size) - size
        length, ids = self._best(letters, start, size)
        # back along the best paths, a step of all words at a time; what is passed is marked
        on, at = np.zeros(len(points), bool), (start + size - 1)[size > 0]
        low = start[size > 0]
        while len(at):
            on[at] = True
            at = at - length[at]
            at, low = at[at >= low], low[at >= low]
        on = np.flatnonzero(on)
        ids, unknown = ids[on], points[on][ids[on] < 0]
        many = np.ones(len(on), np.int64)
        if self.about["byte"] is None:
            ids = np.where(ids < 0, self.about["unknown"], ids)
            out = ids
        else:
            many[ids < 0] = 1 + (unknown >= 0x80) + (unknown >= 0x800) + (unknown >= 0x10000)
            out = np.repeat(ids, many)
            raw = np.frombuffer(unknown.tobytes().decode("utf-32-le").encode(), np.uint8)
            out[out < 0] = self.about["byte"] + raw.astype(np.int32)
        last = np.concatenate([[0], np.cumsum(many)])
        offsets = last[np.searchsorted(on, np.concatenate([start, [len(points)]]))]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out.astype(np.int32, copy=False)))


def _encoded(words: pa.Array, model: str) -> pa.Array:
    lattice = _lattices.get(model) or _lattices.setdefault(model, Lattice(model))
    found = [pa.array([], pa.list_(pa.int32()))]
    for first, last in runs_of(text_buffer(words)[1], _LETTERS):
        found.append(lattice.encode(words.slice(first, last - first).to_pylist()))
    return pa.concat_arrays(found)


def encode_words(words: DataFrame, model: str) -> DataFrame:
    """Add `ids`, the best segmentation of `word`; see Lattice."""
    return words.withColumn("ids", F.arrow_udf(task(_encoded, model), "array<int>")("word"))


def _encoded_texts(batches, model: str, block_bytes: int):
    for batch in batches:
        every = batch.column("words")
        every = every.cast(pa.list_(pa.string()))
        at = every.offsets.to_numpy()
        flat = every.values
        letters = np.concatenate([[0], np.cumsum(pc.binary_length(flat).to_numpy(zero_copy_only=False), dtype=np.int64)])
        for first, last in runs_of(letters[at], block_bytes):
            own = flat.slice(at[first], at[last] - at[first]).dictionary_encode()
            ids = _encoded(own.dictionary, model).take(own.indices)
            ids = pa.ListArray.from_arrays(pa.array(at[first:last + 1] - at[first], pa.int32()), ids)
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("words"), ids], names=["doc_id", "words", "ids"])


def encoded_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """Every text with the ids of its words: doc_id, words, ids (an array for each word). Nothing is shuffled.

    The distinct words of about `block_bytes` of texts are encoded once. An empty or null text has no words.
    """
    words = F.expr(f"case when __text = '' then cast(array() as array<string>) else {words_of()} end").alias("words")
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")).select("doc_id", words)
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(task(_encoded_texts, model, block_bytes), f"doc_id {kind}, words array<string>, ids array<array<int>>")


def in_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """Rows dealt by a hash of the id into blocks of about block_bytes of text; a block has its own table of words."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    given = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
        # never null, and known not to be: else the join would filter one of its two sides and shuffle it anew
        F.coalesce(F.pmod(F.xxhash64(id_col, F.xxhash64(text_col)), F.lit(blocks)), F.lit(0)).alias("block"))
    return given.repartition(blocks, "block"), blocks


def encoded_words(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """Every word of every text with its ids: block, doc_id, __key, at (number of the word), word, ids.

    Texts are shuffled once, into blocks. Words are encoded once per block, so a frequent word costs a row per block; they
    are shuffled by block when they have their ids. `encoded_texts` shuffles nothing.
    """
    given, _ = in_blocks(docs, id_col, text_col, block_bytes)
    placed = given.select("block", "doc_id", F.xxhash64("__text").alias("__key"), F.posexplode_outer(
        F.expr(f"case when __text = '' then null else {words_of()} end")).alias("at", "word"))
    # the ids take part in the list of words, which keeps them in its exchange: it is then the one that the texts use too
    listed = placed.filter("word is not null").groupBy("block", "word").agg(F.max(F.xxhash64("doc_id")).alias("__any")).filter("__any is not null")
    known = encode_words(listed.select("block", "word"), model)
    return placed.join(known.hint("shuffle_hash"), ["block", "word"], "left")


def sentencepiece_check(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """Encode every whole text, decode the ids again and compare.

    Returns per row given: doc_id, n_words, n_pieces, ids_hash (of all ids and their places), round_trip (whether the decoded
    words are the text's). Empty and null texts have no pieces and a true round_trip. Rows that share id and text are counted
    and each returned; a null id is an id as any other. Texts and words may be long. Other columns are not read, so their names
    cannot clash. No rows give no rows. Pieces are scored as the model file gives them: for a unigram model these are the library's
    own ids, for other kinds the segmentation of the highest total score.
    """
    found = encoded_texts(docs, model, id_col, text_col, block_bytes)
    table = _decoding(model)
    n_words, n_pieces = F.size("words").cast("long"), F.size(F.flatten("ids")).cast("long")
    # sums of the halves of the words' hashes cannot overflow
    halves = "aggregate(transform(ids, (x, i) -> xxhash64(i, x)), named_struct('high', 0L, 'low', 0L), (a, h) -> named_struct(" \
             "'high', a.high + shiftright(h, 32), 'low', a.low + (h & 4294967295L)))"
    each = found.select(
        "doc_id", n_words.alias("n_words"), n_pieces.alias("n_pieces"), F.expr(f"case when size(words) > 0 then {halves} end").alias("sums"),
        _text_of(table, F.flatten("ids")).eqNullSafe(F.array_join("words", "")).alias("round_trip"))
    total = "(cast(sums.high as decimal(38,0)) * 4294967296 + cast(sums.low as decimal(38,0)))"
    each = each.withColumn("ids_hash", F.expr(f"xxhash64(cast(cast({total} as decimal(38,6)) as string))"))
    return Scratch(docs.sparkSession, "lattice").keep(each.select("doc_id", "n_words", "n_pieces", "ids_hash", "round_trip"), "result")


def _decoding(model: str) -> Column:
    """The bytes of each piece in hexadecimal, by id."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    codes = [sp.id_to_piece(i)[3:5] if sp.is_byte(i) else sp.id_to_piece(i).encode().hex().upper() for i in range(sp.get_piece_size())]
    return F.split(F.lit(",".join(codes)), ",")


def _text_of(table: Column, ids) -> Column:
    return F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")), "UTF-8")


def decode_ids(words: DataFrame, model: str) -> DataFrame:
    """Add `decoded`: the bytes of the pieces of `ids`, as text; spaces stay in their escaped form."""
    return words.withColumn("decoded", _text_of(_decoding(model), "ids"))


def whole_texts(words: DataFrame) -> DataFrame:
    """The ids of each whole text, from encoded words; one row per text."""
    parts = F.sort_array(F.collect_list(F.struct("at", "ids")))
    return words.groupBy("block", "doc_id", "__key").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")).drop("block", "__key")
