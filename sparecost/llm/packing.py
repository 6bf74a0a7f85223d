"""Packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import array
import bisect
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparecost.llm.common import Scratch, runs_of, task, text_buffer

_CACHED = 200_000
_AT_ONCE = 4 << 20
_JOINED = 1000
_TOGETHER = 16
#: a space before other white space or at the end: such a text is encoded as a whole
_ODD_SPACE = re.compile(r" (?=\s|$)")
_tokenizers: dict = {}


class WordEncoder:
    """Token ids of texts, as little-endian unsigned 32-bit bytes.

    A byte-level BPE of this kind never joins what stands before a space with what follows it, so the ids of a text are
    those of its words, each with the space before it. The distinct words of many texts are looked up once in a cache of two
    generations, of which the older goes when the younger is full; new ones are encoded many at once, as one text that is cut
    where an id begins with a space. Texts with other runs of white space, or with the name of a special token, are encoded as a whole.
    """

    def __init__(self, path: str):
        # the tasks of a machine share its cores already; threads of the tokenizer would hold memory each
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [str(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict = {}
        self.old: dict = {}
        # a byte-level vocabulary spells a space as the letter that stands for byte 32
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.begins[[i for piece, i in self.tokenizer.get_vocab().items() if piece[0] == chr(256 + 32)]] = True

    def _new(self, words: list[str]) -> list[bytes]:
        """Ids of words with the space before each; `_JOINED` words are one text."""
        found = []
        texts = [" " + " ".join(words[i:i + _JOINED]) for i in range(0, len(words), _JOINED)]
        for k, text in enumerate(texts):
            own = words[k * _JOINED:(k + 1) * _JOINED]
            # one text at a time: what the tokenizer makes of a text is many times larger than its ids
            ids = np.array(self._encode([text])[0].ids, np.uint32)
            cuts = np.flatnonzero(self.begins[ids])
            if len(cuts) != len(own):  # a vocabulary that joins spaces otherwise
                found += self._ids([f" {w}" for w in own])
                continue
            raw, ends = ids.tobytes(), [*(4 * cuts[1:]).tolist(), 4 * len(ids)]
            found += [raw[a:b] for a, b in zip([0, *ends], ends)]
        return found

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array.array("I", e.ids).tobytes() for i in range(0, len(texts), _TOGETHER) for e in self._encode(texts[i:i + _TOGETHER])]

    def _encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words. What is met again moves to the young cache; once that is full it becomes the old one."""
        young, old = self.young, self.old
        found = [young.get(w) or old.get(w) for w in words]
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self._new([words[i] for i in new])):
            found[i] = ids
        young.update(zip(words, found))
        if len(young) > _CACHED:
            self.young, self.old = {}, young
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        split, whole = [], []
        for i, text in enumerate(texts):
            (whole if _ODD_SPACE.search(text) or any(s in text for s in self.special) else split).append(i)
        found = dict(zip(whole, self._ids([texts[i] for i in whole])))
        words = pc.split_pattern(pa.array([texts[i] for i in split], pa.large_string()), " ")
        at = words.offsets.to_numpy()
        flat = words.flatten().dictionary_encode()
        first = dict(zip(split, self._ids(flat.take(pa.array(at[:-1])).to_pylist())))
        # distinct words are looked up once; the first word of a text has no space before it
        follows = np.ones(len(flat), bool)
        follows[at[:-1]] = False
        codes = flat.indices.to_numpy()[follows]
        used = np.flatnonzero(np.bincount(codes, minlength=len(flat.dictionary)))
        ids = self._known(flat.dictionary.take(pa.array(used)).to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        every = np.frombuffer(b"".join(ids), np.uint32) if ids else np.zeros(0, np.uint32)
        start = np.cumsum(size) - size
        at = at - np.arange(len(at))
        places = np.zeros(len(flat.dictionary), np.int64)
        places[used] = np.arange(len(used))
        for k, i in enumerate(split):
            own = places[codes[at[k]:at[k + 1]]]
            if len(own):
                ends = np.cumsum(size[own])
                place = np.repeat(start[own] + size[own] - ends, size[own])
                first[i] += every[place + np.arange(ends[-1])].tobytes()
        return [found[i] if i in found else first[i] for i in range(len(texts))]


def _pieces(batches, path: str, capacity: int, end_id: int, keep_ids: bool):
    encoder = _tokenizers.get(path) or _tokenizers.setdefault(path, WordEncoder(path))
    end = array.array("I", [end_id]).tobytes()
    for batch in batches:
        for first, last in runs_of(text_buffer(batch.column("__text"))[1], _AT_ONCE):
            part = batch.slice(first, last - first)
            texts = [t or "" for t in part.column("__text").to_pylist()]
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, ids in enumerate(encoder.encode(texts)):
                ids += end
                total, at, n = len(ids) // 4, 0, 0
                size = total if total <= capacity else total % capacity or capacity
                while at < total:
                    cut = ids[4 * at:4 * (at + size)]
                    row.append(i), piece.append(n), start.append(at), length.append(size), crc.append(zlib.crc32(cut))
                    if keep_ids:
                        kept.append(array.array("I", cut).tolist())
                    at, n, size = at + size, n + 1, capacity
            columns = [part.column("doc_id").take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most `capacity` ids: the ids of each whole text and then `end_id`; a null text counts as empty.

    Only longer documents are cut: into full pieces, with what is over as the first one.
    """
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return df.mapInArrow(task(_pieces, tokenizer, capacity, end_id, keep_ids), schema)


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Which ranks of each size go where: (size, first rank, items per bin, bins, first bin, offset in the bin).

    Pieces above a third of the capacity meet at most twice in a bin: in falling size, each takes the largest other one
    that fits. Smaller pieces follow in falling size, each to the fullest bin with room. Equal pieces in equal bins are
    placed at once, so the work depends on the capacity and not on the number of pieces.
    """
    left, rank, rows, bins = {s: n for s, n in counts.items() if n}, {}, [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []

    def free(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                bisect.insort(order, gap)
            gaps.setdefault(gap, []).append((first, n))

    def put(size: int, per: int, n: int, first: int, offset: int) -> None:
        rows.append((size, rank.get(size, 0), per, n, first, offset))
        rank[size] = rank.get(size, 0) + per * n
        left[size] -= per * n

    large = sorted(s for s in left if 3 * s > capacity)
    for a in reversed(large):
        while left[a]:
            partners = [b for b in large[:bisect.bisect_right(large, min(a, capacity - a))] if left[b]]
            b = partners[-1] if partners else 0
            n = left[a] if not b else left[a] // 2 if a == b else min(left[a], left[b])
            if a == b and not n:  # the last of an odd number takes the next smaller partner
                b = partners[-2] if len(partners) > 1 else 0
                n = 1
            put(a, 1, n, bins, 0)
            if b:
                put(b, 1, n, bins, a)
            free(capacity - a - b, bins, n)
            bins += n
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            at = bisect.bisect_left(order, s)
            if at == len(order):
                gap, first, n = capacity, bins, -(-left[s] // (capacity // s))
                bins += n
            else:
                gap = order[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            per, offset = gap // s, capacity - gap
            full = min(n, left[s] // per)
            if full:
                put(s, per, full, first, offset)
                free(gap - per * s, first, full)
            if left[s] and full < n:
                some = left[s]
                put(s, some, 1, first + full, offset)
                free(gap - some * s, first + full, 1)
                full += 1
            free(gap, first + full, n - full)
    return rows


def pack_pieces(pieces: DataFrame, capacity: int = 2048, ranks_per_group: int = 1 << 16) -> DataFrame:
    """Add sequence_id and offset to pieces of a known length; see packing_plan.

    The driver gets the count of each length (at most `capacity` rows) and makes the plan from them. A piece finds its
    place by its rank among the pieces of its length. Ranks are taken in groups that a hash of the piece decides, so a
    length that most pieces have is ranked by many tasks.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = packing_plan(counts, capacity)
    groups = max(1, max(counts.values(), default=0) // ranks_per_group)
    names = ["length", "first_rank", "per", "bins", "first_bin", "at"]
    rows = pa.table({n: pa.array([r[i] for r in plan], pa.int64()) for i, n in enumerate(names)})
    placed = spark.createDataFrame(rows)
    df = pieces.withColumn("__group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = df.groupBy("length", "__group").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "__group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    within = Window.partitionBy("length", "__group").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = df.withColumn("__rank", F.row_number().over(within) - 1).join(before, ["length", "__group"])
    rank = F.col("__rank") + F.col("__before")
    hit = (F.col("p.length") == F.col("q.length")) & (rank >= F.col("first_rank")) & (rank < F.col("first_rank") + F.col("per") * F.col("bins"))
    by = rank - F.col("first_rank")
    # the plan has a few rows per length and at most `capacity` lengths
    joined = ranked.alias("p").join(F.broadcast(placed.alias("q")), hit)
    return joined.select(
        *[F.col(f"p.{c}") for c in pieces.columns], (F.col("first_bin") + F.expr(f"(__rank + __before - first_rank) div per")).alias("sequence_id"),
        (F.col("at") + F.pmod(by, F.col("per")) * F.col("p.length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence in order, from pieces packed with their ids; a sequence has at most `capacity` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise all documents, cut the longer ones, and pack the pieces into sequences of at most `capacity` ids.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Empty and null texts give one piece with the
    end id alone. A null or repeated doc_id is packed like any other row. No rows give no rows. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.keep(token_pieces(docs, tokenizer, capacity, 0, id_col, text_col), "pieces")
    return scratch.done(pack_pieces(pieces, capacity), "pieces")
