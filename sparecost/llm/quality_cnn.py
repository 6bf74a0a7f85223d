"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecost.llm.common import runs_of, task, text_buffer

CHUNK, STEP, WIDTH, FILTERS = 512, 448, 4, 24
_SLICE = 1 << 18


def chunk_positions(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and start of each chunk: every STEP bytes, so chunks overlap and cover the whole text; at least one."""
    counts = np.maximum(1, -(-np.maximum(sizes - (CHUNK - STEP), 0) // STEP))
    doc = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return doc, number * STEP


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per chunk the position of each of its windows of WIDTH bytes in padded data (each text is followed by WIDTH zero
    bytes); behind the end of a text its last window is taken again, which changes no maximum."""
    sizes = np.diff(offsets)
    doc, start = chunk_positions(sizes)
    base = offsets[:-1] + np.arange(len(sizes)) * WIDTH
    last = np.maximum(sizes - WIDTH, 0)
    at = np.minimum(start[:, None] + np.arange(CHUNK - WIDTH + 1), last[doc][:, None])
    return doc, at + base[doc][:, None]


def padded(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sizes = np.diff(offsets)
    out = np.zeros(len(data) + WIDTH * len(sizes), np.uint8)
    out[np.arange(len(data)) + WIDTH * np.repeat(np.arange(len(sizes)), sizes)] = data
    return out


class Network:
    """Learned filters over WIDTH bytes, maximum over each chunk, and a weighted sum; a document is the mean of its chunks."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.filters = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.weights = rng.normal(0, 0.3, FILTERS).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.weights, self.offset]

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Response to each pair of bytes at the first two and at the last two places of a window."""
        f = self.filters
        return (f[0][:, None] + f[1][None]).reshape(65536, -1), (f[2][:, None] + f[3][None]).reshape(65536, -1)

    def chunk_scores(self, data: np.ndarray, at: np.ndarray, tables: tuple) -> np.ndarray:
        pairs = data[:-1].astype(np.int32) << 8 | data[1:]
        out = np.empty(len(at), np.float32)
        for first in range(0, len(at), 64):
            own = at[first:first + 64]
            found = tables[0][pairs[own]]
            found += tables[1][pairs[own + 2]]
            out[first:first + 64] = np.maximum(found.max(1) + self.bias, 0) @ self.weights + self.offset
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray, tables: tuple) -> np.ndarray:
        doc, at = windows(data, offsets)
        values = self.chunk_scores(padded(data, offsets), at, tables)
        mean = np.bincount(doc, values, len(offsets) - 1) / np.bincount(doc, minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(mean, -30, 30)))

    def train(self, chunks: list[bytes], labels: np.ndarray, weights: np.ndarray, rounds: int = 6, rate: float = 0.01, seed: int = 6) -> None:
        """Adam on the chunk losses; the gradient reaches only the window of each chunk that a filter likes best."""
        rng = np.random.default_rng(seed)
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in chunks])]).astype(np.int64)
        raw = np.frombuffer(b"".join(chunks), np.uint8)
        doc, at = windows(raw, offsets)
        data, at = padded(raw, offsets), at[np.searchsorted(doc, np.arange(len(chunks)))]
        moments = [[np.zeros_like(p) for p in self.parameters()] for _ in range(2)]
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(chunks))
            for first in range(0, len(order), 64):
                own = order[first:first + 64]
                bytes_ = [data[at[own] + k] for k in range(WIDTH)]
                found = self.filters[0][bytes_[0]]
                for k in range(1, WIDTH):
                    found += self.filters[k][bytes_[k]]
                best = found.argmax(1)
                top = np.take_along_axis(found, best[:, None], 1)[:, 0] + self.bias
                active = np.maximum(top, 0)
                z = active @ self.weights + self.offset
                g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[own]) * weights[own] / len(own)).astype(np.float32)
                inner = g[:, None] * self.weights * (top > 0)
                grads = [np.zeros_like(self.filters), inner.sum(0), active.T @ g, np.array([g.sum()], np.float32)]
                columns = np.broadcast_to(np.arange(FILTERS), best.shape)
                for k in range(WIDTH):
                    np.add.at(grads[0][k], (np.take_along_axis(bytes_[k], best, 1), columns), inner)
                step += 1
                for p, grad, m, v in zip(self.parameters(), grads, *moments):
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)


def _sample(batches, most: int):
    for batch in batches:
        data, offsets = text_buffer(batch.column("__text"))
        doc, start = chunk_positions(np.diff(offsets))
        first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        rows, chunks = [], []
        for i in range(batch.num_rows):
            own = np.unique(np.linspace(first[i], first[i + 1] - 1, most).astype(int))
            for s in start[own]:
                rows.append(i), chunks.append(data[offsets[i] + s:min(offsets[i] + s + CHUNK, offsets[i + 1])].tobytes())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").take(pa.array(rows, pa.int32())), batch.column("quality").take(pa.array(rows, pa.int32())), pa.array(chunks, pa.binary())],
            names=["doc_id", "quality", "chunk"])


def _score(batches, network: Network):
    tables = network._pairs()
    for batch in batches:
        data, offsets = text_buffer(batch.column("__text"))
        found = [np.zeros(0)]
        for a, b in runs_of(offsets, _SLICE):
            found.append(network.scores(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], tables))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(found))], names=["doc_id", "score"])


def _held_out(column):
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train_network(docs: DataFrame, labels: DataFrame, rows_per_label: int = 1500, chunks_per_row: int = 6, seed: int = 5) -> Network:
    """Fit on at most rows_per_label documents of each label, those with the smallest hash of their id, and at most
    chunks_per_row chunks of each, spread over the whole text. Rows whose crc32(doc_id) is divisible by 5 are not used."""
    given = labels.filter("doc_id is not null and quality in (0, 1)").filter(~_held_out("doc_id"))
    given = given.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    parts = [given.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_label) for q in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))  # 2 * rows_per_label rows at most
    # of rows that share an id one is used, so as many rows are collected as were chosen
    used = docs.join(chosen, "doc_id").groupBy("doc_id", "quality").agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"))
    chunks = used.mapInArrow(task(_sample, chunks_per_row), "doc_id long, quality int, chunk binary").collect()
    network = Network(seed)
    if chunks:
        chunks.sort(key=lambda r: (r["doc_id"], r["chunk"]))
        y = np.array([r["quality"] for r in chunks], np.float32)
        share = np.array([max(1, (y == 0).sum()), max(1, (y == 1).sum())])
        weights = (len(y) / 2 / share)[y.astype(int)].astype(np.float32)
        network.train([bytes(r["chunk"]) for r in chunks], y, weights, seed=seed + 1)
    return network


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_label: int = 1500,
    threshold: float = 0.3, seed: int = 5,
) -> DataFrame:
    """Score every whole text with a network trained on labelled documents.

    Returns doc_id, held_out (crc32 of the id as text is divisible by 5), score and predicted (1 from `threshold` on), one
    row per row given; equal texts are scored alike, and of rows that share a labelled id one text is trained on. Null and
    empty texts are scored as an empty chunk; texts may be of any length. A null id is not held out and never trained on.
    Other columns are not read, so their names cannot clash. Without labelled rows the network keeps its initial weights;
    no rows give no rows.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"))
    network = train_network(given, labels, rows_per_label, seed=seed)
    scored = given.mapInArrow(task(_score, network), "doc_id long, score double")
    return scored.select("doc_id", _held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
