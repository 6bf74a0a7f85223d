"""Exact deduplication by recipes of content-defined chunks."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparecost.llm import grams
from sparecost.llm.common import Scratch, runs_of, task, text_buffer

_SLICE = 2 << 20


def cut_points(data: np.ndarray, offsets: np.ndarray, bits: int, window: int = 32, longest: int = 1 << 16) -> np.ndarray:
    """Ends of the chunks: after each byte whose last `window` bytes hash to zero in `bits` bits, at the end of a text,
    and where a chunk would be longer than `longest`. Equal texts have equal cuts wherever they stand."""
    cuts = offsets[1:]
    if len(data) >= window:
        ends = np.arange(window, len(data) + 1)
        h = grams.span_hash(grams.prefix_sums(data), ends - window, ends)
        found = ends[(h & np.uint64((1 << bits) - 1)) == 0]
        begun = offsets[np.searchsorted(offsets, found - 1, "right") - 1]
        cuts = np.union1d(found[found - window >= begun], cuts)
    cuts = cuts[cuts > 0]
    starts = np.concatenate([[0], cuts[:-1]]).astype(np.int64)
    if len(cuts) and (cuts - starts).max() > longest:
        more = [np.arange(s + longest, e, longest) for s, e in zip(starts, cuts) if e - s > longest]
        cuts = np.union1d(cuts, np.concatenate(more))
    return cuts


def _chunk(batches, bits: int, hash_bits: int, with_bytes: bool):
    keep = np.uint64((1 << hash_bits) - 1)
    for batch in batches:
        data, offsets = text_buffer(batch.column("__text"))
        for first, last in runs_of(offsets, _SLICE):
            at = offsets[first:last + 1] - offsets[first]
            part = grams.LOWER[data[offsets[first]:offsets[last]]]
            cuts = cut_points(part, at, bits)
            starts = np.concatenate([[0], cuts[:-1]]).astype(np.int64)[:len(cuts)]
            h = (grams.span_hash(grams.prefix_sums(part), starts, cuts) & keep).view(np.int64)
            lists = np.searchsorted(starts, at).astype(np.int32)
            lists[-1] = len(cuts)
            raw, rows = part.tobytes(), batch.slice(first, last - first)
            if with_bytes:
                chunks = [raw[s:e] for s, e in zip(starts, cuts)]
                row = np.repeat(np.arange(last - first), np.diff(lists))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("__row").take(pa.array(row)), pa.array((np.arange(len(cuts)) - lists[row]).astype(np.int32)),
                     pa.array(h), pa.array(chunks, pa.binary())], names=["__row", "seq", "hash", "bytes"])
            else:
                sha = [hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("__row"), pa.array(sha), pa.ListArray.from_arrays(pa.array(lists), pa.array(h))],
                    names=["__row", "text_sha256", "recipe"])


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 10, hash_bits: int = 64) -> DataFrame:
    """One row per chunk of every whole text: __row (the id), seq, hash, bytes."""
    df = docs.select(F.col(id_col).cast("long").alias("__row"), F.col(text_col).alias("__text"))
    return df.mapInArrow(task(_chunk, bits, hash_bits, True), "__row long, seq int, hash long, bytes binary")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 10, hash_bits: int = 64) -> DataFrame:
    """One row per document: __row, text_sha256 of the normalised text, and the hashes of its chunks in order."""
    df = docs.select(F.col(id_col).cast("long").alias("__row"), F.col(text_col).alias("__text"))
    return df.mapInArrow(task(_chunk, bits, hash_bits, False), "__row long, text_sha256 string, recipe array<long>")


def chunk_store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 10, hash_bits: int = 64) -> DataFrame:
    """Each distinct chunk once: hash, bytes, uses. Copies collapse in the map tasks, so a hot chunk sends a row per task."""
    return chunks(docs, id_col, text_col, bits, hash_bits).groupBy("hash", "bytes").agg(F.count(F.lit(1)).alias("uses"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 10, hash_bits: int = 64) -> DataFrame:
    """Group documents with equal texts (A-Z lower-cased, null counts as empty); the largest id of a group stays.

    Texts are cut into chunks of about 2^bits bytes at places that their content decides. Every distinct chunk is moved
    once to compare the bytes behind one hash; a hash that stands for one content is the chunk's verified identifier, and
    the contents behind any other hash are numbered. Two texts are equal if their lists of identifiers are. Groups are
    counted with partial sums, so a group of any size sends one row per map task.

    Returns doc_id, keep_id, group_size, kept, text_sha256, a row for each row given. Rows that share the id that stays
    all count as that document and are kept; a group whose ids are all null keeps all its rows, with a null keep_id. No
    rows give no rows. Other columns are not read, so their names cannot clash.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    listed = scratch.keep(recipes(docs, id_col, text_col, bits, hash_bits), "recipes")
    store = chunk_store(docs, id_col, text_col, bits, hash_bits)
    unclear = scratch.keep(store.groupBy("hash").count().filter("count > 1").select("hash"), "unclear")
    ordered = listed.withColumn("ids", F.col("recipe"))
    if not unclear.isEmpty():
        several = chunks(docs, id_col, text_col, bits, hash_bits).join(unclear, "hash", "left_semi")
        versions = (
            several.select("hash", "bytes").distinct()
            .withColumn("version", F.dense_rank().over(Window.partitionBy("hash").orderBy("bytes")) - 1)
        )
        # by row: which version of the hash stands at which place
        places = (
            several.join(versions, ["hash", "bytes"]).select("__row", "hash", "seq", "version")
            .groupBy("__row").agg(F.sort_array(F.collect_set(F.struct("seq", "hash", "version"))).alias("places"))
        )
        ordered = listed.join(places, listed["__row"].eqNullSafe(places["__row"]), "left").select(
            listed["__row"], "text_sha256", "recipe",
            F.concat("recipe", F.expr("coalesce(flatten(transform(places, p -> array(cast(p.seq as long), cast(p.version as long)))), array())")).alias("ids"),
        )
    groups = ordered.groupBy("ids").agg(F.max("__row").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    result = ordered.join(groups, "ids").select(
        F.col("__row").alias("doc_id"), "keep_id", "group_size",
        F.col("__row").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )
    return scratch.done(result, "recipes", "unclear")
