"""Removal of phrases that recur from earlier documents, located by Aho-Corasick automata."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparecost.llm import grams
from sparecost.llm.common import Scratch, task
from sparecost.llm.recurring import SPANS, given_texts, grouped, merged_spans, repeated_cells, segments, span_batch, with_spans

_BATCH_BYTES = 1 << 18
WINDOW = 5
_SPACES = re.compile(rb"[\x20\x09-\x0D]+")


def recurring_phrases(documents: np.ndarray, words: np.ndarray, ends: np.ndarray, length: int) -> dict[tuple[int, ...], int]:
    """Phrases of `length` words that stand in two documents or more, with the smallest document.

    words are the numbers of the words of all texts, one text after the other; ends tells where each text ends.

    All windows are hashed at once and counted by hash; only those in two documents are looked at as words, one for each
    phrase. Windows that share a hash are compared word by word with the first of them, and counted on their own if they differ.
    """
    of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    if len(words) < length:
        return {}
    hashes = grams.window_hash(grams.mix(words.astype(np.uint64) + np.uint64(1)), length)
    at = np.flatnonzero(of[:len(hashes)] == of[length - 1:])
    at = at[np.lexsort((documents[of[at]], hashes[at]))]
    owner = documents[of[at]]
    head = np.flatnonzero(np.concatenate([[True], hashes[at[1:]] != hashes[at[:-1]]])) if len(at) else at
    size = np.diff(np.concatenate([head, [len(at)]]))
    last = owner[head + size - 1] if len(head) else head
    shared = np.flatnonzero(owner[head] != last)  # least document against greatest
    windows = np.lib.stride_tricks.sliding_window_view(words, length)
    phrases, other = {}, {}
    for first, doc in zip(windows[at[head[shared]]].tolist(), owner[head[shared]].tolist()):
        phrases[tuple(first)] = doc
    members = np.repeat(shared, size[shared])
    place = np.repeat(head[shared] - np.cumsum(size[shared]) + size[shared], size[shared]) + np.arange(len(members))
    for i in range(0, len(place), 1 << 16):
        own, rep = at[place[i:i + (1 << 16)]], at[head[members[i:i + (1 << 16)]]]
        for k in np.flatnonzero((windows[own] != windows[rep]).any(axis=1)).tolist():
            phrase, doc = tuple(windows[own[k]].tolist()), int(owner[place[i + k]])
            other.setdefault(phrase, []).append(doc)
    return phrases | {p: min(docs) for p, docs in other.items() if min(docs) != max(docs)}


class Letters:
    """Words as pairs of letters, so that a node of an automaton has few children: their number is searched one by one.

    The first letters and the second letters of words do not overlap, so a match begins and ends with a word.
    """

    def __init__(self, words: int):
        self.base = max(2, int(np.ceil(np.sqrt(max(1, words)))))

    def text(self, words: np.ndarray) -> str:
        pairs = np.empty((len(words), 2), "<u4")
        pairs[:, 0], pairs[:, 1] = words // self.base, self.base + words % self.base
        return pairs.tobytes().decode("utf-32-le")


def automaton(phrases: dict[tuple[int, ...], int], letters: Letters):
    built = ahocorasick.Automaton(ahocorasick.STORE_ANY)
    if phrases:
        length = len(next(iter(phrases)))
        every = letters.text(np.fromiter((w for p in phrases for w in p), np.int64, length * len(phrases)))
        for i, doc in enumerate(phrases.values()):
            built.add_word(every[2 * length * i:2 * length * (i + 1)], doc)
    built.make_automaton()
    return built


def _located(batches, length: int):
    """One shard of phrases after the other: confirm, compile, and run the texts that the shard's anchors lead to."""
    for rows in grouped(batches, _BATCH_BYTES):
        spans = [(r[1], r[2], r[3], r[3] + r[5]) for r in rows if r[6] is None]
        rows = [r for r in rows if r[6] is not None]
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        words = [r[6].split(b" ") for r in rows]
        ends = np.cumsum([len(w) for w in words])
        flat = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int64, int(ends[-1]) if rows else 0)
        phrases = recurring_phrases(np.array([r[1] for r in rows], np.int64), flat, ends, length) if rows else {}
        if phrases:
            letters = Letters(len(numbers))
            built, text, at = automaton(phrases, letters), letters.text(flat), 0
            for (_, doc, key, start, *_), end in zip(rows, ends.tolist()):
                a = b = -1
                for last, first in built.iter(text[2 * at:2 * end]):
                    if first < doc:
                        close = (last + 1) // 2
                        if a >= 0 and close - length <= b:
                            b = close
                        else:
                            if a >= 0:
                                spans.append((doc, key, start + a, start + b))
                            a, b = close - length, close
                if a >= 0:
                    spans.append((doc, key, start + a, start + b))
                at = end
        if spans:
            yield span_batch(spans)


def _cut(batches, with_text: bool):
    for batch in batches:
        spans = batch.column("spans").to_pylist()
        texts = batch.column("__text").to_pylist()
        out = []
        for text, found in zip(texts, spans):
            words, at, kept = [w for w in _SPACES.split((text or "").encode()) if w], 0, []
            for a, b in merged_spans((s["a"], s["b"]) for s in found or ()):
                kept += words[at:a]
                at = b
            kept += words[at:]
            rest = b" ".join(kept)
            out.append((len(words), len(words) - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode() if with_text else None))
        columns = zip(*out) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))]],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def phrase_dedup(
    docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text", bits: int = 28, with_text: bool = False,
) -> DataFrame:
    """Remove every word covered by a phrase of `length` words that also starts in a document with a smaller doc_id.

    Texts that may recur are dealt by the anchor of their phrases, so a shard of phrases and all texts that can hold them
    meet in one place. A task goes through its shards: it confirms the phrases that stand in two documents, by vectorised
    hashes of all windows and a count, compiles the automaton of these phrases, and streams the texts of the shard through it
    to locate every occurrence. Words are compared themselves there and not by hashes.

    Returns doc_id, n_words, n_removed, kept_sha256 (words left, joined by one space), and with with_text the words; one row
    per row given. Null and empty texts have no words; texts may be of any length. A null doc_id takes no part and keeps
    all words. Rows that share a doc_id, alike or not, are none of them smaller, so they take nothing from each other. Other
    columns are not read, so their names cannot clash. No rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "phrases")
    given = given_texts(docs, id_col, text_col)
    bitmap = repeated_cells(spark, given, True, length, WINDOW, bits)
    found = segments(given, True, length, WINDOW, bits, bitmap, True)
    spans = scratch.keep(found.repartition("h").sortWithinPartitions("h").mapInArrow(task(_located, length), SPANS), "spans")
    bitmap.destroy()
    del found
    scratch.release()
    cut = with_spans(given, spans).mapInArrow(
        task(_cut, with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return scratch.done(cut if with_text else cut.drop("kept_text"), "spans")
