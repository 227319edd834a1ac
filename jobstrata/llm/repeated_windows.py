"""Substring dedup by level-wise doubling of repeated word windows.

To find every run of ``window`` words that also starts earlier, windows of a shorter
length are compared first: only where those repeat, windows of twice the length are
tried, and so on until ``window``. At each short level a long window is represented by
its lowest short window (equal long windows have their lowest short window at the same
offset), so only a share of about 2 / (window - length + 2) of the positions is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm import rows

WINDOW = 20
#: first level; its double is the window itself
FIRST = 10


def levels(first: int, window: int) -> list[int]:
    """The short lengths: ``first``, doubled while shorter than ``window``."""
    out = []
    while first < window:
        out.append(first)
        first *= 2
    return out


def _words(batch: pa.RecordBatch):
    flat, counts = rows.split_words(rows.texts(batch))
    return rows.word_hashes(flat), counts


def _alive(units, counts, lengths: list[int], window: int, batch: pa.RecordBatch):
    """Which windows' lowest short window repeats, judged by the places found so far.

    From its third column on the batch has, for each level done, the offsets of repeated
    anchors by row.
    """
    able = rows.inside(counts, window)
    for length, lists in zip(lengths, batch.columns[2:]):
        span = window - length + 1
        level = rows.stirred(rows.window_hashes(units, length))
        repeated = np.full(len(units), rows.HIGHEST)
        at = rows.listed_places(lists, counts)
        repeated[at] = level[at]
        low = rows.running_min(level, span)
        able &= rows.running_min(repeated, span) == low
    return able


def _doc_of(counts: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.cumsum(counts), at, side="right")


def _anchor_rows(lengths: list[int], window: int, bits: int):
    """The anchors of the next level, among windows still alive."""
    *done, length = lengths

    def run(batches):
        sent = rows.Occurrences(bits)
        for batch in rows.slices(batches, "text"):
            units, counts = _words(batch)
            if not len(units):
                continue
            able = _alive(units, counts, done, window, batch)
            level = rows.stirred(rows.window_hashes(units, length))
            _, marked = rows.anchors(level, able, window - length + 1)
            _send(sent, batch, counts, np.flatnonzero(marked), level, 0)
        yield from sent.batches()

    return run


def _window_rows(lengths: list[int], window: int, bits: int):
    """The windows still alive."""

    def run(batches):
        sent = rows.Occurrences(bits)
        for batch in rows.slices(batches, "text"):
            units, counts = _words(batch)
            if not len(units):
                continue
            able = _alive(units, counts, lengths, window, batch)
            h = rows.stirred(rows.window_hashes(units, window))
            # a second hash, of other units
            g = rows.stirred(rows.window_hashes(rows.stirred(units), window)) >> np.uint64(32)
            _send(sent, batch, counts, np.flatnonzero(able), h, g)
        yield from sent.batches()

    return run


def _send(sent: rows.Occurrences, batch: pa.RecordBatch, counts, at, h, g) -> None:
    doc = _doc_of(counts, at)
    docs = batch.column(0).to_numpy(zero_copy_only=False)
    second = g[at] if isinstance(g, np.ndarray) else g
    sent.add(h[at], second, docs[doc], at - rows.offsets(counts)[doc])


def _removed(window: int):
    """Per document: words, removed words, kept text and its digest."""

    def run(batches):
        for batch in rows.slices(batches, "text"):
            flat, counts = rows.split_words(rows.texts(batch))
            at = rows.listed_places(batch.column(2), counts)  # each place once
            change = np.bincount(at, minlength=len(flat) + 1)
            change -= np.bincount(at + window, minlength=len(flat) + 1)
            gone = np.cumsum(change[:-1]) > 0
            owner = np.repeat(np.arange(len(counts)), counts)
            removed = np.bincount(owner[gone], minlength=len(counts))
            kept = flat.filter(pa.array(~gone))
            ends = np.concatenate([[0], np.cumsum(counts - removed)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), kept)
            texts = pc.binary_join(lists, pa.scalar(" ", pa.large_string()))
            digests = [hashlib.sha256(t.as_buffer()).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts),
                    pa.array(removed),
                    pa.array(digests, pa.string()),
                    texts.cast(pa.string()),
                ],
                names=["doc", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def _by_document(sent: DataFrame, every: bool, name: str) -> DataFrame:
    places = rows.wanted_places(sent, every)
    return places.groupBy("doc").agg(F.collect_list("pos").alias(name))


def without_repeated_windows(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    first: int = FIRST,
) -> DataFrame:
    """Per document: ``key, n_words, n_removed, kept_sha256, kept_text``.

    Every word covered by a run of ``window`` words that also starts earlier (smaller key,
    or same document and earlier) is removed, all judged on the input; the kept words are
    joined by one blank. Words are runs outside ASCII white space, unchanged.

    Rows with a null key are left out; null text has no words; texts shorter than a
    window keep all words. Rows that repeat a key are one document, the one with the
    greatest text. An empty table gives no rows. Other columns are not read.

    The texts are dealt by document once and that shuffle serves every level. A hash
    leaves a task once, so a window that a third of all documents hold has at most one
    entry per task in any group. The places come back packed by document and task.
    """
    texts = rows.one_row_per_document(docs, key, text)
    bits = rows.bucket_bits(docs, text)
    lengths = levels(first, window)
    known = texts
    for n in range(1, len(lengths) + 1):
        sent = known.mapInArrow(_anchor_rows(lengths[:n], window, bits), rows.Occurrences.SCHEMA)
        known = known.join(_by_document(sent, True, f"level{n}"), "doc", "left" if n > 1 else "inner")
    sent = known.mapInArrow(_window_rows(lengths, window, bits), rows.Occurrences.SCHEMA)
    later = _by_document(sent, False, "later")
    done = texts.join(later, "doc", "left").mapInArrow(
        _removed(window),
        "doc long, n_words long, n_removed long, kept_sha256 string, kept_text string",
    )
    return done.withColumnRenamed("doc", key)
