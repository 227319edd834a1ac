"""What the Arrow-based operators share: slicing batches, words, hashes, packed places.

A Python task sees its partition as a stream of Arrow batches. Every batch is cut into
slices of bounded text size, so the memory of a task follows the slice and the longest
single text, not the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20
#: odd multiplier of the polynomial window hashes (any odd 64-bit constant serves)
BASE = np.uint64(0x9E3779B97F4A7C15)
HIGHEST = np.uint64(0xFFFFFFFFFFFFFFFF)

#: a place is a document and an offset in it
PLACE = np.dtype([("doc", "<i8"), ("pos", "<i4")])


def give_back() -> None:
    """Returns free memory to the system: a worker lives on beside later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def slices(batches, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows again, in slices of about ``size`` bytes of ``column``; one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        index = batch.schema.get_field_index(column)
        values = batch.column(index)
        if pa.types.is_binary(values.type):
            sizes = [zstandard.frame_content_size(v) for v in values.to_pylist()]
            lengths = pa.array(sizes, pa.int64())
        else:
            lengths = pc.fill_null(pc.binary_length(values), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column as large strings, null as empty; ``compressed`` texts are unpacked.

    The values are copied, so that their first offset is 0: Arrow's ascii_lower reads a
    slice's data from the wrong place otherwise.
    """
    values = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_binary(values.type):
        unpack_ = zstandard.ZstdDecompressor().decompress
        return pa.array([unpack_(v) for v in values.to_pylist()], pa.large_binary()).cast(
            pa.large_string()
        )
    own = values.take(pa.array(np.arange(len(values))))
    return pc.fill_null(own.cast(pa.large_string()), "")


def compressed(texts: DataFrame) -> DataFrame:
    """(doc, text) with each text as a zstd frame, for texts that are shuffled whole."""

    def run(batches):
        pack_ = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches, "text"):
            bodies = [pack_(v or b"") for v in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(bodies, pa.binary())], names=["doc", "text"]
            )

    return texts.select("doc", "text").mapInArrow(run, "doc long, text binary")


def split_words(values: pa.Array, pattern: str | None = None) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and how many words each text has.

    Words are runs outside ASCII white space, or outside ``pattern``.
    """
    parts = (
        pc.ascii_split_whitespace(values)
        if pattern is None
        else pc.split_pattern_regex(values, pattern)
    )
    owner = pc.list_parent_indices(parts)
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    flat, owner = flat.filter(full), owner.filter(full)
    counts = np.bincount(owner.to_numpy(zero_copy_only=False), minlength=len(values))
    return flat, counts.astype(np.int64)


def lower_ascii(values: pa.Array) -> pa.Array:
    """A-Z to a-z, other characters as they are."""
    return pc.ascii_lower(values)


def word_hashes(words: pa.Array, key: str = "corpus-words-001") -> np.ndarray:
    """A keyed 64-bit hash of every word; each distinct word of the slice is hashed once."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    coded = pc.dictionary_encode(words)
    distinct = coded.dictionary.to_numpy(zero_copy_only=False)
    hashed = pd.util.hash_array(distinct, hash_key=key, categorize=False)
    return hashed[coded.indices.to_numpy(zero_copy_only=False)]


def power(exponent: int) -> np.uint64:
    return np.uint64(pow(int(BASE), exponent, 1 << 64))


def window_hashes(units: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every run of ``width`` units (positions past the end are void).

    Runs are put together by doubling: a run of 2L is a run of L, moved up, and the next.
    """
    out = np.zeros(len(units), np.uint64)
    have, step, level = 0, 1, units.astype(np.uint64)
    while width:
        if width & 1:
            out = _joined(out, have, level, step)
            have += step
        width >>= 1
        if width:
            level = _joined(level, step, level, step)
            step *= 2
    return out


def _joined(left: np.ndarray, have: int, right: np.ndarray, step: int) -> np.ndarray:
    """Hash of ``have`` units at i followed by ``step`` units at i + have."""
    out = left * power(step)
    if have < len(right):
        out[: len(right) - have] += right[have:]
    return out


def stirred(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that their order is as good as random."""
    v = values ^ (values >> np.uint64(31))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    v = v ^ (v >> np.uint64(27))
    v = v * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def running_min(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i : i + width]) by doubling; the array's end is cut short."""
    return _running(values, width, np.minimum)


def _running(values, width, better):
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        if step < len(out):
            out = np.concatenate([better(out[:-step], out[step:]), out[-step:]])
        have += step
    return out


def running_max_before(values: np.ndarray, width: int) -> np.ndarray:
    """max(values[i - width + 1 : i + 1])."""
    return _running(values[::-1], width, np.maximum)[::-1]


def offsets(counts: np.ndarray) -> np.ndarray:
    """Start of each document in the concatenated units."""
    return np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)


def inside(counts: np.ndarray, width: int) -> np.ndarray:
    """Which positions start a run of ``width`` units inside one document."""
    total = int(counts.sum())
    ends = np.repeat(offsets(counts) + counts, counts)
    return np.arange(total) + width <= ends


def anchors(level: np.ndarray, ok: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(lowest value of each window, which positions are such a lowest value).

    ``level`` holds a hash for every position and ``ok`` which window starts count; a
    window at p covers the positions p .. p + span - 1. Equal windows have their lowest
    values at equal places, so only those positions need to be compared at large.
    """
    level = np.maximum(level, np.uint64(1))  # 0 stands for "no window" below
    low = running_min(level, span)
    reach = running_max_before(np.where(ok, low, np.uint64(0)), span)
    # level >= low for every window over a position, so equality with the highest suffices
    return low, (reach == level) & (reach > 0)


class Gathered:
    """Places grouped by hash, for one task: the rows (hash, packed places) of a partition."""

    def __init__(self) -> None:
        self.hashes: list[np.ndarray] = []
        self.places: list[np.ndarray] = []

    def add(self, hashes: np.ndarray, docs: np.ndarray, positions: np.ndarray) -> None:
        place = np.empty(len(hashes), PLACE)
        place["doc"], place["pos"] = docs, positions
        self.hashes.append(hashes)
        self.places.append(place)

    def batches(self, limit: int = 1 << 17) -> Iterator[pa.RecordBatch]:
        if not self.hashes:
            return
        hashes, places = np.concatenate(self.hashes), np.concatenate(self.places)
        self.hashes, self.places = [], []
        order = np.argsort(hashes, kind="stable")
        hashes, places = hashes[order], places[order]
        starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        for i in range(0, len(starts), limit):
            own = starts[i : i + limit]
            end = starts[i + limit] if i + limit < len(starts) else len(hashes)
            packed = pack(places[own[0] : end], np.append(own, end) - own[0])
            yield pa.record_batch(
                [pa.array(hashes[own].view(np.int64)), packed], names=["h", "at"]
            )


def pack(records: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value for each run of records between two bounds."""
    ends = (bounds * records.dtype.itemsize).astype(np.int32)
    body = pa.py_buffer(np.ascontiguousarray(records).tobytes())
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends.tobytes()), body]
    )


def unpack(values: pa.Array, dtype: np.dtype) -> np.ndarray:
    """All records of a binary column, one after another."""
    return np.frombuffer(b"".join(v for v in values.to_pylist() if v), dtype)


def by_document(places: np.ndarray) -> pa.RecordBatch:
    """(doc, packed offsets) rows of a batch of places, one for each document in it."""
    places = places[np.argsort(places["doc"], kind="stable")]
    docs = places["doc"]
    starts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if len(docs) else []
    starts = np.asarray(starts, np.int64)
    return pa.record_batch(
        [
            pa.array(docs[starts].astype(np.int64)),
            pack(places["pos"].astype("<i4"), np.append(starts, len(places))),
        ],
        names=["doc", "found"],
    )


def places_by_document(batches) -> Iterator[pa.RecordBatch]:
    """Turns rows with packed places into one row per document and batch."""
    for batch in batches:
        if batch.num_rows:
            at = batch.column(batch.schema.get_field_index("at"))
            yield by_document(unpack(at, PLACE))


#: a string's two hashes (96 bits tell strings apart), one of its places, and whether the
#: task has the string again
ENTRY = np.dtype([("h", "<u8"), ("g", "<u4"), ("doc", "<i8"), ("pos", "<i4"), ("again", "u1")])
#: text that one bucket of hashes stands for
BUCKET_BYTES = 256 << 10
HELD_BYTES = 16 << 20


def bucket_bits(docs: DataFrame, text: str) -> int:
    """How many leading bits of a hash name its bucket: buckets grow in number, not in size."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(6, min(40, (size // BUCKET_BYTES).bit_length()))


def _planes(records: np.ndarray) -> bytes:
    """The records byte by byte: all first bytes, all second bytes (bytes alike compress)."""
    return records.view(np.uint8).reshape(len(records), -1).T.tobytes()


def _from_planes(body: bytes, dtype: np.dtype) -> np.ndarray:
    planes = np.frombuffer(body, np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


class Occurrences:
    """One task's strings and their places, to find those that occur elsewhere.

    A string leaves the task once, with its first place, in the row of its bucket. Its
    other places in the task are known to repeat an earlier one; they leave as such,
    dealt by document. So a string that a third of all rows hold has one entry per task in
    its bucket.
    """

    SCHEMA = "bucket long, known boolean, body binary"

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.parts: list[np.ndarray] = []

    def add(self, h: np.ndarray, g, docs: np.ndarray, positions: np.ndarray) -> None:
        entries = np.empty(len(h), ENTRY)
        entries["h"], entries["g"], entries["doc"], entries["pos"] = h, g, docs, positions
        entries["again"] = 0
        self.parts.append(entries)

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        entries, fresh = _ordered(np.concatenate(self.parts))
        self.parts = []
        entries["again"][:-1] = ~fresh[1:]
        first, later = entries[fresh], entries[~fresh]
        yield from self._rows(first, first["h"], False)
        spread = stirred(later["doc"].astype(np.uint64))
        order = np.lexsort([later["pos"], spread])
        later = later[order]
        later["g"], later["again"] = 0, 0
        yield from self._rows(later, spread[order], True)

    def _rows(self, records: np.ndarray, hashes: np.ndarray, known: bool):
        buckets = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
        ends = np.append(cuts, len(records))
        for i in range(0, len(cuts), 1024):
            own = cuts[i : i + 1024]
            bodies = [_planes(records[a:b]) for a, b in zip(own, ends[i + 1 : i + 1025])]
            yield pa.record_batch(
                [
                    pa.array(buckets[own]),
                    pa.array(np.full(len(own), known)),
                    pa.array(bodies, pa.binary()),
                ],
                names=["bucket", "known", "body"],
            )


def _ordered(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries by string and place, and which are the first of their string."""
    entries = entries[
        np.lexsort([entries["pos"], entries["doc"], entries["g"], entries["h"]])
    ]
    fresh = np.ones(len(entries), bool)
    h, g = entries["h"], entries["g"]
    fresh[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    return entries, fresh


def wanted_places(sent: DataFrame, every: bool) -> DataFrame:
    """(h, doc, pos): what all tasks' ``Occurrences`` sent, one place a row.

    All places of the strings that repeat (``every``), or all but the first of each.
    """

    def rows_of(entries: np.ndarray):
        for i in range(0, len(entries), 1 << 17):
            part = entries[i : i + (1 << 17)]
            h = np.ascontiguousarray(part["h"]).view(np.int64)
            yield pa.record_batch(
                [pa.array(h), pa.array(part["doc"].copy()), pa.array(part["pos"].copy())],
                names=["h", "doc", "pos"],
            )

    def merged(bodies: list[bytes]):
        entries, fresh = _ordered(np.concatenate([_from_planes(b, ENTRY) for b in bodies]))
        wanted = ~fresh
        if every:
            wanted |= np.append(wanted[1:], False) | (entries["again"] > 0)
        yield from rows_of(entries[wanted])

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for bucket, known, body in zip(*(c.to_pylist() for c in batch.columns)):
                if known:
                    yield from rows_of(_from_planes(body, ENTRY))
                    continue
                if bucket != last and size >= HELD_BYTES:
                    yield from merged(held)
                    held, size = [], 0
                last = bucket
                held.append(body)
                size += len(body)
        if held:
            yield from merged(held)

    return (
        sent.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(run, "h long, doc long, pos int")
    )


def listed_places(lists: pa.Array, counts: np.ndarray) -> np.ndarray:
    """Where the listed offsets of every row lie in the rows' concatenated units."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return np.repeat(offsets(counts), sizes) + flat if len(flat) else np.empty(0, np.int64)


def one_row_per_document(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, text), dealt by document: null keys are left out, null text is empty, and of
    rows that repeat a key the one with the greatest text counts."""
    return (
        docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(text, F.lit("")).alias("text"))
        .where("doc IS NOT NULL")
        .repartition("doc")
        .groupBy("doc")
        .agg(F.max("text").alias("text"))
    )


def with_found(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` and what was found in each: packed values per (doc, sender), as ``parts``."""
    # one packed value for each task that found something in the document
    parts = found.groupBy("doc").agg(F.collect_list("found").alias("parts"))
    return rows.join(parts, "doc", "left")


def repeated_places(gathered: DataFrame) -> DataFrame:
    """(doc, found) of all places whose hash occurs at two places or more.

    ``gathered`` has one row (h, at) for each hash and task, so a hash that a third of
    all rows hold still has only as many rows as there are tasks.
    """
    from pyspark.sql import Window

    size = PLACE.itemsize
    total = F.sum(F.octet_length("at")).over(Window.partitionBy("h"))
    return (
        gathered.withColumn("total", total)
        .where(F.col("total") > size)
        .select("at")
        .mapInArrow(places_by_document, "doc long, found binary")
    )
