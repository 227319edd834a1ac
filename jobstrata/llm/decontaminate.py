"""Benchmark decontamination: a broadcast set of test windows, scanned over all documents.

Words are ASCII lower-cased runs of letters, digits and non-ASCII characters. A window is
``width`` consecutive words of a benchmark item; a shorter item is one window. Every
document word that lies in an occurrence of a window is hit.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm import rows

WIDTH = 13
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: benchmark text held by one broadcast; a larger benchmark is scanned in several turns
BROADCAST_BYTES = 32 << 20
FOUND = ("hit_words", "hit_spans", "hit_items")
JUDGED = ("n_hit", "items_sha256", "contaminated")
SPAN = np.dtype([("start", "<i4"), ("end", "<i4")])


class TestWindows:
    """All windows of some benchmark items, by word numbers, with the items that hold them."""

    __test__ = False  # not a pytest class

    def __init__(self, items: list[tuple[str, str]], width: int) -> None:
        flat, counts = rows.split_words(
            rows.lower_ascii(pa.array([t for _, t in items], pa.large_string())), BETWEEN
        )
        self.vocabulary = flat.unique()
        numbers = self.numbers(flat)
        self.names = [name for name, _ in items]
        found: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        start = 0
        for item, n in enumerate(counts.tolist()):
            own = tuple(numbers[start : start + n].tolist())
            size = min(n, width)
            for i in range(n - size + 1 if n else 0):
                found[size][own[i : i + size]].add(item)
            start += n
        self.by_width = {}
        for size, windows in found.items():
            table = np.array(list(windows), np.int64).reshape(len(windows), size)
            holders = [sorted(x) for x in windows.values()]
            hashes = np.array(
                [rows.window_hashes(rows.stirred(w.astype(np.uint64)), size)[0] for w in table]
            )
            order = np.argsort(hashes, kind="stable")
            self.by_width[size] = (hashes[order], table[order], [holders[i] for i in order])

    def numbers(self, words: pa.Array) -> np.ndarray:
        """1 + each word's place in the vocabulary; 0 for other words."""
        if len(self.vocabulary) == 0:
            return np.zeros(len(words), np.int64)
        found = pc.index_in(words, value_set=self.vocabulary)
        return pc.fill_null(pc.add(found, 1), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def occurrences(self, numbers: np.ndarray, counts: np.ndarray):
        """(width, position, items) of every window occurrence; hash hits are verified."""
        units = rows.stirred(numbers.astype(np.uint64))
        for size, (hashes, table, holders) in self.by_width.items():
            able = rows.inside(counts, size) & (rows.running_min(numbers, size) > 0)
            at = np.flatnonzero(able)
            if not len(at):
                continue
            seen = rows.window_hashes(units, size)[at]
            first = np.searchsorted(hashes, seen, side="left")
            last = np.searchsorted(hashes, seen, side="right")
            for i in np.flatnonzero(last > first):
                words = numbers[at[i] : at[i] + size]
                for w in range(first[i], last[i]):
                    if np.array_equal(table[w], words):
                        yield size, int(at[i]), holders[w]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(windows, text: str):
    """Adds to each row the word count, the hit spans and the items found by ``windows``."""

    def run(batches):
        known = windows.value
        for batch in rows.slices(batches, text):
            flat, counts = rows.split_words(rows.lower_ascii(rows.texts(batch, text)), BETWEEN)
            spans: dict[int, list] = defaultdict(list)
            items: dict[int, set] = defaultdict(set)
            starts = rows.offsets(counts) if len(counts) else counts
            for size, at, holders in known.occurrences(known.numbers(flat), counts):
                doc = int(np.searchsorted(starts, at, side="right")) - 1
                spans[doc].append((at - int(starts[doc]), at - int(starts[doc]) + size))
                items[doc].update(known.names[i] for i in holders)
            before = batch.column(batch.num_columns - 2).to_pylist()
            names = batch.column(batch.num_columns - 1).to_pylist()
            for doc in spans:
                old = np.frombuffer(before[doc] or b"", SPAN).tolist()
                before[doc] = np.array(merged(old + spans[doc]), SPAN).tobytes()
                names[doc] = sorted(items[doc].union(names[doc] or ()))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: batch.num_columns - 3],
                    pa.array(counts, pa.int64()),
                    pa.array(before, pa.binary()),
                    pa.array(names, pa.list_(pa.string())),
                ],
                schema=batch.schema,
            )

    return run


def scanned(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """``docs`` with ``hit_words`` (count of words), ``hit_spans`` (packed word ranges) and
    ``hit_items`` (names of the items found).

    The benchmark is measured first. One broadcast holds at most ``BROADCAST_BYTES`` of
    its text; a larger one is cut into parts by item, and the documents run through one
    scan after another, each adding to the spans of the last, without a shuffle.

    Null text has no words; a null item id is named "". Null, empty and repeated items
    are allowed, also an empty benchmark or document table. Repeated documents are
    judged each by itself. Other columns pass through unchanged; columns that have the
    names of the three are replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col(item_text), F.lit("")).alias("body"),
    )
    size = items.agg(F.sum(F.octet_length("body") + F.octet_length("name"))).first()[0] or 0
    turns = 1 + size // BROADCAST_BYTES
    out = docs.drop(*FOUND).withColumns(
        {
            "hit_words": F.lit(0).cast("long"),
            "hit_spans": F.lit(None).cast("binary"),
            "hit_items": F.lit(None).cast("array<string>"),
        }
    )
    for turn in range(turns):
        part = items.where(F.pmod(F.xxhash64("name", "body"), F.lit(turns)) == turn)
        own = TestWindows([(r["name"], r["body"]) for r in part.collect()], width)
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(own), text), out.schema)
    return out


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """``found`` with n_words, n_hit, n_items, items_sha256 and contaminated.

    A document is contaminated when a ``share``-th of its words or more are hit.
    """

    def run(batches):
        for batch in batches:
            words, spans, names = (batch.column(place).to_pylist() for place in places)
            hits = []
            for packed in spans:
                own = np.frombuffer(packed or b"", SPAN)
                hits.append(int((own["end"] - own["start"]).sum()))
            lists = [sorted(x or ()) for x in names]
            digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists]
            dirty = [h > 0 and share * h >= n for h, n in zip(hits, words)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: batch.num_columns - 3],
                    pa.array(hits, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(dirty, pa.bool_()),
                ],
                schema=batch.schema,
            )

    blank = found.drop(*JUDGED).withColumns(
        {
            "n_hit": F.lit(0).cast("long"),
            "items_sha256": F.lit("").cast("string"),
            "contaminated": F.lit(False),
        }
    )
    places = [blank.columns.index(c) for c in FOUND]
    return blank.mapInArrow(run, blank.schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """``docs`` without the contaminated documents; all other rows and columns as they are."""
    own = {c: f"{c}_of_input" for c in docs.columns if c.lower() in (*FOUND, *JUDGED)}
    renamed = docs.withColumnsRenamed(own)
    kept = judged(scanned(renamed, benchmark, **names)).where(~F.col("contaminated"))
    return kept.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))


def without_hit_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names):
    """``docs`` with every hit span cut out of the text: from its first word's first character
    to its last word's last. Documents stay, texts without a hit are unchanged."""
    own = {c: f"{c}_of_input" for c in docs.columns if c.lower() in FOUND}
    found = scanned(docs.withColumnsRenamed(own), benchmark, text=text, **names)
    place = found.columns.index(text)

    def run(batches):
        word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
        for batch in rows.slices(batches, text):
            spans = batch.column(batch.num_columns - 2).to_pylist()
            values = batch.column(place).to_pylist()
            for i, packed in enumerate(spans):
                if packed:
                    ranges = [m.span() for m in word.finditer(values[i])]
                    kept, last = [], 0
                    for start, end in np.frombuffer(packed, SPAN).tolist():
                        kept.append(values[i][last : ranges[start][0]])
                        last = ranges[end - 1][1]
                    values[i] = "".join([*kept, values[i][last:]])
            columns = list(batch.columns)
            columns[place] = pa.array(values, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    cut = found.mapInArrow(run, found.schema)
    return cut.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))
