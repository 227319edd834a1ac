"""Suffix-array dedup: byte strings of a given length that start at two places or more.

A sparse suffix array stands in for the whole one: of every window of ``length`` bytes the
lowest ``SHALLOW``-byte string (by hash) is its anchor, and equal windows have their anchors
at the same offset, so only suffixes at anchors need sorting. The sort is deep-shallow:

* shallow: suffixes are grouped by their first ``SHALLOW`` bytes, in Spark; alone they go;
* deep: in a group, all of whose suffixes share that prefix, the remaining bytes are put in
  order by a blind trie, which stores only where suffixes part and costs one comparison
  of text per insertion. Its depths are the longest common prefixes.

What stands before the anchors is ordered by a sort of the reversed text. A window repeats
when two suffixes share enough bytes on both sides of the anchor; these intervals are read
off the trie's nodes together with the order of the left sides.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm import rows

LENGTH = 200
SHALLOW = 32
INTERVAL = np.dtype([("doc", "<i8"), ("start", "<i4"), ("end", "<i4")])
RANGE = np.dtype([("start", "<i4"), ("end", "<i4")])


def _body(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the batch's texts, and how many each text has."""
    values = rows.texts(batch)
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset :][: len(values) + 1]
    whole = np.frombuffer(values.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return whole, np.diff(ends)


def _levels(body: np.ndarray, length: int, shallow: int):
    return rows.stirred(rows.window_hashes(rows.stirred(body.astype(np.uint64) + 1), shallow))


def _anchor_rows(length: int, shallow: int):
    def run(batches):
        gathered = rows.Gathered()
        for batch in rows.slices(batches, "text"):
            body, counts = _body(batch)
            able = rows.inside(counts, length)
            if not able.any():
                continue
            level = _levels(body, length, shallow)
            _, marked = rows.anchors(level, able, length - shallow + 1)
            at = np.flatnonzero(marked)
            doc = np.searchsorted(np.cumsum(counts), at, side="right")
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            gathered.add(level[at], docs[doc], at - rows.offsets(counts)[doc])
        yield from gathered.batches()

    return run


def _context_rows(length: int, shallow: int):
    """(h, lead, context, at): the text that the windows of an anchor cover, each distinct one
    of the task once, with the anchors' places packed; ``lead`` bytes stand before the anchor."""

    def run(batches):
        seen: dict[tuple[int, int, bytes], list[bytes]] = {}
        held = 0
        for batch in rows.slices(batches, "text"):
            body, counts = _body(batch)
            if not len(body):
                continue
            span = length - shallow + 1
            able = rows.inside(counts, length)
            level = _levels(body, length, shallow)
            low = rows.running_min(level, span)
            starts, docs = rows.offsets(counts), batch.column(0).to_pylist()
            for row, parts in enumerate(batch.column(2).to_pylist()):
                start = int(starts[row])
                found = np.concatenate([np.frombuffer(p, "<i4") for p in parts])
                for pos in found.tolist():
                    at = start + pos
                    a = max(start, at - span + 1)
                    own = np.flatnonzero((low[a : at + 1] == level[at]) & able[a : at + 1])
                    first, last = a + int(own[0]), a + int(own[-1])
                    context = body[first : last + length].tobytes()
                    place = np.array((docs[row], pos), rows.PLACE).tobytes()
                    seen.setdefault((int(level[at]), at - first, context), []).append(place)
                    held += len(place) + len(context)
            if held > 256 << 20:  # a task's table stays bounded; the rest of the copies meet later
                yield from _packed(seen)
                seen, held = {}, 0
        yield from _packed(seen)

    return run


def _packed(seen: dict) -> Iterator[pa.RecordBatch]:
    items = list(seen.items())
    for i in range(0, len(items), 4096):
        part = items[i : i + 4096]
        yield pa.record_batch(
            [
                pa.array(np.array([k[0] for k, _ in part], np.uint64).view(np.int64)),
                pa.array([k[1] for k, _ in part], pa.int32()),
                pa.array([k[2] for k, _ in part], pa.binary()),
                pa.array([b"".join(v) for _, v in part], pa.binary()),
            ],
            names=["h", "lead", "context", "at"],
        )


class BlindTrie:
    """Orders byte strings; keeps depths and branching bytes only.

    A node is [depth, {byte: child}] with byte -1 for a string that ends there; a leaf is
    a list index. An insertion walks down by branching bytes without reading the text
    between, reaches some leaf, compares with that one string, and so knows where to part.
    """

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        self.root: list | int = 0
        for i in range(1, len(strings)):
            self._insert(i)

    def _insert(self, i: int) -> None:
        own = self.strings[i]
        node, path = self.root, []
        while not isinstance(node, int):
            path.append(node)
            byte = own[node[0]] if node[0] < len(own) else -1
            node = node[1].get(byte)
            if node is None:  # no such branch: any leaf below will do for the comparison
                node = next(iter(path[-1][1].values()))
        other = self.strings[node]
        depth = common(own, other)
        mine = own[depth] if depth < len(own) else -1
        above = bisect_left([n[0] for n in path], depth)
        if above < len(path) and path[above][0] == depth:
            path[above][1][mine] = i
            return
        below = path[above] if above < len(path) else node
        theirs = other[depth] if depth < len(other) else -1
        fresh = [depth, {theirs: below, mine: i}]
        if above:
            parent = path[above - 1]
            parent[1][own[parent[0]] if parent[0] < len(own) else -1] = fresh
        else:
            self.root = fresh

    def nodes(self) -> Iterator[tuple[int, list[int]]]:
        """(depth, leaves in order) of every inner node, children before their parent."""
        if isinstance(self.root, int):
            return
        stack: list[tuple[list, list]] = [(self.root, [])]
        pending = [iter(sorted(self.root[1].items()))]
        while stack:
            node, leaves = stack[-1]
            child = next(pending[-1], None)
            if child is None:
                stack.pop()
                pending.pop()
                yield node[0], leaves
                if stack:
                    stack[-1][1].extend(leaves)
            elif isinstance(child[1], int):
                leaves.append(child[1])
            else:
                stack.append((child[1], []))
                pending.append(iter(sorted(child[1][1].items())))


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    if n <= 64:
        return len(commonprefix([a[:n], b[:n]]))
    both = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(both.argmax())


def repeated_ranges(
    leads: list[bytes], tails: list[bytes], length: int
) -> list[list[tuple[int, int]]]:
    """For distinct (lead, tail) contexts around one anchor: the ranges, relative to the
    anchor, that windows shared with another context cover."""
    back = [lead[::-1] for lead in leads]
    left_order = sorted(range(len(back)), key=back.__getitem__)
    rank = [0] * len(back)
    for place, i in enumerate(left_order):
        rank[i] = place
    out: list[list[tuple[int, int]]] = [[] for _ in leads]
    # equal tails share one leaf
    by_tail: dict[bytes, list[int]] = {}
    for i, tail in enumerate(tails):
        by_tail.setdefault(tail, []).append(i)
    distinct = list(by_tail)
    groups = [(len(t), m) for t, m in by_tail.items() if len(m) > 1]
    for depth, leaves in BlindTrie(distinct).nodes():
        groups.append((depth, [m for leaf in leaves for m in by_tail[distinct[leaf]]]))
    for depth, members in groups:
        if depth + max(len(leads[m]) for m in members) < length:
            continue
        members = sorted(members, key=rank.__getitem__)
        shared = [common(back[a], back[b]) for a, b in zip(members, members[1:])]
        for m, before, after in zip(members, [-1, *shared], [*shared, -1]):
            lead = max(before, after)
            if lead + depth >= length:
                out[m].append((-lead, depth))
    return out


def _interval_rows(length: int):
    """Streams contexts sorted by anchor and gives (doc, found) with packed ranges."""

    def finished(group: dict[tuple[int, bytes], list[bytes]]) -> Iterator[np.ndarray]:
        items = list(group.items())
        leads = [context[:lead] for (lead, context), _ in items]
        tails = [context[lead:] for (lead, context), _ in items]
        ranges = repeated_ranges(leads, tails, length) if len(items) > 1 else [[]]
        for ((lead, context), packed), own in zip(items, ranges):
            places = np.frombuffer(b"".join(packed), rows.PLACE)
            if len(places) > 1:  # the whole context repeats
                own = [(-lead, len(context) - lead)]
            for start, end in _joined(own):
                out = np.empty(len(places), INTERVAL)
                out["doc"] = places["doc"]
                out["start"], out["end"] = places["pos"] + start, places["pos"] + end
                yield out

    def run(batches):
        group: dict[tuple[int, bytes], list[bytes]] = {}
        current, waiting, n_waiting = None, [], 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for h, lead, context, at in zip(*columns):
                if h != current:
                    for found in finished(group) if group else ():
                        waiting.append(found)
                        n_waiting += len(found)
                    group, current = {}, h
                group.setdefault((lead, context), []).append(at)
            if n_waiting > 1 << 18:
                yield _by_document(np.concatenate(waiting))
                waiting, n_waiting = [], 0
        if group:
            waiting.extend(finished(group))
        if waiting:
            yield _by_document(np.concatenate(waiting))

    return run


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _by_document(found: np.ndarray) -> pa.RecordBatch:
    found = found[np.argsort(found["doc"], kind="stable")]
    docs = found["doc"]
    starts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    ranges = np.empty(len(found), RANGE)
    ranges["start"], ranges["end"] = found["start"], found["end"]
    return pa.record_batch(
        [pa.array(docs[starts]), rows.pack(ranges, np.append(starts, len(found)))],
        names=["doc", "found"],
    )


def _cut(batches):
    """Per document: bytes, removed bytes, removed runs, kept bytes and their digest."""
    for batch in rows.slices(batches, "text"):
        body, counts = _body(batch)
        out = []
        for start, count, parts in zip(
            rows.offsets(counts).tolist() if len(counts) else [],
            counts.tolist(),
            batch.column(2).to_pylist(),
        ):
            own = body[start : start + count].tobytes()
            ranges = np.frombuffer(b"".join(parts or ()), RANGE).tolist()
            runs = _joined(ranges)
            kept, last = [], 0
            for a, b in runs:
                kept.append(own[last:a])
                last = b
            rest = b"".join([*kept, own[last:]])
            out.append((count, count - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest))
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *(pa.array(columns[i], pa.int64()) for i in range(3)),
                pa.array(columns[3], pa.string()),
                pa.array(columns[4], pa.binary()),
            ],
            names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"],
        )


def without_repeated_bytes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    shallow: int = SHALLOW,
) -> DataFrame:
    """Per document: ``key, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes``.

    Every byte covered by a string of ``length`` bytes that starts anywhere else too (also
    in the same document, overlapping or not) is removed, judged on the input; no string
    crosses documents. ``n_spans`` counts maximal removed runs. Kept bytes need not be
    whole UTF-8.

    Rows with a null key are left out; null text is empty; shorter texts keep all bytes.
    Rows that repeat a key are one document, the one with the greatest text. An empty
    table gives no rows. Other columns are not read.

    The texts are dealt by document once for all steps. Contexts leave a task once with
    their places packed; an anchor's group has one row for each distinct context and task.
    """
    texts = rows.one_row_per_document(docs, key, text)
    gathered = texts.mapInArrow(_anchor_rows(length, shallow), "h long, at binary")
    repeated = rows.repeated_places(gathered).groupBy("doc").agg(
        F.collect_list("found").alias("parts")
    )
    contexts = texts.join(repeated, "doc").mapInArrow(
        _context_rows(length, shallow), "h long, lead int, context binary, at binary"
    )
    found = (
        contexts.repartition("h")
        .sortWithinPartitions("h")
        .mapInArrow(_interval_rows(length), "doc long, found binary")
    )
    done = rows.with_found(texts, found).mapInArrow(
        _cut,
        "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
        " kept_bytes binary",
    )
    return done.withColumnRenamed("doc", key)
