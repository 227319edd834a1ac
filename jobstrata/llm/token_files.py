"""Token ids as Arrow files of equal-length sequences, for zero-copy random access.

Documents are put in order, encoded, ended by one id each, and packed without gaps into
sequences of fixed length. One task writes one pair of Arrow IPC files: ``tokens-N.arrow``
(fixed-size lists of ids and of a mask that is false on the padding of the last sequence,
in batches of a fixed number of sequences) and ``docs-N.arrow`` (each document's key,
place and length). A batch is a memory map away: nothing is decoded or copied.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.llm import rows
from jobstrata.llm.storage import checkpointed

SEQUENCE = 2048
SEQUENCES_IN_BATCH = 256
#: bytes of kept pieces in one of the two generations, counted with what Python adds to each
KEPT_BYTES = 64 << 20
PIECE_BYTES = 190
SLICE_BYTES = 16 << 20
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Whole texts to ids by the tokenizers library, each distinct piece once.

    The byte-level splitting pattern always starts a new piece at a blank that a visible
    character follows, so a text's ids are the ids of its units between such places, one
    after another; distinct units of a slice are found in Arrow. A unit of plain Latin
    characters, for which the pattern's classes are fixed, is cut into its pieces here and
    each piece goes to the library's merge model, with the ids of recent pieces kept in
    two generations of bounded size. Other units go to the whole tokenizer, and so does a
    text that holds an added token or the mark used here for splitting.
    """

    MARK = "\x01"
    LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
    PLAIN = re.compile(rf"[\t\n\r -~{LETTERS}]*\Z")
    # the byte-level pattern, for plain units only
    PIECES = re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"
    )

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        self.added = [t["content"] for t in described.get("added_tokens", [])]
        self.by_units = (
            (described.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
            and described["pre_tokenizer"].get("use_regex", True)
            and not described["pre_tokenizer"].get("add_prefix_space")
            and not described.get("normalizer")
        )
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.young_bytes, self.kept_bytes = 0, KEPT_BYTES
        self.bytes_as = str.maketrans(_byte_letters())
        self.blank = _byte_letters()[0x20]

    def forget(self) -> None:
        """Drops the kept pieces, which a worker would hold through later tasks."""
        self.young, self.old, self.young_bytes = {}, {}, 0

    def _encode(self, values: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch(values, add_special_tokens=False)
        return [np.array(e.ids, self.type).tobytes() for e in done]

    def _piece(self, piece: str) -> bytes:
        blob = self.old.get(piece)
        if blob is None:
            if piece.isascii() and piece.isprintable():  # all but the blank stand for themselves
                letters = piece.replace(" ", self.blank)
            else:
                letters = piece.encode().decode("latin-1").translate(self.bytes_as)
            ids = [t.id for t in self.model.tokenize(letters)]
            blob = np.array(ids, self.type).tobytes()
        if self.young_bytes >= self.kept_bytes:
            self.old, self.young, self.young_bytes = self.young, {}, 0
        self.young[piece] = blob
        self.young_bytes += PIECE_BYTES + 2 * len(piece) + len(blob)
        return blob

    def _units(self, units: list[str]) -> list[bytes]:
        plain, pieces, young = self.PLAIN.match, self.PIECES.findall, self.young.get
        out: list[bytes] = []
        odd: list[int] = []
        for unit in units:
            blob = young(unit)
            if blob is None:
                if plain(unit):
                    parts = pieces(unit)
                    if len(parts) == 1:
                        blob = self._piece(unit)
                    else:
                        blob = b"".join([young(p) or self._piece(p) for p in parts])
                    young = self.young.get
                else:
                    odd.append(len(out))
            out.append(blob)
        for i, blob in zip(odd, self._encode([units[i] for i in odd])):
            out[i] = blob
        return out

    def __call__(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        plain = np.full(len(values), self.by_units)
        for odd in (self.MARK, *self.added):
            has = pc.match_substring(values, odd).to_numpy(zero_copy_only=False)
            plain &= ~has.astype(bool)
        marked = pc.replace_substring_regex(
            values.filter(pa.array(plain)), r" ([!-~\pL])", self.MARK + r" \1"
        )
        parts = pc.split_pattern(marked, self.MARK)
        owner = np.flatnonzero(plain)[pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)]
        whole = np.flatnonzero(~plain)
        coded = pc.dictionary_encode(parts.flatten())
        blobs = self._units(coded.dictionary.to_pylist())
        distinct = len(blobs)
        blobs += self._encode(values.take(pa.array(whole)).to_pylist())
        index = coded.indices.to_numpy(zero_copy_only=False)
        if len(whole):
            index = np.concatenate([index, np.arange(distinct, len(blobs), dtype=index.dtype)])
            owner = np.concatenate([owner, whole])
            order = np.argsort(owner, kind="stable")
            index, owner = index[order], owner[order]
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // self.type.itemsize
        ends = np.concatenate([[0], np.cumsum(sizes)])
        lists = pa.LargeListArray.from_arrays(
            pa.array(ends), pa.array(np.frombuffer(b"".join(blobs), self.type))
        )
        ids = lists.take(pa.array(index)).flatten().to_numpy(zero_copy_only=False)
        counts = np.bincount(owner, weights=sizes[index], minlength=len(values))
        return ids, counts.astype(np.int64)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The ids with ``end_id`` after each document."""
    return np.insert(ids, np.cumsum(counts), np.array(end_id, ids.dtype))


class SequenceWriter:
    """Packs ids into fixed-length sequences and writes whole batches of them."""

    def __init__(self, sink, kind: np.dtype, sequence: int, in_batch: int) -> None:
        self.sequence, self.size = sequence, sequence * in_batch
        item = pa.from_numpy_dtype(kind)
        self.schema = pa.schema(
            [("ids", pa.list_(item, sequence)), ("mask", pa.list_(pa.bool_(), sequence))]
        )
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.size:
            joined = np.concatenate(self.waiting)
            whole = len(joined) // self.size * self.size
            for i in range(0, whole, self.size):
                self._write(joined[i : i + self.size], self.size)
            self.waiting, self.n_waiting = [joined[whole:].copy()], len(joined) - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        self.writer.write_batch(
            pa.RecordBatch.from_arrays(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(ids), self.sequence),
                    pa.FixedSizeListArray.from_arrays(pa.array(mask), self.sequence),
                ],
                schema=self.schema,
            )
        )

    def close(self) -> None:
        if self.n_waiting:
            ids = np.concatenate(self.waiting)
            padded = np.zeros(-(-len(ids) // self.sequence) * self.sequence, ids.dtype)
            padded[: len(ids)] = ids
            self._write(padded, len(ids))
        self.writer.close()


def _put(filesystem, path: str, attempt: int, write) -> None:
    """Writes under a name of this attempt, then renames: a file is whole or absent."""
    own = f"{path}.{attempt}.part"
    with filesystem.open_output_stream(own) as sink:
        write(sink)
    filesystem.move(own, path)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 2,
    order: tuple[str, ...] = ("doc_id",),
    key: str = "doc_id",
    text: str = "text",
    sequence: int = SEQUENCE,
    in_batch: int = SEQUENCES_IN_BATCH,
    slice_bytes: int = SLICE_BYTES,
    keep_pieces: bool = True,
    kept_bytes: int = KEPT_BYTES,
) -> DataFrame:
    """Writes the files below ``folder`` (a URI that every executor reaches) and returns the
    manifest ``part, n_docs, n_tokens``, checkpointed, so that the files are written once.

    Rows are dealt by ranges of ``order`` and sorted inside, so file N + 1 goes on where
    file N ends. A task that runs again writes the same bytes under the same name. Null
    text is empty (only the end id). Null keys come first; rows with equal ``order`` are
    put in order of their text. Repeated rows are encoded each. Other columns are not
    read. An empty table gives an empty manifest and no files.

    A worker keeps the ids of recent pieces for its next task, up to 2 x ``kept_bytes``; where
    other stages need its memory, let ``keep_pieces`` be false, the other two small.
    """

    def run(batches):
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        filesystem, path = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(path, recursive=True)
        rows.give_back()
        encode = encoder(tokenizer)
        encode.kept_bytes = kept_bytes
        index, total, own = [], 0, iter(rows.slices(batches, "text", slice_bytes))
        first = next(own, None)
        if first is None:
            return

        def tokens(sink):
            nonlocal total
            writer = SequenceWriter(sink, encode.type, sequence, in_batch)
            batch = first
            while batch is not None:
                ids, counts = encode(rows.texts(batch))
                counts_with_end = counts + 1
                starts = total + rows.offsets(counts_with_end)
                index.append((batch.column(0), starts, counts_with_end))
                writer.add(with_end(ids, counts, end_id))
                total += int(counts_with_end.sum())
                batch = next(own, None)
            writer.close()

        _put(filesystem, f"{path}/tokens-{part:08d}.arrow", attempt, tokens)
        schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])

        def places(sink):
            with pa.ipc.new_file(sink, schema) as writer:
                for keys, starts, counts in index:
                    writer.write_batch(
                        pa.RecordBatch.from_arrays(
                            [keys.cast(pa.int64()), pa.array(starts), pa.array(counts)],
                            schema=schema,
                        )
                    )

        _put(filesystem, f"{path}/docs-{part:08d}.arrow", attempt, places)
        n_docs = sum(len(c) for _, _, c in index)
        if not keep_pieces:
            encode.forget()
        rows.give_back()
        yield pa.record_batch(
            [pa.array([part]), pa.array([n_docs]), pa.array([total])],
            names=["part", "n_docs", "n_tokens"],
        )

    named = [f"__order{i}" for i in range(len(order))]
    ordered = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        *(F.col(c).alias(n) for c, n in zip(order, named)),
    )
    dealt = ordered.repartitionByRange(*named).sortWithinPartitions(*named, "text")
    done = dealt.mapInArrow(run, "part long, n_docs long, n_tokens long")
    return checkpointed(done)


def _open(folder: str, name: str):
    filesystem, path = fs.FileSystem.from_uri(folder)
    if isinstance(filesystem, fs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(f"{path}/{name}"))
    return pa.ipc.open_file(filesystem.open_input_file(f"{path}/{name}"))


def read_sequence(folder: str, part: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence ``number`` of a file: its ids (a view of the mapped file) and its mask."""
    reader = _open(folder, f"tokens-{part:08d}.arrow")
    in_batch = reader.get_batch(0).num_rows
    batch = reader.get_batch(number // in_batch)
    length = batch.schema.field("ids").type.list_size
    row = number % in_batch
    ids = batch.column(0).flatten().slice(row * length, length)
    mask = batch.column(1).flatten().slice(row * length, length)
    return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)


def _documents(folder: str, part: int):
    """(keys, starts, counts, list of id arrays) of a file, one index batch after another."""
    reader = _open(folder, f"tokens-{part:08d}.arrow")
    index = _open(folder, f"docs-{part:08d}.arrow")
    number, base, held = 0, 0, np.empty(0, np.uint16)
    for b in range(index.num_record_batches):
        batch = index.get_batch(b)
        starts, counts = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        own = []
        for start, count in zip(starts.tolist(), counts.tolist()):
            while base + len(held) < start + count:
                ids = reader.get_batch(number).column(0).flatten().to_numpy()
                number += 1
                left = held[start - base :] if start - base < len(held) else held[:0]
                base += len(held) - len(left)
                held = np.concatenate([left, ids]) if len(left) else ids
            own.append(held[start - base : start - base + count])
        yield batch.column(0), starts, counts, own


def read_token_files(manifest: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: ``key, start`` (ids before it, over all files),
    ``n_tokens`` (with the end id), ``ids_crc32`` and ``part``.

    ``start`` adds up the files before; that sum runs over one row per file.
    """

    def run(batches):
        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for keys, starts, counts, own in _documents(folder, part):
                    sums = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys,
                            pa.array(starts + base),
                            pa.array(counts),
                            pa.array(sums, pa.int64()),
                            pa.array([part] * len(sums), pa.int64()),
                        ],
                        names=[key, "start", "n_tokens", "ids_crc32", "part"],
                    )

    before = F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")
    files = manifest.withColumn("base", before).select("part", "base")
    # a task a file: the rows are few, their work is the files' size, so the number is given
    spread = files.repartitionByRange(max(1, manifest.count()), "part")
    return spread.mapInArrow(
        run, f"`{key}` long, start long, n_tokens long, ids_crc32 long, part long"
    )
