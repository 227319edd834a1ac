"""Language model scores: hashed maximum entropy with a class-factored softmax.

Every word has a cell, and cells are dealt into classes: the ``HEADS`` most frequent training
words have a cell of their own, all others share cells by a hash of their last three
characters. The model gives

    P(word | before) = P(class | before) * P(slot | class, before) * P(word | cell),

where the first two are softmaxes over weights of features of the words before: the cell of
the last word, of the last but one (a skip) and the pair of both, hashed into a fixed number
of rows. P(word | cell) is 1 for a frequent word and otherwise
its share (c + 1) / (N + V + 1) of the cell's training words; the last 1 is for words never
seen. The probabilities of all words and of one unseen word per cell add up to 1.

The texts are split once. A task numbers the words of each slice, so that only a slice's
distinct words travel to be counted over the corpus, and its counts come back to it. What is
kept of a document are its cells, and training and scoring read nothing else.

Training makes ``ROUNDS`` passes over all training documents. All that a
gradient needs of a token is what it is and the two before it, so a task counts equal runs of
three cells first and works on distinct contexts. From the model of the round before it makes
gradient steps on small batches of them; the tasks' changes are added up in Spark segment by
segment, each row weighted by how many tokens a task changed it for.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm import rows
from jobstrata.llm.storage import stored

SLOT_BITS = 4
CLASSES, SLOTS = 64, 1 << SLOT_BITS
CELLS = CLASSES * SLOTS
#: cells of single words; the cells after them are shared
HEADS = 768
#: the cell before a text begins
BEFORE = CELLS
FEATURES = 3
#: rows of the hashed features' weights, for classes and for slots
CLASS_ROW_BITS, SLOT_ROW_BITS = 15, 16
CLASS_ROWS, SLOT_ROWS = 1 << CLASS_ROW_BITS, 1 << SLOT_ROW_BITS
ROUNDS = 2
#: contexts of one gradient step
BATCH = 4096
RATE = 0.2
#: tokens whose contexts are counted together
SPAN = 4 << 20
#: bytes of cells in a slice, two a token
CELL_BYTES = 2 << 20
#: where a row's sum of squared gradients starts: rows seen a few times move little
CALM = 3.0
#: the document's fold: those of ``HELD_OUT`` are not learned from
FOLDS, HELD_OUT = 7, 2
SLICE_BYTES = 16 << 20
#: weight rows that travel as one row
SEGMENT_ROWS = 1 << 12
#: the end of a text among the words, none of which is empty
END = ""


def held_out(key) -> F.Column:
    """Whether the fold of the key's decimal text is held out; a null key's is not."""
    fold = F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def numbered(docs: DataFrame) -> DataFrame:
    """One table of two kinds of rows for each slice of texts: a row per document (doc_id,
    held_out, body: its words' numbers) and a row per distinct word (number, word, c: its
    occurrences in training documents). ``slice`` tells the slices apart."""
    schema = (
        "slice long, doc_id long, held_out boolean, body binary, number int, word string, c long"
    )

    def run(batches):
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=1).compress
        base = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(rows.slices(batches, "text", SLICE_BYTES)):
            flat, counts = rows.split_words(rows.lower_ascii(rows.texts(batch, "text")))
            coded = pc.dictionary_encode(flat)
            words = pa.concat_arrays([coded.dictionary, pa.array([END], coded.dictionary.type)])
            end = len(words) - 1
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            learned = ~np.asarray(batch.column(1))
            own = np.bincount(codes[np.repeat(learned, counts)], minlength=end + 1)
            own[end] += int(learned.sum())
            starts = rows.offsets(counts) if len(counts) else counts
            bodies = [
                pack(rows._planes(np.append(codes[a : a + n], end).astype("<u4")))
                for a, n in zip(starts.tolist(), counts.tolist())
            ]
            yield made(base + i, len(bodies), batch.column(0), batch.column(1), pa.array(bodies, pa.binary()))
            for at in range(0, end + 1, 1 << 16):
                part = words.slice(at, 1 << 16)
                yield made(
                    base + i,
                    len(part),
                    number=pa.array(np.arange(at, at + len(part), dtype=np.int32)),
                    word=part.cast(pa.string()),
                    c=pa.array(own[at : at + len(part)]),
                )

    def made(number_of_slice, n, doc_id=None, held=None, body=None, number=None, word=None, c=None):
        types = (pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.string(), pa.int64())
        cells = (doc_id, held, body, number, word, c)
        return pa.record_batch(
            [pa.array(np.full(n, number_of_slice))]
            + [pa.nulls(n, t) if x is None else x for x, t in zip(cells, types)],
            names=["slice", "doc_id", "held_out", "body", "number", "word", "c"],
        )

    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Vocabulary:
    """Training tokens and distinct ones, over all and in every cell."""

    tokens: int
    words: int
    cell_tokens: np.ndarray
    cell_words: np.ndarray


def word_table(found: DataFrame) -> DataFrame:
    """(word, c, cell): every word of the corpus, c its training occurrences."""
    counted = stored(
        found.where("word IS NOT NULL").groupBy("word").agg(F.sum("c").alias("c")), "lm-words"
    )
    top = counted.where("c > 0").orderBy(F.desc("c"), F.asc("word")).limit(HEADS)
    # one word a row, HEADS rows: a bounded broadcast
    ranked = [(r["word"], i) for i, r in enumerate(top.select("word").collect())]
    heads = counted.sparkSession.createDataFrame(ranked, "word string, head int")
    shared = HEADS + F.pmod(F.xxhash64(F.right("word", F.lit(3))), F.lit(CELLS - HEADS))
    return counted.join(F.broadcast(heads), "word", "left").select(
        "word", "c", F.coalesce("head", shared).cast("short").alias("cell")
    )


def vocabulary(words: DataFrame) -> Vocabulary:
    """Sums over the words, CELLS rows."""
    sums = words.groupBy("cell").agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v"))
    tokens, distinct = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
    for r in sums.collect():
        tokens[r["cell"]], distinct[r["cell"]] = r["n"], r["v"]
    return Vocabulary(int(tokens.sum()), int(distinct.sum()), tokens, distinct)


def in_cells(found: DataFrame, words: DataFrame, known: Vocabulary) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, word_score (log10 of P(word | cell)) and
    ``cells``, packed, for every document."""
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
        "word_score double, cells binary"
    )
    size = known.tokens + known.words + 1
    cell_sizes = np.log10((known.cell_tokens + known.cell_words + 1).astype(np.float64))

    def of_slice(bodies: pa.Table, numbers: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        pack = zstandard.ZstdCompressor(level=1).compress
        number = numbers.column("number").to_numpy()
        cells, counts = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        cells[number] = numbers.column("cell").to_numpy()
        counts[number] = numbers.column("c").to_numpy()
        logs = np.log10(counts + 1.0)
        within = np.where(cells < HEADS, 0.0, logs - cell_sizes[cells])
        out: list[list] = [[] for _ in range(5)]
        for body in bodies.column("body"):
            codes = rows._from_planes(unpack(body.as_py()), np.dtype("<u4"))
            out[0].append(len(codes))
            out[1].append(int(np.count_nonzero(counts[codes])))
            out[2].append(float(logs[codes].sum() - len(codes) * np.log10(size)))
            out[3].append(float(within[codes].sum()))
            out[4].append(pack(rows._planes(cells[codes].astype("<u2"))))
        types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        return pa.table(
            [bodies.column("doc_id"), bodies.column("held_out")]
            + [pa.array(x, t) for x, t in zip(out, types)],
            names=[c.split()[0] for c in schema.split(", ")],
        )

    looked_up = (
        found.where("word IS NOT NULL")
        .select(F.col("slice").alias("of_slice"), "number", "word")
        .join(words.hint("shuffle_hash"), "word")
        .select("of_slice", "number", "cell", "c")
    )
    bodies = found.where("body IS NOT NULL").select("slice", "doc_id", "held_out", "body")
    met = bodies.groupBy("slice").cogroup(looked_up.groupBy("of_slice"))
    return met.applyInArrow(of_slice, schema)


class Model:
    """Weights of both softmaxes; row 0 of each slot block and the class biases hold for all."""

    def __init__(self) -> None:
        self.class_bias = np.zeros(CLASSES, np.float32)
        self.slot_bias = np.zeros((CLASSES, SLOTS), np.float32)
        self.classes = np.zeros((CLASS_ROWS, CLASSES), np.float32)
        self.slots = np.zeros((SLOT_ROWS, SLOTS), np.float32)

    @classmethod
    def from_counts(cls, known: Vocabulary) -> Model:
        """Without features: the training shares of classes and slots."""
        out = cls()
        shares = (known.cell_tokens + 0.5).reshape(CLASSES, SLOTS)
        out.class_bias[:] = np.log(shares.sum(1) / shares.sum())
        out.slot_bias[:] = np.log(shares / shares.sum(1, keepdims=True))
        return out


#: a cell before a token takes so many bits, its pair twice as many
CELL_BITS = 11
_CELL_MASK = np.uint64((1 << CELL_BITS) - 1)
_PAIR_MASK = np.uint64((1 << 2 * CELL_BITS) - 1)
#: an odd number and its inverse modulo the number of pairs: they deal pairs at random and back
_DEAL = 0x9E379
_DEAL_BACK = pow(_DEAL, -1, 1 << 2 * CELL_BITS)
#: odd multipliers of the features' hashes
_KINDS = [np.uint64(int(rows.BASE) * (2 * i + 1) % (1 << 64)) for i in range(1, FEATURES + 2)]


def pairs_before(cells: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The two cells before each token as one number, dealt at random; ``starts`` are the first
    tokens of the documents."""
    one = np.full(len(cells), BEFORE, np.uint64)
    one[1:] = cells[:-1]
    one[starts] = BEFORE
    two = np.full(len(cells), BEFORE, np.uint64)
    two[1:] = one[:-1]
    two[starts] = BEFORE
    return (((two << np.uint64(CELL_BITS)) | one) * np.uint64(_DEAL)) & _PAIR_MASK


def features(pairs: np.ndarray) -> list[np.ndarray]:
    """Hashes of what stands before a token: the last cell, the skip, the pair."""
    plain = (pairs * np.uint64(_DEAL_BACK)) & _PAIR_MASK
    parts = (plain & _CELL_MASK, plain >> np.uint64(CELL_BITS), plain)
    return [(x + np.uint64(1)) * k for x, k in zip(parts, _KINDS)]


def class_rows(pairs: np.ndarray) -> np.ndarray:
    """(FEATURES, n) rows of the class weights."""
    return np.stack([(h >> np.uint64(64 - CLASS_ROW_BITS)).astype(np.uint16) for h in features(pairs)])


def slot_rows(pairs: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """(FEATURES, n) rows of the slot weights."""
    keyed = (classes.astype(np.uint64) + np.uint64(1)) * _KINDS[-1]
    hashed = [(h ^ keyed) * rows.BASE for h in features(pairs)]
    return np.stack([(h >> np.uint64(64 - SLOT_ROW_BITS)).astype(np.uint16) for h in hashed])


def _logs(bias, weights, own):
    """Log probabilities (n, outcomes) of the softmax with these rows of weights."""
    z = weights.take(own[0], 0)
    z += bias
    for part in own[1:]:
        z += weights.take(part, 0)
    z -= z.max(1, keepdims=True)
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    return z


def _first(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))


def followed(cells: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each token's pair before it and its cell in 32 bits."""
    pairs = pairs_before(cells, starts)
    return ((pairs << np.uint64(10)) | cells.astype(np.uint64)).astype(np.uint32)


class Trainer:
    """Gradient steps on a copy of the model, with a step size per row (Adagrad)."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.old = (model.classes.copy(), model.slots.copy())
        self.sums = (np.full(CLASS_ROWS, CALM, np.float32), np.full(SLOT_ROWS, CALM, np.float32))
        self.hits = (np.zeros(CLASS_ROWS, np.float32), np.zeros(SLOT_ROWS, np.float32))

    def learn(self, keys: np.ndarray) -> None:
        """Steps on all tokens, given as ``followed``."""
        if not len(keys):
            return
        keys = np.sort(keys)
        at = _first(keys)
        counts = np.diff(np.append(at, len(keys))).astype(np.float32)
        keys = keys[at]
        pair, cell = keys >> np.uint32(10), (keys & np.uint32(CELLS - 1)).astype(np.int64)
        contexts = _first(pair), _first(keys >> np.uint32(SLOT_BITS))
        for of, starts in enumerate(contexts):
            for i in range(0, len(starts), BATCH):
                begin = starts[i]
                end = starts[i + BATCH] if i + BATCH < len(starts) else len(keys)
                cut = slice(begin, end)
                self._batch(of, starts[i : i + BATCH] - begin, pair[cut], cell[cut], counts[cut])

    def _batch(self, of, starts, pair, cell, counts) -> None:
        """One step; ``starts`` are the first entries of the contexts."""
        own_pairs, classes = pair[starts].astype(np.uint64), cell[starts] // SLOTS
        context = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(pair))))
        if of == 0:
            bias, weights, width, outcome = self.model.class_bias, self.model.classes, CLASSES, cell // SLOTS
            own = class_rows(own_pairs)
        else:
            bias, weights, width, outcome = self.model.slot_bias[classes], self.model.slots, SLOTS, cell % SLOTS
            own = slot_rows(own_pairs, classes)
        seen = np.bincount(context * width + outcome, counts, minlength=len(starts) * width)
        seen = seen.reshape(len(starts), width).astype(np.float32)
        n = seen.sum(1, keepdims=True)
        wrong = np.exp(_logs(bias, weights, own)) * n - seen
        self._step(weights, self.sums[of], self.hits[of], own, wrong, n[:, 0])

    def _step(self, weights, sums, hits, own, wrong, n) -> None:
        flat = own.ravel()
        order = np.argsort(flat, kind="stable")
        sorted_ = flat[order]
        starts = _first(sorted_)
        sizes = np.diff(np.append(starts, len(flat)))
        changed = sorted_[starts]
        context = order % own.shape[1]
        each = wrong[context]
        g = each[starts]
        many = np.flatnonzero(sizes > 1)
        if len(many):
            # pairs of single floats are added as one complex number, in half the steps
            again = each[np.repeat(sizes > 1, sizes)].view(np.complex64)
            at = np.cumsum(sizes[many]) - sizes[many]
            g[many] = np.add.reduceat(again, at, axis=0).view(np.float32)
        sums[changed] += np.einsum("ij,ij->i", g, g) / g.shape[1]
        weights[changed] -= RATE * g / np.sqrt(sums[changed])[:, None]
        hits[changed] += np.add.reduceat(n[context], starts)

    def changes(self):
        """(part, segment, hits, change times hits) of the rows that changed, packed."""
        pack = zstandard.ZstdCompressor(level=1).compress
        for part, (new, old) in enumerate(zip((self.model.classes, self.model.slots), self.old)):
            for segment in range(len(new) // SEGMENT_ROWS):
                cut = slice(segment * SEGMENT_ROWS, (segment + 1) * SEGMENT_ROWS)
                hits = self.hits[part][cut]
                if hits.any():
                    moved = (new[cut] - old[cut]).astype("<f2")
                    yield part, segment, pack(hits.astype("<f4").tobytes()), pack(rows._planes(moved.ravel()))


def _documents(batches, place: int):
    """(batch, cells of its documents one after another, their first tokens) of each slice."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in rows.slices(batches, "cells", CELL_BYTES):
        own = [rows._from_planes(unpack(x), np.dtype("<u2")) for x in batch.column(place).to_pylist()]
        sizes = np.array([len(x) for x in own], np.int64)
        yield batch, np.concatenate(own).astype(np.int64), rows.offsets(sizes)


def train_round(learned: DataFrame, model: Model) -> Model:
    """The model after one pass over the training documents' cells."""
    shared = learned.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        trainer, held, size = None, [], 0
        for _, cells, starts in _documents(batches, 0):
            trainer = trainer or Trainer(_copy(shared.value))
            held.append(followed(cells, starts))
            size += len(cells)
            if size >= SPAN:
                trainer.learn(np.concatenate(held))
                held, size = [], 0
        if held:
            trainer.learn(np.concatenate(held))
        for part, segment, hits, moved in trainer.changes() if trainer else ():
            yield pa.record_batch(
                [pa.array([part]), pa.array([segment]), pa.array([hits]), pa.array([moved])],
                names=["part", "segment", "hits", "moved"],
            )

    def merged(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        key, hits, total = None, None, None
        for batch in batches:
            for part, segment, own_hits, own in zip(*(c.to_pylist() for c in batch.columns)):
                if (part, segment) != key:
                    if key:
                        yield mean(key, hits, total)
                    key, hits, total = (part, segment), 0.0, 0.0
                n = np.frombuffer(unpack(own_hits), "<f4").astype(np.float64)
                moved = rows._from_planes(unpack(own), np.dtype("<f2")).astype(np.float64)
                hits = hits + n
                total = total + moved.reshape(SEGMENT_ROWS, -1) * n[:, None]
        if key:
            yield mean(key, hits, total)

    def mean(key, hits, total):
        body = (total / np.maximum(hits, 1)[:, None]).astype("<f4").tobytes()
        return pa.record_batch(
            [pa.array([key[0]]), pa.array([key[1]]), pa.array([body])],
            names=["part", "segment", "change"],
        )

    sent = learned.select("cells").mapInArrow(
        run, "part long, segment long, hits binary, moved binary"
    )
    changes = (
        sent.repartition("part", "segment")
        .sortWithinPartitions("part", "segment")
        .mapInArrow(merged, "part long, segment long, change binary")
    )
    out = _copy(model)
    # the model's size, whatever the corpus has
    for r in changes.collect():
        weights = (out.classes, out.slots)[r["part"]]
        start = r["segment"] * SEGMENT_ROWS
        change = np.frombuffer(r["change"], "<f4").reshape(SEGMENT_ROWS, -1)
        weights[start : start + SEGMENT_ROWS] += change
    shared.unpersist()
    return out


def _copy(model: Model) -> Model:
    out = Model()
    out.class_bias, out.slot_bias = model.class_bias, model.slot_bias
    out.classes, out.slots = model.classes.copy(), model.slots.copy()
    return out


def cell_scores(model: Model, cells: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Natural log of P(class | before) * P(slot | class, before) of every token."""
    pairs = pairs_before(cells, starts)
    order = np.argsort(pairs.astype(np.uint32))
    pairs, cells = pairs[order], cells[order]
    found = np.empty(len(cells))
    firsts = _first(pairs) if len(pairs) else np.empty(0, np.int64)
    # the classes once for each distinct pair, with all tokens that follow it
    for i in range(0, len(firsts), BATCH):
        own = firsts[i : i + BATCH]
        end = firsts[i + BATCH] if i + BATCH < len(firsts) else len(pairs)
        logs = _logs(model.class_bias, model.classes, class_rows(pairs[own]))
        context = np.repeat(np.arange(len(own)), np.diff(np.append(own, end)))
        found[own[0] : end] = logs[context, cells[own[0] : end] // SLOTS]
    for i in range(0, len(cells), BATCH):
        classes, slots = cells[i : i + BATCH] // SLOTS, cells[i : i + BATCH] % SLOTS
        of_slot = slot_rows(pairs[i : i + BATCH], classes)
        logs = _logs(model.slot_bias[classes], model.slots, of_slot)
        found[i : i + BATCH] += logs[np.arange(len(slots)), slots]
    out = np.empty(len(cells))
    out[order] = found
    return out


def scored_cells(celled: DataFrame, model: Model) -> DataFrame:
    """The rows of ``in_cells`` with ``cell_score``, log10, in place of ``cells``."""
    shared = celled.sparkSession.sparkContext.broadcast(model)
    last = len(celled.columns) - 1

    def run(batches):
        for batch, cells, starts in _documents(batches, last):
            sums = np.add.reduceat(cell_scores(shared.value, cells, starts), starts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:last], pa.array(sums / np.log(10))],
                names=[*batch.schema.names[:last], "cell_score"],
            )

    plain = celled.drop("cells").withColumn("cell_score", F.lit(0.0))
    return celled.mapInArrow(run, plain.schema)


def scored(docs: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Tokens are the text's words between white space, A-Z lower-cased, and one end. ``score``
    is the model's log10 probability of all of them, ``base_score`` that of the training
    words' shares (c + 1) / (N + V + 1). Documents of the held-out fold are scored but not
    learned from, in no part of the model.

    A null text is empty and has the end as its one token; a null key belongs to the training
    documents. Texts of any length and repeated rows are allowed, each row gives one row. An
    empty table gives no rows; where nothing is learned from, all words are unseen. Other
    columns, with any names, are not read; keys are read as long.

    Runs jobs while it is built (counts and training rounds), on tables in the shared folder.
    The sums of a round depend on how rows lie in partitions, in the last digits.
    """
    source = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        held_out(key).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    found = stored(numbered(source), "lm-numbered")
    words = word_table(found)
    known = vocabulary(words)
    celled = stored(in_cells(found, words, known), "lm-cells")
    model = Model.from_counts(known)
    for _ in range(rounds):
        model = train_round(celled.where("NOT held_out"), model)
    return scored_cells(celled, model).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("cell_score") + F.col("word_score")).alias("score"),
    )
