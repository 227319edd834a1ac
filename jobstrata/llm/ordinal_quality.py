"""Quality by ordinal cumulative-link regression on hashed text.

One weight vector over hashed features is shared by all grades; ordered thresholds cut
its line into grades: P(grade > k) = sigmoid(w.x - theta_k). A text's features are the
relative frequencies of its hashed byte trigrams and of word signs (shape, repeated
word), plus hashed marks of the whole text (share of distinct words, length).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm import rows
from jobstrata.llm.samples import fit_sample
from jobstrata.llm.storage import checkpointed

BITS = 15
ROUNDS = 30
PARTITIONS = 12
FEATURES = "label int, at binary, weight binary"
GAIN = 8.0  # scales relative frequencies, so that unit weights matter


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, line: np.ndarray) -> np.ndarray:
        """P(grade > k) for every row and threshold."""
        return _sigmoid(line[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _slot(values: np.ndarray, kind: int) -> np.ndarray:
    """The feature number of hashed values of one kind."""
    salted = values.astype(np.uint64) * np.uint64(8) + np.uint64(kind)
    return (rows.stirred(salted) >> np.uint64(64 - BITS)).astype(np.int32)


def features(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, weight) of all texts; entries of a feature add up."""
    n = len(values)
    sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    body = np.frombuffer(b"".join(v.as_buffer().to_pybytes() for v in values), np.uint8)
    at, slot, weight = [], [], []

    def add(owner: np.ndarray, number: np.ndarray, share: np.ndarray) -> None:
        at.append(owner.astype(np.int32))
        slot.append(number)
        weight.append(share.astype(np.float32))

    if len(body) >= 3:
        grams = body[:-2].astype(np.uint32) << 16 | body[1:-1].astype(np.uint32) << 8 | body[2:]
        owner = np.repeat(np.arange(n), sizes)[:-2]
        own = rows.inside(sizes, 3)[:-2]
        owner = owner[own]
        share = GAIN / np.maximum(np.bincount(owner, minlength=n), 1)
        numbers = _slot(np.arange(1 << 24, dtype=np.uint64), 0) if len(body) > 1 << 24 else None
        numbers = numbers[grams[own]] if numbers is not None else _slot(grams[own], 0)
        add(owner, numbers, share[owner])
    words, counts = rows.split_words(values)
    if len(words):
        hashed = rows.word_hashes(words)
        owner = np.repeat(np.arange(n), counts)
        share = GAIN / np.maximum(counts, 1)
        same = np.zeros(len(hashed), bool)
        same[1:] = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])
        add(owner, _slot(same.astype(np.uint64), 1), share[owner])
        length = np.minimum(pc.utf8_length(words).to_numpy(zero_copy_only=False), 15)
        signs = pc.match_substring_regex(words, r"[^\pL\pN.,;:]").to_numpy(zero_copy_only=False)
        upper = pc.utf8_is_upper(words).to_numpy(zero_copy_only=False)
        shape = length * 4 + signs.astype(np.int64) * 2 + upper.astype(np.int64)
        add(owner, _slot(shape, 2), share[owner])
        order = np.lexsort([hashed, owner])
        fresh = np.ones(len(order), bool)
        fresh[1:] = (hashed[order][1:] != hashed[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        distinct = np.bincount(owner[order][fresh], minlength=n) / np.maximum(counts, 1)
        # the expected share of distinct words falls with the length, so both are marked
        band = np.log2(counts + 1).astype(np.int64) * 16 + np.ceil(distinct * 15).astype(np.int64)
        add(np.arange(n), _slot(band, 3), np.ones(n))
    add(np.arange(n), _slot(np.log2(sizes + 1).astype(np.int64), 4), np.ones(n))
    return np.concatenate(at), np.concatenate(slot), np.concatenate(weight)


def lines(model: OrdinalModel, values: pa.Array) -> np.ndarray:
    """w.x of every text."""
    owner, slot, weight = features(values)
    return np.bincount(owner, weights=model.weights[slot] * weight, minlength=len(values))


def _featurised(batches):
    for batch in rows.slices(batches, "text"):
        values = rows.texts(batch)
        owner, slot, weight = features(values)
        code = owner.astype(np.int64) << BITS | slot
        keys, back = np.unique(code, return_inverse=True)
        sums = np.bincount(back, weights=weight).astype("<f4")
        starts = np.searchsorted(keys, np.arange(len(values) + 1, dtype=np.int64) << BITS)
        slots = (keys & ((1 << BITS) - 1)).astype("<i4")
        yield pa.record_batch(
            [batch.column(1), rows.pack(slots, starts), rows.pack(sums, starts)],
            names=["label", "at", "weight"],
        )


def fitted(
    docs: DataFrame,
    ratings: DataFrame,
    grade: str,
    grades: int,
    key: str = "doc_id",
    text: str = "text",
    rounds: int = ROUNDS,
    rate: float = 0.5,
    decay: float = 1e-5,
) -> OrdinalModel:
    """Fits by full gradient steps: each round every partition adds up its gradient over its
    rows, and only the sums (one vector a partition) come back.

    At most ``samples.FIT_ROWS`` rated training rows are used (the documented bound); fold
    0 is held out. Ratings outside 0 .. grades - 1 are ignored. Without ratings the model
    is flat: every text gets the same line, and thresholds at zero.
    """
    spark = docs.sparkSession
    rated = ratings.where(F.col(grade).between(0, grades - 1))
    sample = fit_sample(docs, rated, grade, key, text).repartition(PARTITIONS)
    table = checkpointed(sample.mapInArrow(_featurised, FEATURES))
    seen = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    total = sum(seen.values())
    above = [sum(c for g, c in seen.items() if g > k) for k in range(grades - 1)]
    theta = np.array([-math.log((a + 0.5) / (total - a + 0.5)) for a in above])
    if not total:
        return OrdinalModel(np.zeros(1 << BITS), np.zeros(grades - 1))
    size = 1 << BITS
    weights, past = np.zeros(size), np.full(size, 1e-8)
    past_theta = np.full(grades - 1, 1e-8)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(OrdinalModel(weights, theta))
        sums = np.zeros(size + grades - 1)
        for row in table.mapInArrow(_gradient(shared, size), "gradient binary").collect():
            sums += np.frombuffer(row["gradient"])
        shared.unpersist()
        gradient = sums[:size] / total + decay * weights
        past += gradient**2
        weights = weights - rate * gradient / np.sqrt(past)
        slope = sums[size:] / total
        past_theta += slope**2
        theta = np.sort(theta - rate / 4 * slope / np.sqrt(past_theta))
    return OrdinalModel(weights, theta)


def _gradient(shared, size: int):
    """One row a partition: the gradient of the negative log-likelihood over its rows."""

    def run(batches):
        model, out = shared.value, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if out is None:
                out = np.zeros(size + len(model.thresholds))
            slot = rows.unpack(batch.column(1), np.dtype("<i4"))
            weight = rows.unpack(batch.column(2), np.dtype("<f4")).astype(np.float64)
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False) // 4
            owner = np.repeat(np.arange(n), sizes)
            line = np.bincount(owner, weights=model.weights[slot] * weight, minlength=n)
            grade = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            tails = model.tails(line)
            padded = np.column_stack([np.ones(n), tails, np.zeros(n)])
            pick = np.arange(n)
            upper, lower = padded[pick, grade], padded[pick, grade + 1]
            chance = np.maximum(upper - lower, 1e-9)
            to_line = -(upper * (1 - upper) - lower * (1 - lower)) / chance
            out[:size] += np.bincount(slot, weights=to_line[owner] * weight, minlength=size)
            for k in range(len(model.thresholds)):
                rise = tails[:, k] * (1 - tails[:, k]) / chance
                out[size + k] += rise[grade == k + 1].sum() - rise[grade == k].sum()
        if out is not None:
            yield pa.record_batch([pa.array([out.tobytes()], pa.binary())], names=["gradient"])

    return run


def graded(
    docs: DataFrame,
    model: OrdinalModel,
    key: str = "doc_id",
    text: str = "text",
    tail: int = 0,
    least: float = 0.5,
) -> DataFrame:
    """``key, expected_grade, tail_probability, kept`` of every row.

    ``tail_probability`` is P(grade > tail); a row is kept when it reaches ``least``.
    Null text is empty; empty texts are graded by their length mark alone. Repeated rows
    are graded each. Other columns are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in rows.slices(batches, "text", 1 << 20):
            tails = own.tails(lines(own, rows.texts(batch)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(tails.sum(axis=1)),
                    pa.array(tails[:, tail].copy()),
                    pa.array(tails[:, tail] >= least),
                ],
                names=[key, "expected_grade", "tail_probability", "kept"],
            )

    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, expected_grade double, tail_probability double, kept boolean"
    return docs.select(F.col(key), F.col(text).alias("text")).mapInArrow(run, schema)
