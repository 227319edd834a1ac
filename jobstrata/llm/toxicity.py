"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: compatibility forms and look-alike letters to their plain letter,
digits and signs that stand for letters inside a word to those letters. The lexicon holds
whole words and word beginnings with a log-odds weight, learned from labelled documents;
exception phrases are neighbouring words in which an entry is harmless. A document's
density is its summed weight over its length; a monotone table turns it into a score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm import rows
from jobstrata.llm.samples import fit_sample, fold_of
from jobstrata.llm.storage import checkpointed

# FIXED VALUES: look-alike letters of other scripts and the letter each resembles.
LOOK_ALIKES = dict(
    zip(
        "аеіорсухѕјԁһкмтвнαεικνορτυχβηγ",
        "aeiopcyxsjdhkmtbhaeikvoptuxbny",
        strict=True,
    )
)
# FIXED VALUES: digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"} | {
    "@": "a",
    "$": "s",
}
#: one sign for letters that are told apart by hardly anything when written as digits
MERGED = {"l": "i"}
STEM_SIZES = (4, 5, 6, 7, 8)
BINS = 48
_plain = re.compile(r"[^\W_]+")
_mixed = re.compile(r"[\w@$]+")
_sign = re.compile(r"[0-9@$]")
_letter = re.compile(r"[^\W\d_]")
_table = str.maketrans(LOOK_ALIKES | MERGED)
_digits = str.maketrans(SUBSTITUTES)
_hidden = re.compile("[­​-‏⁠﻿̀-ͯ]")


def _word(match: re.Match) -> str:
    word = match.group()
    return word.translate(_digits) if _letter.search(word) else " "


def folded(text: str) -> str:
    """The folded words of a text, one blank before and after each."""
    if not text.isascii():
        text = _hidden.sub("", unicodedata.normalize("NFKC", text))
    text = text.lower()
    if _sign.search(text):
        text = _mixed.sub(_word, text)
    return f" {' '.join(_plain.findall(text.translate(_table)))} "


def entries_of(word: str) -> Iterator[str]:
    """What a lexicon may hold of a word: the word, and its beginnings of some lengths."""
    yield f" {word} "
    for size in STEM_SIZES:
        if len(word) > size:
            yield f" {word[:size]}"


@dataclass
class Lexicon:
    """Weights of entries, harmless phrases, and the score of each density bin."""

    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    scores: list[float] = field(default_factory=list)

    def automaton(self):
        import ahocorasick

        auto = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            auto.add_word(entry, (len(entry), weight, False))
        for phrase in self.exceptions:
            auto.add_word(f" {phrase} ", (len(phrase) + 2, 0.0, True))
        if len(auto):
            auto.make_automaton()
        return auto


def matches(auto, text: str) -> list[tuple[int, float]]:
    """(start of the word, weight) of every word hit; of entries at one word the heaviest.

    An entry inside an exception phrase does not count.
    """
    if not len(auto):
        return []
    hits: dict[int, float] = {}
    harmless: list[tuple[int, int]] = []
    for end, (size, weight, exception) in auto.iter(text):
        start = end - size + 1
        if exception:
            harmless.append((start, end))
        else:
            hits[start] = max(weight, hits.get(start, 0.0))
    return [
        (at, w) for at, w in sorted(hits.items()) if not any(a <= at < b for a, b in harmless)
    ]


def density(auto, text: str) -> tuple[float, int, int]:
    """(summed weight per root of length, words, hits) of a folded text."""
    words = text.count(" ") - 1
    found = matches(auto, text)
    return sum(w for _, w in found) / math.sqrt(10 + max(words, 0)), max(words, 0), len(found)


def bin_of(value: float) -> int:
    """Bin 0 is no hit at all; the others grow by a fixed ratio."""
    if value <= 0:
        return 0
    return 1 + min(BINS - 2, max(0, int(4 * math.log2(value) + BINS / 2)))


def _folded_rows(run):
    def mapped(batches):
        for batch in rows.slices(batches, "text"):
            values = batch.column(0).to_pylist()
            yield from run([folded(t or "") for t in values], batch.column(1).to_pylist())

    return mapped


def _counts(sample: DataFrame, counted, names: str = "entry string") -> DataFrame:
    """Sums per key of (toxic, other) documents, added up in each slice before the shuffle."""

    def run(texts: list[str], labels: list[int]):
        sums: dict[str, list[int]] = {}
        for text, label in zip(texts, labels):
            for key in counted(text):
                sums.setdefault(key, [0, 0])[0 if label else 1] += 1
        if sums:
            yield pa.record_batch(
                [
                    pa.array(list(sums), pa.string()),
                    pa.array([v[0] for v in sums.values()], pa.int64()),
                    pa.array([v[1] for v in sums.values()], pa.int64()),
                ],
                names=["entry", "toxic", "other"],
            )

    got = sample.mapInArrow(_folded_rows(run), f"{names}, toxic long, other long")
    return got.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def learned(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    least_share: float = 0.005,
    least_documents: int = 4,
    least_evidence: float = 1.5,
) -> Lexicon:
    """A lexicon from the labelled documents outside the held-out fold.

    It is fitted on at most ``samples.FIT_ROWS`` labelled rows (the documented bound). An
    entry needs ``least_documents`` toxic documents and ``least_share`` of them, which
    bounds the number of entries, and a log-odds that stays above ``least_evidence`` when
    two standard errors are taken off. Without labels, or without
    toxic ones, the lexicon is empty and every score is the base rate.
    """
    sample = checkpointed(fit_sample(docs, labels, label, key, text))
    sizes = sample.groupBy("label").count().collect()
    n = {bool(r["label"]): r["count"] for r in sizes}
    toxic, other = n.get(True, 0), n.get(False, 0)
    least = max(least_documents, least_share * toxic)
    hits, rest = F.col("toxic") + 0.5, F.col("other") + 0.5
    odds = F.log(hits / (toxic + 1)) - F.log(rest / (other + 1))
    table = (
        _counts(sample, lambda t: {e for w in set(t.split()) for e in entries_of(w)})
        .where(F.col("toxic") >= least)
        .withColumn("odds", odds)
        .where(F.col("odds") - 2 * F.sqrt(1 / hits + 1 / rest) >= least_evidence)
        .collect()
    )
    weights = {r["entry"]: r["odds"] for r in table}
    cover = {r["entry"]: r["toxic"] for r in table}
    lexicon = Lexicon(_needed(sample, _closest(weights, cover), cover, toxic))
    lexicon.exceptions = _exceptions(sample, lexicon)
    lexicon.scores = _calibrated(sample, lexicon, toxic, other)
    return lexicon


def _closest(weights: dict[str, float], cover: dict[str, int]) -> dict[str, float]:
    """Of word beginnings that cover the same documents the longest, and no entry that a
    kept beginning already covers about as well."""
    stems = sorted((e for e in weights if not e.endswith(" ")), key=len, reverse=True)
    kept: dict[str, float] = {}
    for stem in stems:
        longer = [k for k in kept if k.startswith(stem)]
        if any(cover[k] >= 0.9 * cover[stem] for k in longer):
            continue
        if any(weights[k] > weights[stem] + 1 for k in longer):
            continue
        for k in longer:
            del kept[k]
        kept[stem] = weights[stem]
    for word in (e for e in weights if e.endswith(" ")):
        stem = next((k for k in kept if word.startswith(k)), None)
        if stem is None or weights[word] > weights[stem] + 1:
            kept[word] = weights[word]
        elif cover[word] >= 0.9 * cover[stem]:  # the beginning stands for this word alone
            del kept[stem]
            kept[word] = weights[word]
    return kept


def _needed(
    sample: DataFrame,
    weights: dict[str, float],
    cover: dict[str, int],
    toxic: int,
    sole_share: float = 0.002,
    wide_share: float = 0.1,
) -> dict[str, float]:
    """The entries of a ``wide_share`` of the toxic documents, and those that are the widest
    entry of a ``sole_share`` of them (two at least).

    A harmless word of a much copied toxic text only ever stands beside wider entries.
    """
    ranked = sorted(weights, key=lambda e: (cover[e], e))
    ranks = Lexicon({e: float(i + 1) for i, e in enumerate(ranked)})
    shared = sample.sparkSession.sparkContext.broadcast(ranks)
    held: list = []

    def widest(text: str):
        if not held:
            held.append(shared.value.automaton())
        return {str(int(max(w for _, w in found)))} if (found := matches(held[0], text)) else ()

    least = max(2, sole_share * toxic)
    table = _counts(sample, widest).where(F.col("toxic") >= least).collect()
    sole = {ranked[int(r["entry"]) - 1] for r in table}
    return {e: w for e, w in weights.items() if e in sole or cover[e] >= wide_share * toxic}


def _exceptions(sample: DataFrame, lexicon: Lexicon, least: int = 3) -> set[str]:
    """Neighbouring words with a hit that several harmless documents have and hardly a toxic one."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)
    held: list = []

    def phrases(text: str) -> set[str]:
        if not held:
            held.append(shared.value.automaton())
        out = set()
        for at, _ in matches(held[0], text):
            end = text.index(" ", at + 1)
            before = text.rfind(" ", 0, at)
            after = text.find(" ", end + 1)
            if before >= 0:
                out.add(text[before + 1 : end])
            if after >= 0:
                out.add(text[at + 1 : after])
        return out

    table = _counts(sample, phrases).where(
        (F.col("other") >= least) & (F.col("toxic") * 20 <= F.col("other"))
    )
    return {r["entry"] for r in table.collect()}


def _calibrated(sample: DataFrame, lexicon: Lexicon, toxic: int, other: int) -> list[float]:
    """The share of toxic documents in each density bin, made to rise with the density."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)
    held: list = []

    def bins(text: str):
        if not held:
            held.append(shared.value.automaton())
        return (str(bin_of(density(held[0], text)[0])),)

    counts: Counter = Counter()
    for r in _counts(sample, bins).collect():
        counts[int(r["entry"]), True] += r["toxic"]
        counts[int(r["entry"]), False] += r["other"]
    base = (toxic + 0.5) / (toxic + other + 1)
    blocks: list[list[float]] = []  # share, weight, bins
    for b in range(BINS):
        n = counts[b, True] + counts[b, False]
        blocks.append([(counts[b, True] + 0.5 * base) / (n + 0.5), n + 0.5, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            share, weight, size = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + share * weight) / (last[1] + weight)
            last[1] += weight
            last[2] += size
    return [share for share, _, size in blocks for _ in range(int(size))]


def scored(
    docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, score, predicted, n_hits, n_words`` of every row; ``docs`` keeps its partitions.

    Null and empty texts have no hit and get the score of no hit. Repeated rows are scored
    each. Other columns are not read, whatever their names. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        known = shared.value
        auto = known.automaton()
        for batch in rows.slices(batches, "text"):
            found = [density(auto, folded(t or "")) for t in batch.column(1).to_pylist()]
            scores = [min(1.0, max(0.0, known.scores[bin_of(d)])) for d, _, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array([int(x >= 0.5) for x in scores], pa.int32()),
                    pa.array([h for _, _, h in found], pa.int64()),
                    pa.array([w for _, w, _ in found], pa.int64()),
                ],
                names=[key, "score", "predicted", "n_hits", "n_words"],
            )

    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, score double, predicted int, n_hits long, n_words long"
    return docs.select(F.col(key), F.col(text).alias("text")).mapInArrow(run, schema)


def without_toxic(
    docs: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = 0.5
) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; other rows unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    place = docs.columns.index(text)

    def run(batches):
        known = shared.value
        auto = known.automaton()
        for batch in rows.slices(batches, text):
            values = batch.column(place).to_pylist()
            keep = [
                known.scores[bin_of(density(auto, folded(t or ""))[0])] < threshold for t in values
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


__all__ = ["Lexicon", "fold_of", "folded", "learned", "scored", "without_toxic"]
