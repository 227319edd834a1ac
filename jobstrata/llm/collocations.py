"""Phrase collocations: padded five-word windows counted once, shorter phrases by ROLLUP.

Every word starts one window of up to ``longest`` words of its piece, padded with "" where
the piece ends. Only these windows are counted; Spark's ROLLUP over the window's columns
sums them to the counts of all shorter phrases, since every occurrence of a phrase is the
beginning of exactly one window.

All beginnings of a phrase that occurs ``least`` times do so as well. A first read of the
texts therefore counts hashed beginnings of windows, a table of buckets for each length; the
second one cuts a window where a beginning's whole bucket stays below ``least``. A bucket
counts at least what each of its members does, so no frequent phrase is lost, and few
distinct windows are left to be shuffled. The tables grow with the corpus up to ``MOST_BITS``;
beyond about 2 GB of text for each 100 of ``least`` they tell less and less apart, and the
result stays exact. On larger corpora more windows are kept, one for each word at most.

A task merges the windows of its slices and sends each distinct one once, as codes in blocks
that bring their own words. A block holds the windows of a bucket of their first ``HEAD``
words, so the beginnings of that many words and more meet in one place: they are counted
exactly and windows cut again. What is left goes by the bucket of its first word, where shorter
beginnings are counted and windows cut for the last time, before any row is made of
them. What reaches the ROLLUP are windows that are frequent phrases, each once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.llm import rows
from jobstrata.llm.storage import stored

LONGEST = 5
LEAST = 100
TOP = 2000
#: text of a task's slice; the windows of a slice are counted before they leave it
SLICE_BYTES = 4 << 20
#: bytes of text for one bucket of a table, and a table's least and greatest size
BYTES_PER_BUCKET = 256
LEAST_BITS, MOST_BITS = 12, 23
#: buckets that travel as one row
SEGMENT_BITS = 16
#: windows whose first words are the same meet in one block's bucket, for so many words
HEAD = 3
#: text that one such bucket stands for, and the least number of buckets
BLOCK_BYTES, LEAST_BLOCKS = 16 << 20, 16
#: the columns of a block
_BLOCK = "bucket int, words binary, sizes binary, codes binary, counts binary"
#: windows a task holds before it merges them
HELD = 1 << 20
#: an unstated language
NO_LANG = "und"

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*map(ord, ".,;:!?"), *range(0x0A, 0x0E)]] = 2
#: what a byte becomes before words are split at white space: lower case, marks to blanks
_AS_WORDS = np.arange(256, dtype=np.uint8)
_AS_WORDS[ord("A") : ord("Z") + 1] += 32
_AS_WORDS[_KIND == 2] = 0x20


class Words:
    """The words of a slice: codes in a dictionary, keyed hashes, and who follows whom."""

    def __init__(self, texts: pa.Array, langs: pa.Array) -> None:
        begin, end = (int(x.as_py()) for x in (_offsets(texts)[0], _offsets(texts)[-1]))
        body = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begin:end]
        bounds = _offsets(texts).to_numpy().astype(np.int64) - begin
        cleaned = pa.Array.from_buffers(
            pa.large_string(),
            len(texts),
            [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(_AS_WORDS[body].tobytes())],
        )
        flat, counts = rows.split_words(cleaned)
        coded = pc.dictionary_encode(flat)
        self.dictionary = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kind = _KIND[body]
        doc = np.repeat(np.arange(len(texts)), counts)
        starts = self._starts(kind, bounds)
        breaks = np.cumsum(kind == 2)[starts] if len(starts) else starts
        #: the next word stands in the same piece of the same text
        self.linked = np.zeros(len(doc), bool)
        if len(doc):
            self.linked[:-1] = (doc[1:] == doc[:-1]) & (breaks[1:] == breaks[:-1])
        named = pc.dictionary_encode(langs)
        self.langs = named.dictionary
        self.lang = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc]
        keys = self._hashes(self.langs, "collocation-lang")[self.lang]
        plain = self._hashes(self.dictionary, "collocation-word")
        self.word = rows.stirred(plain[self.codes] ^ keys) if len(doc) else plain
    def beginnings(self, longest: int):
        """(length, hash of the words from each on, where there are so many) for each length."""
        hashes, able = self.word, np.ones(len(self.word), bool)
        for length in range(1, longest + 1):
            yield length, hashes, able
            ahead = len(hashes) - length
            if ahead <= 0:
                return
            longer, goes_on = hashes.copy(), np.zeros(len(able), bool)
            longer[:ahead] = rows.stirred(hashes[:ahead] * rows.BASE + self.word[length:])
            goes_on[:ahead] = able[:ahead] & self.linked[length - 1 : -1]
            hashes, able = longer, goes_on

    @staticmethod
    def _starts(kind: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        inside = kind == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        at = bounds[:-1][bounds[:-1] < len(kind)]
        first[at] = inside[at]  # a text's first byte follows no byte of the text before
        return np.flatnonzero(first)

    @staticmethod
    def _hashes(values: pa.Array, key: str) -> np.ndarray:
        if not len(values):
            return np.empty(0, np.uint64)
        plain = values.to_numpy(zero_copy_only=False)
        return pd.util.hash_array(plain, hash_key=(key * 2)[:16], categorize=False)


def _offsets(values: pa.Array) -> pa.Array:
    return pa.Array.from_buffers(
        pa.int64(), len(values) + 1, [None, values.buffers()[1]], offset=values.offset
    )


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _slice_words(batch: pa.RecordBatch) -> Words:
    return Words(rows.texts(batch, "text"), batch.column(0).cast(pa.large_string()))


def bucket_counts(spoken: DataFrame, bits: int, longest: int, least: int) -> DataFrame:
    """(part, segment, lang, n, counts): every task's bucket counts of beginnings (part: their
    length), packed by segment, and its word counts by language (part 0)."""
    schema = "part int, segment long, lang string, n long, counts binary"
    # a count that has reached ``least`` need not go on
    kind = np.dtype("<u2") if least < 1 << 16 else np.dtype("<u4")
    most = np.iinfo(kind).max

    def run(batches):
        counts = np.zeros((longest, 1 << bits), kind)
        spoken_words: dict[str, int] = {}
        for batch in rows.slices(batches, "text", SLICE_BYTES):
            own = _slice_words(batch)
            for length, hashes, able in own.beginnings(longest):
                found = np.sort(_bucket(hashes[able], bits))
                at = np.flatnonzero(np.append(True, found[1:] != found[:-1])[: len(found)])
                met = found[at]
                total = counts[length - 1][met] + np.diff(np.append(at, len(found)))
                counts[length - 1][met] = np.minimum(total, most)
            sizes = np.bincount(own.lang, minlength=len(own.langs)).tolist()
            for lang, n in zip(own.langs.to_pylist(), sizes):
                spoken_words[lang] = spoken_words.get(lang, 0) + n
        pack = zstandard.ZstdCompressor(level=1).compress
        size = 1 << min(bits, SEGMENT_BITS)
        for length in range(1, longest + 1):
            for segment in range((1 << bits) // size):
                cut = counts[length - 1, segment * size : (segment + 1) * size]
                if cut.any():
                    yield _one(length, segment, None, 0, pack(rows._planes(cut.astype("<u4"))))
        for lang, n in spoken_words.items():
            yield _one(0, 0, lang, n, None)

    def _one(*cells):
        types = (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary())
        return pa.record_batch(
            [pa.array([c], t) for c, t in zip(cells, types)],
            names=["part", "segment", "lang", "n", "counts"],
        )

    return spoken.mapInArrow(run, schema)


def frequent_buckets(counted: DataFrame, least: int) -> DataFrame:
    """(part, segment, bits): which buckets of a segment reach ``least`` over all tasks.

    A task adds up its segments as their parts stream in; it holds one sum at a time.
    """

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        key, total = None, None
        for batch in batches:
            for *own, body in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
                cut = rows._from_planes(unpack(body), np.dtype("<u4")).astype(np.uint64)
                if own != key:
                    if key is not None:
                        yield _bits(key, total)
                    key, total = own, np.zeros(len(cut), np.uint64)
                total += cut
        if key is not None:
            yield _bits(key, total)

    def _bits(key, total):
        body = np.packbits(total >= least).tobytes()
        return pa.record_batch(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([body])],
            names=["part", "segment", "bits"],
        )

    return (
        counted.where("part > 0")
        .select("part", "segment", "counts")
        .repartition("part", "segment")
        .sortWithinPartitions("part", "segment")
        .mapInArrow(run, "part int, segment long, bits binary")
    )


def _bitmaps(found: DataFrame, bits: int, longest: int) -> np.ndarray:
    """The tables as packed bits: at most ``longest`` x 2**MOST_BITS come to the driver."""
    maps = np.zeros((longest, 1 << bits), bool)
    size = 1 << min(bits, SEGMENT_BITS)
    for r in found.collect():
        start = r["segment"] * size
        cut = np.frombuffer(r["bits"], np.uint8)
        maps[r["part"] - 1, start : start + size] = np.unpackbits(cut)[:size].astype(bool)
    return np.packbits(maps, axis=1)


@dataclass(frozen=True)
class Counted:
    """Windows and how often each occurs. A row of ``codes`` has the window's bucket, its
    language and its words, the last two as places in ``words``; a pad is "" among them."""

    words: pa.Array
    codes: np.ndarray
    counts: np.ndarray

    @classmethod
    def of_slice(cls, own: Words, lengths: np.ndarray, buckets: np.ndarray, longest: int) -> Counted:
        """The windows of ``lengths`` words that start at each word of a slice; 0: none."""
        pad = len(own.dictionary)
        words = pa.concat_arrays([own.dictionary, pa.array([""], own.dictionary.type), own.langs])
        at = np.flatnonzero(lengths)
        codes = np.full((len(at), 2 + longest), pad, np.int32)
        codes[:, 0], codes[:, 1] = buckets[at], pad + 1 + own.lang[at]
        for i in range(longest):
            long = np.flatnonzero(lengths[at] > i)
            codes[long, 2 + i] = own.codes[at[long] + i]
        return cls(words, codes, np.ones(len(at), np.int64)).distinct().trimmed()

    @classmethod
    def merged(cls, parts: list[Counted]) -> Counted:
        if len(parts) == 1:
            return parts[0]
        coded = pc.dictionary_encode(pa.concat_arrays([p.words for p in parts]))
        place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        starts = rows.offsets(np.array([len(p.words) for p in parts]))
        codes = np.concatenate([p.codes for p in parts])
        bounds = np.cumsum([0, *(len(p.codes) for p in parts)])
        for start, a, b in zip(starts, bounds[:-1], bounds[1:]):
            codes[a:b, 1:] = place[codes[a:b, 1:] + start]
        return cls(coded.dictionary, codes, np.concatenate([p.counts for p in parts])).distinct()

    def distinct(self) -> Counted:
        """Each window once, ordered by its codes."""
        key, span = np.zeros(len(self.codes), np.int64), 1
        for column in self.codes.T:
            high = int(column.max(initial=0)) + 1
            if span * high >= 1 << 62:  # numbers of beginnings take the place of their codes
                known, key = np.unique(key, return_inverse=True)
                span = len(known)
            key = key * high + column
            span *= high
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        counts = np.add.reduceat(self.counts[order], first) if len(first) else self.counts
        return Counted(self.words, self.codes[order[first]], counts)

    def trimmed(self) -> Counted:
        """Without words that no window has."""
        used = np.zeros(len(self.words), bool)
        used[self.codes[:, 1:]] = True
        codes = self.codes.copy()
        codes[:, 1:] = (np.cumsum(used, dtype=np.int32) - 1)[codes[:, 1:]]
        return Counted(self.words.take(pa.array(np.flatnonzero(used))), codes, self.counts)

    def blocks(self):
        """The windows of one bucket after the other; they are ordered."""
        bucket = self.codes[:, 0]
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
        for a, b in zip(starts, np.append(starts[1:], len(bucket))):
            yield Counted(self.words, self.codes[a:b], self.counts[a:b]).trimmed()

    def frequent(self, least: int, head: int) -> Counted:
        """The windows of a whole bucket, cut after their last beginning of ``head`` words
        or more that occurs ``least`` times; shorter beginnings are met in other buckets too."""
        words, pad = self.words, self.words.index("").as_py()
        if pad < 0:  # no window of the bucket ended early
            words, pad = pa.concat_arrays([words, pa.array([""], words.type)]), len(words)
        codes = self.codes.copy()
        longest = codes.shape[1] - 2
        changed = np.zeros(len(codes), bool)
        if len(codes):
            changed[0] = True
            changed[1:] = (codes[1:, : 1 + head] != codes[:-1, : 1 + head]).any(1)
        rare = np.zeros(len(codes), bool)
        for place in range(1 + head, 2 + longest):
            changed[1:] |= self.codes[1:, place] != self.codes[:-1, place]
            starts = np.flatnonzero(changed)
            sizes = np.diff(np.append(starts, len(codes)))
            if len(starts):
                rare |= np.repeat(np.add.reduceat(self.counts, starts) < least, sizes)
            codes[rare, place] = pad
        some = codes[:, 2] != pad
        return Counted(words, codes[some], self.counts[some]).distinct()

    def by_first_word(self, buckets: int) -> Counted:
        """The windows in buckets of their first word."""
        of_word = Words._hashes(self.words, "collocation-word")[self.codes[:, 2]]
        of_lang = Words._hashes(self.words, "collocation-lang")[self.codes[:, 1]]
        codes = self.codes.copy()
        codes[:, 0] = rows.stirred(of_word ^ of_lang) % np.uint64(buckets)
        return Counted(self.words, codes, self.counts).distinct()

    def packed(self) -> pa.RecordBatch:
        """A block's row."""
        pack = zstandard.ZstdCompressor(level=1).compress
        sizes = pc.binary_length(self.words).to_numpy(zero_copy_only=False)
        body = pa.concat_arrays([self.words]).buffers()[2]
        columns = np.ascontiguousarray(self.codes[:, 1:].T).ravel()
        cells = [
            pack(body.to_pybytes()[: int(sizes.sum())] if body else b""),
            pack(rows._planes(sizes.astype("<u4"))),
            pack(rows._planes(columns.astype("<u4"))),
            pack(rows._planes(self.counts.astype("<u8"))),
        ]
        return pa.record_batch(
            [pa.array(self.codes[:1, 0]), *(pa.array([c], pa.binary()) for c in cells)],
            names=[c.split()[0] for c in _BLOCK.split(", ")],
        )

    @classmethod
    def unpacked(cls, bucket: int, body: bytes, sizes: bytes, codes: bytes, counts: bytes) -> Counted:
        unpack = zstandard.ZstdDecompressor().decompress
        ends = np.cumsum(np.append(0, rows._from_planes(unpack(sizes), np.dtype("<u4"))), dtype=np.int64)
        words = pa.Array.from_buffers(
            pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(unpack(body))]
        )
        own = rows._from_planes(unpack(counts), np.dtype("<u8")).astype(np.int64)
        columns = rows._from_planes(unpack(codes), np.dtype("<u4")).reshape(-1, len(own)).T
        first = np.full((len(own), 1), bucket)
        return cls(words, np.concatenate([first, columns], axis=1).astype(np.int32), own)

    def batches(self, names: list[str]):
        for i in range(0, len(self.codes), 1 << 16):
            part = self.codes[i : i + (1 << 16), 1:]
            columns = [self.words.take(pa.array(c)).cast(pa.string()) for c in part.T]
            columns.append(pa.array(self.counts[i : i + (1 << 16)]))
            yield pa.record_batch(columns, names=names)


def windows(spoken: DataFrame, maps: np.ndarray, bits: int, longest: int, buckets: int) -> DataFrame:
    """Packed blocks of the padded windows, each counted within its task."""
    shared = spoken.sparkSession.sparkContext.broadcast(maps)

    def run(batches):
        held, size = [], 0
        for batch in rows.slices(batches, "text", SLICE_BYTES):
            own = _slice_words(batch)
            if not len(own.codes):
                continue
            held.append(kept(own))
            size += len(held[-1].codes)
            if size >= HELD:
                held = [Counted.merged(held)]
                size = len(held[0].codes)
                if size >= HELD // 2:
                    yield from (block.packed() for block in held[0].blocks())
                    held, size = [], 0
        if size:
            yield from (block.packed() for block in Counted.merged(held).blocks())
        del held
        rows.give_back()

    def kept(own):
        lengths, whole = np.zeros(len(own.codes), np.int8), True
        met = np.zeros(len(own.codes), np.int32)
        for length, hashes, able in own.beginnings(longest):
            at = np.flatnonzero(able & whole)
            bucket = _bucket(hashes[at], bits)
            bit = shared.value[length - 1][bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)
            shorter, whole = whole, np.zeros(len(able), bool)
            whole[at] = (bit & 1).astype(bool)
            if length > 1:  # what follows the first word is frequent as well
                whole[:-1] &= shorter[1:]
            lengths[whole] = length
            if length <= HEAD:
                met[whole] = hashes[whole] % np.uint64(buckets)
        return Counted.of_slice(own, lengths, met, longest)

    return spoken.mapInArrow(run, _BLOCK)


def _met(sent: DataFrame, head: int, least: int, onward, schema: str) -> DataFrame:
    """What ``onward`` makes of the windows of each whole bucket, cut at rare beginnings of
    ``head`` words and more."""

    def run(batches):
        last, held, size, most = None, [], 0, HELD
        for batch in batches:
            for i in range(batch.num_rows):
                bucket, *body = (c[i].as_py() for c in batch.columns)
                if bucket != last and held:
                    yield from onward(Counted.merged(held).frequent(least, head))
                    held, size, most = [], 0, HELD
                last = bucket
                held.append(Counted.unpacked(bucket, *body))
                size += len(held[-1].codes)
                if size >= most:
                    held = [Counted.merged(held)]
                    size = len(held[0].codes)
                    most = max(HELD, 2 * size)
        if held:
            yield from onward(Counted.merged(held).frequent(least, head))
        del held
        rows.give_back()

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def whole_windows(sent: DataFrame, longest: int, least: int, buckets: int) -> DataFrame:
    """(lang, w1 .. w<longest>, c): the windows of all tasks, each once and cut after its last
    beginning that occurs ``least`` times; without one it is left out."""
    names = [f"w{i + 1}" for i in range(longest)]
    columns = ", ".join(f"{n} string" for n in names)
    fewer = max(LEAST_BLOCKS, buckets // 4)

    def again(counted):
        return (block.packed() for block in counted.by_first_word(fewer).blocks())

    def as_rows(counted):
        return counted.batches(["lang", *names, "c"])

    rests = _met(sent, HEAD, least, again, _BLOCK)
    return _met(rests, 1, least, as_rows, f"lang string, {columns}, c long")


def phrase_counts(counted: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, words, f) of all phrases that occur ``least`` times, from the windows."""
    names = [f"w{i + 1}" for i in range(longest)]
    level = longest - F.size(F.filter(F.array(*(F.grouping(n) for n in names)), lambda g: g == 1))
    summed = (
        counted.withColumn("of", F.col("lang"))
        .rollup("of", *names)
        .agg(F.sum("c").alias("f"), level.alias("level"))
        .where((F.col("f") >= least) & (F.col("level") > 0) & F.col("of").isNotNull())
        .withColumn("words", F.slice(F.array(*names), 1, F.col("level")))
    )
    # a window that ended early has pads at its deeper levels
    return summed.where(F.element_at("words", -1) != "").select(
        F.col("of").alias("lang"), "words", "f"
    )


def _phrase(words) -> Column:
    return F.array_join(words, " ")


def floored_score(a: Column, n: Column, l: Column, r: Column) -> Column:
    """floor(1000 * a * n / (l * r)) in decimals of 38 digits, exact below 10**35 for a * n."""
    wide = [x.cast("decimal(18,0)") for x in (a, n, l, r)]
    above = F.lit(1000).cast("decimal(4,0)") * (wide[0] * wide[1])
    below = wide[2] * wide[3]
    return F.call_function("div", above, below)


def best_cuts(phrases: DataFrame, totals: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score): every candidate at its lowest-scoring cut."""
    size = F.size("words")
    parts = phrases.select("lang", _phrase("words").alias("part"), F.col("f").alias("of_part"))
    cuts = (
        phrases.where(size >= 2)
        .withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
        .select(
            "lang",
            "words",
            F.col("f").alias("a"),
            "k",
            _phrase(F.slice("words", F.lit(1), F.col("k"))).alias("head"),
            _phrase(F.slice("words", F.col("k") + 1, size - F.col("k"))).alias("tail"),
        )
    )
    heads = parts.withColumnsRenamed({"part": "head", "of_part": "l"})
    tails = parts.withColumnsRenamed({"part": "tail", "of_part": "r"})
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .join(totals, "lang")
        .withColumn("score", floored_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return (
        scored.groupBy("lang", "words")
        .agg(lowest, F.max("a").alias("a"), F.max("n").alias("n"))
        .select("lang", _phrase("words").alias("phrase"), "words", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def absorbed(phrases: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase) of the phrases inside a longer one that has ``percent`` of their count."""
    size = F.size("words")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda k: F.transform(
                F.sequence(F.lit(1), size - k + 1), lambda i: F.slice("words", i, k)
            ),
        )
    )
    inside = phrases.where(size >= 3).select(
        F.col("lang").alias("of_lang"), F.col("f").alias("longer"), F.explode(inner).alias("inner")
    )
    most = (
        inside.groupBy("of_lang", _phrase("inner").alias("of_phrase"))
        .agg(F.max("longer").alias("longer"))
    )
    own = phrases.where(size >= 2).select("lang", _phrase("words").alias("phrase"), "f")
    met = own.join(most, (F.col("lang") == F.col("of_lang")) & (F.col("phrase") == F.col("of_phrase")))
    return met.where(100 * F.col("longer") >= percent * F.col("f")).select("lang", "phrase")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    percent: int = 100,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` strongest phrases.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into
    words at blanks and tabs. A phrase of 2 to ``longest`` words that occurs a >= ``least``
    times is a candidate; its score is 1000 * a * n / (l * r), floored, for the cut into two
    phrases (l and r occurrences) that scores lowest, the first of them on a tie. Candidates
    inside a longer one with ``percent`` of their count or more are left out.

    A null text is empty, a null language is ``und``. Texts of any length, repeated rows (each
    counts) and empty tables (no rows) are allowed; no column but the two is read, so extra
    ones with any name do not matter. Ranks are unique: score, then a, both falling, then
    phrase in byte order. Two jobs run while the result is built: the bucket counts, and the
    phrases, which are written to the shared folder.
    """
    spoken = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    size = spoken.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(LEAST_BITS, min(MOST_BITS, (size // BYTES_PER_BUCKET).bit_length()))
    counted = stored(bucket_counts(spoken, bits, longest, least), "collocation-buckets")
    totals = counted.where("part = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    maps = _bitmaps(frequent_buckets(counted, least), bits, longest)
    buckets = max(LEAST_BLOCKS, 1 << (size // BLOCK_BYTES).bit_length())
    found = whole_windows(windows(spoken, maps, bits, longest, buckets), longest, least, buckets)
    phrases = stored(phrase_counts(found, longest, least), "collocation-phrases")
    kept = best_cuts(phrases, totals, longest).join(
        absorbed(phrases, percent), ["lang", "phrase"], "left_anti"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        kept.withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
