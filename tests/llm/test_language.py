"""Language model, ranked search and collocations against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from jobstrata.llm import collocations, maxent_lm, ranked_search, rows

SCHEMA = "doc_id long, text string, lang string, term string, n int, score double, w1 string, c int, word string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def corpus(seed=3, n=80):
    rng = random.Random(seed)
    common = ["of the", "New York", "in spite of", "a b c d e f", "Größe ist", "the The"]
    out = []
    for _ in range(n):
        words = [rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(60)}é" for _ in range(rng.randrange(60))]
        text = " ".join(w + rng.choice(["", "", "", ".", ", ", "\n", "\t"]) for w in words)
        out.append((text, rng.choice(["en", "de", None])))
    out += [(None, "en"), ("", None), (" .,\n ", "de"), ("x" * 700, "en"), ("one", "fr"), ("of the " * 4000, "en")]
    out += out[:5]
    return [(i * 3 - 5, *row) for i, row in enumerate(out)]


@pytest.fixture(scope="module")
def docs():
    return corpus()


def frame(spark, docs, parts=4):
    extra = [(*d, "t", 1, 0.5, "a", 2, "w") for d in docs]
    given = spark.createDataFrame(extra, SCHEMA)
    return given.coalesce(1) if parts == 1 else given.repartition(parts)


@pytest.fixture(autouse=True)
def small_slices(monkeypatch):
    """Slices of a few documents (tasks get the sizes along with the functions)."""
    monkeypatch.setattr(collocations, "SLICE_BYTES", 2000)
    monkeypatch.setattr(maxent_lm, "SLICE_BYTES", 2000)


# ---- collocations


def phrases_by_hand(docs, longest, least, top, percent=100):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            lang_ = "und" if lang is None else lang
            n[lang_] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang_][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if c >= least}
        inner = Counter()
        for p, c in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inner[p[i : i + k]] = max(inner[p[i : i + k]], c)
        kept = []
        for p, a in often.items():
            if len(p) < 2 or (p in inner and 100 * inner[p] >= percent * a):
                continue
            cuts = [(1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), a, often[p[:k]], often[p[k:]]))
        for rank, (score, _, phrase, a, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, l, r, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least,longest,top", [(3, 5, 2000), (10, 3, 7), (1, 2, 50)])
def test_collocations(spark, docs, least, longest, top):
    found = collocations.collocations(frame(spark, docs), least=least, longest=longest, top=top)
    assert sorted(map(tuple, found.collect())) == phrases_by_hand(docs, longest, least, top)


def test_collocations_of_crowded_buckets(spark, docs, monkeypatch):
    """Tables too small to tell words apart only cut less."""
    monkeypatch.setattr(collocations, "LEAST_BITS", 2)
    monkeypatch.setattr(collocations, "MOST_BITS", 2)
    found = collocations.collocations(frame(spark, docs), least=4)
    assert sorted(map(tuple, found.collect())) == phrases_by_hand(docs, 5, 4, 2000)


def test_collocations_partly_absorbed(spark, docs):
    found = collocations.collocations(frame(spark, docs), least=3, percent=60)
    assert sorted(map(tuple, found.collect())) == phrases_by_hand(docs, 5, 3, 2000, 60)


def test_windows_are_merged_before_rows(spark, monkeypatch):
    """One row for each window that is a frequent phrase, although slices and tasks all have it
    and the tables of buckets cut nothing."""
    monkeypatch.setattr(collocations, "SLICE_BYTES", 40)
    docs = [(i, f"a b c d e. a b c d x{i} y{i}", "en") for i in range(60)]
    spoken = frame(spark, docs).select("lang", "text")
    maps = np.full((5, 2), 255, np.uint8)
    sent = collocations.windows(spoken, maps, 4, 5, 8)
    made = collocations.whole_windows(sent, 5, 50, 8).collect()
    phrases = ["a b c d e", "b c d e", "c d e", "d e", "e", "a b c d", "b c d", "c d", "d"]
    padded = [(p.split() + [""] * 5)[:5] for p in phrases]
    assert sorted(map(tuple, made)) == sorted(("en", *p, 60) for p in padded)


@pytest.mark.parametrize("held", [1, 7, 1 << 20])
def test_collocations_in_small_merges(spark, docs, monkeypatch, held):
    monkeypatch.setattr(collocations, "HELD", held)
    given = [*docs, *((i, "of the a b c d e", "") for i in range(3))]
    found = collocations.collocations(frame(spark, given), least=3)
    assert sorted(map(tuple, found.collect())) == phrases_by_hand(given, 5, 3, 2000)


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, n, l, r = 10**14 + 7, 10**17 + 1, 10**15 + 9, 10**14 + 31
    row = spark.range(1).select(
        collocations.floored_score(*(F.lit(x).cast("long") for x in (a, n, l, r))).alias("s")
    )
    assert row.first()["s"] == 1000 * a * n // (l * r)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations.collocations(frame(spark, [(1, None, None), (None, "", "en")])).count() == 0


# ---- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked_by_hand(docs, items, k=10):
    bags = [(i, Counter(TERM.findall(lower(t)))) for i, t, *_ in docs]
    n_docs = sum(bool(b) for _, b in bags)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        scores = []
        for doc, bag in bags:
            n, score = sum(bag.values()), 0
            for t in set(TERM.findall(lower(text))) & set(bag):
                m = 100 - 90 + (90 * n * n_docs) // total
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, doc, -score) for r, (score, _, doc) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def items_of(docs):
    texts = [" ".join(t.split()[:n]) for (_, t, _), n in zip(docs[:40], range(1, 41)) if t]
    return [*enumerate(texts), (900, "nothing-here zzz"), (901, None), (902, ""), (7, texts[7]), (3, "of the w1é")]


def asked(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("turn_bytes,block", [(1 << 20, 1 << 20), (300, 40)])
def test_ranked_search(spark, docs, monkeypatch, turn_bytes, block):
    monkeypatch.setattr(ranked_search, "TURN_BYTES", turn_bytes)
    monkeypatch.setattr(ranked_search, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(ranked_search, "FIRST_READ", 2)
    given = [*docs, (None, "of the w1é", "en")]
    found = ranked_search.ranked(frame(spark, given), asked(spark, items_of(docs)))
    assert sorted(map(tuple, found.collect()), key=str) == ranked_by_hand(given, items_of(docs))


def test_search_stops_early_and_strictly():
    """Ties at the k-th score are settled by id although the bound has reached it."""
    n = 5000
    weights = np.array([1000, 10])
    own = np.zeros(n, ranked_search.POSTING)
    own["tf"] = 1
    block = ranked_search.Block(np.full(n, 1), np.ones(n, np.int64), own, weights, n, n)
    ids = np.arange(n)[::-1].copy()
    top, _ = block.best(np.array([0, 1]), 10, ids)
    assert ids[top].tolist() == list(range(10))
    # one document stands out: few positions of the common list are read
    own = np.zeros(n + 10, ranked_search.POSTING)
    own["tf"] = 1
    own["tf"][:10] = 50
    lengths = np.full(n + 10, 1)
    block = ranked_search.Block(lengths, np.ones(n + 10, np.int64), own, weights, n, n)
    reads = []
    plain = np.searchsorted
    ranked_search.np.searchsorted, old = (lambda *a, **b: reads.append(len(a[1])) or plain(*a, **b)), plain
    try:
        block.best(np.array([0]), 10, np.arange(n + 10))
    finally:
        ranked_search.np.searchsorted = old
    assert sum(reads) < 100


def test_ranked_search_of_nothing(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert ranked_search.ranked(frame(spark, docs), empty).count() == 0
    items = asked(spark, items_of(docs))
    assert ranked_search.ranked(spark.createDataFrame([], SCHEMA), items).count() == 0


# ---- language model


def fold(doc):
    return 0 if doc is None else zlib.crc32(str(doc).encode()) % 7


def lm_by_hand(docs):
    tokens = [(i, [*WORD.findall(lower(t)), ""]) for i, t, *_ in docs]
    counts = Counter(w for i, ws in tokens if fold(i) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {
        (i, len(ws), sum(counts[w] > 0 for w in ws)): sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        for i, ws in tokens
    }, n


def test_language_model_counts(spark, docs):
    given = [*docs, (None, "of the never seen", "en")]
    found = maxent_lm.scored(frame(spark, given)).collect()
    want, n = lm_by_hand(given)
    assert len(found) == len(given)
    for r in found:
        assert r["train_tokens"] == n and r["held_out"] == (fold(r["doc_id"]) == 2)
        assert math.isclose(want[r["doc_id"], r["n_tokens"], r["n_known"]], r["base_score"], rel_tol=1e-9)
        assert r["score"] < 0
    held = [r for r in found if r["held_out"]]
    assert len(held) > 5
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_words_beyond_the_heads_are_all_there(spark, docs, monkeypatch):
    """The most frequent words get cells of their own; every other one has a shared cell and its
    exact count, and a shared cell's words and its unseen one add up to 1."""
    monkeypatch.setattr(maxent_lm, "HEADS", 5)
    given = frame(spark, docs).selectExpr("doc_id", "false AS held_out", "coalesce(text, '') AS text")
    words = maxent_lm.word_table(maxent_lm.numbered(given))
    found = {r["word"]: r for r in words.collect()}
    counts = Counter(w for _, t, *_ in docs for w in [*WORD.findall(lower(t)), ""])
    assert words.count() == len(counts) and {w: r["c"] for w, r in found.items()} == counts
    heads = sorted(counts, key=lambda w: (-counts[w], w))[:5]
    assert [found[w]["cell"] for w in heads] == [0, 1, 2, 3, 4]
    known = maxent_lm.vocabulary(words)
    assert known.tokens == sum(counts.values()) and known.words == len(counts)
    shares = Counter()
    for w, r in found.items():
        assert w in heads or 5 <= r["cell"] < maxent_lm.CELLS
        size = known.cell_tokens[r["cell"]] + known.cell_words[r["cell"]] + 1
        shares[r["cell"]] += (r["c"] + 1) / size
    assert all(math.isclose(p + 1 / (known.cell_tokens[c] + known.cell_words[c] + 1), 1) for c, p in shares.items())


def test_held_out_texts_change_nothing(spark, docs):
    """Other words in the held-out fold leave all other scores as they were."""
    changed = [(i, t if fold(i) != 2 else "secret words " * 50, lang) for i, t, lang in docs]
    one, two = (
        {r["doc_id"]: r for r in maxent_lm.scored(frame(spark, d, 1)).collect()} for d in (docs, changed)
    )
    for i, r in one.items():
        if not r["held_out"]:
            assert math.isclose(r["score"], two[i]["score"], rel_tol=1e-6)
            assert r["base_score"] == two[i]["base_score"]


def test_language_model_of_nothing(spark):
    assert maxent_lm.scored(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(100) if fold(i) == 2)
    row = maxent_lm.scored(frame(spark, [(held, "a b", "en")])).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (True, 3, 0, 0)
    assert math.isclose(row["base_score"], 0.0, abs_tol=1e-12) and row["score"] < 0


def trained(seed=1, n=30):
    rng = np.random.default_rng(seed)
    cells = rng.integers(0, maxent_lm.CELLS, 2000)
    cells[1::2] = (cells[::2][: len(cells[1::2])] * 7) % maxent_lm.CELLS
    known = maxent_lm.Vocabulary(
        2000, 900, np.bincount(cells, minlength=maxent_lm.CELLS), np.ones(maxent_lm.CELLS, np.int64)
    )
    starts = np.arange(0, 2000, 50)
    trainer = maxent_lm.Trainer(maxent_lm.Model.from_counts(known))
    for _ in range(n):
        trainer.learn(maxent_lm.followed(cells, starts))
    return trainer, cells, starts


def test_cells_have_probabilities():
    """After any history the cells' probabilities add up to 1."""
    trainer, cells, _ = trained()
    history = cells[:3]
    every = np.arange(maxent_lm.CELLS)
    total = 0.0
    for cell in every:
        own = np.append(history, cell)
        total += math.exp(maxent_lm.cell_scores(trainer.model, own, np.array([0]))[-1])
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_training_learns_what_follows():
    trainer, cells, starts = trained()
    before = maxent_lm.cell_scores(maxent_lm._copy(trainer.model), cells, starts)
    plain = maxent_lm.Model()
    plain.class_bias, plain.slot_bias = trainer.model.class_bias, trainer.model.slot_bias
    assert before[1::2].mean() > maxent_lm.cell_scores(plain, cells, starts)[1::2].mean() + 1


def test_gradient_by_differences():
    """A step's direction is the gradient of the log probability, over classes and slots."""
    cells = np.array([5, 40, 5, 40, 700, 5, 40])
    starts = np.array([0, 4])
    known = maxent_lm.Vocabulary(7, 3, np.bincount(cells, minlength=1024), np.ones(1024, np.int64))
    model = maxent_lm.Model.from_counts(known)
    pairs = maxent_lm.pairs_before(cells, starts)
    trainer = maxent_lm.Trainer(maxent_lm._copy(model))
    trainer.learn(maxent_lm.followed(cells, starts))
    of_class = int(maxent_lm.class_rows(pairs)[0, 1])
    of_slot = int(maxent_lm.slot_rows(pairs, cells // maxent_lm.SLOTS)[2, 1])
    for name, row, sums in (("classes", of_class, trainer.sums[0]), ("slots", of_slot, trainer.sums[1])):
        moved = getattr(trainer.model, name)[row] - getattr(model, name)[row]
        for place in (0, 1, 2, 8):
            up = maxent_lm._copy(model)
            getattr(up, name)[row, place] += 1e-2
            slope = maxent_lm.cell_scores(up, cells, starts).sum() - maxent_lm.cell_scores(model, cells, starts).sum()
            gradient = moved[place] * np.sqrt(sums[row]) / maxent_lm.RATE
            assert math.isclose(slope / 1e-2, gradient, rel_tol=0.05, abs_tol=1e-2)


def test_scores_by_plain_softmax():
    """Sorted, shared contexts give each token the score of a softmax of its own."""
    trainer, cells, starts = trained(n=3)
    model = trainer.model
    found = maxent_lm.cell_scores(model, cells, starts)
    pairs = maxent_lm.pairs_before(cells, starts)
    classes, slots = cells // maxent_lm.SLOTS, cells % maxent_lm.SLOTS
    first, second = maxent_lm.class_rows(pairs), maxent_lm.slot_rows(pairs, classes)
    for i in (0, 1, 2, 49, 50, 51, 1999):
        z = model.class_bias + sum(model.classes[r] for r in first[:, i])
        y = model.slot_bias[classes[i]] + sum(model.slots[r] for r in second[:, i])
        want = z[classes[i]] - np.log(np.exp(z).sum()) + y[slots[i]] - np.log(np.exp(y).sum())
        assert math.isclose(found[i], want, rel_tol=1e-4)


def test_pairs_stay_in_their_document():
    cells = np.array([1, 2, 3, 1, 2, 3, 4])
    one = maxent_lm.pairs_before(cells, np.array([0, 3]))
    assert np.array_equal(one[:3], one[3:6])
    assert maxent_lm.pairs_before(cells, np.array([0]))[3] != one[3]
    assert len(set(one.tolist())) == 4


# ---- token files


def test_token_files_are_read_back_a_file_a_task(spark, tmp_path):
    from jobstrata.llm import token_files
    from jobstrata.llm.queries_text import tokenizer_path

    docs = spark.range(400).selectExpr("id AS doc_id", "repeat(concat('word ', id, ' '), 20) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_token_files(docs, tmp_path.as_uri(), tokenizer_path())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = manifest.count()
    assert files > 4
    read = token_files.read_token_files(manifest, tmp_path.as_uri())
    assert read.rdd.getNumPartitions() == files
    tasks = read.groupBy("part").agg({"doc_id": "count"}).collect()
    assert len(tasks) == files and sum(r[1] for r in tasks) == 400


def test_kept_pieces_are_bounded(monkeypatch):
    import pyarrow as pa

    from jobstrata.llm import token_files
    from jobstrata.llm.queries_text import tokenizer_path

    monkeypatch.setattr(token_files, "KEPT_BYTES", 20_000)
    encode = token_files.Encoder(tokenizer_path())
    texts = [" ".join(f"w{i}x{j}" for j in range(200)) for i in range(20)]
    ids, counts = encode(pa.array(texts, pa.large_string()))
    assert len(encode.young) + len(encode.old) < 220
    want = encode.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert counts.tolist() == [len(e.ids) for e in want]
    assert ids.tolist() == [i for e in want for i in e.ids]
