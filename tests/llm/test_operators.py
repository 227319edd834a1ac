"""The corpus operators against brute force, on hand-made edge rows and small slices."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from jobstrata.llm import (
    components,
    decontaminate,
    exact_copies,
    jaccard_join,
    mixing,
    ordinal_quality,
    repeated_windows,
    rows,
    suffix_dedup,
    token_files,
    toxicity,
    url_lists,
)
from jobstrata.llm.queries_native import TARGETS
from jobstrata.llm.queries_text import tokenizer_path
from jobstrata.llm.storage import shared_folder

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n int, h string, doc string, found string, hit_words int"


def words_of(rng, n, size=40):
    return " ".join(f"w{rng.randrange(size)}é" if rng.random() < 0.1 else f"W{rng.randrange(size)}" for _ in range(n))


def corpus(seed=7, n=60):
    """Copies, near copies, shared passages, a long text, nulls, blanks, signs."""
    rng = random.Random(seed)
    base = [words_of(rng, rng.randrange(1, 120), 4000) for _ in range(n)]
    passage = words_of(rng, 60, 4000)
    out = list(base)
    for t in base[:20]:
        w = t.split()
        out.append(t)
        for _ in range(3):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            out.append("\t".join(v))
        out.append(f"{t} {passage}\n{t}")
    out += [passage, f"x {passage}", "abc " * 300, "a" * 700, words_of(rng, 5000, 4000)]
    out += [None, "", " \n\t ", "one", "two words", "a  b", "x\n y", "<|endoftext|> it's 'll", "中文 “q” a\x01 b"]
    rng.shuffle(out)
    return [(i * 3 - 5, t) for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    return corpus()


def frame(spark, docs):
    """The rows with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, 1, "h", "d", "f", 3) for i, t in docs], SCHEMA).repartition(5)


def got(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.fixture(autouse=True)
def small_slices(monkeypatch):
    """Slices of a few documents, so that every operator crosses slice borders."""
    plain = rows.slices
    monkeypatch.setattr(rows, "slices", lambda b, c, size=0: plain(b, c, 3000))


def test_slices_keep_words_apart():
    import pyarrow as pa

    texts = [t for _, t in corpus()]
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    found = []
    for part in rows.slices([batch], "text", 2000):
        flat, counts = rows.split_words(rows.lower_ascii(rows.texts(part)))
        assert counts.sum() == len(flat)
        found += flat.to_pylist()
    lower = str.maketrans({c: c + 32 for c in range(65, 91)})
    assert found == [w for t in texts for w in BLANK.findall((t or "").translate(lower))]


def test_window_hashes_and_anchors():
    rng = np.random.default_rng(1)
    units = rows.stirred(rng.integers(1, 5, 500).astype(np.uint64))
    for width in (1, 2, 3, 7, 20):
        h = rows.window_hashes(units, width)
        seen = {}
        for i in range(len(units) - width + 1):
            assert seen.setdefault(units[i : i + width].tobytes(), h[i]) == h[i]
        assert len(set(seen.values())) == len(seen)
    level = rows.stirred(rows.window_hashes(units, 3))
    ok = rows.inside(np.array([100, 0, 390, 10]), 9)
    low, marked = rows.anchors(level, ok, 7)
    want = set()
    for p in np.flatnonzero(ok):
        assert low[p] == level[p : p + 7].min()
        want |= {p + i for i in range(7) if level[p + i] == low[p]}
    assert set(np.flatnonzero(marked)) == want


def test_repeated_windows(spark, docs):
    seen, want = set(), {}
    for i, t in sorted(docs):
        w = BLANK.findall(t or "")
        gone = [0] * len(w)
        for p in range(len(w) - 19):
            key = tuple(w[p : p + 20])
            if key in seen:
                gone[p : p + 20] = [1] * 20
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    out = ("n_words", "n_removed", "kept_sha256", "kept_text")
    assert sum(x[1] for x in want.values()) > 500
    assert got(repeated_windows.without_repeated_windows(frame(spark, docs)), *out) == want
    three = repeated_windows.without_repeated_windows(frame(spark, docs), first=5)
    assert got(three, *out) == want


def test_repeated_bytes(spark, docs):
    for length in (200, 60):
        seen = Counter(
            b[p : p + length] for _, t in docs for b in [(t or "").encode()] for p in range(len(b) - length + 1)
        )
        want = {}
        for i, t in docs:
            b = (t or "").encode()
            gone = bytearray(len(b))
            for p in range(len(b) - length + 1):
                if seen[b[p : p + length]] > 1:
                    gone[p : p + length] = b"\1" * length
            kept = bytes(x for x, g in zip(b, gone) if not g)
            runs = len(re.findall(b"\1+", bytes(gone)))
            want[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
        found = suffix_dedup.without_repeated_bytes(frame(spark, docs), length=length)
        assert got(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_blind_trie_orders_suffixes():
    rng = random.Random(3)
    strings = list({bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(300)})
    nodes = list(suffix_dedup.BlindTrie(strings).nodes())
    depth, order = nodes[-1]
    assert [strings[i] for i in order] == sorted(strings)
    for depth, leaves in nodes:
        assert len({strings[i][:depth] for i in leaves}) == 1
        assert len({strings[i][: depth + 1] for i in leaves}) > 1


def lowered(text):
    return BLANK.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def groups(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = lowered(t)
        grams = {tuple(w[p : p + width]) for p in range(len(w) - width + 1)}
        sets[i] = grams or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("width,percent,block", [(4, 85, 4096), (5, 80, 4096), (2, 60, 3)])
def test_jaccard_groups(spark, docs, monkeypatch, width, percent, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", block)
    want = groups(docs, width, percent)
    assert sum(c != i for i, (_, c) in want.items()) > 20
    found = jaccard_join.jaccard_groups(frame(spark, docs), width=width, percent=percent)
    assert got(found, "n_shingles", "component_id") == want
    kept = jaccard_join.one_of_each_group(frame(spark, docs), width=width, percent=percent)
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()}
    assert kept.columns == frame(spark, docs).columns


def test_a_chain_of_near_copies_is_one_component(spark):
    """Neighbours are linked, ends are not, and no member is close to all."""
    words = [f"c{i}" for i in range(120)]
    docs = [(i, " ".join([*(f"n{j}" for j in range(i)), *words[i:]])) for i in range(0, 40, 2)]
    want = groups(docs, 4, 85)
    assert {c for _, c in want.values()} == {0}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(jaccard_join.jaccard_groups(df), "n_shingles", "component_id") == want


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 97])
def test_linked_sets_share_the_keys_they_need(percent):
    """In a common group of lists, whatever differs; sets with empty parts only share a shingle."""
    rng = np.random.default_rng(percent)
    weak = 0
    for n in [2, 3, 7, 12, 13, 25, 40, 41, 99, 300, 1200] * 4:
        common = -(-percent * n // 100)
        more = rng.integers(0, n - common + 1)
        hashes = rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)
        x, y = np.sort(hashes[: common + more]), np.sort(np.delete(hashes, slice(common, common + more)))
        counts = np.array([len(x), len(y)])
        seen = [{}, {}]
        for keys, own, need, group in jaccard_join.part_keys(np.concatenate([x, y]), counts, percent):
            for k, o, d, g in zip(keys.tolist(), own.tolist(), need.tolist(), group.tolist()):
                seen[o].setdefault(g, (d, set()))[1].add(k)
        both = [(max(1, *(s[g][0] for s in seen)), seen[0][g][1] & seen[1][g][1]) for g in seen[0] if g in seen[1]]
        assert both and any(len(shared) >= need for need, shared in both)
        weak += max(need for need, _ in both) == 1
    assert weak


def test_sharing_with_many_sets_is_not_sharing_with_one(spark, monkeypatch):
    """Texts of common passages: every shingle is shared, no text with one other meets it."""
    rng = random.Random(3)
    passages = [words_of(rng, 40, 4000) for _ in range(60)]
    docs = [(i, " ".join(rng.sample(passages, 8))) for i in range(0, 160, 2)]
    docs += [(2 * i + 1, f"{docs[i][1]} end") for i in range(0, 80, 10)]
    kept = []
    keep = jaccard_join.checkpointed
    monkeypatch.setattr(jaccard_join, "checkpointed", lambda df: kept.append(keep(df)) or kept[-1])
    found = got(jaccard_join.jaccard_groups(frame(spark, docs)), "n_shingles", "component_id")
    assert found == groups(docs, 4, 85)
    met = {(r.hub, r.doc) for df in kept if df.columns == ["hub", "doc"] for r in df.collect()}
    assert met == {(2 * i, d) for i in range(0, 80, 10) for d in (2 * i, 2 * i + 1)}


def test_a_large_group_of_copies_of_copies_has_few_hubs(spark, monkeypatch):
    """Each set meets the others at a few places, whichever parts it shares with whom."""
    rng = random.Random(11)
    words = words_of(rng, 300, 4000).split()
    docs = []
    for i in range(150):
        own = list(words)
        for at in rng.sample(range(300), rng.randrange(1, 20)):
            own[at] = f"n{i}x{at}"
        docs.append((i, " ".join(own)))
    kept = []
    keep = jaccard_join.checkpointed
    monkeypatch.setattr(jaccard_join, "checkpointed", lambda df: kept.append(keep(df)) or kept[-1])
    found = got(jaccard_join.jaccard_groups(frame(spark, docs)), "n_shingles", "component_id")
    want = groups(docs, 4, 85)
    assert found == want and 1 < len({c for _, c in want.values()}) < 150
    assert sum(df.count() for df in kept if df.columns == ["hub", "doc"]) <= 2 * len(docs)


def test_light_boundary_follows_cost():
    assert jaccard_join.light_boundary({}) == 0
    at = jaccard_join.light_boundary({n: 10 for n in range(7, 97)})
    assert 0 < at < jaccard_join.LARGEST_LIGHT


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 50)] + [(100, 100), (7, 3)]
    edges += [(200, 200 + rng.randrange(1, 50)) for _ in range(60)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert all(roots[i] == 0 for i in range(1, 51))
    assert {v for k, v in roots.items() if k > 199} == {200}


def test_exact_copies(spark, docs):
    more = docs + [(900, "W1  w2"), (901, "W1 w2"), (902, "W1w2"), (None, "W1w2 \n "), (903, "z"), (903, "z")]
    plain = [(i, t or "", re.sub(r"[\x20\x09-\x0D]", "", t or "")) for i, t in more]
    want = Counter()
    for i, t, p in plain:
        same = [(-len(u), j is None, j) for j, u, q in plain if q == p]
        best = min(same, key=lambda x: x[:2] + ((x[2],) if x[2] is not None else (0,)))
        keep = best[2]
        want[i, keep, len(same), i == keep, hashlib.sha256(p.encode()).hexdigest()] += 1
    for all_ in (True, False):
        found = exact_copies.exact_copies(frame(spark, more), digest_all=all_).collect()
        out = Counter(
            (r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256 or "") for r in found
        )
        if all_:
            assert out == want
        else:
            assert {k[:4] for k in out} == {k[:4] for k in want}


def test_decontaminate(spark, docs):
    bench = [(1, docs[3][1]), (2, "W1 w2"), (3, None), (4, ""), (5, "W1, w2!"), (None, "zzz"), (6, words_of(random.Random(9), 30, 4000))]
    docs = docs + [(800, f"zzz {bench[-1][1].upper()} tail"), (801, "alpha. w1-W2; beta " + "pad " * 60)]
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {}
    for i, t in bench:
        w = find(t)
        k = min(13, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[p : p + k]), set()).add("" if i is None else str(i))
    want = {}
    for i, t in docs:
        w = find(t)
        hit, items = [0] * len(w), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if found := windows.get(tuple(w[p : p + k])):
                    items |= found
                    hit[p : p + k] = [1] * k
        n = sum(hit)
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        want[i] = (len(w), n, sha, n > 0 and 20 * n >= len(w))
    bench_df = spark.createDataFrame(bench, "item_id long, text string")
    for size in (32 << 20, 200):  # the second cuts the benchmark into several broadcasts
        decontaminate.BROADCAST_BYTES, old = size, decontaminate.BROADCAST_BYTES
        try:
            found = decontaminate.judged(decontaminate.scanned(frame(spark, docs), bench_df))
            assert got(found, "hit_words", "n_hit", "items_sha256", "contaminated") == want
        finally:
            decontaminate.BROADCAST_BYTES = old
    clean = decontaminate.without_contaminated(frame(spark, docs), bench_df)
    assert {r.doc_id for r in clean.collect()} == {i for i, x in want.items() if not x[3]}
    assert clean.columns == frame(spark, docs).columns
    cut = got(decontaminate.without_hit_spans(frame(spark, docs), bench_df), "text")
    assert cut[801][0].startswith("alpha. ; beta")


def test_token_files(spark, docs):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(tokenizer_path())
    docs = docs + [(-100, "first"), (5, "again"), (5, "again")]
    folder = shared_folder(spark, "test-tokens")
    manifest = token_files.write_token_files(
        frame(spark, docs), folder, tokenizer_path(), sequence=16, in_batch=4
    )
    found = token_files.read_token_files(manifest, folder).collect()
    start, want, every = 0, Counter(), []
    for i, t in sorted(docs, key=lambda d: (d[0], d[1] is not None, d[1] or "")):
        ids = [*known.encode(t or "", add_special_tokens=False).ids, 2]
        want[i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
        every.append(ids)
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == want
    flat = [x for ids in every for x in ids]
    first = min(r.part for r in manifest.collect())
    ids, mask = token_files.read_sequence(folder, first, 5)
    assert ids.tolist() == flat[80:96] and mask.all() and len(ids) == 16


def test_timetable_keeps_sources_within_a_block():
    for weights in (TARGETS, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 1}, {"a": 0.998, "b": 1e-9}):
        parts = mixing.whole_parts(weights)
        total = sum(parts.values())
        assert total == mixing.PARTS
        done = Counter()
        for t, s in enumerate(mixing.timetable(parts), 1):
            done[s] += 1
            assert all(abs(t * p - done[x] * total) < total for x, p in parts.items())
        assert done == parts
    assert mixing.timetable(mixing.whole_parts({})) == []


def test_mixing_keeps_all_rows(spark):
    data = [(i, "ab"[i % 3 == 0]) for i in range(900)] + [(None, "a"), (1, "a"), (5, None), (6, "zz")]
    df = spark.createDataFrame(data, "doc_id long, source string")
    out = mixing.mixed(df, {"a": 0.75, "b": 0.25, "none": 0.1}, block=4).collect()
    assert Counter((r.doc_id, r.source) for r in out) == Counter(data)
    places = [(r.mix_slot, r.mix_place) for r in out if r.source in ("a", "b")]
    assert len(set(places)) == len(places)
    assert all(r.mix_slot is None for r in out if r.source in (None, "zz"))
    blocks = sorted({(r.mix_slot, r.source) for r in out if r.source in ("a", "b")})
    share = sum(s == "a" for _, s in blocks[:100]) / 100
    assert abs(share - 0.75) < 0.03


def test_url_lists(spark):
    log = [
        ("block", "bad.com", "add", 10),
        ("block", "bad.com", "remove", 20),
        ("block", "bad.com", "add", 30),
        ("allow", "ok.bad.com", "add", 15),
        ("block", "x.org", "add", 5),
        ("block", "x.org", "remove", 5),
        ("block", None, "add", 1),
        ("block", "y.net", "add", 7),
        ("block", "y.net", "add", 7),
    ]
    entries = spark.createDataFrame(log, "list string, entry string, action string, at int")
    asked = [
        (1, "http://bad.com/", 9, "pass"),
        (2, "http://a.BAD.com:80/x", 10, "block"),
        (3, "https://u:p@bad.com?q", 20, "pass"),
        (4, "http://bad.com#f", 99, "block"),
        (5, "http://ok.bad.com", 16, "allow"),
        (6, "http://deep.ok.bad.com", 12, "block"),
        (7, "http://x.org", 6, "pass"),
        (8, None, 6, "pass"),
        (9, "http://bad.com", None, "pass"),
        (10, "notbad.com", 12, "pass"),
        (11, "http://notbad.com", 12, "pass"),
        (12, "http://y.net", 8, "block"),
    ]
    df = spark.createDataFrame([(*a, "v") for a in asked], "page_id long, url string, fetched int, want string, verdict string")
    out = {r.page_id: r.verdict for r in url_lists.judged(df, entries).collect()}
    assert out == {a[0]: a[3] for a in asked}
    assert url_lists.judged(df.limit(0), entries).count() == 0
    assert {r.verdict for r in url_lists.judged(df, entries.limit(0)).collect()} == {"pass"}


def test_captures_of_one_key_and_host_stay_apart(spark):
    """Brute force: the distinct (key, URL, time) rows, each with its host."""
    entries = spark.createDataFrame([("block", "bad.com", "add", 0)], "list string, entry string, action string, at int")
    rows = [(1, "http://bad.com/a", 5), (1, "http://bad.com/b", 5), (1, "http://bad.com/b", 5), (1, "http://bad.com/b", 6)]
    rows += [(None, f"http://x.org/{i % 3}", None) for i in range(6)] + [(None, "http://bad.com/", 5), (2, None, 5), (2, "", 5)]
    hosts = {True: ("bad.com", "block"), False: ("x.org", "pass")}
    want = Counter((k, at, *(hosts["bad.com" in u] if u else ("", "pass"))) for k, u, at in set(rows))
    df = spark.createDataFrame(rows, "page_id long, url string, fetched int")
    out = url_lists.judged(df, entries).collect()
    assert Counter((r.page_id, r.fetched, r.host, r.verdict) for r in out) == want


def test_folding_and_exceptions():
    assert toxicity.folded("An 1D10T, ｗｏrthless! 2020") == " an idiot worthiess  2020 ".replace("  2020", "")
    lexicon = toxicity.Lexicon({" scum ": 2.0, " vequ": 1.5}, {"pond scum"})
    auto = lexicon.automaton()
    count = lambda t: toxicity.density(auto, toxicity.folded(t))[2]
    assert [count(t) for t in ("scum", "pond scum", "$cum vequlle", "discum", "", "pond. ѕсum scum")] == [1, 0, 2, 0, 0, 1]


def test_toxicity_and_quality_learn(spark):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(600):
        bad, poor = i % 5 == 0, i % 7 == 0
        text = words_of(rng, 40, 300) if not poor else "### !! " * rng.randrange(10, 40)
        if bad:
            text = f"{text} gr0tty {words_of(rng, 5, 300)} " + rng.choice(["grotty", "blastrix", "blastron"])
        docs.append((i, text))
        labels.append((i, 0 if poor else 1, int(bad)))
    docs += [(1000, None), (1001, ""), (1002, "grotty " * 20000)]
    d = frame(spark, docs)
    table = spark.createDataFrame([*labels, (1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learned(d, table)
    found = got(toxicity.scored(d, lexicon), "score", "predicted")
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i][1] == int(i % 5 == 0) for i in held)
    assert found[1000] == found[1001] and found[1001][1] == 0 and found[1002][1] == 1
    kept = toxicity.without_toxic(d, lexicon)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, x in found.items() if not x[1]}
    empty = toxicity.learned(d, table.limit(0))
    assert all(0 <= s < 1 for s, _ in got(toxicity.scored(d, empty), "score", "predicted").values())

    model = ordinal_quality.fitted(d, table, "quality", 2)
    graded = got(ordinal_quality.graded(d, model), "kept", "tail_probability")
    assert sum(graded[i][0] == (i % 7 != 0) for i in held) >= 0.95 * len(held)
    flat = ordinal_quality.fitted(d, table.limit(0), "quality", 2)
    assert set(got(ordinal_quality.graded(d, flat), "tail_probability").values()) == {(0.5,)}


def test_ordered_thresholds_rank_three_grades(spark):
    rng = random.Random(2)
    text = {0: "!!! ??? ", 1: "plain words ! ", 2: "calm careful prose "}
    docs = [(i, text[i % 3] * rng.randrange(5, 30)) for i in range(300)]
    table = spark.createDataFrame([(i, i % 3) for i, _ in docs] + [(3, 9)], "doc_id long, grade int")
    model = ordinal_quality.fitted(frame(spark, docs), table, "grade", 3)
    assert model.thresholds[0] <= model.thresholds[1]
    found = got(ordinal_quality.graded(frame(spark, docs), model), "expected_grade")
    means = [np.mean([found[i][0] for i, _ in docs if i % 3 == g]) for g in range(3)]
    assert means[0] + 0.3 < means[1] and means[1] + 0.3 < means[2]


def test_empty_repeated_and_null_keys(spark):
    nothing = frame(spark, []).limit(0)
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder = shared_folder(spark, "test-none")
    manifest = token_files.write_token_files(nothing, folder, tokenizer_path())
    for df in (
        repeated_windows.without_repeated_windows(nothing),
        suffix_dedup.without_repeated_bytes(nothing),
        jaccard_join.jaccard_groups(nothing),
        exact_copies.exact_copies(nothing),
        decontaminate.judged(decontaminate.scanned(nothing, bench.limit(0))),
        mixing.mixed(nothing.withColumnRenamed("h", "source"), {"a": 1}),
        token_files.read_token_files(manifest, folder),
        toxicity.scored(nothing, toxicity.learned(nothing, labels)),
    ):
        assert df.count() == 0
    long = words_of(random.Random(1), 60, 4000)
    twice = frame(spark, [(1, long), (1, long), (1, "A"), (2, long), (None, long), (None, None)])
    assert got(jaccard_join.jaccard_groups(twice), "component_id") == {1: (1,), 2: (1,)}
    assert got(repeated_windows.without_repeated_windows(twice), "n_removed") == {1: (0,), 2: (60,)}
    size = len(long.encode())
    assert got(suffix_dedup.without_repeated_bytes(twice), "n_removed") == {1: (size,), 2: (size,)}
