"""N-gram Jaccard join by size: subsets for light sets, inverted lists for heavy ones.

Documents are sets of word shingles; two are linked at a Jaccard similarity of
``percent`` / 100 or more. Documents with equal sets form one class, and the join runs
between classes.

* Shingles are ordered, frequent ones last. A set of n shingles whose link needs an overlap
  of o shares a shingle with its partner within the first n - o + 1 (the prefix), and two
  within the first n - o + 2.
* Light sets enumerate all two-element subsets of the longer prefix: few, and rarely
  shared by chance. Heavy sets go into inverted lists; light sets large enough to have a
  heavy partner do both. The boundary has the least keys.
* A list of one shingle would hold all sets that have it by chance, and in a large corpus
  every long text shares many. So a list is of the sets that are equal in a part of all
  shingles: the hashes are dealt into some more parts than linked sets of about one size can
  have differences, and so linked sets share as many parts as were added. Parts without
  shingles are no keys and count as not shared; a set with too many of these also puts the
  shingles of its prefix into lists, as does any partner with which it has only such parts.
* Two sets that share half as many keys as they need in lists of few sets meet as a pair.
  Others need the rest in lists of more sets. There all sets that share a key meet at the
  key's hub, and no pairs are listed. A list's first hub is its member with the most shared
  keys; then the list moves to the hub that the most sets would have of those that its members
  have most often, so that a large group of copies of copies has few hubs.
* Each member is written once for each of its hubs, as
  its difference from the hub. In a hub's block, members close to the hub are linked to it;
  the others are tried against the block through lists of the differences, exactly, since
  |x ^ y| = |(x ^ hub) ^ (y ^ hub)|. A block gives a spanning forest of its links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.llm import rows
from jobstrata.llm.components import components
from jobstrata.llm.storage import checkpointed

SHINGLE = 4
PERCENT = 85
#: a shingle is frequent when this share of the documents has it; this bounds their number by
#: the share's inverse times the mean set size, whatever the number of documents
FREQUENT_SHARE = 1 / 1000
SEEN_IN_SLICE = 4
LARGEST_LIGHT = 96
#: parts beyond the differences of linked sets, in percent of these; as many must be shared
SPARE = 20
#: members of a list up to which its pairs are counted
FEW = 4
#: what a key's place has beside the document: the list group (0 for subsets) and the need
GROUP_BITS, MOST_NEED = 11, 1 << 19
#: a bucket of keys has 2^this as much text as one of other strings, so that rows stay long
WIDER_BITS = 3
BLOCK_MEMBERS = 4096
PROFILE_BYTES = 8 << 20
#: text that is split into words at a time, and keys a task holds before it sends them
STEP_BYTES = 2 << 20
KEY_BYTES = 16 << 20


def needed_overlap(n: int, percent: int = PERCENT) -> int:
    """The least overlap of a set of n elements with any partner."""
    return -(-percent * n // 100)


def list_prefix(n, percent: int = PERCENT):
    """How many shingles of a set (or an array of sizes) hold one of any partner's first ones."""
    return n - needed_overlap(n, percent) + 1


def size_classes(largest: int, percent: int = PERCENT) -> np.ndarray:
    """The least size of every class up to that of ``largest`` and of two more. Partners of a
    class's sets are in the class or in one beside it."""
    least = [1]
    while least[-1] <= largest:
        least.append(100 * least[-1] // percent + 1)
    return np.array([*least, 100 * least[-1] // percent + 1], np.int64)


def parts_of(group: np.ndarray, classes: np.ndarray, percent: int = PERCENT):
    """(parts, how many of them linked sets share at least) of each group of lists: of sets of
    the group's class and the class before it."""
    apart = (100 - percent) * 2 * (classes[group + 1] - 1) // (100 + percent)
    shared = 2 + SPARE * apart // 100
    return apart + shared, shared


def part_keys(hashes: np.ndarray, counts: np.ndarray, percent: int = PERCENT):
    """For both groups of each set (ascending hashes, none empty): (keys, owners, needs, groups)
    of its parts with shingles, then of the prefix of the sets that can share empty parts only.
    The need is how many keys a set shares with any partner in the group, where it is positive."""
    classes = size_classes(int(counts.max()), percent)
    owner = np.repeat(np.arange(len(counts)), counts)
    own_class = np.searchsorted(classes, counts, side="right") - 1
    in_prefix = np.arange(len(hashes)) - rows.offsets(counts)[owner] < list_prefix(counts, percent)[owner]
    low = np.uint64(32)
    for group in (own_class, own_class + 1):
        parts, shared = parts_of(group, classes, percent)
        part = ((hashes >> low) * parts[owner].astype(np.uint64)) >> low
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(fresh)
        own = owner[starts]
        need = shared - parts + np.bincount(own, minlength=len(counts))
        tag = (part[starts] << np.uint64(GROUP_BITS)) | group[own].astype(np.uint64)
        content = np.add.reduceat(hashes, starts)
        yield _tagged(content, tag), own, need[own], group[own]
        weak = np.flatnonzero((need < 1)[owner] & in_prefix)
        tag = ~group[owner[weak]].astype(np.uint64)
        yield _tagged(hashes[weak], tag), owner[weak], need[owner[weak]], group[owner[weak]]


def _tagged(hashes: np.ndarray, tag: np.ndarray) -> np.ndarray:
    return rows.stirred(hashes * rows.BASE + rows.stirred(tag))


def shingle_sets(values: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the distinct shingles, ascending in each document; how many each has)."""
    flat, counts = rows.split_words(rows.lower_ascii(values))
    units = rows.word_hashes(flat)
    n = len(counts)
    whole = rows.inside(counts, width)
    hashes = rows.stirred(rows.window_hashes(units, width))[whole]
    owner = np.repeat(np.arange(n), counts)[whole]
    few = np.flatnonzero((counts > 0) & (counts < width))
    if len(few):
        starts = rows.offsets(counts)
        short = [
            rows.window_hashes(units[starts[i] : starts[i] + counts[i]], int(counts[i]))[0]
            + np.uint64(counts[i])
            for i in few
        ]
        hashes = np.concatenate([hashes, rows.stirred(np.array(short, np.uint64))])
        owner = np.concatenate([owner, few])
    order = np.lexsort([hashes, owner])
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.bincount(owner[fresh], minlength=n).astype(np.int64)


def _profile(width: int):
    """A row (doc, n, digest) for each document, and (h, c) for shingles seen often in a slice."""

    def run(batches):
        for batch in rows.slices(batches, "text", PROFILE_BYTES):
            steps = rows.slices([batch], "text", STEP_BYTES)
            sets = [shingle_sets(rows.texts(step), width) for step in steps]
            hashes, counts = (np.concatenate(part) for part in zip(*sets))
            del sets
            ends = np.cumsum(counts)
            digests = [
                hashlib.blake2b(hashes[e - n : e].tobytes(), digest_size=16).digest()
                for n, e in zip(counts, ends)
            ]
            seen, times = np.unique(hashes, return_counts=True)
            often = times >= SEEN_IN_SLICE
            seen, times = seen[often], times[often]
            none, blank = len(counts), len(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), pa.nulls(blank, pa.int64())]),
                    pa.concat_arrays([pa.array(counts), pa.nulls(blank, pa.int64())]),
                    pa.array([*digests, *[None] * blank], pa.binary()),
                    pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(seen.view(np.int64))]),
                    pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(times)]),
                ],
                names=["doc", "n", "digest", "h", "c"],
            )

    return run


def light_boundary(sizes: dict[int, int], percent: int = PERCENT) -> int:
    """The size up to which subsets are enumerated, with the least keys; 0 for none.

    ``sizes`` counts the sets of each size up to ``LARGEST_LIGHT``.
    """
    classes = size_classes(LARGEST_LIGHT, percent)
    best, at = None, 0
    for boundary in range(0, LARGEST_LIGHT + 1):
        cost = 0
        for n, count in sizes.items():
            if n <= boundary:
                first = n - needed_overlap(n, percent) + 2
                cost += count * first * (first - 1) // 2
            if n > boundary or 100 * n >= percent * (boundary + 1):
                own = np.searchsorted(classes, n, side="right") - 1
                cost += count * int(parts_of(np.array([own, own + 1]), classes, percent)[0].sum())
        if best is None or cost < best:
            best, at = cost, boundary
    return at


def _key_rows(frequent, boundary: int, width: int, percent: int, bits: int):
    """The keys of every set that can have an unequal partner, at (document, need and group)."""

    def run(batches):
        ranks = frequent.value  # hashes of frequent shingles, ascending, and their ranks
        sent = rows.Occurrences(bits)
        for batch in rows.slices(batches, "text", STEP_BYTES):
            if sum(part.nbytes for part in sent.parts) >= KEY_BYTES:
                yield from sent.batches()  # a key then leaves once for each such run
            hashes, counts = shingle_sets(rows.texts(batch), width)
            n = len(counts)
            # equal sets are one class, so a set must allow a difference
            open_ = 100 * (counts - 1) >= percent * counts
            open_ |= 100 * counts >= percent * (counts + 1)
            owner = np.repeat(np.arange(n), counts)
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            light = counts <= boundary
            listed = open_ & (~light | (100 * counts >= percent * (boundary + 1)))
            if listed.any():
                own_docs = docs[listed]
                for keys, own, need, group in part_keys(hashes[listed[owner]], counts[listed], percent):
                    beside = np.clip(need, 1, MOST_NEED) << GROUP_BITS | group + 1
                    sent.add(keys, 0, own_docs[own], beside)
            light &= open_
            hashes, owner = hashes[light[owner]], owner[light[owner]]
            rank = np.zeros(len(hashes), np.int64)
            if len(ranks[0]):
                near = np.minimum(np.searchsorted(ranks[0], hashes), len(ranks[0]) - 1)
                rank = np.where(ranks[0][near] == hashes, ranks[1][near], 0)
            hashes = hashes[np.lexsort([hashes, rank, owner])]
            starts = rows.offsets(np.where(light, counts, 0))
            for size in np.unique(counts[light]):
                which = np.flatnonzero(light & (counts == size))
                first = int(size - needed_overlap(int(size), percent) + 2)
                a, b = np.triu_indices(min(first, int(size)), 1)
                x = hashes[starts[which][:, None] + a[None, :]]
                y = hashes[starts[which][:, None] + b[None, :]]
                low, high = np.minimum(x, y), np.maximum(x, y)
                subset = rows.stirred(low * rows.BASE + high).ravel()
                sent.add(subset, 0, np.repeat(docs[which], len(a)), 1 << GROUP_BITS)
        yield from sent.batches()
        rows.give_back()

    return run


def _differences(width: int, percent: int):
    """Streams rows sorted by (hub, salt, hub first). A block that is whole here is solved at
    once and gives its links (a, b); members of a divided block leave as differences."""

    def run(batches):
        hub, hub_set, members = None, np.empty(0, np.uint64), []
        for batch in rows.slices(batches, "text", STEP_BYTES):
            hashes, counts = shingle_sets(rows.texts(batch), width)
            ends = np.cumsum(counts)
            links, out = [], []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for h, salt, doc, parts, n, end in zip(*columns, counts.tolist(), ends.tolist()):
                own = hashes[end - n : end]
                if doc == h:
                    if members:
                        links.extend(_solve(hub, members, percent))
                    hub, hub_set, members = h, own.copy(), []
                    if salt:
                        continue  # the hub itself counts once
                if hub != h:
                    raise ValueError(f"document {h} leads a block but has no text")
                delta = np.setxor1d(own, hub_set, assume_unique=True).tobytes()
                if parts == 1:
                    members.append((doc, n, len(hub_set), delta))
                else:
                    out.append((h, doc, n, len(hub_set), parts, delta))
            yield _links_and_members(links, out)
        if members:
            yield _links_and_members(_solve(hub, members, percent), [])

    return run


def _links_and_members(links: list, members: list) -> pa.RecordBatch:
    columns = list(zip(*members)) if members else [()] * 6
    pairs = list(zip(*links)) if links else [()] * 2
    none, blank = len(links), len(members)
    return pa.RecordBatch.from_arrays(
        [
            *(pa.array([*pairs[i], *[None] * blank], pa.int64()) for i in range(2)),
            *(pa.array([*[None] * none, *columns[i]], pa.int64()) for i in range(5)),
            pa.array([*[None] * none, *columns[5]], pa.binary()),
        ],
        names=["a", "b", "hub", "doc", "n", "n_hub", "parts", "delta"],
    )


def linked(
    docs: np.ndarray, sizes: np.ndarray, hub_size: int, hub: int, deltas: list[np.ndarray], percent: int
) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links within a block."""
    m = len(docs)
    apart = np.array([len(d) for d in deltas], np.int64)

    def close(total, difference):
        return 100 * (total - difference) >= percent * (total + difference)

    near = close(sizes + hub_size, apart)
    parent = list(range(m + 1))  # the last stands for the hub

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in np.flatnonzero(near).tolist():
        parent[i] = m
        if docs[i] != hub:
            yield int(docs[i]), hub
    rest = np.flatnonzero(~near)
    if not len(rest):
        return
    elements = np.concatenate(deltas)
    owners = np.repeat(np.arange(m), apart)
    _, code = np.unique(elements, return_inverse=True)
    by_code = np.argsort(code, kind="stable")
    lists = owners[by_code]
    ends = np.concatenate([[0], np.cumsum(np.bincount(code))])
    starts_of = np.concatenate([[0], np.cumsum(apart)])
    for x in rest.tolist():
        own = code[starts_of[x] : starts_of[x + 1]]
        lengths = ends[own + 1] - ends[own]
        shift = np.repeat(ends[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        shared = np.bincount(lists[np.arange(lengths.sum()) + shift], minlength=m)
        hits = close(sizes + sizes[x], apart + apart[x] - 2 * shared)
        hits[x] = False
        for y in np.flatnonzero(hits).tolist():
            a, b = root(x), root(y)
            if a != b:
                parent[min(a, b)] = max(a, b)
                yield int(docs[x]), int(docs[y])


def _block_links(percent: int):
    """Streams members sorted by block and gives the links (a, b) of each block."""

    def run(batches):
        current, members = None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            out = []
            for hub, i, j, doc, n, n_hub, delta in zip(*columns):
                if (hub, i, j) != current:
                    if members:
                        out.extend(_solve(current[0], members, percent))
                    current, members = (hub, i, j), []
                members.append((doc, n, n_hub, delta))
            yield _edges(out)
        if members:
            yield _edges(_solve(current[0], members, percent))

    return run


def _solve(hub: int, members: list, percent: int) -> list[tuple[int, int]]:
    docs, sizes, hub_sizes, deltas = zip(*members)
    sets = [np.frombuffer(d, np.uint64) for d in deltas]
    return list(linked(np.array(docs), np.array(sizes), hub_sizes[0], hub, sets, percent))


def _edges(pairs) -> pa.RecordBatch:
    pairs = list(pairs)
    return pa.record_batch(
        [pa.array([p[i] for p in pairs], pa.int64()) for i in range(2)], names=["a", "b"]
    )


def _plain_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, text) with one row per document; dealt by document only where keys repeat."""
    again = docs.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
    if again.isEmpty():
        return docs.select(
            F.col(key).cast("long").alias("doc"), F.coalesce(text, F.lit("")).alias("text")
        ).where("doc IS NOT NULL")
    return rows.one_row_per_document(docs, key, text)


def _frequent(spark: SparkSession, profile: DataFrame, n_docs: int):
    """The broadcast of frequent shingles and their ranks, the rarest first."""
    least = max(SEEN_IN_SLICE, FREQUENT_SHARE * n_docs)
    table = (
        profile.where("h IS NOT NULL").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    ).collect()  # at most 1 / FREQUENT_SHARE times the mean set size
    hashes = np.array([r["h"] for r in table], np.int64).view(np.uint64)
    times = np.array([r["c"] for r in table], np.int64)
    order = np.argsort(hashes, kind="stable")
    return spark.sparkContext.broadcast((hashes[order], times[order]))


def _met_alone(close: DataFrame) -> DataFrame:
    """(hub, doc) of sets that share half of the keys they need in lists of few sets."""
    few = close.where(F.col("size") <= FEW).groupBy("h")
    # FEW members at most
    lists = few.agg(F.sort_array(F.collect_list(F.struct("doc", "need", "grp"))).alias("m"))
    met = lists.select(
        F.explode(
            F.expr(
                "flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)), y -> "
                "struct(x.doc AS hub, y.doc AS doc, x.grp AS grp, greatest(x.need, y.need) AS need))))"
            )
        ).alias("p")
    ).select("p.*")
    enough = (
        met.groupBy("hub", "doc", "grp")
        .agg(F.count("*").alias("keys"), F.max("need").alias("need"))
        .where("2 * keys >= need")
    )
    return enough.select("hub", F.explode(F.array("hub", "doc")).alias("doc"))


def _met_at_hubs(close: DataFrame) -> DataFrame:
    """(hub, doc) of sets that can have half of the keys they need in lists of more sets."""
    many = close.where(F.col("size") > FEW)
    able = (
        many.groupBy("doc", "grp")
        .agg(F.count("*").alias("keys"), F.first("need").alias("need"))
        .where("2 * keys > need")
        .select("doc", "grp")
    )
    members = checkpointed(many.join(able, ["doc", "grp"], "left_semi").select("h", "doc"))
    degree = members.groupBy("doc").agg(F.count("*").alias("weight"))
    first = _heaviest(members.join(degree, "doc").withColumn("hub", F.col("doc")), "h")
    votes = members.join(first, "h").groupBy("doc", "hub").agg(F.count("*").alias("weight"))
    own = checkpointed(_heaviest(votes, "doc"))
    fame = own.groupBy("hub").agg(F.count("*").alias("weight"))
    hubs = _heaviest(members.join(own.join(fame, "hub"), "doc"), "h")
    pairs = members.join(hubs, "h").select("hub", "doc")
    return pairs.union(hubs.select("hub", F.col("hub").alias("doc")))


def _heaviest(candidates: DataFrame, key: str) -> DataFrame:
    """(key, hub) with the greatest weight, then the least hub."""
    top = F.max(F.struct("weight", (-F.col("hub")).alias("low")))
    return candidates.groupBy(key).agg(top.alias("top")).select(key, (-F.col("top.low")).alias("hub"))


def jaccard_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Per document: ``key, n_shingles, class_id, component_id``.

    ``class_id`` is the smallest key with an equal set, ``component_id`` the smallest key
    reachable by links. Words are runs outside ASCII white space with A-Z lower-cased; a
    text of fewer words than a shingle is one shingle; null, empty and blank texts have no
    shingles and are linked with nothing. Rows with a null key are left out. Rows that
    repeat a key are one document, the one with the greatest text. An empty table gives
    no rows. Other columns are not read.

    The order of shingles is the same for all documents and any order gives the same
    result; counting the frequent ones only keeps the lists short. A hub with many members
    is split: its set is sent to each part, and large blocks are solved part against part.
    """
    spark = docs.sparkSession
    texts = _plain_texts(docs, key, text)
    profile = checkpointed(
        texts.mapInArrow(_profile(width), "doc long, n long, digest binary, h long, c long")
    )
    sets = profile.where("doc IS NOT NULL").select("doc", "n", "digest")
    first = sets.where("n > 0").groupBy("digest", "n").agg(F.min("doc").alias("class_id"))
    classes = checkpointed(
        sets.join(first, ["digest", "n"], "left").select(
            "doc", "n", F.coalesce("class_id", "doc").alias("class_id")
        )
    )
    leaders = classes.where("doc = class_id AND n > 0").select("doc")
    sizes = (
        classes.where("doc = class_id")
        .where(F.col("n").between(1, LARGEST_LIGHT))
        .groupBy("n")
        .count()
        .collect()
    )
    boundary = light_boundary({r["n"]: r["count"] for r in sizes}, percent)
    frequent = _frequent(spark, profile, classes.count())
    bits = max(6, rows.bucket_bits(docs, text) - WIDER_BITS)
    sent = texts.mapInArrow(
        _key_rows(frequent, boundary, width, percent, bits), rows.Occurrences.SCHEMA
    )
    places = checkpointed(
        rows.wanted_places(sent, every=True)
        .join(leaders, "doc", "left_semi")
        .select(
            "h",
            "doc",
            F.shiftright("pos", GROUP_BITS).alias("need"),
            F.col("pos").bitwiseAND((1 << GROUP_BITS) - 1).alias("grp"),
        )
    )
    crowded = places.groupBy("h").agg(F.count("*").alias("size")).where("size > 1")
    close = checkpointed(places.join(crowded, "h"))
    pairs = checkpointed(_met_alone(close).union(_met_at_hubs(close)).distinct())
    parts = pairs.groupBy("hub").agg(
        F.ceil(F.count("*") / BLOCK_MEMBERS).cast("int").alias("parts")
    )
    salt = F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")
    dealt = pairs.join(parts, "hub").withColumn(
        "salt",
        F.explode(
            F.when(F.col("doc") == F.col("hub"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
                F.array(salt)
            )
        ),
    )
    with_text = dealt.join(rows.compressed(texts), "doc").select(
        "hub",
        "salt",
        "doc",
        F.col("parts").cast("long").alias("parts"),
        (F.col("doc") != F.col("hub")).alias("member"),
        "text",
    )
    solved = checkpointed(
        with_text.repartition("hub", "salt")
        .sortWithinPartitions("hub", "salt", "member")
        .mapInArrow(
            _differences(width, percent),
            "a long, b long, hub long, doc long, n long, n_hub long, parts long, delta binary",
        )
    )
    side = F.pmod(F.xxhash64("doc"), F.col("parts"))
    divided = (
        solved.where("a IS NULL")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select(
            "hub",
            F.least(side, "other").alias("i"),
            F.greatest(side, "other").alias("j"),
            "doc",
            "n",
            "n_hub",
            "delta",
        )
        .repartition("hub", "i", "j")
        .sortWithinPartitions("hub", "i", "j")
        .mapInArrow(_block_links(percent), "a long, b long")
    )
    edges = solved.where("a IS NOT NULL").select("a", "b").union(divided)
    roots = components(edges)
    return (
        classes.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select(
            F.col("doc").alias(key),
            F.col("n").alias("n_shingles"),
            "class_id",
            F.coalesce("root", "class_id").alias("component_id"),
        )
    )


def one_of_each_group(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows whose document is not the smallest key of its component.

    Rows with a null key stay; of rows that repeat a key all stay or go together.
    """
    groups = jaccard_groups(docs, key=key, **options)
    dropped = groups.where(F.col(key) != F.col("component_id")).select(F.col(key).alias("__gone"))
    return docs.join(dropped, F.col(key) == F.col("__gone"), "left_anti")
