"""Ranked lexical search with the Best Position Algorithm.

The documents stay where they are read: each task turns its own into impact lists, one for
each query term, ordered by what the term adds to a document's score. A query reads its
lists from the top. A document met in one list is scored at once by direct access to all
others, which also tells its positions there. A list's best position ends the unbroken run
of seen positions from its top, so no unseen document can score more than the sum of the
impacts at the best positions. That bound is at most the one at the positions last read,
so the search ends earlier; it ends when the bound is strictly below the k-th score, since a
document that ties with the k-th may have the smaller id. The tasks' top documents are then
ranked together.

Scores need the corpus' counts, so the documents are read once for their query terms, which
are stored with their frequencies, and the lists are made from those.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.llm import rows
from jobstrata.llm.storage import stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: between terms, once A-Z are lower case
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: query text whose terms are held at once; more queries take several turns
TURN_BYTES = 4 << 20
#: postings of one block of documents, whose lists are searched together
BLOCK_POSTINGS = 2 << 20
#: positions read from each list before the first look at the bound; doubled from then on
FIRST_READ = 16
POSTING = np.dtype([("term", "<i4"), ("tf", "<i4")])
#: length scaling of a document: its share that does not depend on the length, of 100
FIXED_SHARE = 10


def query_terms(items: DataFrame) -> DataFrame:
    """(item_no, term): each item's distinct terms."""
    lowered = F.translate("body", _UPPER, _LOWER)
    found = F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"({TERM})"), F.lit(1)))
    return items.select("item_no", F.explode(found).alias("term"))


class Queries:
    """The terms of one turn, numbered, and which terms each item has; sent to every task."""

    def __init__(self, pairs: pa.Table) -> None:
        coded = pc.dictionary_encode(pairs.column("term").combine_chunks().cast(pa.large_string()))
        self.terms = coded.dictionary
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        items = pairs.column("item_no").to_numpy()
        order = np.lexsort([numbers, items])
        items, self.numbers = items[order], numbers[order]
        self.items, starts = np.unique(items, return_index=True)
        self.bounds = np.append(starts, len(items))

    def __iter__(self):
        for i, item in enumerate(self.items.tolist()):
            yield item, self.numbers[self.bounds[i] : self.bounds[i + 1]]


def _postings(shared, text: str):
    """(doc_id, n, body): each document's length in terms and its packed query terms."""

    def run(batches):
        terms = shared.value.terms
        for batch in rows.slices(batches, text):
            flat, counts = rows.split_words(rows.lower_ascii(rows.texts(batch, text)), BETWEEN)
            found = pc.index_in(flat, value_set=terms)
            known = pc.is_valid(found).to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(counts)), counts)[known]
            number = found.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            keys, tf = np.unique(doc * (len(terms) + 1) + number, return_counts=True)
            own = np.empty(len(keys), POSTING)
            own["term"], own["tf"] = keys % (len(terms) + 1), tf
            bounds = np.searchsorted(keys // (len(terms) + 1), np.arange(len(counts) + 1))
            yield pa.record_batch(
                [batch.column(0), pa.array(counts), rows.pack(own, bounds)],
                names=["doc_id", "n", "body"],
            )

    return run


def document_frequencies(postings: DataFrame) -> DataFrame:
    """(term, df) of the numbered terms."""

    def run(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            own = rows.unpack(batch.column(0), POSTING)
            fresh = np.bincount(own["term"], minlength=len(counts))
            fresh[: len(counts)] += counts
            counts = fresh
        held = np.flatnonzero(counts)
        for i in range(0, len(held), 1 << 16):
            part = held[i : i + (1 << 16)]
            yield pa.record_batch([pa.array(part), pa.array(counts[part])], names=["term", "c"])

    counted = postings.select("body").mapInArrow(run, "term long, c long")
    return counted.groupBy("term").agg(F.sum("c").alias("df"))


class Block:
    """The impact lists of some documents: by document for direct, by impact for sorted access."""

    def __init__(self, lengths: np.ndarray, sizes: np.ndarray, own: np.ndarray, weights: np.ndarray,
                 n_docs: int, n_terms: int) -> None:
        doc = np.repeat(np.arange(len(sizes)), sizes)
        m = FIXED_SHARE + ((100 - FIXED_SHARE) * lengths * n_docs) // max(n_terms, 1)
        tf = own["tf"].astype(np.int64)
        impact = weights[own["term"]] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        # a term that adds nothing has no place in a list
        keep = impact > 0
        doc, impact, term = doc[keep], impact[keep], own["term"][keep]
        by_doc = np.lexsort([doc, term])
        self.doc, self.impact = doc[by_doc], impact[by_doc]
        self.bounds = np.searchsorted(term[by_doc], np.arange(len(weights) + 1))
        number = np.repeat(np.arange(len(weights)), np.diff(self.bounds))
        #: places of ``doc`` and ``impact`` in the order of falling impact, term by term
        self.by_impact = np.lexsort([self.doc, -self.impact, number])
        self.position = np.empty(len(self.doc), np.int64)
        self.position[self.by_impact] = np.arange(len(self.doc)) - self.bounds[number]
        self.n = len(sizes)

    def best(self, terms: np.ndarray, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best, by score and then by id, as far as there are."""
        spans = [(self.bounds[t], self.bounds[t + 1]) for t in terms.tolist()]
        spans = [(a, b) for a, b in spans if b > a]
        met = np.zeros(self.n, bool)
        seen = [np.zeros(b - a, bool) for a, b in spans]
        upto = [0] * len(spans)
        top, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, FIRST_READ
        while spans:
            read = [self.doc[self.by_impact[a + depth : min(a + depth + step, b)]] for a, b in spans]
            fresh = np.unique(np.concatenate(read))
            fresh = fresh[~met[fresh]]
            met[fresh] = True
            total = np.zeros(len(fresh), np.int64)
            bound = 0
            for i, (a, b) in enumerate(spans):
                at = np.minimum(a + np.searchsorted(self.doc[a:b], fresh), b - 1)
                hit = self.doc[at] == fresh
                total[hit] += self.impact[at[hit]]
                seen[i][self.position[at[hit]]] = True
                rest = seen[i][upto[i] :]
                upto[i] += int(np.argmin(rest)) if not rest.all() else len(rest)
                if upto[i] < b - a:
                    bound += int(self.impact[self.by_impact[a + upto[i] - 1]])
            top, scores = np.concatenate([top, fresh]), np.concatenate([scores, total])
            order = np.lexsort([ids[top], -scores])[:k]
            top, scores = top[order], scores[order]
            if bound == 0 or (len(top) == k and bound < scores[-1]):
                break
            depth, step = depth + step, step * 2
        return top, scores


def _searched(shared, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    def run(batches):
        held, postings = [], 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes // POSTING.itemsize)
            start = 0
            while start < batch.num_rows:
                base = ends[start - 1] if start else 0
                room = base + BLOCK_POSTINGS - postings
                stop = max(start + (not held), int(np.searchsorted(ends, room, side="right")))
                if stop > start:
                    held.append(batch.slice(start, stop - start))
                    postings += int(ends[stop - 1] - base)
                    start = stop
                if start < batch.num_rows:
                    yield from answers(held)
                    held, postings = [], 0
        if held:
            yield from answers(held)

    def answers(held):
        table = pa.Table.from_batches(held)
        # a null id stands after all others
        ids = table.column(0).fill_null(np.iinfo(np.int64).max).to_numpy()
        own = rows.unpack(table.column(2), POSTING)
        sizes = pc.binary_length(table.column(2)).to_numpy().astype(np.int64) // POSTING.itemsize
        block = Block(table.column(1).to_numpy(), sizes, own, weights, n_docs, n_terms)
        absent = np.asarray(table.column(0).is_null())
        found: list[list] = [[], [], []]
        for item, terms in shared.value:
            top, scores = block.best(terms, k, ids)
            found[0].append(np.full(len(top), item))
            found[1].append(top)
            found[2].append(scores)
        if found[0]:
            items, docs, scores = (np.concatenate(x) for x in found)
            yield pa.record_batch(
                [
                    pa.array(items),
                    pa.array(ids[docs], mask=absent[docs]),
                    pa.array(scores),
                ],
                names=["item_no", "doc_id", "score"],
            )

    return run


def ranked(
    docs: DataFrame,
    queries: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    k: int = 10,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every query.

    Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A term's
    weight is floor(1000 * ln((2N + 2) / (2df + 1))) over the N documents that have terms; all
    else is 64-bit integer arithmetic. Only scores above 0 count, equal ones rank by id.

    Null texts have no terms; queries without terms and empty tables give no rows. A query
    that repeats (id and text) counts once; queries that share an id are ranked each by
    itself. Repeated documents rank each by itself, null ids after all others of their
    score. Ids are read as long. Other columns, with any name, are not read.

    Runs jobs while it is built: the queries' terms come to the driver in turns of at most
    ``TURN_BYTES`` of query text, and every turn reads the documents once.
    """
    spark = docs.sparkSession
    items = stored(
        queries.select(
            F.col(item).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("body")
        )
        .distinct()
        .withColumn("item_no", F.monotonically_increasing_id()),
        "search-items",
    )
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    turns = 1 + size // TURN_BYTES
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for turn in range(turns):
        part = items.where(F.pmod(F.xxhash64("item_no"), F.lit(turns)) == turn)
        own = Queries(query_terms(part).toArrow())
        shared = spark.sparkContext.broadcast(own)
        postings = stored(
            source.mapInArrow(_postings(shared, "text"), "doc_id long, n long, body binary"),
            "search-postings",
        )
        counts = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        n_docs, n_terms = counts[0], counts[1] or 0
        weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2 * F.col("df") + 1)))
        known = document_frequencies(postings).select("term", weight.alias("w")).toArrow()
        weights = np.zeros(len(own.terms), np.int64)
        weights[known.column("term").to_numpy()] = known.column("w").to_numpy()
        answers = postings.mapInArrow(
            _searched(shared, weights, n_docs, n_terms, k), "item_no long, doc_id long, score long"
        )
        if turns > 1:  # one turn's lists are let go before the next turn's are made
            answers = stored(answers, "search-answers")
            shared.unpersist()
        found = answers if found is None else found.unionByName(answers)
    order = Window.partitionBy("item_no").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id")
    )
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(items.select("item_no", "item_id"), "item_no").select(
        "item_id", "rank", "doc_id", "score"
    )
