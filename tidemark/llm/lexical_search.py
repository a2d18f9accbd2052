"""Ranked lexical search by NRA (no random access) over impact-sorted lists.

1. *Terms.*  A scan cuts every whole text into terms and keeps, per document, its number of
   terms and the counts of those that the queries hold.  The table is written once.  Number
   of documents, of terms, and documents per query term are aggregates of it.
2. *Lists.*  A task holds the lists of its own documents, in shards of at most ``SHARD``
   postings: per term the documents by falling impact (what the term adds to the score).
   Nothing is shuffled.
3. *NRA.*  For a query the lists are read from the top, in blocks that double, never by
   document.  What was read is the lower end of a document's score; the upper end adds, for
   every list in which it was not yet met, the impact at which that list stands.  The bar
   is the k-th best lower end, or the k-th best score of earlier shards.  Reading goes on
   until no unmet document can reach the bar and every met one that can has closed
   its interval: then membership, ties and scores are exact.
4. The best k of each task meet in a top-k per query, first in 64 salted groups.

Queries are taken in blocks of at most ``BLOCK_TERMS`` terms, each against all documents, so that
the vocabulary sent to the tasks is bounded whatever the number of queries.

Rules: a null text has no term; documents without a term do not count; rows that repeat a
doc_id are documents of their own; equal scores rank by doc_id, null last; query rows that
repeat item and text count once, rows of one item with other texts are ranked each; a query
without terms, or an empty table, gives no row; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import written
from tidemark.llm.words import text_buffers

TOP = 50
SHARD = 1 << 22               # postings that a task sorts at a time
BLOCK_TERMS = 1 << 17
FIRST_READ = 256
NO_ID = (1 << 63) - 1         # sorts null ids last
#: Bytes of terms: digits, letters (A-Z lower-cased) and all of other characters; the rest separates.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_HIT = "item int, doc_id long, score long, shard int"
_OUT = "item_id long, rank int, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def _postings(vocabulary: dict[bytes, int]):
    known = vocabulary.keys()

    def run(batches):
        for batch in batches:
            data, offs = text_buffers(batch.column("text"))
            data, offs = data.tobytes(), offs.tolist()
            n, sizes, term, tf = [], [0], [], []
            for a, b in zip(offs, offs[1:]):
                words = terms(data[a:b])
                held = Counter(words)
                mine = held.keys() & known
                n.append(len(words))
                sizes.append(len(mine))
                term += [vocabulary[t] for t in mine]
                tf += [held[t] for t in mine]
            at = pa.array(np.cumsum(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tf, pa.int64()))], names=["doc_id", "n", "terms", "tf"])

    return run


def _held(n_terms: int):
    """Documents per term, added up within the task."""
    def run(batches):
        df = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        there = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(df[there])], names=["term", "df"])

    return run


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def impacts(weight, tf, n, n_docs: int, n_terms: int):
    """What a term adds to a document's score, in whole numbers."""
    m = 100 - 50 + (50 * n * n_docs) // n_terms
    return weight * ((1000000000 * tf) // (1000 * tf + 20 * m))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents (numbers below ``n_docs``) that may be among the best ``k``, and their exact scores.

    ``lists`` hold (documents, falling impacts), a document once per list.  All that score at
    least the bar, which is ``floor`` at the least, are returned: ties at the bar included.
    """
    low = np.zeros(n_docs, dtype=np.int64)
    met = np.zeros(n_docs, dtype=bool)
    place, step = 0, FIRST_READ
    while True:
        for docs, gains in lists:                       # sequential reads
            part = docs[place:place + step]
            low[part] += gains[place:place + step]
            met[part] = True
        place, step = place + step, place + step
        stand = [int(gains[place]) if place < len(gains) else 0 for _, gains in lists]
        bar = max(floor, int(np.partition(low, n_docs - k)[n_docs - k]) if n_docs > k else 0)
        unmet = sum(stand)
        if unmet and unmet >= bar:
            continue                                    # a document not met yet could still enter
        rest = np.full(n_docs, unmet)                   # what lists may still add to a document
        for (docs, _), s in zip(lists, stand):
            if s:
                rest[docs[:place]] -= s
        if not ((rest > 0) & met & (low + rest >= bar)).any():
            found = np.flatnonzero(met & (low >= max(bar, 1)) & (rest == 0))
            return found, low[found]


class _Best:
    """The best k of a task so far, per query: scores falling, ties by doc_id."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[:self.k]
        self.score, self.doc = score[order], doc[order]


def _search_shard(batches: list[pa.RecordBatch], queries, weight, n_docs: int, n_terms: int, best: list[_Best]) -> None:
    doc_id = np.concatenate([b.column("doc_id").fill_null(NO_ID).to_numpy() for b in batches])
    n = np.concatenate([b.column("n").to_numpy() for b in batches])
    term = np.concatenate([b.column("terms").flatten().to_numpy() for b in batches])
    tf = np.concatenate([b.column("tf").flatten().to_numpy() for b in batches])
    held = np.concatenate([np.asarray(b.column("terms").value_lengths()) for b in batches])
    doc = np.repeat(np.arange(len(doc_id), dtype=np.int32), held)
    gain = impacts(weight[term], tf, n[doc], n_docs, n_terms)
    order = np.lexsort((-gain, term))
    doc, gain = doc[order], gain[order]
    edge = np.searchsorted(term[order], np.arange(len(weight) + 1))
    for query, top in zip(queries, best):
        lists = [(doc[edge[t]:edge[t + 1]], gain[edge[t]:edge[t + 1]]) for t in query if weight[t] > 0 and edge[t] < edge[t + 1]]
        if lists:
            found, score = nra(lists, len(doc_id), top.k, top.floor())
            top.add(score, doc_id[found])


def _search(queries: list[list[int]], weight: np.ndarray, n_docs: int, n_terms: int, k: int, shard: int):
    def run(batches):
        from pyspark import TaskContext
        best, waiting, size = [_Best(k) for _ in queries], [], 0
        for batch in batches:
            waiting.append(batch)
            size += len(batch.column("terms").flatten())
            if size >= shard:
                _search_shard(waiting, queries, weight, n_docs, n_terms, best)
                waiting, size = [], 0
        if waiting:
            _search_shard(waiting, queries, weight, n_docs, n_terms, best)
        for i, top in enumerate(best):
            if len(top.score):
                many = len(top.score)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * many, pa.int32()), pa.array(top.doc, pa.int64(), mask=top.doc == NO_ID), pa.array(top.score),
                     pa.array([TaskContext.get().partitionId()] * many, pa.int32())], names=["item", "doc_id", "score", "shard"])

    return run


def _blocks(items: DataFrame, limit: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Items and their distinct terms, in blocks of at most ``limit`` distinct terms (one item at least)."""
    ids, sets, seen = [], [], set()
    for r in items.toLocalIterator():
        mine = set(terms(r["text"].encode()))
        if sets and len(seen | mine) > limit:
            yield ids, sets
            ids, sets, seen = [], [], set()
        ids.append(r["item_id"])
        sets.append(sorted(mine))
        seen |= mine
    if sets:
        yield ids, sets


def _top(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, ids: list, sets: list[list[bytes]], k: int, shard: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*sets)))}
    size = len(vocabulary)
    table = written(docs.mapInArrow(_postings(vocabulary), "doc_id long, n long, terms array<int>, tf array<long>").where("n > 0"), "postings")
    n_docs, n_terms = table.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs or not size:
        return spark.createDataFrame([], _OUT)
    df = np.zeros(size, dtype=np.int64)
    for r in table.mapInArrow(_held(size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # one row a query term
        df[r["term"]] = r["df"]
    queries = [[vocabulary[t] for t in s] for s in sets]
    hits = table.mapInArrow(_search(queries, weights(df, n_docs), n_docs, n_terms, k, shard), _HIT)
    best = _top(_top(hits.withColumn("salt", F.col("shard") % 64), ["item", "salt"], k).drop("rank"), ["item"], k)
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")       # one row a query of the block
    return best.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, shard: int = SHARD, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best rows of ``docs`` (doc_id, text) for every row of ``items`` (item_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null").distinct()
    found = None
    for ids, sets in _blocks(items, block_terms):
        block = _search_block(docs, ids, sets, k, shard)
        found = block if found is None else found.unionByName(block)
    return found if found is not None else docs.sparkSession.createDataFrame([], _OUT)
