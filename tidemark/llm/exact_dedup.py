"""Exact dedup by an extendible-hash index kept in shared files.

1. *Entries.*  A scan lower-cases A-Z in the UTF-8 bytes of every whole text and joins
   equal texts of one Arrow batch, so a text that a third of all rows hold travels once
   per batch.  An entry has the 64-bit hash of its bytes, the bytes, its number of rows and
   its largest doc_id.  Rows and entries are written once in the shared folder.
2. *Directory.*  The leading bits of the hash choose a slot of the directory, a slot names a
   bucket.  Starting from one bucket, an overfull one splits by its next bit; if it was
   already as deep as the directory, the directory doubles first.  Loads come from one
   histogram over the leading bits (``deepest_bits``, at most 2^20 cells whatever the
   corpus), so that the driver sees no row.  A bucket that no bit can split, because one
   text fills it, stays overfull and becomes a longer run for its owner.
3. *Owners.*  Entries go to the task that owns their bucket, a range of hashes, sorted by
   hash.  The owner reads them as a stream.  Entries with one hash form a chain; texts in a
   chain are compared byte by byte, so a collision gives two groups.  Only one chain is in
   memory: its distinct texts and the numbers of its entries, at most one per batch of input.
4. The index (bucket, hash, entry -> group) is written; rows look up their entry.  An entry
   belongs to one batch, so no join key is hot.

Rules: null text is empty; equal texts keep the row with the largest doc_id; of rows that
repeat that doc_id the first one stays, others go; a null doc_id is smaller than any other
(stored as the least 64-bit number), and a group of null ids keeps one row with a null
keep_id.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import partitions, written
from tidemark.llm.words import text_buffers

NO_ID = -(1 << 63)
BUCKETS_PER_TASK = 8
_ROW = "doc_id long, entry long, best boolean, hash long, n_bytes long, top long, copies long, text binary"
_FOUND = "bucket int, hash long, entry long, winner long, keep_id long, group_size long, sha binary"


def fold(data: bytes) -> bytes:
    """Lower-case A-Z only (the bytes of other characters are no ASCII letters)."""
    return data.lower()


def hash64(data: bytes) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(data)


def _entries(hash_of: Callable[[bytes], int]):
    def run(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            entries, many = _batch_entries(batch, number, hash_of)
            number += many
            yield entries

    return run


def _batch_entries(batch: pa.RecordBatch, number: int, hash_of) -> tuple[pa.RecordBatch, int]:
    """The rows of a batch with their entries, numbered from ``number`` on, and how many entries."""
    data, offs = text_buffers(batch.column("text"))
    data, offs = fold(data.tobytes()), offs.tolist()
    seen: dict[bytes, int] = {}
    slot = np.fromiter((seen.setdefault(data[a:b], len(seen)) for a, b in zip(offs, offs[1:])), np.int64, batch.num_rows)
    ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
    order = np.lexsort((~ids, slot))          # per entry the largest id first, equal ids in row order
    first = np.ones(len(order), dtype=bool)
    first[1:] = slot[order][1:] != slot[order][:-1]
    best = np.zeros(batch.num_rows, dtype=bool)
    best[order[first]] = True
    texts = list(seen)
    lead = dict(zip(slot[best].tolist(), np.flatnonzero(best).tolist()))     # the row that carries an entry
    place = np.full(batch.num_rows, -1)
    place[list(lead.values())] = list(lead)
    only = lambda values, kind: pa.array(values, kind, mask=~best)
    hashes = np.array([hash_of(t) for t in texts], dtype=np.uint64).view(np.int64)
    out = pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(slot + number), pa.array(best), only(hashes[place], pa.int64()),
         only(np.array([len(t) for t in texts])[place], pa.int64()), only(ids, pa.int64()),
         only(np.bincount(slot, minlength=len(texts))[place], pa.int64()),
         pa.array([texts[p] if p >= 0 else None for p in place.tolist()], pa.binary())],
        names=["doc_id", "entry", "best", "hash", "n_bytes", "top", "copies", "text"])
    return out, len(texts)


def deepest_bits(tasks: int) -> int:
    """Leading bits that the histogram resolves: 64 cells a task, 2^20 cells at most."""
    return max(8, min(20, math.ceil(math.log2(64 * max(tasks, 1)))))


def grow(cells: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Bucket of every directory slot, and the directory's depth, for loads by leading bits."""
    deepest = int(len(cells)).bit_length() - 1
    total = np.concatenate([[0], np.cumsum(cells)])
    slots, depth = np.zeros(1, dtype=np.int64), 0
    start, local, full = [0], [0], [0]
    while full:
        b = full.pop()
        width = 1 << (deepest - local[b])
        if local[b] == deepest or total[start[b] + width] - total[start[b]] <= capacity:
            continue
        if local[b] == depth:
            slots, depth = np.repeat(slots, 2), depth + 1
        local[b] += 1
        start.append(start[b] + width // 2)
        local.append(local[b])
        at = start[-1] >> (deepest - depth)
        slots[at:at + (1 << (depth - local[b]))] = len(start) - 1
        full += [b, len(start) - 1]
    return slots, depth


def _bucket_of(entries: DataFrame, tasks: int) -> DataFrame:
    """Add the bucket that the directory names."""
    deepest = deepest_bits(tasks)
    cell = F.shiftrightunsigned("hash", 64 - deepest)
    cells = np.zeros(1 << deepest, dtype=np.int64)
    for r in entries.groupBy(cell.alias("cell")).agg(F.sum(F.col("n_bytes") + 32).alias("n")).collect():   # at most 2^20 cells
        cells[r["cell"]] = r["n"]
    slots, depth = grow(cells, max(1, int(cells.sum()) // (BUCKETS_PER_TASK * tasks)))
    if depth == 0:
        return entries.withColumn("bucket", F.lit(0))
    rows = list(enumerate(slots.tolist()))
    directory = entries.sparkSession.createDataFrame(rows, "slot long, bucket int")
    return entries.withColumn("slot", F.shiftrightunsigned("hash", 64 - depth)).join(F.broadcast(directory), "slot").drop("slot")


def _groups(chain: dict[bytes, list], out: list) -> None:
    for text, members in chain.items():
        top = max(m[1] for m in members)
        winner = min(m[0] for m in members if m[1] == top)
        size, sha = sum(m[2] for m in members), hashlib.sha256(text).digest()
        out += [(m[3], m[4], m[0], winner, top, size, sha) for m in members]


def _chains(batches):
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["bucket", "hash", "entry", "winner", "keep_id", "group_size", "sha"]
    chain: dict[bytes, list] = {}
    key, out = None, []

    def flush():
        cols = list(zip(*out)) or [()] * len(names)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    for batch in batches:
        cols = (batch.column(c) for c in ("bucket", "hash", "entry", "top", "copies", "text"))
        for bucket, h, entry, top, copies, text in zip(*(c.to_pylist() for c in cols)):
            if h != key:
                _groups(chain, out)
                chain, key = {}, h
            chain.setdefault(text, []).append((entry, top, copies, bucket, h))    # finds an equal hash, then compares bytes
        yield flush()
    _groups(chain, out)
    yield flush()


def index(rows: DataFrame) -> DataFrame:
    """The index of the entries among ``rows``: bucket, hash, entry, winner, keep_id, group_size, sha."""
    tasks = partitions(rows)
    entries = _bucket_of(rows.where("best").select("hash", "entry", "n_bytes", "top", "copies", "text"), tasks)
    owned = entries.repartition(tasks, "bucket").sortWithinPartitions("hash", "entry")
    return owned.select("bucket", "hash", "entry", "top", "copies", "text").mapInArrow(_chains, _FOUND)


def exact_duplicates(docs: DataFrame, hash_of: Callable[[bytes], int] = hash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text).

    ``hash_of`` gives 64 bits of which the leading ones choose the bucket; results do not depend on it.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = written(docs.mapInArrow(_entries(hash_of), _ROW), "exact-entries")
    found = written(index(rows), "exact-index").select("entry", "winner", "keep_id", "group_size", "sha")
    kept = (F.col("best") & (F.col("entry") == F.col("winner"))).alias("kept")
    return rows.select("doc_id", "entry", "best").join(found, "entry").select(
        "doc_id", F.nullif(F.col("keep_id"), F.lit(NO_ID)).alias("keep_id"), "group_size", kept,
        F.lower(F.hex("sha")).alias("text_sha256"))
