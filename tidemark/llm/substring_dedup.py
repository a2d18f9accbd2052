"""Substring deduplication by De Bruijn compaction.

The words of all documents form a De Bruijn graph: every run of ``k`` words (13)
is an edge between two (k-1)-word nodes.  An edge that also starts in a document
with a smaller id is a repeat, and its *source coordinates* are the first
(doc_id, position) where it starts.

1. *Edges* (``_edge_blobs``).  Each task hashes its documents' edges with numpy.
   Consecutive edges that share a minimiser (the least hash among their 5-word
   parts) travel to the same bucket, so repeats arrive in runs.  A task
   pre-aggregates first: of equal edges it sends only those of the first
   document, so a passage held by a third of all documents is sent once per
   task.  That document's further places of the edge go too, since another
   task may hold the edge in a smaller document.  An edge costs about 9 bytes of
   shuffle.  The edges of one document in ``SAMPLE`` are counted per bucket first: the
   number of buckets follows from their sum, so that a bucket holds about half of ``BUCKET_EDGES``
   whatever the corpus; one with more, as around a very common line, is split by
   the edges themselves (equal edges still meet).
2. *Repeats* (``_repeats``).  Each bucket finds the source coordinates of its
   edges; consecutive repeats with consecutive sources leave as one piece.
3. *Paths* (``_join_pieces``).  Pieces are shuffled by document and joined into
   maximal paths as long as the node between two edges does not branch, that is,
   as long as the document and its source go on with the same next edge.
4. *Verification*.  Paths are joined to the texts by document and by source;
   both spans are digested from the words themselves.  A path that differs from
   its source (a 64-bit hash collision) is dropped, and since its edges may have
   another, true source, they are looked up again (``_again``) with hashes of
   another family: the edges of all documents pass a bitmap of ``SIEVE`` bits over
   the dropped ones first, so the second search moves little.  Rows are done when all
   their paths of one family are verified.

Rules: null text has no words; a null ``doc_id`` is neither a source nor cut;
rows that repeat a doc_id are cut each by its own words and never by one
another (only strictly smaller ids are sources): edges and paths carry the row's
text hash.  Texts shorter than k words are kept.
Extra columns pass through; a column named like an output is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tables import partitions, written
from tidemark.llm.words import mix, slices, text_buffers, windows, within, word_hashes

K = 13
PART = 5                      # words of a minimiser
SLICE_BYTES = 1 << 21         # text hashed at a time
CHUNK_BYTES = 6 << 20         # text pre-aggregated at a time
SAMPLE = 8
BUCKET_EDGES = 1 << 20        # edges of a bucket; one with more is split by the edges themselves
FINE = 64                     # most buckets, in terms of the least
HASH_BITS = 64                # of an edge in the first search
SIEVE = 1 << 26               # bits (8 MB)

_BLOB = "bucket int, hashes binary, docs binary, rows binary, counts binary, places binary, pieces binary"
_PIECE = "doc_id long, _row long, start int, n int, src_doc long, src_row long, src_start int"
_PIECE_NP = np.dtype([("doc_id", "<i8"), ("_row", "<i8"), ("start", "<i4"), ("n", "<i4"), ("src_doc", "<i8"), ("src_row", "<i8"), ("src_start", "<i4")])


def _runs(doc, row, start, at, src) -> np.ndarray:
    """Consecutive edges ``at`` with consecutive sources ``src`` as one piece; input in (doc, row, start) order."""
    src_doc, src_row, src_start = doc[src], row[src], start[src]
    doc, row, start = doc[at], row[at], start[at]
    if not len(doc):
        return np.zeros(0, _PIECE_NP)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = ((doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1) | (src_doc[1:] != src_doc[:-1])
               | (src_row[1:] != src_row[:-1]) | (src_start[1:] != src_start[:-1] + 1))
    at = np.flatnonzero(new)
    out = np.empty(len(at), _PIECE_NP)
    out["doc_id"], out["_row"], out["start"] = doc[at], row[at], start[at]
    out["src_doc"], out["src_row"], out["src_start"] = src_doc[at], src_row[at], src_start[at]
    out["n"] = np.diff(np.append(at, len(doc)))
    return out


def _firsts(h):
    """For every entry the index of the first (doc, row, start) with its hash; entries
    already in (doc, row, start) order."""
    order = np.argsort(h, kind="stable")
    sh = h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = sh[1:] != sh[:-1]
    at = np.flatnonzero(new)
    first = np.empty(len(h), np.int64)
    first[order] = np.repeat(order[at], np.diff(np.append(at, len(h))))
    return first


@dataclass(frozen=True)
class Search:
    """Hash family of a search, bits of its hashes, and the edges it is about (None: all)."""
    turn: int = 0
    bits: int = 64
    sieve: bytes | None = None

    def edges(self, w, words_of, k: int):
        """Hashes of the windows of ``w`` (words of turn 0) and which of them take part."""
        h = windows(w.hashes, k)
        if self.turn == 0:
            return h & np.uint64(2 ** self.bits - 1), None
        place = (h & np.uint64(2 ** self.bits - 1)) % np.uint64(SIEVE)
        table = np.frombuffer(self.sieve, np.uint8)
        hit = (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return windows(words_of(self.turn).hashes, k) if hit.any() else h, hit


def _edges(table: pa.Table, k: int, search: Search = Search()):
    """(hash, minimiser, doc_id, row, start) of every edge; documents ascending by id and row."""
    table = table.sort_by([("doc_id", "ascending"), ("_row", "ascending")])
    ids, rows = table["doc_id"].to_numpy(), table["_row"].to_numpy()
    col = table["text"].combine_chunks() if table.num_rows else table["text"]
    _, offs = text_buffers(col)
    parts = []
    size = min(PART, k)
    for a, b in slices(offs, SLICE_BYTES):
        w = word_hashes(col.slice(a, b - a))
        h, hit = search.edges(w, lambda turn: word_hashes(col.slice(a, b - a), turn), k)
        if not len(h):
            continue
        g = windows(w.hashes, size)
        low = g[:len(h)].copy()
        for j in range(1, k - size + 1):
            np.minimum(low, g[j:j + len(h)], out=low)
        ok = within(w.first, k, len(w.hashes))
        ok = np.flatnonzero(ok if hit is None else ok & hit)
        doc = w.doc()[ok]
        parts.append((h[ok], low[ok], ids[a:b][doc], rows[a:b][doc], (ok - w.first[doc]).astype(np.int32)))
    if not parts:
        return None
    return [np.concatenate(x) for x in zip(*parts)]


def _bucket_of(low, buckets: int) -> np.ndarray:
    return (mix(low) % np.uint64(buckets)).astype(np.int32)


def _bucket_counts(k: int, buckets: int, search: Search):
    """Edges per bucket, before pre-aggregation."""
    def run(batches):
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                got = _edges(pa.Table.from_batches([batch.slice(a, 256)]), k, search)
                if got is not None:
                    n += np.bincount(_bucket_of(got[1], buckets), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["bucket", "n"])

    return run


def _ways(docs: DataFrame, k: int, least: int, search: Search) -> np.ndarray:
    """Into how many parts each bucket is split; as many buckets as keep their mean at half of BUCKET_EDGES.

    The sample is counted in FINE buckets for each of the ``least`` ones; a coarser number of
    buckets that divides the fine one adds fine counts up.
    """
    fine = least * FINE
    some = docs.where(F.pmod(F.xxhash64("doc_id", "_row"), F.lit(SAMPLE)) == 0)
    n = np.zeros(fine)
    for r in some.mapInArrow(_bucket_counts(k, fine, search), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        n[r["bucket"]] = SAMPLE * r["n"]                  # at most ``fine`` rows
    buckets = least
    while buckets < fine and n.sum() > buckets * BUCKET_EDGES / 2:
        buckets *= 2
    return np.maximum(np.ceil(n.reshape(-1, buckets).sum(0) / BUCKET_EDGES), 1).astype(np.int64)


def _edge_blobs(k: int, ways: np.ndarray, search: Search):
    groups, begin = int(ways.sum()), np.cumsum(ways) - ways

    def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
        got = _edges(table, k, search)
        if got is None:
            return
        h, low, doc, row, start = got
        first = _firsts(h)
        again = np.flatnonzero(doc > doc[first])
        pieces = _runs(doc, row, start, again, first[again])
        to = _bucket_of(low, len(ways))
        to = (begin[to] + (mix(h) % ways[to].astype(np.uint64)).astype(np.int64)).astype(np.int32)
        send = np.flatnonzero(doc == doc[first])
        send = send[np.argsort(to[send], kind="stable")]
        cuts = np.searchsorted(to[send], np.arange(groups + 1))
        piece_cuts = np.linspace(0, len(pieces), groups + 1).astype(int)
        rows = []
        for b in range(groups):
            at = send[cuts[b]:cuts[b + 1]]
            own = pieces[piece_cuts[b]:piece_cuts[b + 1]]
            if not len(at) and not len(own):
                continue
            ids, keys = doc[at], row[at]
            new = np.ones(len(at), dtype=bool)
            new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
            marks = np.flatnonzero(new)
            places = np.diff(start[at], prepend=np.int32(0)).astype(np.int32)
            rows.append((b, h[at].tobytes(), np.diff(ids[marks], prepend=np.int64(0)).tobytes(), keys[marks].tobytes(),
                         np.diff(np.append(marks, len(at))).astype(np.int32).tobytes(), places.tobytes(), own.tobytes()))
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
                                             names=["bucket", "hashes", "docs", "rows", "counts", "places", "pieces"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                held.append(part)
                size += part.column(1).nbytes
                if size >= CHUNK_BYTES:
                    yield from emit(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield from emit(pa.Table.from_batches(held))

    return run


def _repeats(table: pa.Table) -> pa.Table:
    """One bucket: pieces whose edges start in a smaller document."""
    cols = [table[c].to_pylist() for c in ("hashes", "docs", "rows", "counts", "places", "pieces")]
    hs, ds, rs, ps, done = [], [], [], [], []
    for h, docs, rows, counts, places, pieces in zip(*cols):
        many = np.frombuffer(counts, np.int32)
        hs.append(np.frombuffer(h, np.uint64))
        ds.append(np.repeat(np.cumsum(np.frombuffer(docs, np.int64)), many))
        rs.append(np.repeat(np.frombuffer(rows, np.int64), many))
        ps.append(np.cumsum(np.frombuffer(places, np.int32), dtype=np.int32))
        done.append(np.frombuffer(pieces, _PIECE_NP))
    h, doc, row, start = np.concatenate(hs), np.concatenate(ds), np.concatenate(rs), np.concatenate(ps)
    order = np.argsort(h, kind="stable")
    sh = h[order]
    same = np.zeros(len(h), dtype=bool)
    same[1:] = sh[1:] == sh[:-1]
    same[:-1] |= same[1:].copy()
    at = order[same]                       # entries whose hash comes more than once
    at = at[np.lexsort((start[at], row[at], doc[at]))]
    src = at[_firsts(h[at])]
    again = doc[at] > doc[src]
    out = np.concatenate([_runs(doc, row, start, at[again], src[again]), *done])
    return pa.table({n: np.ascontiguousarray(out[n]) for n in _PIECE_NP.names})


def _join_pieces(batches):
    """Pieces sorted by (doc, row, src, src row, start - src_start, start) joined into maximal paths."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        x = {n: batch.column(n).to_numpy() for n in _PIECE_NP.names}
        if held is not None:
            x = {n: np.concatenate([held[n], x[n]]) for n in x}
        end = x["start"] + x["n"]
        diag = x["start"].astype(np.int64) - x["src_start"]
        same = diag[1:] == diag[:-1]
        for n in ("doc_id", "_row", "src_doc", "src_row"):
            same &= x[n][1:] == x[n][:-1]
        group = np.concatenate([[0], np.cumsum(~same)])
        top = np.maximum.accumulate(end.astype(np.int64) + group * (1 << 32)) - group * (1 << 32)
        new = np.ones(len(end), dtype=bool)
        new[1:] = ~same | (x["start"][1:] > top[:-1])
        at = np.flatnonzero(new)
        out = {n: x[n][at] for n in x}
        out["n"] = (np.maximum.reduceat(top, at) - out["start"]).astype(np.int32)
        held = {n: out[n][-1:] for n in out}
        if len(at) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(out[n][:-1]) for n in _PIECE_NP.names], names=list(_PIECE_NP.names))
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(held[n]) for n in _PIECE_NP.names], names=list(_PIECE_NP.names))


def _blobs(docs: DataFrame, k: int, search: Search | None = None) -> DataFrame:
    search = search or Search(bits=HASH_BITS)
    docs = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .withColumn("_row", F.xxhash64("text"))
            .where(F.col("doc_id").isNotNull() & (F.length("text") >= 2 * k - 1)))
    return docs.mapInArrow(_edge_blobs(k, _ways(docs, k, 2 * partitions(docs), search), search), _BLOB)


def repeat_paths(docs: DataFrame, k: int = K) -> DataFrame:
    """Maximal repeated paths (doc_id, _row, start, n edges, src_doc, src_row, src_start); not yet verified."""
    return _paths(_blobs(docs, k))


def _paths(blobs: DataFrame) -> DataFrame:
    pieces = blobs.groupBy("bucket").applyInArrow(_repeats, _PIECE)
    return (pieces.repartition("doc_id")
            .sortWithinPartitions("doc_id", "_row", "src_doc", "src_row", F.col("start") - F.col("src_start"), "start")
            .mapInArrow(_join_pieces, _PIECE))


def _digest(words: list[bytes], start: int, n: int, k: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[start:start + n + k - 1]), digest_size=16).digest()


def _cut(k: int, with_text: bool):
    """Remove the words covered by a document's paths; digest its spans and those that others copy."""
    def run(batches):
        for batch in batches:
            rest = [n for n in batch.schema.names if n not in ("text", "own", "asked")]
            texts, own, asked = (batch.column(n) for n in ("text", "own", "asked"))
            out = {n: [] for n in ("n_words", "n_removed", "kept_sha256", "kept_text", "own_digests", "asked_digests")}
            for i in range(batch.num_rows):
                words = (texts[i].as_py() or "").encode().split()
                spans = own[i].as_py() or []
                if spans:
                    hit = np.zeros(len(words) + 1, np.int32)
                    for s in spans:
                        hit[min(s["start"], len(words))] += 1
                        hit[min(s["start"] + s["n"] + k - 1, len(words))] -= 1
                    gone = np.cumsum(hit[:-1]) > 0
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    kept = words
                body = b" ".join(kept)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(body).hexdigest())
                out["kept_text"].append(None if not with_text else body.decode() if spans else texts[i].as_py() or "")
                out["own_digests"].append([_digest(words, s["start"], s["n"], k) for s in spans])
                out["asked_digests"].append([_digest(words, s["src_start"], s["n"], k) for s in asked[i].as_py() or []])
            kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "own_digests": pa.list_(pa.binary()),
                     "asked_digests": pa.list_(pa.binary())}
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in rest] + [own, asked] + [pa.array(v, kinds.get(n, pa.string())) for n, v in out.items()],
                names=[*rest, "own", "asked", *out])

    return run


_RESULT = ("n_words", "n_removed", "kept_sha256", "kept_text")


def _apply(docs: DataFrame, paths: DataFrame, k: int, with_text: bool) -> DataFrame:
    own = paths.groupBy("doc_id", "_row").agg(F.collect_list(F.struct("start", "n", "src_doc", "src_row", "src_start")).alias("own"))
    asked = (paths.select(F.col("src_doc").alias("doc_id"), F.col("src_row").alias("_row"), "src_start", "n").distinct()
             .groupBy("doc_id", "_row").agg(F.collect_list(F.struct("src_start", "n")).alias("asked")))
    spans = own.join(asked, ["doc_id", "_row"], "full").withColumnsRenamed({"doc_id": "_key", "_row": "_key_row"})
    base = docs.withColumn("_row", F.xxhash64("text"))
    base = base.join(spans, (F.col("doc_id") == F.col("_key")) & (F.col("_row") == F.col("_key_row")), "left").drop("_key", "_key_row")
    extra = ("n_words long, n_removed long, kept_sha256 string, kept_text string, "
             "own_digests array<binary>, asked_digests array<binary>")
    rest = [f for f in base.schema.fields if f.name not in ("text", "own", "asked")]
    tail = [T.StructField(n, base.schema[n].dataType) for n in ("own", "asked")]
    schema = T.StructType(rest + tail + T._parse_datatype_string(extra).fields)
    return base.mapInArrow(_cut(k, with_text), schema)


def _unverified(cut: DataFrame) -> DataFrame | None:
    """Paths of ``cut`` (doc_id, _row, start, src_doc, src_row, src_start, n) whose span differs from its source, if there are any."""
    asked = (cut.select(F.col("doc_id").alias("src_doc"), F.col("_row").alias("src_row"), F.explode(F.arrays_zip("asked", "asked_digests")).alias("a"))
             .select("src_doc", "src_row", "a.asked.src_start", "a.asked.n", F.col("a.asked_digests").alias("src_digest")).distinct())
    own = (cut.select("doc_id", "_row", F.explode(F.arrays_zip("own", "own_digests")).alias("o"))
           .select("doc_id", "_row", "o.own.*", F.col("o.own_digests").alias("digest")))
    key = ["src_doc", "src_row", "src_start", "n"]
    told = asked.groupBy(*key).agg(F.collect_set("src_digest").alias("sources"))
    distinct = own.select(*key, "digest").distinct().join(told, key, "left")
    bad = distinct.where(~F.coalesce(F.array_contains("sources", F.col("digest")), F.lit(False))).select(*key, "digest")
    bad = written(bad, "unverified")
    if bad.isEmpty():
        return None
    return written(own.join(bad, [*key, "digest"]).select("doc_id", "_row", "start", *key).distinct(), "wrong")


def _sieve_of(docs: DataFrame, wrong: DataFrame, k: int) -> bytes:
    """Bitmap of the hashes (turn 0) of the edges of the dropped paths; SIEVE bits whatever their number."""
    bits = HASH_BITS

    def places(batches):
        for batch in batches:
            got = []
            for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
                h = windows(word_hashes(pa.array([text.as_py()], pa.string())).hashes, k) & np.uint64(2 ** bits - 1)
                got += [h[s["start"]:s["start"] + s["n"]] % np.uint64(SIEVE) for s in spans]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got).astype(np.int64) if got else np.zeros(0, np.int64))], names=["place"])

    row = ["doc_id", "_row"]
    spans = wrong.groupBy(*row).agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    found = docs.withColumn("_row", F.xxhash64("text")).select(*row, "text").dropDuplicates(row).join(spans, row) \
        .select("text", "spans").mapInArrow(places, "place long")
    page = 1 << 15                                         # bits of a bitmap: at most SIEVE / page rows
    maps = found.groupBy(F.expr(f"place div {page}").alias("page")).agg(F.expr(f"bitmap_construct_agg(place % {page})").alias("bits")).collect()
    out = np.zeros(SIEVE // 8, np.uint8)
    for r in maps:
        out[r["page"] * page // 8:(r["page"] + 1) * page // 8] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def _again(docs: DataFrame, paths: DataFrame, wrong: DataFrame, k: int, with_text: bool, turn: int):
    """Rows with dropped paths, cut by their verified paths and those that another family of hashes finds:
    (cut of those rows and their sources, paths used, keys of those rows)."""
    row = ["doc_id", "_row"]
    keyed = docs.withColumn("_row", F.xxhash64("text"))
    ids = written(wrong.select(*row).distinct(), "ids")
    names = list(_PIECE_NP.names)
    good = paths.join(ids, row, "left_semi").join(wrong, [*row, "start", "src_doc", "src_row", "src_start", "n"], "left_anti").select(*names)
    more = _paths(_blobs(docs, k, Search(turn, HASH_BITS, _sieve_of(docs, wrong, k)))).join(ids, row, "left_semi").select(*names)
    found = written(good.unionByName(more).distinct(), "paths")
    sides = ids.unionByName(found.select(F.col("src_doc").alias("doc_id"), F.col("src_row").alias("_row"))).distinct()
    cut = written(_apply(keyed.join(sides, row, "left_semi").drop("_row"), found, k, with_text), "cut")
    return cut, found, ids


def substring_dedup(docs: DataFrame, k: int = K, with_text: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_words, n_removed, kept_sha256 and kept_text (null unless
    ``with_text``; the text itself where nothing goes, else the kept words joined by one space) in
    place of ``text``; see the module docstring for the rules."""
    docs = docs.drop(*[c for c in (*_RESULT, "own", "asked", "own_digests", "asked_digests", "_key", "_key_row", "_row") if c in docs.columns])
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string"))
    paths = written(repeat_paths(docs, k), "paths")
    cut = written(_apply(docs, paths, k, with_text), "cut")
    out = [f.name for f in docs.schema.fields if f.name != "text"] + list(_RESULT)
    row, mine, done, turn = ["doc_id", "_row"], cut, [], 0
    while (wrong := _unverified(cut)) is not None:
        turn += 1
        cut_again, paths, ids = _again(docs, paths, wrong, k, with_text, turn)
        done.append(mine.join(ids, row, "left_anti"))     # null ids have no paths: the anti join keeps them
        cut, mine = cut_again, cut_again.join(ids, row, "left_semi")
    return reduce(DataFrame.unionByName, [d.select(*out) for d in (*done, mine)])
