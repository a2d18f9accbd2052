"""Cross-tokenizer alignment by pointer jumping.

1. A task encodes each whole text with both tokenizers and takes the byte ranges of the
   tokens from tables of token bytes.
2. Every token points to the farthest-right token that overlaps it; a token that none
   overlaps beyond its end points to itself (of two tokens that end together, B's points to
   A's).  Doubling, ``next = next[next]`` on whole arrays, brings every token in as many steps
   as the logarithm of the longest chain to the last A token of its component.  That token
   labels the group; its end is a place where tokens of both sides end.
3. Two tokens that end together are linked.  The links of a document are kept as (pair,
   times), pairs of ids coded as one number.
4. Links per pair, corpus-wide, and the highest of each B id are aggregates (combined
   map-side).  The table of pairs is broadcast if it holds at most ``BROADCAST_PAIRS`` rows,
   else joined by a shuffle; the links of a document are then added up per document.

Rules: null and empty texts, and texts whose tokens do not spell space + text on both sides,
have no tokens: zeros and ''.  Rows that repeat a doc_id are aligned each and all count; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import written
from tidemark.llm.token_counts import model_file
from tidemark.llm.words import slices, text_buffers

A_RANKS, B_MODEL = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
SLICE = 1 << 21               # bytes of text aligned at a time
BROADCAST_PAIRS = 1 << 20
MARK = "▁"


class Side:
    """Token bytes as one buffer with offsets."""

    def __init__(self, strings: list[bytes]):
        self.buffer = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.size = np.array([len(s) for s in strings], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.buffer, self.start[ids], self.size[ids])


def gather(buffer: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces buffer[start:start + size], one after another."""
    before = np.cumsum(size) - size
    return buffer[np.arange(int(size.sum())) + np.repeat(start - before, size)]


class Pair:
    """Both tokenizers; A is the byte-level vocabulary (the ids of its .json form), B the piece model."""

    def __init__(self, a: str, b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        with open(model_file(a), "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        self._a = tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        names = {i: t for t, i in ranks.items()}
        self.a = Side([names.get(i, b"") for i in range(max(names) + 1)])
        self._b = sentencepiece.SentencePieceProcessor(model_file=model_file(b))
        pieces = [(self._b.is_byte(i), self._b.id_to_piece(i)) for i in range(self._b.get_piece_size())]
        self.b = Side([bytes([int(p[3:5], 16)]) if is_byte else p.replace(MARK, " ").encode() for is_byte, p in pieces])
        if not self.a.size[list(ranks.values())].all() or not self.b.size.all():
            raise ValueError("a token without bytes ends where another does")
        self.base = len(pieces)
        digits = [f"{i};".encode() for i in range(max(len(self.a.size), self.base))]
        self.digits = Side(digits)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [self._a.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        b = [np.asarray(x) for x in self._b.encode(texts, num_threads=1, return_type="numpy")] if texts else []
        return a, b


@lru_cache(maxsize=1)
def pair(a: str, b: str) -> Pair:
    return Pair(a, b)


def components(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terminal token (number of an A token) of every A and B token, for ascending ends over one text.

    The farthest-right token that overlaps a token is the other side's that holds its last byte.
    """
    n = len(end_a)
    over_a = np.searchsorted(end_b, end_a)
    succ = np.concatenate([np.where(end_b[over_a] > end_a, n + over_a, np.arange(n)), np.searchsorted(end_a, end_b)]) if n else np.zeros(0, np.int64)
    while True:
        jumped = succ[succ]
        if np.array_equal(jumped, succ):
            return succ[:n], succ[n:]
        succ = jumped


@dataclass
class Aligned:
    """Tokens of the texts that both sides spell, and their groups."""
    n_a: np.ndarray             # per text
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[bytes]
    pair_sizes: np.ndarray
    pairs: np.ndarray           # distinct per text
    times: np.ndarray


def _spelt(p: Pair, ids: list[np.ndarray], side: Side, want: list[bytes]) -> np.ndarray:
    size = np.array([int(side.size[x].sum()) for x in ids], dtype=np.int64)
    ok = size == np.array([len(w) for w in want])
    at = np.flatnonzero(ok)
    if len(at):
        got = side.spell(np.concatenate([ids[i] for i in at]))
        wrong = got != np.frombuffer(b"".join(want[i] for i in at), dtype=np.uint8)
        if wrong.any():
            edge = np.cumsum(size[at])
            ok[at[np.unique(np.searchsorted(edge, np.flatnonzero(wrong), "right"))]] = False
    return ok


def align_texts(p: Pair, texts: list[str]) -> Aligned:
    many = len(texts)
    ids_a, ids_b = p.encode(texts)
    want = [b" " + t.encode() for t in texts]
    ok = _spelt(p, ids_a, p.a, want) & _spelt(p, ids_b, p.b, want) & np.array([bool(t) for t in texts], dtype=bool)
    n_a = np.where(ok, [len(x) for x in ids_a], 0)
    n_b = np.where(ok, [len(x) for x in ids_b], 0)
    if not ok.any():
        zero = np.zeros(many, dtype=np.int64)
        return Aligned(zero, zero, zero, [b""] * many, zero, zero[:0], zero[:0])
    a = np.concatenate([ids_a[i] for i in np.flatnonzero(ok)]).astype(np.int64)
    b = np.concatenate([ids_b[i] for i in np.flatnonzero(ok)]).astype(np.int64)
    # the texts stand one after another: both sides end at the end of each, so no component crosses
    end_a, end_b = np.cumsum(p.a.size[a]), np.cumsum(p.b.size[b])
    last_a, last_b = components(end_a, end_b)
    last = np.flatnonzero(last_a == np.arange(len(a)))
    group_a, group_b = np.searchsorted(last, last_a), np.searchsorted(last, last_b)
    doc_a = np.repeat(np.arange(many), n_a)
    doc = doc_a[last]
    n_groups = np.bincount(doc, minlength=many)
    code = a[last] * p.base + b[np.searchsorted(end_b, end_a[last])]
    width = int(len(p.a.size)) * p.base
    linked, times = np.unique(doc * width + code, return_counts=True)
    # "a1,a2|b1;a3|b2": tokens by group, A before B; the separator after a token shows what follows
    side = np.concatenate([group_a * 2, group_b * 2 + 1])
    order = np.argsort(side, kind="stable")
    side, token = side[order], np.concatenate([a, b])[order]
    size = p.digits.size[token]
    out = gather(p.digits.buffer, p.digits.start[token], size)
    end = np.cumsum(size)
    step = np.diff(side, append=side[-1] + 2)
    out[end - 1] = np.where(step == 0, ord(","), np.where((step == 1) & (side % 2 == 0), ord("|"), ord(";")))
    length = np.bincount(doc[side // 2], weights=size, minlength=many).astype(np.int64)
    stop = np.cumsum(length)
    data = out.tobytes()
    groups = [data[e - n:e - 1] if n else b"" for e, n in zip(stop.tolist(), length.tolist())]
    return Aligned(n_a, n_b, n_groups, groups, np.bincount(linked // width, minlength=many), linked % width, times)


def _align(a: str, b: str, with_groups: bool):
    def run(batches):
        p = pair(a, b)
        for batch in batches:
            offs = text_buffers(batch.column("text"))[1]
            for i, j in slices(offs, SLICE):
                part = batch.slice(i, j - i)
                got = align_texts(p, [t or "" for t in part.column("text").to_pylist()])
                at = pa.array(np.concatenate([[0], np.cumsum(got.pair_sizes)]), pa.int32())
                digest = [hashlib.sha256(g).hexdigest() if g else "" for g in got.groups]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(x, pa.int64()) for x in (got.n_a, got.n_b, got.n_groups)], pa.array(digest, pa.string()),
                     pa.array([g.decode() for g in got.groups] if with_groups else [None] * part.num_rows, pa.string()),
                     pa.ListArray.from_arrays(at, pa.array(got.pairs, pa.int64())), pa.ListArray.from_arrays(at, pa.array(got.times, pa.int32()))],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "groups", "pairs", "times"])

    return run


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, groups string, pairs array<long>, times array<int>"


def pair_counts(links: DataFrame, base: int) -> DataFrame:
    """pair, count, best (1 if the count is the highest of the pair's B id, ties included)."""
    counts = written(links.groupBy("pair").agg(F.sum("times").alias("count")).withColumn("b", F.col("pair") % base), "pairs")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))        # at most one row a B id
    return counts.join(top, "b").select("pair", "count", (F.col("count") == F.col("top")).cast("long").alias("best"))


def align(docs: DataFrame, a: str = A_RANKS, b: str = B_MODEL, with_groups: bool = False, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256 and, ``with_groups``, the groups themselves (else null)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = written(docs.mapInArrow(_align(a, b, with_groups), _ALIGNED).withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = rows.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), "times")))
    counts = written(pair_counts(links, pair(a, b).base), "pair-counts")
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum("times").alias("n_links"), F.sum(F.col("times") * F.col("best")).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    total = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", total("n_links"), total("n_best"),
                                                 total("count_sum"), "groups_sha256", "groups")
