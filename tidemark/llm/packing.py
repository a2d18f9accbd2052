"""Best-fit packing of token pieces into sequences by patterns from non-negative least squares.

1. Every document is encoded once and closed with an end id.  Documents longer
   than a sequence are cut into full pieces; the first piece takes the rest.
2. The histogram of piece lengths (at most ``size`` + 1 rows whatever the corpus)
   is all that the driver sees.
3. *Patterns*: a full piece alone, all pairs that fill a sequence, and triples
   that fill one, on a grid of the most frequent lengths.  Repeat counts come
   from minimising |A x - histogram| over x >= 0 (projected gradient with
   momentum), are rounded down and kept within what the histogram still has.
4. *Residuals* are packed on the histogram as well: lengths in descending order
   go to the bins with the least room that fits.  Equal bins are one record with a
   count, so the work depends on ``size`` alone.
5. The plan says, for every length, which ranks of its pieces go to which
   pattern, repeat and offset.  Pieces are ranked per length by the skew-safe ranker and
   look their place up in the plan, whose rows are bounded by patterns and
   lengths.

Rules: null text is empty (its piece is the end id alone); rows that repeat a
doc_id are packed each; extra columns are ignored.
"""

from __future__ import annotations

import base64
import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import written
from tidemark.llm.token_counts import model_file
from tidemark.operators.ranking import group_row_number

RANKS, MODEL = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"     # the same vocabulary as ranks and as the library's file
SIZE, END_ID = 1024, 2
TRIPLES = 6000
STEPS = 300
SHARES = (1.0, 0.95, 0.8, 0.5, 0.2)


@lru_cache(maxsize=1)
def encoder(name: str):
    """The byte-level vocabulary (the same ids as its .json form, special strings included)."""
    import public_tokenizers
    import tiktoken
    with open(model_file(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(model_file(MODEL), encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cuts(n: int, size: int) -> list[int]:
    """Starts of the pieces of a document of n tokens; only the first may be shorter than size."""
    if n <= size:
        return [0]
    first = n % size or size
    return [0, *range(first, n, size)]


def _pieces(model: str, size: int, with_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]

    def run(batches):
        enc = encoder(model)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                out = []
                part = batch.slice(a, 1000)
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.array([*enc.encode(text or "", allowed_special="all"), END_ID], dtype="<u4")
                    at = cuts(len(ids), size)
                    for i, (s, e) in enumerate(zip(at, [*at[1:], len(ids)])):
                        out.append((doc, i, s, e - s, zlib.crc32(ids[s:e].tobytes()), ids[s:e].astype(np.int32) if with_ids else None))
                cols = list(zip(*out)) or [()] * 6
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return run


def pieces(docs: DataFrame, model: str = RANKS, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_pieces(model, size, with_ids),
                           "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>")


def fill_patterns(histogram: np.ndarray, size: int, triples: int = TRIPLES) -> np.ndarray:
    """Patterns of up to three lengths (0: none) that fill a sequence and whose lengths occur."""
    there = histogram > 0
    rows = [(size, 0, 0)] if there[size] else []
    rows += [(a, size - a, 0) for a in range(1, size // 2 + 1) if there[a] and there[size - a]]
    often = np.argsort(-histogram[1:size], kind="stable")[:int(np.sqrt(triples * 4))] + 1
    often = np.sort(often[there[often]])
    three = [(int(a), int(b), size - int(a) - int(b)) for i, a in enumerate(often) for b in often[i:]
             if size - a - b >= b and there[size - a - b]]
    step = max(1, -(-len(three) // triples))
    return np.array(rows + three[::step], dtype=np.int64).reshape(-1, 3)


def nnls(patterns: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 minimising |A x - histogram|, A holding how often a pattern uses a length.

    Scaled by the square root of what each length needs, so that rare lengths count too.
    """
    size = len(histogram)
    weight = np.where(histogram > 0, 1 / np.sqrt(np.maximum(histogram, 1.0)), 0.0)
    weight[0] = 0
    flat = patterns.reshape(-1)
    forward = lambda x: np.bincount(flat, np.repeat(x, 3), size) * weight
    back = lambda r: (weight * r)[patterns].sum(axis=1)                    # noqa: E731
    target = histogram * weight
    target[0] = 0
    v = np.ones(len(patterns))
    for _ in range(30):                      # largest curvature by power iteration
        v = back(forward(v))
        top = np.linalg.norm(v) or 1.0
        v /= top
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(forward(y) - target) / (1.05 * top))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit(left: np.ndarray, size: int) -> list[tuple[list[int], int]]:
    """(lengths, repeats) of bins for the pieces in ``left``, by best fit on counts."""
    bins: list[list[list]] = [[] for _ in range(size + 1)]      # by room: [lengths, repeats]
    for n in range(size, 0, -1):
        need = int(left[n])
        room = n
        while need and room <= size:
            records, bins[room] = bins[room], []
            for k, (lengths, repeats) in enumerate(records):
                if not need:
                    bins[room] += records[k:]
                    break
                fit = room // n
                whole = min(repeats, need // fit)
                if whole:
                    bins[room - fit * n].append([lengths + [n] * fit, whole])
                    need -= whole * fit
                    repeats -= whole
                if repeats and need:
                    part = min(need, fit)
                    bins[room - part * n].append([lengths + [n] * part, 1])
                    need -= part
                    repeats -= 1
                if repeats:
                    bins[room].append([lengths, repeats])
            room += 1
        if need:
            fit = size // n
            if need // fit:
                bins[size - fit * n].append([[n] * fit, need // fit])
            if need % fit:
                bins[size - need % fit * n].append([[n] * (need % fit), 1])
    return [(lengths, repeats) for room in bins for lengths, repeats in room]


def _round(patterns: np.ndarray, repeats: np.ndarray, histogram: np.ndarray, size: int):
    """Whole repeats of patterns within the histogram, then best fit for the rest."""
    left, chosen = histogram.astype(np.int64).copy(), []
    for i in np.argsort(-repeats, kind="stable"):
        lengths = [int(n) for n in patterns[i] if n]
        r = min([int(repeats[i]), *[int(left[n]) // lengths.count(n) for n in set(lengths)]])
        if r > 0:
            chosen.append((lengths, r))
            np.subtract.at(left, lengths, r)
    return chosen + best_fit(left, size)


def plan(histogram: np.ndarray, size: int = SIZE) -> dict[str, np.ndarray]:
    """For each length the rank intervals of its pieces: (length, first rank, pieces per
    repeat, first sequence, offset of the first of them), sorted by length and rank.

    Rounding down leaves residuals; a smaller share of every count leaves more of them, which
    pack better where counts are small.  The share with the fewest sequences wins.
    """
    patterns = fill_patterns(histogram, size)
    counts = nnls(patterns, histogram.astype(float)) if len(patterns) else np.zeros(0)
    chosen = min((_round(patterns, np.floor(counts * share + 1e-9).astype(np.int64), histogram, size) for share in SHARES),
                 key=lambda c: sum(r for _, r in c))
    used = np.zeros(size + 1, np.int64)
    rows, sequence = [], 0
    for lengths, r in chosen:
        place = 0
        for n in sorted(set(lengths), reverse=True):
            many = lengths.count(n)
            rows.append((n, used[n], many, sequence, place))
            used[n] += many * r
            place += many * n
        sequence += r
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "many", "sequence", "offset"), table.T)) | {"sequences": np.array(sequence)}


def _place(p: dict[str, np.ndarray]):
    key = p["length"] * (1 << 44) + p["rank"]

    def run(batches):
        for batch in batches:
            n, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy() - 1
            i = np.searchsorted(key, n * (1 << 44) + rank, "right") - 1
            inside = rank - p["rank"][i]
            rest = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + [pa.array(p["sequence"][i] + inside // p["many"][i]),
                                                   pa.array(p["offset"][i] + inside % p["many"][i] * n)],
                names=[*rest, "sequence_id", "offset"])

    return run


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """Add sequence_id and offset to ``cut`` (length, ...), whose columns doc_id and piece order equal lengths."""
    histogram = np.zeros(size + 1, np.int64)
    for r in cut.groupBy("length").count().collect():     # at most ``size`` rows
        histogram[r["length"]] = r["count"]
    if not histogram.any():
        return cut.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    ranked = group_row_number(cut, ["length"], ["doc_id", "piece"], "rank")
    schema = cut.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.withColumn("rank", F.col("rank").cast("long")).mapInArrow(_place(plan(histogram, size)), schema)


def pack_documents(docs: DataFrame, size: int = SIZE, model: str = RANKS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids (null unless ``with_ids``), sequence_id, offset."""
    if not with_ids:
        return pack(written(pieces(docs, model, size), "pieces"), size)
    # the ids are written once and meet their places again by row; only the narrow columns are ranked
    cut = written(pieces(docs, model, size, True).withColumn("_at", F.monotonically_increasing_id()), "pieces")
    return pack(cut.drop("ids"), size).join(cut.select("_at", "ids"), "_at").drop("_at")
