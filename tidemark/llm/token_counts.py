"""Token counts of whole texts; huge documents are counted in overlapping chunks.

A huge document becomes chunks of ``chunk`` characters, each read with ``overlap`` more on both
sides, so that many tasks share it.  A chunk is encoded with offsets.  Chunks are spliced at *stable
boundaries*: places where a space mark follows another character.  No piece of the model
holds a space mark after another character (checked when the model is loaded), so no merge
crosses such a place, and tokens on both sides are those of the whole text.  A chunk counts the
tokens from the first stable boundary at or after its start to the first one at or after its
end; both chunks at a seam look for the same boundary.

Where the overlap shows none, or the encoding has no token edge there, the chunk stays open.
Neighbours that are open miss the same boundary: they become one span, which is encoded again
with an overlap of a whole chunk to its right, where the next chunk has seen the boundary (then
doubled, until it has or reaches the end of the text).  So a text without boundaries, however
long, is sent to the encoder twice and not once per chunk and round.  Texts are cut in one pass.

Rules: null text is empty (0 tokens, 0 bytes); rows that repeat a doc_id are
counted each; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import written

MODEL = "piece_bpe_32k.model"
CHUNK, OVERLAP = 1 << 15, 256
MARK = "▁"
_STABLE = re.compile(f"(?<=[^ {MARK}])[ {MARK}]")
BATCH = 128                   # texts encoded at a time
CUT = 1 << 22                 # characters of pieces sent on at a time


def model_file(name: str) -> str:
    """A path as given, or the place of a public tokenizer's file (on the executor that asks)."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def processor(name: str):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file(name))
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if any(b == MARK and a != MARK for a, b in zip(piece, piece[1:])):
            raise ValueError(f"piece {piece!r} crosses a space: no boundary of this model is stable")
    return sp


def splice(sp, text: str, at: int, start: int, end: int, to_end: bool) -> int | None:
    """Tokens of the document between the stable boundaries at or after start and end.

    ``text`` is the document from ``at`` on, up to its end if ``to_end``: the end
    is then the last boundary.  None: the overlap is too small.
    """
    size = len(text)

    def boundary(place):
        if place == 0:
            return 0
        got = _STABLE.search(text, max(place - at, 1))
        if got is not None:
            return got.start()
        return size if to_end else None

    lo, hi = boundary(start), boundary(end)
    if lo is None or hi is None:
        return None
    if lo == hi:
        return 0
    if (lo, hi) == (0, size):
        return len(sp.encode([text], num_threads=1, return_type="numpy")[0])
    begins = [b for b, _ in sp.encode(text, return_type="offset_mapping")["offsets"]]
    edges = [bisect.bisect_left(begins, x) for x in (lo, hi)]
    for x, i in zip((lo, hi), edges):
        if 0 < x < size and (i == len(begins) or begins[i] != x):
            return None
    return edges[1] - edges[0]


def _count(model: str):
    def run(batches):
        sp = processor(model)
        for batch in batches:
            col, n = batch.column("text"), []
            for a in range(0, batch.num_rows, BATCH):
                n += [len(x) for x in sp.encode([t or "" for t in col.slice(a, BATCH).to_pylist()], num_threads=1, return_type="numpy")]
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(n, pa.int64())], names=[*rest, "n_tokens"])

    return run


def _splice_batch(model: str):
    def run(batches):
        sp = processor(model)
        for batch in batches:
            n = [splice(sp, r["piece"], r["at"], r["start"], r["end"], r["to_end"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "copy", "start", "end")] + [pa.array(n, pa.int64())],
                                             names=["doc_id", "copy", "start", "end", "n"])

    return run


def _cut(left: int, right: int):
    """Pieces of texts for their spans, with ``left`` and ``right`` characters more."""
    names = ["doc_id", "copy", "start", "end", "at", "to_end", "piece"]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 7, kinds)], names=names)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                doc, copy, text, spans = (batch.column(c)[i].as_py() for c in ("doc_id", "copy", "text", "spans"))
                rows, size = [], 0
                for span in spans:
                    start, end = span["start"], span["end"]
                    at = max(start - left, 0)
                    rows.append((doc, copy, start, end, at, end + right >= len(text), text[at:end + right]))
                    size += len(rows[-1][-1])
                    if size > CUT:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)

    return run


def _pieces(huge: DataFrame, spans: DataFrame, left: int, right: int) -> DataFrame:
    """The pieces to encode for spans (_id, _copy, spans) of huge texts."""
    same = huge.doc_id.eqNullSafe(spans["_id"]) & (huge.copy == spans["_copy"])
    rows = huge.join(spans, same).select("doc_id", "copy", "text", "spans")
    return rows.mapInArrow(_cut(left, right), "doc_id long, copy string, start int, end int, at int, to_end boolean, piece string")


def _span_counts(pieces: DataFrame, model: str) -> DataFrame:
    """doc_id, copy, start, end, n: tokens of each span, null where the overlap is too small."""
    return pieces.repartition("doc_id", "start").mapInArrow(_splice_batch(model), "doc_id long, copy string, start int, end int, n long")


def _merged(open_: DataFrame) -> DataFrame:
    """Neighbouring open spans as one: _id, _copy, spans.  A group holds the open chunks of one document."""
    in_order = Window.partitionBy("doc_id", "copy").orderBy("start")
    first = F.coalesce(F.lag("end").over(in_order) != F.col("start"), F.lit(True))
    runs = open_.withColumn("first", first).withColumn("run", F.sum(F.col("first").cast("int")).over(in_order)) \
        .groupBy("doc_id", "copy", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for every row of ``docs`` (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    small = docs.where(F.length("text") <= chunk).select("doc_id", n_bytes, "text") \
        .mapInArrow(_count(model), "doc_id long, n_bytes long, n_tokens long")
    rows = docs.where(F.length("text") > chunk).select("doc_id", n_bytes, F.md5("text").alias("copy"), "text", F.length("text").alias("n_chars"))
    huge = rows.dropDuplicates(["doc_id", "copy"]).select("doc_id", "copy", "text", "n_chars")
    start = F.sequence(F.lit(0), F.col("n_chars") - 1, F.lit(chunk))
    spans = huge.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"),
                        F.transform(start, lambda x: F.struct(x.alias("start"), (x + chunk).alias("end"))).alias("spans"))
    done = written(_span_counts(_pieces(huge, spans, overlap, overlap), model), "chunks")
    parts, right = done.where("n is not null"), chunk + overlap
    while not (open_ := done.where("n is null")).isEmpty():
        done = written(_span_counts(_pieces(huge, _merged(open_), overlap, right), model), "chunks")
        parts, right = parts.unionByName(done.where("n is not null")), 2 * right
    sums = parts.groupBy("doc_id", "copy").agg(F.sum("n").alias("n_tokens"))
    large = rows.select("doc_id", "n_bytes", "copy").alias("r").join(
        sums.alias("s"), F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("r.copy") == F.col("s.copy"))) \
        .select("r.doc_id", "n_bytes", "n_tokens")
    return small.unionByName(large).withColumn("over_limit", F.col("n_tokens") > limit)
