"""Near-duplicate documents by BagMinHash over word shingles.

A document is the multiset of its 5-word shingles (all its words if it has fewer
than five); two documents are near copies when the weighted Jaccard similarity
of their multisets, sum of minima over sum of maxima, is at least 0.8.

1. *Signature* (``signatures``).  The weight axis of a shingle is cut into the
   levels [0,1), [1,2), [2,4), [4,8), ...  Every (shingle, level) owns a Poisson
   process whose rate is the width of the level; each point has a time, a weight
   position inside the level and a slot of the signature.  A document with
   weight w sees the points below w, so two documents see the same points up to
   the smaller weight.  A slot keeps its earliest time: slots of two documents
   agree with a probability equal to their weighted Jaccard similarity.  Points
   are generated in ascending time and only up to a bound per document; if a
   slot stays empty, the document's bound is doubled.  The result does not
   depend on the bound.
2. *Copies.*  Equal texts collapse to their smallest doc_id (a map-side combined
   aggregate), so a group of thousands of copies costs one row from here on.
3. *Bands.*  45 bands of 7 slots: a pair at 0.8 is missed with probability 3e-5.
4. *Verification, first round.*  A bucket's head is its smallest document; every
   document is compared with the head that it shares most buckets with.  Texts travel to (head, salt) groups, so the head of a
   huge group is copied once per group of members and no group is collected.
5. *Second round.*  Links already make most buckets one component.  Where a
   bucket holds several, the members outside its largest component meet all
   members of other components, block by block (``_cross_links``).  One bit per slot
   tells how far two signatures differ: pairs five standard deviations beyond
   what 0.8 gives are dropped, the others are compared in their first common bucket.  A
   block returns only links that join two components, so no list of pairs arises.
6. *Classes* are the connected components of the verified links.

Rules: null or wordless texts are alone in their class; a null doc_id has no
class (null) and is kept; rows that repeat a doc_id share a class; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import written
from tidemark.llm.words import mix, powers, slices, text_buffers, windows, within, word_hashes

SHINGLE = 5
BANDS, ROWS = 45, 7
WORDS64 = -(-BANDS * ROWS // 64)     # long words for one bit per slot
SLICE_BYTES = 1 << 21
SLICE_DOCS = 4000             # the document's number takes 12 bits of a sort key
MEMBERS = 64                  # members compared with one copy of a head
BLOCK = 512                   # members of a bucket on one side of a comparison
_U = np.uint64


def multisets(col, size: int = SHINGLE):
    """Per document of ``col`` (at most SLICE_DOCS): offsets into (shingle, count), shingles ascending."""
    w = word_hashes(col)
    h = windows(w.hashes, size)
    ok = np.flatnonzero(within(w.first, size, len(w.hashes)))
    doc = w.doc()[ok].astype(np.uint64) if len(ok) else np.zeros(0, np.uint64)
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < size))
    one = np.array([windows(w.hashes[w.first[i]:w.first[i + 1]], int(n[i]))[0] for i in short], np.uint64)
    key = np.concatenate([(doc << _U(52)) | (h[ok] >> _U(12)), (short.astype(np.uint64) << _U(52)) | (one >> _U(12))])
    key.sort()
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(key)))
    key = key[at]
    first = np.searchsorted(key >> _U(52), np.arange(len(n) + 1))
    return first, key & _U((1 << 52) - 1), count


def _levels(first, shingle, count):
    """(document, seed, rate, lower bound, weight) of every (shingle, level) below the weight."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out, j = [], 0
    while True:
        low = 0 if j == 0 else 1 << (j - 1)
        at = np.flatnonzero(count > low)
        if not len(at):
            break
        seed = mix(shingle[at] * _U(0xD1B54A32D192ED03) + _U(j + 1))
        out.append((doc[at], seed, np.full(len(at), float(max(low, 1))), np.full(len(at), low), count[at]))
        j += 1
    return [np.concatenate(x) for x in zip(*out)] if out else None


def bag_minhash(first, shingle, count, slots: int = BANDS * ROWS) -> np.ndarray:
    """Earliest point time per (document, slot); inf for documents without shingles."""
    n = len(first) - 1
    sig = np.full(n * slots, np.inf)
    got = _levels(first, shingle, count)
    if got is None:
        return sig.reshape(n, slots)
    doc, seed, rate, low, weight = got
    total = np.bincount(np.repeat(np.arange(n), np.diff(first)), count, n)
    bound = slots / np.maximum(total, 1) * (np.log(slots) + 3)
    while len(doc):
        d, s, r, lo, we, t = doc, seed, rate, low, weight, np.zeros(len(doc))
        i = 0
        while len(d):
            i += 1
            s = s + _U(0x9E3779B97F4A7C15)
            u = mix(s)
            t = t - np.log(((u >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / r
            alive = t <= bound[d]
            d, s, r, lo, we, t = d[alive], s[alive], r[alive], lo[alive], we[alive], t[alive]
            v = mix(s ^ _U(0xA0761D6478BD642F))
            width = np.maximum(lo, 1)
            place = lo + ((v >> _U(32)).astype(np.float64) * 2.0**-32 * width).astype(np.int64)
            hit = place < we
            np.minimum.at(sig, d[hit] * slots + ((v[hit] & _U(0xFFFFFFFF)) % _U(slots)).astype(np.int64), t[hit])
        open_ = np.isinf(sig.reshape(n, slots)).any(axis=1) & (total > 0)
        bound = np.where(open_, bound * 2, bound)
        again = open_[doc]
        doc, seed, rate, low, weight = doc[again], seed[again], rate[again], low[again], weight[again]
    return sig.reshape(n, slots)


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    bits = sig.view(np.uint64).reshape(len(sig), bands, rows)
    pw = powers(rows + 1)[1:]
    return mix((mix(bits) * pw).sum(axis=2) + np.arange(1, bands + 1, dtype=np.uint64) * _U(0x2545F4914F6CDD1D)).view(np.int64)


def slot_bits(sig: np.ndarray) -> np.ndarray:
    """One bit per slot in WORDS64 long words: equal slots have equal bits, others in half of all cases."""
    bits = np.zeros((len(sig), WORDS64 * 64), np.uint8)
    bits[:, :sig.shape[1]] = mix(sig.view(np.uint64)) & _U(1)
    return np.packbits(bits, axis=1).view(np.int64)


def most_differing_bits(num: int, den: int, slots: int = BANDS * ROWS) -> int:
    """Bits that differ at similarity num/den: mean and five standard deviations."""
    p = (1 - num / den) / 2
    return int(slots * p + 5 * np.sqrt(slots * p * (1 - p)))


def _doc_slices(col):
    _, offs = text_buffers(col)
    for a, b in slices(offs, SLICE_BYTES):
        for c in range(a, b, SLICE_DOCS):
            yield c, min(c + SLICE_DOCS, b)


def _sign(batches):
    for batch in batches:
        col = batch.column(1)
        for a, b in _doc_slices(col):
            first, shingle, count = multisets(col.slice(a, b - a))
            sig = bag_minhash(first, shingle, count)
            keys = band_keys(sig)
            some = np.diff(first) > 0
            flat = pa.array(keys[some].reshape(-1))
            offs = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                                              pa.ListArray.from_arrays(pa.array(offs), flat), pa.array(list(slot_bits(sig)), pa.list_(pa.int64()))],
                                             names=["doc_id", "copy", "bands", "bits"])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, copy: digest of the text, bands: bucket key per band, empty without words, bits: one per slot)."""
    return docs.select("doc_id", "text", F.md5(F.col("text")).alias("copy")) \
        .mapInArrow(_sign, "doc_id long, copy string, bands array<long>, bits array<long>")


def _verify(num: int, den: int):
    """Rows sorted by (head, salt, kind): a head's text, then its members' texts."""
    def run(batches):
        head, hx, hc = None, None, None
        for batch in batches:
            heads, kinds = batch.column("head").to_numpy(), batch.column("kind").to_numpy()
            ids, col = batch.column("doc_id").to_numpy(), batch.column("text")
            a_out, b_out = [], []
            for a, b in _doc_slices(col):
                first, x, c = multisets(col.slice(a, b - a))
                for i in range(a, b):
                    ox, oc = x[first[i - a]:first[i - a + 1]], c[first[i - a]:first[i - a + 1]]
                    if kinds[i] == 0:
                        head, hx, hc = heads[i], ox, oc
                        continue
                    if head != heads[i] or not len(hx) or not len(ox):
                        continue
                    n, m = int(hc.sum()), int(oc.sum())
                    if den * min(n, m) < num * max(n, m):
                        continue
                    at = np.minimum(np.searchsorted(hx, ox), len(hx) - 1)
                    common = int(np.minimum(hc[at], oc)[hx[at] == ox].sum())
                    if den * common >= num * (n + m - common):
                        a_out.append(head)
                        b_out.append(ids[i])
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return run


def verified(docs: DataFrame, pairs: DataFrame, num: int = 4, den: int = 5) -> DataFrame:
    """Pairs (head, member) whose multiset similarity is at least num/den, as links (a, b)."""
    sizes = pairs.groupBy("head").agg(F.count(F.lit(1)).alias("n"))
    groups = sizes.withColumn("groups", F.ceil(F.col("n") / MEMBERS).cast("int"))
    pairs = pairs.select("head", "member").join(groups.where("groups > 1").select("head", "groups"), "head", "left") \
        .select("head", "member", F.when(F.col("groups").isNull(), 0)
                .otherwise(F.pmod(F.xxhash64("member"), F.col("groups"))).cast("int").alias("salt"))
    want = pairs.select(F.col("member").alias("doc_id"), "head", "salt", F.lit(1).alias("kind")).unionByName(
        groups.select(F.col("head").alias("doc_id"), "head", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"),
                      F.lit(0).alias("kind")))
    # texts always take the merge join: a plan that broadcasts a small side here and a large one there grows unevenly
    rows = docs.join(want.hint("merge"), "doc_id").select("head", "salt", "kind", "doc_id", "text")
    return rows.repartition("head", "salt").sortWithinPartitions("head", "salt", "kind") \
        .mapInArrow(_verify(num, den), "a long, b long").distinct()


def _sets(col):
    """multisets of any number of texts, hashed a slice at a time."""
    firsts, xs, cs, n = [np.zeros(1, np.int64)], [], [], 0
    for a, b in _doc_slices(col):
        first, x, c = multisets(col.slice(a, b - a))
        firsts.append(first[1:] + n)
        xs.append(x)
        cs.append(c)
        n += len(x)
    return np.concatenate(firsts), np.concatenate(xs), np.concatenate(cs)


def _cross_links(num: int, den: int):
    """One block pair of a bucket: links that join components, from the left outsiders to the right members."""
    most = most_differing_bits(num, den)

    def run(table: pa.Table) -> pa.Table:
        mine = table["mine"].to_numpy()
        comp, largest = table["component"].to_numpy(), table["largest"].to_numpy()
        sides = [table.filter(pa.array(mine & (comp != largest))), table.filter(pa.array(~mine))]
        out: list[tuple[int, int]] = []
        if all(t.num_rows for t in sides):
            band = table["band"][0].as_py()
            ids, comps = ([t[c].to_numpy() for t in sides] for c in ("doc_id", "component"))
            bits, bands = ([np.stack(t[c].to_numpy()) for t in sides] for c in ("bits", "bands"))
            (lf, lx, lc), (rf, rx, rc) = (_sets(t["text"].combine_chunks()) for t in sides)
            owner, rn = np.repeat(np.arange(len(ids[1])), np.diff(rf)), np.add.reduceat(rc, rf[:-1])
            parent: dict[int, int] = {}

            def root(x):
                while parent.get(x, x) != x:
                    x = parent[x]
                return x

            for i in range(len(ids[0])):
                same = bands[1] == bands[0][i]
                ok = (comps[1] != comps[0][i]) & ((comps[1] == largest[0]) | (ids[1] > ids[0][i]))
                ok &= bands[0][i][np.argmax(same, 1)] == band
                ok &= np.bitwise_count((bits[1] ^ bits[0][i]).view(np.uint64)).sum(1) <= most
                x, c = lx[lf[i]:lf[i + 1]], lc[lf[i]:lf[i + 1]]
                n = int(c.sum())
                ok &= den * np.minimum(n, rn) >= num * np.maximum(n, rn)
                if not ok.any():
                    continue
                use = ok[owner]
                xs, os = rx[use], owner[use]
                at = np.minimum(np.searchsorted(x, xs), len(x) - 1)
                common = np.bincount(os, np.where(x[at] == xs, np.minimum(c[at], rc[use]), 0), len(ids[1]))
                for j in np.flatnonzero(ok & (den * common >= num * (n + rn - common))):
                    a, b = root(int(comps[0][i])), root(int(comps[1][j]))
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        out.append((int(ids[0][i]), int(ids[1][j])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _sides(rest: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Outsiders in blocks i against all members in blocks j: a member is sent once per block of
    outsiders, an outsider once per block of members."""
    block = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = rest.join(reps.select("doc_id", "bands", "bits"), "doc_id").join(texts.hint("merge"), "doc_id")
    carry = ["doc_id", "component", "largest", "bands", "bits", "text"]
    left = rows.where("component <> largest").select("band", block("is").alias("i"), each("js").alias("j"), F.lit(True).alias("mine"), *carry)
    right = rows.select("band", each("is").alias("i"), block("js").alias("j"), F.lit(False).alias("mine"), *carry)
    return left.unionByName(right)


def _second_round(rest: DataFrame, reps: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    return written(_sides(rest, reps, texts).groupBy("band", "i", "j").applyInArrow(_cross_links(num, den), "a long, b long").distinct(), "second")


def near_duplicates(docs: DataFrame, num: int = 4, den: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id of the class), kept (doc_id = class_id)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written(signatures(docs), "signed")
    some = signed.where(F.col("doc_id").isNotNull() & (F.size("bands") > 0))
    # map-side combined: copies of one text become one row per task, then one in all
    reps = written(some.groupBy("copy").agg(F.min(F.struct("doc_id", "bands", "bits")).alias("r"))
                   .select("copy", "r.doc_id", "r.bands", "r.bits"), "reps")
    buckets = reps.select("doc_id", F.explode("bands").alias("band"))
    heads = buckets.groupBy("band").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("band", "head")
    shared = written(buckets.join(heads, "band"), "buckets")     # rows of buckets with two documents or more
    met = shared.where("head < doc_id").groupBy(F.col("doc_id").alias("member"), "head").agg(F.count(F.lit(1)).alias("n"))
    star = met.groupBy("member").agg(F.max(F.struct("n", (-F.col("head")).alias("h"))).alias("best")) \
        .select("member", (-F.col("best.h")).alias("head"))
    texts = docs.where(F.col("doc_id").isNotNull())
    first = written(verified(texts, star, num, den), "first")
    comp = components(first)
    labelled = shared.join(comp, shared.doc_id == comp.node, "left") \
        .select("band", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    tally = labelled.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = tally.groupBy("band").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("members"),
                                      F.max(F.struct("n", "component")).alias("top")).where("parts > 1")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    rest = written(labelled.join(mixed.select("band", F.col("top.component").alias("largest"), blocks(F.col("members") - F.col("top.n")).alias("is"),
                                              blocks(F.col("members")).alias("js")), "band"), "rest")
    links = first if rest.isEmpty() else first.unionByName(_second_round(rest, reps, texts, num, den))
    comp = components(links)
    # a copy's class is its representative's
    cls = reps.join(comp, reps.doc_id == comp.node, "left").select("copy", F.coalesce("component", "doc_id").alias("class_id"))
    wordless = F.size("bands") == 0
    rows = signed.select("doc_id", F.when(~wordless & F.col("doc_id").isNotNull(), F.col("copy")).alias("copy"))
    got = rows.where(F.col("copy").isNotNull()).join(cls, "copy").select("doc_id", "class_id") \
        .unionByName(rows.where(F.col("copy").isNull()).select("doc_id", F.col("doc_id").alias("class_id")))
    return got.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
