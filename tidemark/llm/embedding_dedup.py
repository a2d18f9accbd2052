"""Near-duplicate embeddings by NN-descent.

Two vectors link when their labels are equal and their cosine, in double
precision, is at least 0.98.

1. Equal vectors of a label collapse to one node with a count (map-side
   combined).
2. *First graph.*  Every node gets a code of random hyperplane signs per table;
   the bits in use follow the size of its label.  Rows are range-sorted by
   (label, table, code, projection) and compared in runs of at most 256, so a hot
   label or bucket is cut along the projection and never gathered.
3. *Descent.*  A node's list holds its best neighbours.  Each round joins
   the members of every list with one another (neighbours of neighbours) and keeps the best
   of old and new.  Only neighbours above ``floor`` take part: if both v-a and
   v-b reach 0.98, then a-b reaches 0.92.
4. *Saturated lists.*  A list full of links may have lost some.  All nodes of a
   component with a saturated list get lists as long as the component: it is
   compared block by block, and only counts leave a block.
5. *Joining components.*  A link can only miss both lists if both are full of
   better links, as between two dense groups.  Such nodes are hashed again, at
   most ``REPS`` of a component per bucket; components with members above
   ``floor`` are compared whole, block by block, and each block hands over
   one link per pair of components.
6. *Audit.*  ``AUDIT`` nodes with links and as many without, first by hash, are
   compared with all vectors; while the mean recall of a linked node is below
   ``target``, or one of them links with a node of another component, as many tables
   again are added to the graph.  After ``MORE`` attempts the call fails rather
   than return a short result.

Rules: vectors that are null, empty, zero or hold null or non-finite components link
with nothing, nor do null labels, null ids and vectors of another length;
such rows have n_links 0 and are their own component.  Ids are expected to be
unique; rows that repeat one share a component.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import partitions, written

COSINE, FLOOR = 0.98, 0.90
K, TABLES, RUN, BLOCK, REPS = 16, 12, 256, 512, 16
MAX_BITS = 30
AUDIT, TARGET, MORE = 256, 0.99, 4


def _matrix(col, unit: bool = True) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x


def _planes(dim: int, table: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([dim, table])).standard_normal((MAX_BITS + 1, dim))


def _codes(first_table: int, tables: int, extra: tuple[str, ...] = ()):
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                x, bits = _matrix(part.column("embedding")), part.column("bits").to_numpy()
                for t in range(first_table, first_table + tables):
                    side = x @ _planes(int(d), t).T
                    code = ((side[:, :MAX_BITS] > 0) @ (1 << np.arange(MAX_BITS, dtype=np.int64))) & ((np.int64(1) << bits) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(c) for c in ("label", "dim")], pa.array(np.full(len(x), t, np.int32)), pa.array(code),
                         pa.array(side[:, MAX_BITS]), *[part.column(c) for c in ("node", "embedding", *extra)]],
                        names=["label", "dim", "turn", "code", "spot", "node", "embedding", *extra])

    return run


def _runs(batches, keys, limit: int):
    """Tables of consecutive rows with equal keys, at most ``limit`` rows each; the input is sorted by the keys."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        if not t.num_rows:
            continue
        new = np.zeros(t.num_rows, dtype=bool)
        new[0] = True
        for k in keys:
            v = t[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        at = np.append(np.flatnonzero(new), t.num_rows)
        for a, b in zip(at[:-2], at[1:-1]):
            for i in range(a, b, limit):
                yield t.slice(i, min(limit, b - i))
        a = at[-2]
        while t.num_rows - a >= 2 * limit:                 # the last group goes on in the next batch
            yield t.slice(a, limit)
            a += limit
        held = t.slice(a)
    if held is not None and held.num_rows:
        for i in range(0, held.num_rows, limit):
            yield held.slice(i, min(limit, held.num_rows - i))


_EDGES = "a long, b long, cosine double"


def _edge_batch(a, b, s):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, k)) for x, k in ((a, np.int64), (b, np.int64), (s, np.float64))],
                                      names=["a", "b", "cosine"])


def _best(keys, k: int, limit: int, floor: float):
    """Per row of a run its k best others above ``floor``."""
    def run(batches):
        out = [[], [], []]
        for t in _runs(batches, keys, limit):
            n = t.num_rows
            if n < 2:
                continue
            ids, x = t["node"].to_numpy(), _matrix(t["embedding"])
            s = x @ x.T
            s[ids[:, None] == ids[None, :]] = -2
            if n - 1 > k:
                low = np.partition(s, n - k, axis=1)[:, n - k]
                s[s < low[:, None]] = -2
            i, j = np.nonzero(s >= floor)
            for o, v in zip(out, (ids[i], ids[j], s[i, j])):
                o.append(v)
            if len(out[0]) >= 500:
                yield _edge_batch(*out)
                out = [[], [], []]
        yield _edge_batch(*out)

    return run


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The k best neighbours of every node; edges count both ways."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    both = both.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    w = Window.partitionBy("a").orderBy(F.col("cosine").desc(), "b")
    return both.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k)


_BUCKET = ["label", "dim", "turn", "code"]
_CODED = "label long, dim int, turn int, code long, spot double, node long, embedding array<float>"


def _with_bits(nodes: DataFrame) -> DataFrame:
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("n") / (RUN // 2))), F.lit(0)), F.lit(MAX_BITS)).cast("long")
    return nodes.join(sizes.select("label", "dim", bits.alias("bits")), ["label", "dim"])


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange(partitions(rows), *_BUCKET, "spot", "node").sortWithinPartitions(*_BUCKET, "spot", "node")


def _first_graph(nodes: DataFrame, first_table: int, tables: int) -> DataFrame:
    rows = _with_bits(nodes).mapInArrow(_codes(first_table, tables), _CODED)
    return _in_order(rows).mapInArrow(_best(_BUCKET, K, RUN, FLOOR), _EDGES)


def _descend(nodes: DataFrame, lists: DataFrame) -> DataFrame:
    """Join the members of every list with one another."""
    members = lists.select(F.col("a").alias("owner"), F.col("b").alias("node"))
    members = members.unionByName(members.select("owner", F.col("owner").alias("node")).distinct())
    rows = members.join(nodes.select("node", "embedding"), "node")
    return rows.repartition("owner").sortWithinPartitions("owner").mapInArrow(_best(["owner"], K, K + 1, FLOOR), _EDGES)


def _block_counts(threshold: float):
    """Weighted links of each node of block i with block j; two halves of one group."""
    def run(table: pa.Table) -> pa.Table:
        mine = table["mine"].to_numpy(zero_copy_only=False)
        ids, many = table["node"].to_numpy(), table["copies"].to_numpy()
        x = _matrix(table["embedding"])
        hit = (x[mine] @ x[~mine].T >= threshold) & (ids[mine][:, None] != ids[~mine][None, :])
        return pa.table({"node": ids[mine], "n": hit @ many[~mine].astype(np.int64)})

    return run


def _component_counts(nodes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(node, n) links inside whole components, compared in blocks."""
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = members.join(sizes, "component").join(nodes.select("node", "embedding", "copies"), "node") \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = rows.select("component", F.col("block").alias("i"), F.col("other").alias("j"), F.lit(True).alias("mine"), "node", "copies", "embedding")
    right = rows.select("component", F.col("other").alias("i"), F.col("block").alias("j"), F.lit(False).alias("mine"), "node", "copies", "embedding")
    parts = left.unionByName(right).groupBy("component", "i", "j").applyInArrow(_block_counts(threshold), "node long, n long")
    return parts.groupBy("node").agg(F.sum("n").alias("n"))


def _near_components(batches):
    """Pairs of components with members above FLOOR in one run."""
    for t in _runs(batches, _BUCKET, RUN):
        c, x = t["component"].to_numpy(), _matrix(t["embedding"])
        i, j = np.nonzero((x @ x.T >= FLOOR) & (c[:, None] < c[None, :]))
        if len(i):
            got = np.unique(np.stack([c[i], c[j]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1])], names=["c", "d"])


def _block_links(threshold: float):
    """The best link of a block of one component with each component of the other block."""
    def run(table: pa.Table) -> pa.Table:
        mine = table["mine"].to_numpy(zero_copy_only=False)
        if mine.all() or not mine.any():
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        ids, comp, x = table["node"].to_numpy(), table["component"].to_numpy()[~mine], _matrix(table["embedding"])
        s = x[mine] @ x[~mine].T
        best, top = s.argmax(0), s.max(0)
        at = np.flatnonzero(top >= threshold)
        at = at[np.lexsort((-top[at], comp[at]))]
        at = at[np.unique(comp[at], return_index=True)[1]]
        return pa.table({"a": ids[mine][best[at]], "b": ids[~mine][at]})

    return run


def _joining(nodes: DataFrame, full: DataFrame, tables: int, threshold: float) -> DataFrame:
    """Links (a, b) between components of ``full`` (node, component), the nodes with full lists."""
    hot = written(full.join(nodes.select("node", "label", "dim", "embedding"), "node"), "full")
    coded = _with_bits(hot).mapInArrow(_codes(0, tables, ("component",)), _CODED + ", component long")
    # row_number <= k plans as a partial limit per task: a large component is cut before the exchange
    turn = F.row_number().over(Window.partitionBy(*_BUCKET, "component").orderBy(F.xxhash64("node", "turn"), "node"))
    some = coded.withColumn("nth", turn).where(F.col("nth") <= REPS).drop("nth")
    near = written(_in_order(some).mapInArrow(_near_components, "c long, d long").distinct(), "near")
    sizes = hot.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    c, d = (sizes.select(F.col("component").alias(x), F.col("n").alias(f"n_{x}")) for x in "cd")
    # the larger one of a pair meets all its smaller ones at once
    larger = F.col("n_c") >= F.col("n_d")
    pairs = near.join(c, "c").join(d, "d").select(F.when(larger, F.col("c")).otherwise(F.col("d")).alias("hub"),
                                                  F.when(larger, F.col("d")).otherwise(F.col("c")).alias("component"),
                                                  F.greatest("n_c", "n_d").alias("n_hub"), F.least("n_c", "n_d").alias("n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    hubs = pairs.groupBy("hub").agg(blocks(F.max("n_hub")).alias("is"), blocks(F.sum("n")).alias("js"))
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = hot.select("component", "node", "embedding")
    left = hubs.join(members, F.col("hub") == F.col("component")).withColumn("i", part("is")).withColumn("j", each("js"))
    right = pairs.select("hub", "component").join(hubs, "hub").join(members, "component").withColumn("j", part("js")).withColumn("i", each("is"))
    out = ["hub", "i", "j", "component", "node", "embedding"]
    both = left.select(*out, F.lit(True).alias("mine")).unionByName(right.select(*out, F.lit(False).alias("mine")))
    return written(both.groupBy("hub", "i", "j").applyInArrow(_block_links(threshold), "a long, b long"), "joining")


def _audit(nodes: DataFrame, counts: DataFrame, threshold: float, comp: DataFrame | None = None) -> float:
    """Mean recall of a linked node's links, from AUDIT nodes with found links and AUDIT nodes without.

    With ``comp`` (node, component) a link between two components is a missed join: the recall is 0 then.
    """
    nodes = nodes.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")) if comp is not None \
        else nodes.withColumn("component", F.lit(0).cast("long"))
    known = nodes.join(counts.withColumnRenamed("n", "found"), "node", "left") \
        .select("node", "label", "dim", "embedding", "component", F.coalesce("found", F.lit(0)).alias("found"))
    sizes = {r["some"]: r["n"] for r in known.groupBy((F.col("found") > 0).alias("some")).agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = [r for side in (F.col("found") > 0, F.col("found") == 0)
             for r in known.where(side).orderBy(F.xxhash64("node"), "node").limit(AUDIT).collect()]
    by = {}
    for r in asked:
        by.setdefault((r["label"], r["dim"]), []).append((r["node"], r["component"], np.array(r["embedding"], np.float64)))

    def count(batches):
        got, apart = {}, {}
        for batch in batches:
            labels, dims, ids = (batch.column(c).to_numpy() for c in ("label", "dim", "node"))
            many, comps = batch.column("copies").to_numpy(), batch.column("component").to_numpy()
            for (label, dim), queries in by.items():
                at = np.flatnonzero((labels == label) & (dims == dim))
                if not len(at):
                    continue
                x = _matrix(batch.column("embedding").take(pa.array(at)))
                for node, component, q in queries:
                    hit = (x @ (q / np.linalg.norm(q)) >= threshold) & (ids[at] != node)
                    got[node] = got.get(node, 0) + int(many[at][hit].sum())
                    apart[node] = apart.get(node, 0) + int((comps[at][hit] != component).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(d), pa.int64()) for d in (got, got.values(), apart.values())], names=["node", "n", "apart"])

    told = nodes.select("label", "dim", "node", "copies", "component", "embedding").mapInArrow(count, "node long, n long, apart long") \
        .groupBy("node").agg(F.sum("n").alias("n"), F.sum("apart").alias("apart")).collect()       # the nodes asked for
    true = {r["node"]: r["n"] for r in told}
    if comp is not None and any(r["apart"] for r in told):
        return 0.0
    shares = [min(r["found"], true[r["node"]]) / true[r["node"]] for r in asked if r["found"] and true.get(r["node"])]
    without = [bool(true.get(r["node"])) for r in asked if not r["found"]]
    linked = sizes.get(True, 0)
    lost = sizes.get(False, 0) * float(np.mean(without)) if without else 0.0       # linked nodes that no link was found of
    return linked * float(np.mean(shares or [1.0])) / (linked + lost) if linked + lost else 1.0


def _links(nodes: DataFrame, graph: DataFrame, tables: int, threshold: float):
    """Descend to a fixed point; (edges kept for a later call, (node, n links), (node, component))."""
    lists, seen = written(_top(graph, K), "lists"), -1
    while (grown := lists.where(F.col("cosine") >= threshold).count()) > max(seen, 0):      # lists only get better
        seen = grown
        lists = written(_top(lists.select("a", "b", "cosine").unionByName(_descend(nodes, lists)), K), "lists")
    links = lists.where(F.col("cosine") >= threshold)
    comp = written(components(links.select("a", "b")), "components")
    full = links.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= K).select("node")
    joining = _joining(nodes, comp.join(full, "node"), tables, threshold)
    if not joining.isEmpty():
        comp = written(components(links.select("a", "b").unionByName(joining)), "components")
    dense = comp.join(full, "node").select("component").distinct()
    members = comp.join(dense, "component")
    few = links.join(members.select(F.col("node").alias("a")), "a", "left_anti") \
        .join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("n"))
    counts = written(few.unionByName(_component_counts(nodes, members, threshold)), "counts")
    return lists.select("a", "b", "cosine"), counts, comp


def near_vectors(vectors: DataFrame, threshold: float = COSINE, target: float = TARGET) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<float>").alias("embedding"))
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
             & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
             & F.exists("embedding", lambda v: v != 0))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False))) \
        .withColumn("k1", F.xxhash64("label", "embedding")).withColumn("k2", F.xxhash64(F.lit("second"), "embedding", "label"))
    good = rows.where("sound")
    nodes = written(good.groupBy("k1", "k2").agg(F.min(F.struct("vec_id", "label", "embedding")).alias("v"), F.count(F.lit(1)).alias("copies"))
                    .select("k1", "k2", F.col("v.vec_id").alias("node"), "v.label", F.size("v.embedding").alias("dim"), "v.embedding", "copies"), "nodes")
    graph, tables = _first_graph(nodes, 0, TABLES), TABLES
    for attempt in range(MORE):
        edges, counts, comp = _links(nodes, graph, tables, threshold)
        recall = _audit(nodes, counts, threshold, comp)
        if recall >= target:
            break
        if attempt == MORE - 1:
            raise RuntimeError(f"recall of links is {recall:.4f} with {tables} tables, below {target}")
        graph, tables = edges.unionByName(_first_graph(nodes, tables, tables)), 2 * tables
    known = nodes.select("k1", "k2", "node", "copies").join(counts, "node", "left").join(comp, "node", "left") \
        .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    found = good.select("vec_id", "k1", "k2").join(known, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("sound")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
