"""Each training-data operator against a brute-force version, and its edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, embedding_dedup, html_extract, language_id, minhash_dedup, packing, quality, sharding, substring_dedup, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    docs = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 120]))]
        if i % 4 == 0:
            words[len(words) // 2:len(words) // 2] = passage.split()
        docs.append(" ".join(words))
    near = docs[7].split()
    near[len(near) // 2] = "changed"
    docs += [docs[5], docs[5], " ".join(near), None, "", " \t\n", "one", "ab " * 40, docs[9] + "\n" + docs[9]]
    return [(i, t, ["x", "y", None][i % 3]) for i, t in enumerate(docs)]


@pytest.fixture(scope="module")
def docs(spark):
    # a column that clashes with outputs, a repeated row and a null id
    rows = corpus()
    rows += [rows[10], (None, rows[11][1], "x")]
    return spark.createDataFrame([(*r, 1, "extra") for r in rows], "doc_id long, text string, source string, n_words int, own string")


def table(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_substring_dedup(spark, docs):
    first = {}
    for i, t in table(docs):
        w = WORD.findall(t or "")
        for p in range(len(w) - 12):
            if i is not None:
                k = tuple(w[p:p + 13])
                first[k] = min(first.get(k, i), i)
    want = collections.Counter()
    for i, t in table(docs):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for p in range(len(w) - 12):
            if i is not None and first[tuple(w[p:p + 13])] < i:
                gone[p:p + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = substring_dedup.substring_dedup(docs)
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == want
    assert substring_dedup.substring_dedup(docs.limit(0)).count() == 0


def test_substring_repeats_inside_one_document(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passage = fresh(20)
    source, twice = fresh(5) + passage, passage + fresh(30) + passage + fresh(7) + passage[:13]
    rows = [(1, " ".join(source)), (2, " ".join(twice))]
    # one partition each: the document that holds the passage more than once is the first in its chunk
    parts = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(parts).collect()}
    assert (got[1].n_removed, got[2].n_removed) == (0, 53)
    assert got[2].kept_text == " ".join(twice[20:50] + twice[70:77])


def test_substring_rows_of_one_id_keep_their_own_paths(spark):
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    p, q = fresh(40), fresh(40)
    # two texts of document 2 overlap the same stretch of document 1; document 3 copies from both
    rows = [(1, p), (2, fresh(5) + p[:25] + q[:20]), (2, fresh(15) + p[10:] + q[5:30]), (3, q[:20] + fresh(3)), (3, q[5:30])]
    want = collections.Counter({(1, 40, 0): 1, (2, 50, 25): 1, (2, 70, 30): 1, (3, 23, 20): 1, (3, 25, 25): 1})
    for parts in (1, 5):
        docs = spark.createDataFrame(spark.sparkContext.parallelize([(i, " ".join(w)) for i, w in rows], parts), "doc_id long, text string")
        got = substring_dedup.substring_dedup(docs).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.n_removed) for r in got) == want


def test_substring_false_paths_go_per_row(spark, monkeypatch):
    w = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in ((1, w[:30]), (2, w[:30] + w[40:]), (2, w[30:40] + w[:20]))], "doc_id long, text string")
    true = substring_dedup.repeat_paths
    wrong = lambda d, k: true(d, k).unionByName(true(d, k).withColumn("start", F.col("start") + 1))
    monkeypatch.setattr(substring_dedup, "repeat_paths", wrong)
    got = substring_dedup.substring_dedup(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(1, 30, 0), (2, 30, 20), (2, 50, 30)]


def test_substring_finds_the_true_source_after_a_collision(spark, monkeypatch):
    """Hashes of eight bits collide all the time: every window with a true source goes all the same."""
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    shared = [fresh(40) for _ in range(6)]
    rows = [(i, " ".join(fresh(15) + shared[i % 6][i % 5:] + fresh(10) + shared[(i + 1) % 6][:20])) for i in range(24)]
    rows += [(5, rows[7][1]), (None, rows[3][1])]
    want = collections.Counter((i, *r) for i, *r in plain_cut([r for r in rows if r[0] is not None]))
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), "doc_id long, text string")
    monkeypatch.setattr(substring_dedup, "HASH_BITS", 8)
    got = substring_dedup.substring_dedup(docs).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, " ".join(r.kept_text.split())) for r in got if r.doc_id is not None) == want
    assert [r.n_removed for r in got if r.doc_id is None] == [0]


def plain_cut(rows, k=13):
    first = {}
    for i, t in rows:
        w = t.split()
        for p in range(len(w) - k + 1):
            g = tuple(w[p:p + k])
            first[g] = min(first.get(g, i), i)
    for i, t in rows:
        w = t.split()
        gone = {q for p in range(len(w) - k + 1) if first[tuple(w[p:p + k])] < i for q in range(p, p + k)}
        kept = [x for q, x in enumerate(w) if q not in gone]
        yield i, len(w), len(gone), " ".join(kept)


def test_substring_bucket_of_a_common_line_is_split(spark, monkeypatch):
    rng = random.Random(10)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    line = [f"common{i}" for i in range(12)]
    texts = [fresh(6) + line + fresh(6) for _ in range(400)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts + [fresh(3) + w[:20] for w in texts])]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "doc_id long, text string")
    fullest = lambda: substring_dedup._blobs(docs, 13).groupBy("bucket").agg(F.sum(F.length("hashes")).alias("n")).agg(F.max("n")).first()[0]
    whole = fullest()
    monkeypatch.setattr(substring_dedup, "BUCKET_EDGES", 300)
    assert fullest() < 0.6 * whole
    assert all(r.n_removed == (20 if r.doc_id >= 400 else 0) for r in substring_dedup.substring_dedup(docs).collect())


def test_near_duplicates(spark, docs):
    bags = {}
    for i, t in table(docs):
        w = WORD.findall(t or "")
        if w and i is not None:
            bags[i] = collections.Counter(tuple(w[p:p + 5]) for p in range(max(1, len(w) - 4)))
    parent = {i: i for i in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in bags:
        for j in bags:
            if j < i and 5 * (bags[i] & bags[j]).total() >= 4 * (bags[i] | bags[j]).total():
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = minhash_dedup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.class_id == (root(r.doc_id) if r.doc_id in bags else r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.class_id)
    assert minhash_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_weighted_signature_estimates_similarity():
    import pyarrow as pa
    a, b = "x y z w v " * 6 + "p q r s t u", "x y z w v " * 4 + "p q r s t u"
    sig = minhash_dedup.bag_minhash(*minhash_dedup.multisets(pa.array([a, b])), slots=4000)
    A, B = (collections.Counter(tuple(w[p:p + 5]) for p in range(len(w) - 4)) for w in (a.split(), b.split()))
    assert abs((sig[0] == sig[1]).mean() - (A & B).total() / (A | B).total()) < 0.04


def test_many_near_copies_join_one_class(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(700):
        w = list(base)
        for _ in range(rng.choice([1, 2, 4])):
            w[rng.randrange(150)] = f"z{rng.randrange(50)}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(w[p:p + 5]) for p in range(146)} for w in (t.split() for _, t in rows)]       # no shingle comes twice
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: root(i) for i in range(len(rows))}


def test_sharding(spark, docs):
    rows = sharding.shard_rows(docs).collect()
    assert len(rows) == docs.count()
    sizes = collections.Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(24))
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    texts = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in table(docs))
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == texts
    assert sharding.shard_rows(docs.limit(0)).count() == 0


def test_token_counts(spark, docs):
    sp = token_counts.processor(token_counts.MODEL)
    extra = spark.createDataFrame([(900, "x" * 3000 + " " + "y" * 400), (901, "  lead " * 200), (902, "▁a▁▁b " * 200)], "doc_id long, text string")
    all_ = docs.select("doc_id", "text").unionByName(extra)
    want = collections.Counter((i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in table(all_))
    for chunk, overlap in ((1 << 15, 256), (300, 8)):
        got = token_counts.token_counts(all_, chunk=chunk, overlap=overlap).collect()
        assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def test_bpe_equals_the_library(spark, docs):
    import tokenizers
    ref = tokenizers.Tokenizer.from_file(token_counts.model_file(bpe.WORD_MODEL))
    rng = random.Random(1)
    letters = "aàbcdé'sΣςİ ẞßthe  \x1c\x85 漢字🙂0१½_-.!?<|startoftext|>'ré "
    odd = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(800)] + ["<|endoftext|> a <|startoftext|>b", "a" * 3000, ""]
    tok = bpe.word_tokenizer(bpe.WORD_MODEL)
    for t in odd:
        ids = ref.encode(t, add_special_tokens=False).ids
        assert tok.encode(t).tolist() == ids
        assert tok.decode(tok.encode(t)).decode() == ref.decode(ids, skip_special_tokens=False)
    got = collections.Counter((r.doc_id, r.n_tokens) for r in bpe.encode_digests(docs).collect())
    assert got == collections.Counter((i, len(ref.encode(t or "", add_special_tokens=False).ids)) for i, t in table(docs))


def test_packing(spark, docs):
    import tokenizers
    ref = tokenizers.Tokenizer.from_file(token_counts.model_file("byte_bpe_50k.json"))
    long = spark.createDataFrame([(800, "word and <|endoftext|> 12 'll " * 600)], "doc_id long, text string")
    all_ = docs.select("doc_id", "text").unionByName(long)
    rows = packing.pack_documents(all_, with_ids=True).collect()
    want = collections.Counter()
    for i, t in table(all_):
        ids = [*ref.encode(t or "", add_special_tokens=False).ids, 2]
        at = packing.cuts(len(ids), 1024)
        for k, (s, e) in enumerate(zip(at, [*at[1:], len(ids)])):
            want[i, k, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_plan_is_near_the_bound():
    h = np.bincount(np.random.default_rng(0).integers(1, 1025, 50_000), minlength=1025)
    assert int(packing.plan(h)["sequences"]) <= 1.01 * -(-int((h * np.arange(1025)).sum()) // 1024)


def test_quality_counts(spark, docs):
    for r in quality.clean_lines(docs).collect():
        t = r.text or ""
        w = WORD.findall(t)
        n = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        hit = [False] * len(w)
        for i in range(len(w) - 2):
            if n[tuple(w[i:i + 3])] > 1:
                hit[i:i + 3] = [True] * 3
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(hit))
        assert r.base_failed == (len(w) < 50 or 100 * sum(hit) > 50 * len(w)) and (not r.kept or not r.base_failed)


def test_quality_lines(spark):
    prose = "\n".join(" ".join(f"w{i}x{j}" for j in range(9)) + "." for i in range(12))
    junk = "\n".join("Win### now*** at%%% the&&& best$$$ place### for&&& you***" + str(i) for i in range(12))
    nav = "Home | News | Sport | Weather"
    df = spark.createDataFrame([(0, prose + "\n" + nav + "\nAll rights reserved."), (1, junk)], "doc_id long, text string")
    a, b = quality.clean_lines(df).orderBy("doc_id").collect()
    assert a.kept and a.clean_text == prose and a.n_lines_failed == 2
    assert not b.kept and b.n_lines_failed == 12


def test_language_id(spark):
    rng = random.Random(2)
    words = {"aa": "the of and that with this".split(), "bb": "der die und das nicht mit".split()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(20)), k) for i in range(200) for k in [["aa", "bb"][i % 2]]]
    rows += [(300, None, "aa"), (301, "123 !!", None), (None, "the of and", None)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    true = {i: k for i, _, k in rows}
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (300, 301):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred == true[r.doc_id] and 0 <= r.score <= 1
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    none = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language_id.identify(none).collect()] == [("und", 0.0)]


def test_embedding_links(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((150, 16))
    close = base[0] + 0.02 * rng.standard_normal((80, 16))       # more links than a list holds
    x = np.concatenate([base, close, base[3:5] + 0.01 * rng.standard_normal((2, 16))]).astype(np.float32)
    rows = [(i, v.tolist(), i % 2 if i < 150 else 0) for i, v in enumerate(x)]
    rows += [(900, x[7].tolist(), 1), (901, x[7].tolist(), None), (902, None, 1), (903, [0.0] * 16, 1), (904, [float("nan")] * 16, 1)]
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    ok = [r for r in rows if r[2] is not None and r[1] and np.isfinite(r[1]).all() and any(r[1])]
    v = np.array([r[1] for r in ok], np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([r[2] for r in ok])
    link = (v @ v.T >= 0.98) & (label[:, None] == label[None, :]) & ~np.eye(len(ok), dtype=bool)
    comp = np.array([r[0] for r in ok])
    for _ in range(10):
        comp = np.minimum(comp, np.where(link, comp[None, :], 10**9).min(1))
    assert len(got) == len(rows)
    for r, n, c in zip(ok, link.sum(1), comp):
        assert (got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (n, c, r[0] == c)
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i in (901, 902, 903, 904))


def embedding_rows(spark, x):
    return spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")


def test_embedding_links_between_dense_groups(spark):
    rng = np.random.default_rng(6)
    first, side = np.linalg.qr(rng.standard_normal((16, 2)))[0].T
    angle = np.arccos(0.985)
    centres = [first, np.cos(angle) * first + np.sin(angle) * side, -first]
    x = np.concatenate([c + 0.004 * rng.standard_normal((40, 16)) for c in centres]).astype(np.float32)
    v = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    link = (v @ v.T >= 0.98) & ~np.eye(len(v), dtype=bool)
    assert link[:40, 40:80].any() and (v[:40] @ v[:40].T).min() > 0.998
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(embedding_rows(spark, x)).collect()}
    assert got == {i: (n, 0 if i < 80 else 80, i in (0, 80)) for i, n in enumerate(link.sum(1))}


def test_embedding_audit_counts_nodes_and_fails_loudly(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((21, 16))
    x = np.concatenate([base[0] + 0.004 * rng.standard_normal((120, 16)), np.repeat(base[1:], 2, 0) + 0.004 * rng.standard_normal((40, 16))])
    rows = embedding_rows(spark, x.astype(np.float32)).selectExpr("vec_id node", "cast(label as long) label", "size(embedding) dim", "embedding", "1L copies")
    # the dense group is whole, the pairs are lost: 14280 of 14320 links, 120 of 160 nodes
    found = spark.createDataFrame([(i, 119) for i in range(120)], "node long, n long")
    assert embedding_dedup._audit(rows, found, 0.98) == pytest.approx(0.75)
    assert embedding_dedup._audit(rows, found.limit(0), 0.98) == 0
    assert embedding_dedup._audit(rows, found.unionByName(spark.createDataFrame([(i, 1) for i in range(120, 160)], "node long, n long")), 0.98) == 1
    monkeypatch.setattr(embedding_dedup, "_first_graph", lambda *a: spark.createDataFrame([], embedding_dedup._EDGES))
    monkeypatch.setattr(embedding_dedup, "MORE", 2)
    with pytest.raises(RuntimeError, match="recall"):
        embedding_dedup.near_vectors(embedding_rows(spark, x.astype(np.float32)))


def test_html_extraction(spark):
    def page(i):
        body = "".join(f"<p>Paragraph {j} of page {i} says &amp; explains\n several things, in whole sentences." for j in range(4))
        return (f"<html><head><title>t</title><script>x('</p>')</script></head><body><nav><ul><li><a href=a>Home</a><li><a href=b>More</a></ul></nav>"
                f"<div class=ad>Buy now.</div><article><h1>Title {i}</h1>{body}</article><footer>&copy; site</footer></body></html>")
    rows = [(i, "u", page(i)) for i in range(30)] + [(40, "u", None), (41, None, "")]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(30):
        assert got[i] == f"Title {i} " + " ".join(f"Paragraph {j} of page {i} says & explains several things, in whole sentences." for j in range(4))
    assert got[40] == got[41] == ""
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(none).count() == 0


def test_html_head_without_an_end_tag():
    def texts(html):
        return [t for t in html_extract.Dom(html).texts if t is not None]
    head = "<html><head><meta charset=x><title>t</title><style>s</style><noscript><div>n</div></noscript>\n"
    assert texts(head + "<body>one<p>two</p></body></html>") == ["one", "two"]
    assert texts(head + "<div>one</div>two") == ["one", "two"]
    assert texts(head + "<b>one</b> two") == ["one two"]
    assert texts(head + "one<p>two") == ["one", "two"]
    assert texts(head + "</head><body><p>one</p></body></html>") == ["one"]


def test_pipeline_language_without_labels(spark):
    from tidemark.llm import pipeline as c
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 4 == 2)
    for rows in ([(1, "some words", None), (2, "12 34", None), (3, None, None)], [(held, "some words", "en"), (held, "12 34", "fr"), (held, "mots", "fr")]):
        docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
        got = [r.text for r in c.language_id(spark, docs, "").collect()]
        assert sorted(got) == sorted(t for _, t, _ in rows if t and any(map(str.isalpha, t)))


def test_pipeline_stages(spark, docs):
    from tidemark.llm import pipeline as c
    full = docs.select("doc_id", F.concat("text", F.lit(".")).alias("text"), F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"))
    kept = c.quality_rules(spark, full, "")
    assert kept.columns == list(c.COLUMNS)
    assert kept.count() == quality.clean_lines(full).where("kept").count() > 0
    once = c.minhash_dedup(spark, full, "")
    classes = minhash_dedup.near_duplicates(full).where("kept and doc_id is not null").select("doc_id").distinct()
    assert once.where("doc_id is not null").count() == classes.count()
    cut = c.substring_dedup_stage(spark, full, "")
    assert cut.columns == list(c.COLUMNS) and not any(r.text is None for r in cut.collect())


STOCK_PHRASE = re.compile(quality.STOCK[4:], re.IGNORECASE | re.ASCII)


def plain_quality(text):
    """The text without failed lines; None if the document goes."""
    def fails(line):
        words = len(WORD.findall(line))
        return (sum(line.count(c) for c in quality.LINE_SYMBOLS) > 0.5 * words or sum(line.count(c) for c in quality.SEPARATORS) >= 3
                or (len(line) <= 200 and STOCK_PHRASE.search(line) is not None) or (words >= 4 and not re.search(quality.SENTENCE_END, line)))

    chars = lambda t: sum(map(len, WORD.findall(t)))
    words = WORD.findall(text)
    runs = collections.Counter(zip(words, words[1:], words[2:]))
    twice = {i + j for i in range(len(words) - 2) if runs[tuple(words[i:i + 3])] > 1 for j in range(3)}
    clean = "\n".join(x for x in text.split("\n") if not WORD.search(x) or not fails(x))
    return None if len(words) < 50 or 2 * len(twice) > len(words) or 2 * chars(clean) < chars(text) else clean


def plain_near_duplicates(rows):
    bags = {}
    for i, t, *_ in rows:
        if i is not None:
            w = WORD.findall(t)
            bags[i] = collections.Counter(tuple(w[p:p + 5]) for p in range(max(1, len(w) - 4)))
    least = {i: i for i in bags}
    for _ in bags:
        for i in bags:
            for j in bags:
                if 5 * (bags[i] & bags[j]).total() >= 4 * (bags[i] | bags[j]).total():
                    least[i] = min(least[i], least[j])
    one = {}
    for r in sorted((r for r in rows if r[0] is not None and least[r[0]] == r[0]), reverse=True):
        one[r[0]] = r
    return [*one.values(), *(r for r in rows if r[0] is None)]


def plain_substrings(rows):
    first, out = {}, []
    for i, t, *_ in rows:
        w = WORD.findall(t)
        for p in range(len(w) - 12 if i is not None else 0):
            k = tuple(w[p:p + 13])
            first[k] = min(first.get(k, i), i)
    for i, t, *rest in rows:
        w = WORD.findall(t)
        gone = {p + j for p in range(len(w) - 12 if i is not None else 0) if first[tuple(w[p:p + 13])] < i for j in range(13)}
        if len(gone) < len(w) or not w:
            out.append((i, " ".join(x for p, x in enumerate(w) if p not in gone) if gone else t, *rest))
    return out


def test_pipeline_run_equals_plain_python(spark, tmp_path):
    from tidemark.llm import pipeline as c
    import tokenizers
    rng = random.Random(12)
    words = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(900)]
             for lang, letters in (("en", "abcdeghinorst"), ("el", "αβγδεικλμνοπ"))}

    def lines(lang, n):
        return [" ".join(rng.choice(words[lang]) for _ in range(rng.randint(6, 12))) + "." for _ in range(n)]

    passage, texts = lines("en", 4), []
    for i in range(50):
        lang = ("en", "el")[i % 2]
        body = lines(lang, rng.choice([3, 9, 14, 20]))
        if i % 5 == 0:
            body[2:2] = ["home | news | shop | more", "Click here.", "no end of a sentence here", "###### $$$ %%%"]
        if i % 6 == 0:
            body[1:1] = passage
        if i % 18 == 6:
            body += ["and then."] + passage
        texts.append(("\n".join(body), lang if i % 7 else None))
    near = texts[13][0].replace("\n", " ", 1)
    texts += [(near, "el"), texts[9], (texts[11][0].replace(".", ";", 1), "el"), (None, "en"), ("", "el"), ("1 2 3. " * 3 + " ".join(map(str, range(100))) + ".", "en"),
              ("a b c. " * 40, "en"), ("word <|endoftext|> " + "\n".join(lines("en", 400)), "en"), ("\n".join(passage + passage[:1] + lines("el", 9)), None)]
    rows = [(i, t, lang, "xy"[i % 2], len(t or "")) for i, (t, lang) in enumerate(texts)]
    rows += [rows[21], (23, texts[24][0], "en", "z", 1), (None, "\n".join(passage + lines("en", 10)), "en", "x", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = c.run(spark, str(tmp_path)).collect()

    good = [(i, clean, lang, s, len(clean)) for i, t, lang, s, _ in rows if (clean := plain_quality(t or "")) is not None]
    model = language_id.learn(spark.createDataFrame(good, schema))
    said = [model.predict(*x) for x in language_id.feature_counts([r[1] for r in good])]
    sure = [r for r, (lang, score) in zip(good, said) if lang != "und" and score >= 0.5]
    once = plain_near_duplicates(sure)
    cut = plain_substrings(once)
    assert len(rows) > len(good) > len(sure) > len(once) and {r[1] for r in once} != {r[1] for r in cut}      # each stage takes something
    ref = tokenizers.Tokenizer.from_file(token_counts.model_file("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t, *_ in cut:
        ids = [*ref.encode(t, add_special_tokens=False).ids, 2]
        at = packing.cuts(len(ids), 1024)
        for k, (s, e) in enumerate(zip(at, [*at[1:], len(ids)])):
            want[i, k, s, e - s, tuple(ids[s:e])] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, tuple(r.ids)) for r in got) == want
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 1024
