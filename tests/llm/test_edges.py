"""Edge cases of the first ten operators and the pipeline: empty tables, clashing columns, repeated rows, very long texts, ties."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, embedding_dedup, html_extract, language_id, minhash_dedup, packing, quality, sharding, substring_dedup, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def spread(spark, rows, schema, parts=3):
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), schema)


def counted(df, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.collect())


# -- empty tables ------------------------------------------------------------------
def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], DOCS)
    for f in (substring_dedup.substring_dedup, sharding.shard_rows, token_counts.token_counts, language_id.identify, packing.pack_documents,
              bpe.encode_digests, minhash_dedup.near_duplicates, quality.clean_lines):
        assert f(none).collect() == [], f.__name__
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_pipeline_on_an_empty_table(spark, tmp_path):
    from tidemark.llm import pipeline
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    out = pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and {"doc_id", "piece", "ids", "sequence_id", "offset"} <= set(out.columns)


# -- clashing columns and repeated rows ------------------------------------------------
def two_languages(n=60):
    rng = random.Random(5)
    words = {"aa": ["tomi", "kalu", "resa", "mino", "pelta", "sora"], "bb": ["zwxy", "qrrt", "vvkh", "xchz", "wqth", "grzz"]}
    return [(i, " ".join(rng.choices(words[l], k=20)), l) for i in range(n) for l in [("aa", "bb")[i % 2]]]


def test_language_id_with_clashing_columns_and_repeated_rows(spark):
    rows = two_languages()
    plain = spread(spark, rows, "doc_id long, text string, lang string")
    want = counted(language_id.identify(plain), "doc_id", "held_out", "lang_pred", "score")
    clash = plain.withColumns({"score": F.lit("x"), "lang_pred": F.lit(1), "held_out": F.lit("no"), "turn": F.lit(0), "order": F.lit("o"), "places": F.lit(2)})
    assert counted(language_id.identify(clash), "doc_id", "held_out", "lang_pred", "score") == want
    again = counted(language_id.identify(plain.unionByName(plain.where("doc_id in (0, 1)"))), "doc_id", "lang_pred")
    assert again[0, "aa"] == again[1, "bb"] == 2 and sum(again.values()) == len(rows) + 2
    other = spread(spark, [*rows, (2, rows[1][1], "bb"), (None, rows[0][1], "aa"), (None, None, None)], "doc_id long, text string, lang string")
    got = counted(language_id.identify(other), "doc_id", "lang_pred")
    assert got[2, "aa"] == got[2, "bb"] == 1 and got[None, "aa"] == got[None, "und"] == 1


def test_embedding_dedup_with_clashing_columns_repeated_ids_and_other_lengths(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((6, 8)).astype(np.float32)
    rows = [(i, base[i % 6].tolist(), 0) for i in range(12)]
    rows += [(3, base[3].tolist(), 0), (20, base[0].tolist()[:4], 0), (21, base[0].tolist()[:4], 0), (None, base[0].tolist(), 0), (22, base[0].tolist(), 1)]
    vectors = spread(spark, rows, "vec_id long, embedding array<float>, label int")
    clash = vectors.withColumns({c: F.lit("x") for c in ("n_links", "component_id", "kept", "node", "copies", "k1", "dim", "sound")})
    got = counted(embedding_dedup.near_vectors(clash), "vec_id", "n_links", "component_id", "kept")
    assert got[0, 1, 0, True] == got[6, 1, 0, False] == 1           # the vectors of another length and label are no links
    assert got[3, 2, 3, True] == 2 and got[9, 2, 3, False] == 1     # a repeated id: both rows in one component
    assert got[20, 1, 20, True] == got[21, 1, 20, False] == 1
    assert got[22, 0, 22, True] == 1 and got[None, 0, None, True] == 1 and sum(got.values()) == len(rows)


def test_embedding_audit_sees_components_that_were_not_joined(spark):
    """Two loose groups that touch at one end: whole they are one component, and cut apart the audit says so."""
    rng = np.random.default_rng(3)
    angle = np.concatenate([np.linspace(0, 1.2, 60), 1.2 + np.linspace(0.1, 1.3, 60)])
    x = np.stack([np.cos(angle), np.sin(angle), *0.001 * rng.standard_normal((4, 120))], axis=1)
    v = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (v @ v.T >= 0.98) & ~np.eye(120, dtype=bool)
    assert link[:60, 60:].any()
    rows = spread(spark, [(i, y.tolist(), 0) for i, y in enumerate(x.astype(np.float32))], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(rows).collect()}
    assert got == {i: (int(n), 0) for i, n in enumerate(link.sum(1))}
    nodes = rows.selectExpr("vec_id node", "cast(label as long) label", "size(embedding) dim", "embedding", "1L copies")
    counts = spread(spark, [(i, int(n)) for i, n in enumerate(link.sum(1))], "node long, n long")
    apart = spread(spark, [(i, 0 if i < 60 else 60) for i in range(120)], "node long, component long")
    assert embedding_dedup._audit(nodes, counts, 0.98, apart) == 0
    assert embedding_dedup._audit(nodes, counts, 0.98, apart.withColumn("component", F.lit(0).cast("long"))) == 1


def pages(layout, n=24):
    out = []
    for i in range(n):
        body = [f"Paragraph {j} of page {i} tells a story about things that happened, in more words than a menu has, and it ends here after a while." for j in range(5)]
        out.append((i, layout(i, f"Title {i}", body), f"Title {i} " + " ".join(body)))
    return out


LAYOUTS = {
    "classes": lambda i, t, b: f"<div class=navbar><a href=a>Home</a> <a href=b>About</a></div><div class='post-content'><h1>{t}</h1>" + "".join(f"<p>{x}</p>" for x in b)
    + "</div><div class=sidebar><a href=c>More</a> <a href=d>News</a></div><div id=footer>Imprint</div>",
    "main": lambda i, t, b: f"<header><h2>Site</h2></header><main><h1>{t}</h1>" + "".join(f"<div><p>{x}</div>" for x in b) + "</main><aside>Ads here</aside><footer>2020</footer>",
    "comments": lambda i, t, b: f"<nav><a href=a>Home</a></nav><article><h1>{t}</h1>" + "".join(f"<p>{x}</p>" for x in b)
    + "<form><input><button>Send</button></form></article><section class=comments><p>First comment by a reader, which is long enough to look like text.</p></section>",
    "plain": lambda i, t, b: f"<div><a href=x>Start</a> | <a href=y>Archive</a></div><div><div><h1>{t}</h1>" + "".join(f"<p>{x}</p>" for x in b) + "</div></div><div><a href=z>Legal</a></div>",
}


def test_html_layouts(spark):
    """Pages of several layouts together; pages without hints are learned from those that have them."""
    rows, want = [], {}
    for k, layout in enumerate(LAYOUTS.values()):
        for i, html, text in pages(layout):
            rows.append((100 * k + i, "u", f"<html><body>{html}</body></html>"))
            want[100 * k + i] = text
    got = {r.page_id: r.text for r in html_extract.extract(spread(spark, rows, "page_id long, url string, html string")).collect()}
    right = collections.Counter(list(LAYOUTS)[i // 100] for i in want if got[i] == want[i])
    assert right["classes"] == right["main"] == right["comments"] == 24, right
    whole = [i for i in want if i >= 300]
    assert all(want[i].split(" ", 2)[2] in got[i] for i in whole), [got[i] for i in whole][:1]


def test_html_with_clashing_columns_repeated_pages_and_deep_nesting(spark):
    rows = [(i, "u", f"<html><body>{html}</body></html>") for i, html, _ in pages(LAYOUTS["main"])]
    deep = "<div>" * 4000 + "<p>deep text, in a sentence.</p>" + "</div>" * 4000
    wide = "<main>" + "".join(f"<p>Sentence {j} of a long page, which has an end.</p>" for j in range(30_000)) + "</main>"
    rows += [rows[0], (0, "v", rows[1][2]), (None, None, rows[2][2]), (50, "u", deep), (51, "u", wide), (52, "u", "<" * 5000), (53, "u", "&amp;" * 3)]
    table = spread(spark, rows, "page_id long, url string, html string").withColumns({c: F.lit(7) for c in ("text", "n_chars", "order", "x", "y")})
    got = html_extract.extract(table).collect()
    by = collections.Counter((r.page_id, r.url, r.text) for r in got)
    texts = {i: t for i, _, t in pages(LAYOUTS["main"])}
    assert by[0, "u", texts[0]] == 2 and by[0, "v", texts[1]] == 1 and by[None, None, texts[2]] == 1 and len(got) == len(rows)
    long = next(r for r in got if r.page_id == 51)
    assert long.text.count("Sentence") == 30_000 and long.n_chars == len(long.text)


def test_html_formulas_and_labels_of_figures_are_text():
    texts = [t for t in html_extract.Dom("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds<figure><svg><style>s</style><text>axis</text></svg></figure>").texts if t]
    assert " ".join(texts) == "so x=2 holds axis"


# -- very long texts -----------------------------------------------------------------
def test_very_long_texts(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**7)}" for _ in range(300_000)]
    lines = [" ".join(words[i:i + 9]) + "." for i in range(0, len(words), 9)]
    long = "\n".join(lines)
    near = "\n".join(lines[:-100])
    docs = spread(spark, [(1, long), (2, near), (3, "x" * 2_000_000), (4, " ".join(words[1000:1040]))], "doc_id long, text string")
    cut = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(docs, with_text=False).collect()}
    n, m = len(WORD.findall(long)), len(WORD.findall(near))
    assert cut[1] == (n, 0) and cut[2] == (m, m) and cut[3] == (1, 0)
    classes = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(docs).collect()}
    assert classes == {1: 1, 2: 1, 3: 3, 4: 4}
    good = {r.doc_id: (r.n_words, r.n_lines, r.n_lines_failed, r.kept) for r in quality.clean_lines(docs).collect()}
    assert good[1] == (n, len(lines), 0, True) and good[3] == (1, 1, 0, False)
    said = language_id.identify(docs.unionByName(spread(spark, [r[:2] for r in two_languages()], "doc_id long, text string")).withColumn(
        "lang", F.when(F.col("text").startswith("w"), None).when(F.col("text").rlike("[zwxq]{2}"), "bb").otherwise("aa")))
    assert said.count() == 64


# -- sharding: mixture, seeded order, ties ------------------------------------------------
def test_sharding_mixture_order_and_ties(spark):
    sizes = {"big": 400, "mid": 100, "same": 100, "tiny": 5, None: 60}
    rows = [(i, f"t{i % 50}", s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    rows += [rows[0], rows[0]]                      # rows that repeat
    random.Random(1).shuffle(rows)
    docs = spread(spark, rows, "doc_id long, text string, source string", 5)
    got = sharding.shard_rows(docs).collect()
    total = collections.Counter(r.source for r in got)
    per = collections.Counter((r.shard, r.source) for r in got)
    for (shard, source), n in per.items():
        assert abs(n - total[source] / 24) <= 1.5, (shard, source, n)
    assert all((s, source) in per for s in range(24) for source, n in total.items() if n >= 60)
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(24))
    for s in range(24):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    for source in sizes:                            # within its source a row's rank is that of the seeded shuffle
        mine = sorted((r for r in got if r.source == source), key=lambda r: r.source_rank)
        keys = [hashlib.md5(f"{sharding.SEED}/{r.doc_id}".encode()).hexdigest() for r in mine]
        assert keys == sorted(keys) and [r.source_rank for r in mine] == list(range(1, len(mine) + 1))
    same = lambda rs: {(r.doc_id, r.shard, r.slot) for r in rs}
    assert same(sharding.shard_rows(docs.repartition(2)).collect()) == same(got)            # ties are broken by the rows alone
    assert same(sharding.shard_rows(docs, seed="other").collect()) != same(got)


# -- language ID: penalties, ties, calibration ----------------------------------------------
def test_language_model_is_sparse_and_calibrated(spark):
    rows = two_languages(120)
    model = language_id.learn(spread(spark, rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb"] and 0.05 <= model.temperature <= 5
    used = np.abs(model.weights).sum(1) > 0
    assert 0 < used.mean() < 0.05                   # features never seen, and weak ones, have no weight
    said = [model.predict(*x) for x in language_id.feature_counts([t for _, t, _ in rows])]
    assert [s[0] for s in said] == [l for _, _, l in rows] and all(0 <= s[1] <= 1 for s in said)
    sure = np.mean([s[1] for s in said])
    assert sure > 0.9                               # right on all rows: calibrated scores say so


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["same words here", "", "no end", "12", "same words here", "same words here."]
    together = list(language_id.feature_counts(texts))
    for t, (at, counts) in zip(texts, together):
        ((a, c),) = language_id.feature_counts([t])
        assert (a == at).all() and (c == counts).all()
    assert (together[0][0] == together[4][0]).all() and (together[0][0] == together[5][0]).all()


def test_language_tie_is_stable(spark):
    rows = [(i, "same words here", ("aa", "bb")[i % 2]) for i in range(40)]
    docs = spread(spark, rows, "doc_id long, text string, lang string")
    first, second = (counted(language_id.identify(d), "doc_id", "lang_pred", "score") for d in (docs, docs.repartition(5)))
    assert first == second and {k[1] for k in first} <= {"aa", "bb"}


def test_language_sample_is_bounded(spark, monkeypatch):
    """The most frequent languages are learned, one text of a doc_id counts, and the sample keeps to its bound."""
    rows = [(i, t, lang) for i, (_, t, lang) in enumerate(two_languages())]
    rare = [(10_000 + i, "zzz qqq xxx", f"rare{i}") for i in range(6)]
    hot = [(10_100, f"hot text {i}", "rare0") for i in range(4)]
    docs = spread(spark, rows + rare + hot, "doc_id long, text string, lang string")
    seen = []
    fit = language_id.fit
    monkeypatch.setattr(language_id, "fit", lambda rows, idf: seen.append(rows) or fit(rows, idf))
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 20)
    assert len(language_id.learn(docs).languages) == 2 and not any("rare" in lang for lang in language_id.learn(docs).languages)
    assert all(len(s) <= 20 for s in seen)
    monkeypatch.setattr(language_id, "LANGUAGES", 512)
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 20_000)
    language_id.learn(spread(spark, hot * 3, "doc_id long, text string, lang string"))
    assert len(seen[-1]) <= 1
