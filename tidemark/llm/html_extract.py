"""Main text of web pages by gradient-boosted trees over DOM nodes.

Each node (block element or text run) is MIXED (an ancestor of the article),
MAIN (inside it) or BOILER.  One forest per class scores the features of
``html_dom``: depth, subtree text and link density, attribute tokens of the node,
its ancestors and its subtree, and statistics of the siblings.

*Labels* are weak: in pages with an article or main element, what lies in it and
in no navigation, header, footer, form, advert or comment element is MAIN, its
ancestors are MIXED, the rest is BOILER.  Elsewhere long runs with few links are
MAIN.  The trees also see copies of the rows without the hints of their own labels
(so that densities carry the decision where a page has no such tags) and
boilerplate rows placed inside an article.  The fit uses ``sample_pages`` pages,
first by MD5 of the page_id; the driver gets their feature rows only.

*Decoding* picks the most probable consistent tree: below BOILER everything is
BOILER, below MAIN nothing is MIXED.  It is one pass from the leaves up and one down.

Text: character references decoded, white space inside a block one space, blocks
joined in page order by one space; nothing is cut off.

Rules: null html is empty (empty text); rows that repeat a page_id are extracted
each; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Forest, fit_forest
from tidemark.llm.html_dom import F_AT, FEATURES, Dom, features

MIXED, MAIN, BOILER = 0, 1, 2
SAMPLE_PAGES = 200
PAGES_AT_ONCE = 100
_HINTS = [F_AT[n] for n in ("main_own", "main_above", "main_below", "boiler_own", "boiler_above", "boiler_below")]


def weak_labels(dom: Dom, x: np.ndarray) -> np.ndarray:
    main = (x[:, F_AT["main_own"]] + x[:, F_AT["main_above"]]) > 0
    boiler = (x[:, F_AT["boiler_own"]] + x[:, F_AT["boiler_above"]]) > 0
    if main.any():
        holds = x[:, F_AT["main_below"]] > 0
    else:
        run = np.array([t is not None for t in dom.texts])
        main = run & (np.expm1(x[:, F_AT["words"]]) >= 20) & (x[:, F_AT["link_density"]] < 0.3)
        holds = np.zeros(len(main), bool)
        for i in range(len(main) - 1, 0, -1):
            holds[dom.parents[i]] |= main[i] | holds[i]
    return np.where(boiler, BOILER, np.where(main, MAIN, np.where(holds, MIXED, BOILER)))


@dataclass
class Model:
    forests: list[Forest]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        p = np.stack([1 / (1 + np.exp(-np.clip(f.margin(x), -30, 30))) for f in self.forests], 1) + 1e-6
        return np.log(p / p.sum(1, keepdims=True))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    bare = x.copy()
    bare[:, _HINTS] = 0
    moved = x[y == BOILER].copy()                      # boilerplate inside an article, told by its tokens alone
    moved[:, F_AT["main_above"]] = 1
    moved[:, F_AT["boiler_own"]] = 1
    moved[:, F_AT["start"]] = rng.random(len(moved))
    moved[:, F_AT["depth"]] += rng.integers(0, 3, len(moved))
    rows = np.concatenate([x, bare, moved])
    labels = np.concatenate([y, y, np.full(len(moved), BOILER)])
    weight = np.concatenate([np.ones(len(x)), np.full(len(x), 0.3), np.ones(len(moved))])
    return Model([fit_forest(rows, (labels == c).astype(float), weight) for c in (MIXED, MAIN, BOILER)])


def decode(parents: list[int], score: np.ndarray) -> np.ndarray:
    """Most probable states with BOILER closed downwards and no MIXED below MAIN."""
    n = len(parents)
    up = score.copy()                 # best sum of the subtree, by the node's own state
    s = up.tolist()
    for i in range(n - 1, 0, -1):
        mixed, main, boiler = s[i]
        p = s[parents[i]]
        p[BOILER] += boiler
        p[MAIN] += main if main >= boiler else boiler
        p[MIXED] += max(mixed, main, boiler)
    state = [MIXED] * n
    for i in range(n):
        mixed, main, boiler = s[i]
        above = state[parents[i]] if i else MIXED
        if above == BOILER:
            state[i] = BOILER
        elif above == MAIN:
            state[i] = MAIN if main >= boiler else BOILER
        else:
            state[i] = MIXED if mixed >= max(main, boiler) else MAIN if main >= boiler else BOILER
    return np.array(state)


def _feature_rows(batches):
    for batch in batches:
        out = []
        for html in batch.column("html").to_pylist():
            dom = Dom(html or "")
            x = features(dom)
            out += [(row, int(y)) for row, y in zip(x.tolist(), weak_labels(dom, x))]
        yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in out], pa.list_(pa.float64())), pa.array([y for _, y in out], pa.int32())], names=["x", "y"])


def learn(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Model | None:
    sample = pages.where(F.length("html") > 0).select(F.md5(F.col("page_id").cast("string")).alias("order"), "page_id", "html") \
        .orderBy("order", "page_id", F.md5("html")).limit(sample_pages).select("html")
    rows = sample.mapInArrow(_feature_rows, "x array<double>, y int").collect()      # the nodes of sample_pages pages
    if not rows:
        return None
    rows.sort(key=lambda r: (r["x"], r["y"]))
    return fit(np.array([r["x"] for r in rows]).reshape(-1, len(FEATURES)), np.array([r["y"] for r in rows]))


def extract_text(htmls: list[str], model: Model) -> list[str]:
    doms = [Dom(h) for h in htmls]
    xs = [features(d) for d in doms]
    scores = model.log_odds(np.concatenate(xs))
    out, a = [], 0
    for dom, x in zip(doms, xs):
        state = decode(dom.parents, scores[a:a + len(x)])
        a += len(x)
        out.append(" ".join(t for t, s in zip(dom.texts, state) if t is not None and s == MAIN))
    return out


def _extract(model: Model | None):
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(a, PAGES_AT_ONCE)
                htmls = [h or "" for h in part.column("html").to_pylist()]
                texts = extract_text(htmls, model) if model else [""] * len(htmls)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(_extract(learn(pages, sample_pages)), "page_id long, url string, text string, n_chars long")
