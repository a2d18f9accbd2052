"""Lexical search, cross-tokenizer alignment and exact dedup against brute force, and their edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest

from tidemark.llm import alignment, exact_dedup, lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spread(spark, rows, schema, parts):
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), schema)


def texts():
    rng = random.Random(5)
    vocabulary = [w for n in (1, 2, 3) for w in ("".join(x) for x in itertools.product("abcdé", repeat=n))]
    rng.shuffle(vocabulary)
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    out = [" ".join(rng.choices(vocabulary, weights, k=rng.choice([2, 30, 120]))) for _ in range(150)]
    out += [out[3], out[3].upper(), out[4].title(), "ÉÀ Straße İ", "éÀ sTRAßE İ", None, "", " \t\n", "one", "ab " * 3000, "…", "a\x00b"]
    return out


@pytest.fixture(scope="module")
def rows():
    # repeated rows and ids, null ids; a group that holds a third of all rows
    out = [(i, t) for i, t in enumerate(texts())]
    out += [out[10], out[10], (10, out[11][1]), (None, out[12][1]), (None, "only null ids"), (None, "only null ids")]
    out += [(1000 + i, "The Common text") for i in range(80)]
    random.Random(6).shuffle(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    # columns that clash with names used inside
    return spread(spark, [(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n long, hash string, pairs int", 7)


# -- exact dedup -----------------------------------------------------------------
def groups(rows):
    by = collections.defaultdict(list)
    for i, t in rows:
        by[(t or "").translate(FOLD)].append(i)
    return by


def want_dedup(rows):
    out = collections.Counter()
    for text, ids in groups(rows).items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for nth, i in enumerate(sorted(ids, key=lambda i: i != keep)):
            out[i, keep, len(ids), nth == 0, sha] += 1
    return out


def got_dedup(df):
    return collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_exact_dedup(spark, docs, rows):
    assert got_dedup(exact_dedup.exact_duplicates(docs)) == want_dedup(rows)
    assert exact_dedup.exact_duplicates(docs.limit(0)).collect() == []


def test_exact_dedup_long_text(spark):
    rows = [(1, "Ab" * 2_000_000), (2, "aB" * 2_000_000), (3, "ab" * 2_000_000 + "c")]
    assert got_dedup(exact_dedup.exact_duplicates(spread(spark, rows, "doc_id long, text string", 3))) == want_dedup(rows)


def test_collisions_are_chained(docs, rows):
    assert got_dedup(exact_dedup.exact_duplicates(docs, lambda data: len(data) % 5)) == want_dedup(rows)


def test_directory_doubles_and_splits():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 20, 1 << 10)
    cells[77] = 10_000                      # one text that no bit splits
    slots, depth = exact_dedup.grow(cells, 500)
    assert depth == 10 and len(slots) == 1 << depth
    bucket = slots[np.arange(1 << 10) >> (10 - depth)]
    load = np.bincount(bucket, weights=cells)
    assert load.sum() == cells.sum() and load[np.arange(len(load)) != bucket[77]].max() <= 500
    assert (bucket == bucket[77]).sum() == 1
    for b in range(len(load)):              # a bucket is one aligned range of hashes
        at = np.flatnonzero(bucket == b)
        assert len(at) & (len(at) - 1) == 0 and at[0] % len(at) == 0 and at[-1] - at[0] == len(at) - 1
    assert exact_dedup.grow(np.zeros(256, dtype=np.int64), 1)[1] == 0


# -- lexical search ----------------------------------------------------------------
ITEMS = [(1, "a b Cd é"), (2, "DDD a a"), (3, None), (4, "-- !?"), (5, "nowhere"), (1, "a b Cd é"), (None, "common TEXT"), (7, "abé bb cc d e ea b a c"), (2, "b")]


def want_search(rows, items, k):
    held = [(i, collections.Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in rows]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = collections.Counter()
    for item, text in set(items):
        if text is None:
            continue
        scores = []
        for i, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(TERM.findall(text.translate(FOLD))) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, None if none else i, -s] += 1
    return out


def got_search(df):
    return collections.Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("k, shard, block", [(50, 1 << 22, 1 << 17), (7, 200, 5)])
def test_search(spark, docs, rows, k, shard, block):
    items = spread(spark, [(*i, "x") for i in ITEMS], "item_id long, text string, score string", 2)
    assert got_search(lexical_search.search(docs, items, k, shard, block)) == want_search(rows, ITEMS, k)


def test_search_without_rows(spark, docs):
    items = spread(spark, ITEMS, "item_id long, text string", 1)
    assert lexical_search.search(docs.limit(0), items).collect() == []
    assert lexical_search.search(docs, items.limit(0)).collect() == []
    assert lexical_search.search(docs, items.where("item_id in (3, 4, 5)")).collect() == []


def test_nra_stops_early_and_is_exact():
    rng = np.random.default_rng(2)
    n, saved = 20_000, 0
    for trial in range(30):
        lists = []
        for _ in range(rng.integers(1, 6)):
            docs = rng.permutation(n)[:rng.integers(1, n)]
            gains = np.sort(rng.integers(1, 50 if trial % 2 else 10**6, len(docs)))[::-1].astype(np.int64)
            lists.append((docs, gains))
        whole = np.zeros(n, dtype=np.int64)
        for docs, gains in lists:
            whole[docs] += gains
        k = int(rng.integers(1, 60))
        bar = np.sort(whole)[-k]
        found, score = lexical_search.nra(lists, n, k)
        assert sorted(found) == list(np.flatnonzero((whole >= bar) & (whole > 0))) and (whole[found] == score).all()
        high = int(bar) + 1
        found, score = lexical_search.nra(lists, n, k, high)
        assert sorted(found) == list(np.flatnonzero(whole >= high)) and (whole[found] == score).all()

    class Read:
        def __init__(self, x):
            self.x, self.last = x, 0

        def __len__(self):
            return len(self.x)

        def __getitem__(self, at):
            self.last = max(self.last, at.stop if isinstance(at, slice) else at)
            return self.x[at]

    docs, gains = Read(np.arange(n)), np.arange(n, 0, -1)
    lexical_search.nra([(docs, gains)], n, 5)
    assert docs.last <= 4 * lexical_search.FIRST_READ       # one list: the top is known from its head


# -- alignment ------------------------------------------------------------------------
@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def letters():
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def want_alignment(rows, tokenizers):
    a, b = tokenizers
    byte = letters()
    held = []
    for i, t in rows:
        t = t or ""
        enc = a.encode(" " + t, add_special_tokens=False)
        A = [(x, bytes(byte[c] for c in a.id_to_token(x))) for x in enc.ids]
        B = [(x, bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode()) for x in b.encode(t)]
        want = (" " + t).encode()
        if not t or any(b"".join(x for _, x in side) != want for side in (A, B)):
            A = B = []
        ends = [list(itertools.accumulate(len(x) for _, x in side)) for side in (A, B)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        parts, links = [], []
        for lo, hi in zip([0, *cuts], cuts):
            pick = [[x for (x, _), e in zip(side, ee) if lo < e <= hi] for side, ee in zip((A, B), ends)]
            parts.append(",".join(map(str, pick[0])) + "|" + ",".join(map(str, pick[1])))
            links.append((pick[0][-1], pick[1][-1]))
        held.append((i, len(A), len(B), parts, links))
    count = collections.Counter(x for h in held for x in h[4])
    top = collections.defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return collections.Counter((i, na, nb, len(parts), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                                hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else "") for i, na, nb, parts, links in held)


def odd_texts():
    rng = random.Random(7)
    alphabet = list("abcdefgh  \n\t'.,0123 ") + list("éüßñ中文字日本語кирил…▁  👍🏽‍́") + ["<|endoftext|>", "<s>", "</s>", "<0x41>", "the ", " of"]
    return ["".join(rng.choices(alphabet, k=rng.choice([1, 5, 40, 200]))) for _ in range(400)]


def got_alignment(df):
    return collections.Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_alignment(spark, rows, tokenizers, broadcast_pairs):
    rows = rows + [(5000 + i, t) for i, t in enumerate(odd_texts())] + [(6000, "<|endoftext|>"), (6001, "▁"), (6002, " "), (6003, "x" * 30_000)]
    docs = spread(spark, [(*r, 3) for r in rows], "doc_id long, text string, pairs int", 5)
    want = want_alignment(rows, tokenizers)
    assert got_alignment(alignment.align(docs, broadcast_pairs=broadcast_pairs)) == want
    assert sum(1 for r in want if r[1] == 0) > 3 and sum(1 for r in want if r[3] > 1) > 300


def test_alignment_groups_and_empty(spark, docs):
    got = alignment.align(docs, with_groups=True).where("n_a > 0").limit(20).collect()
    assert got and all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 and r.groups.count(";") + 1 == r.n_groups for r in got)
    assert alignment.align(docs.limit(0)).collect() == []


def test_components_of_a_long_chain():
    # tokens of two bytes that overlap like bricks: one component from end to end
    n = 10_000
    end_a, end_b = np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n, 2), 2 * n)
    a, b = alignment.components(end_a, end_b)
    assert set(a) == {n - 1} and set(b) == {n - 1}
    a, b = alignment.components(np.array([1, 3, 4, 9]), np.array([2, 4, 5, 9]))
    assert a.tolist() == [2, 2, 2, 3] and b.tolist() == [2, 2, 3, 3]


# -- the word tokenizer over all of Unicode -------------------------------------------
def test_word_tokenizer_on_every_code_point():
    """Ids equal the library's for every code point between letters, and for those that this Python does not know alone and among digits."""
    import unicodedata

    import public_tokenizers as P
    from tokenizers import Tokenizer

    from tidemark.llm import bpe
    library = Tokenizer.from_file(P.path(bpe.WORD_MODEL))
    library.no_padding()
    library.no_truncation()
    mine = bpe.word_tokenizer(bpe.WORD_MODEL)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    new = [c for c in points if unicodedata.category(c) == "Cn" and ord(c) < 0x40000]
    for chars, context in ((points, "a{}B"), (new, "{}"), (new, "1{} 2{}Σ!")):
        for i in range(0, len(chars), 20_000):
            texts = [context.replace("{}", c) for c in chars[i:i + 20_000]]
            want = library.encode_batch(texts, add_special_tokens=False)
            wrong = [t for t, e in zip(texts, want) if mine.encode(t).tolist() != e.ids]
            assert not wrong, [hex(ord(max(t))) for t in wrong[:10]]


# -- token counts of texts without boundaries --------------------------------------------
def test_token_counts_send_a_text_without_boundaries_twice(spark, monkeypatch):
    """16 MiB without a space, stretches without one over several chunks, and boundaries right at seams."""
    from pyspark.sql import functions as F

    from tidemark.llm import token_counts
    rng = random.Random(11)
    solid = lambda n: "".join(rng.choices("abcdefgh0123456789+/", k=1024)) * (n // 1024)
    chunk = token_counts.CHUNK
    rows = [(1, solid(1 << 24)), (2, solid(3 * chunk) + " x " + solid(5 * chunk) + " " + "y z " * 9000), (3, ("w" * (chunk - 1) + " ") * 7),
            (4, "中文" * (2 * chunk)), (5, (solid(2048) + " ") * 60), (None, solid(2 * chunk) + " end"), (5, "a" * chunk + " b")]
    docs = spread(spark, rows, "doc_id long, text string", 3)
    sent, cut = [], token_counts._pieces

    def counted(*args):
        out = cut(*args)
        sent.append(out.agg(F.sum(F.length("piece"))).first()[0])
        return out

    monkeypatch.setattr(token_counts, "_pieces", counted)
    sp = token_counts.processor(token_counts.MODEL)
    want = collections.Counter((i, len(t.encode()), len(sp.encode([t], num_threads=1, return_type="numpy")[0])) for i, t in rows)
    got = token_counts.token_counts(docs).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert sum(sent) < 4 * sum(len(t) for _, t in rows) and len(sent) <= 3


# -- the second round of the near-dedup ---------------------------------------------------
def test_second_round_sends_a_member_once_per_block_of_outsiders(spark):
    """A bucket of many near copies and one outsider: the outsider meets all, members travel once."""
    from pyspark.sql import functions as F

    from tidemark.llm import minhash_dedup as m
    rng = random.Random(13)
    n = 3 * m.BLOCK
    rest = spark.createDataFrame([(i, 7, 0 if i else 9, 0, 1, 3) for i in range(n)], "doc_id long, band long, component long, largest long, is int, js int")
    words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    texts = spark.createDataFrame([(i, " ".join(words + [f"own{i}"])) for i in range(n)], "doc_id long, text string")
    reps = m.signatures(texts).select("doc_id", F.array(F.lit(7).cast(m.signatures(texts).schema["bands"].dataType.elementType)).alias("bands"), "bits")
    sent = m._sides(rest, reps, texts)
    count = {r.mine: r.n for r in sent.groupBy("mine").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert count == {True: 3, False: n}
    links = m._second_round(rest, reps, texts, 4, 5).collect()
    assert links and all(0 in (r.a, r.b) for r in links)
