"""Lexical search, hard negatives and decontamination against brute force, and their odd rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brontide.llm import catalog, decontaminate, hard_negatives, lexical
from brontide.llm.terms import terms

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 97}" for i in range(400_000))


def words_of(text):
    return WORDS.findall((text or "").translate(LOWER))


def test_terms_are_those_of_the_pattern():
    odd = ["", "Ab-C_d é É 1\x7f2\x002 ", "x" * 3_000_000 + " Y", "\U0001f642A\n" * 1000, " " * 2_000_000 + "a", LONG]
    for text in odd:
        assert [w.decode() for part in terms(text.encode()) for w in part] == words_of(text)
    assert list(terms(None)) == []


def corpus(seed=3, n=120, words=30):
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"W{x}" for x in rng.zipf(1.4, rng.integers(1, 80)) % words) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)]


# --- decontamination -----------------------------------------------------------------------------

def hits(doc, items, window):
    """Hit words and items by looking at every position."""
    words, hit, found = words_of(doc), set(), set()
    for item, text in items:
        own = words_of(text)
        size = min(len(own), window)
        grams = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(item)
    return len(words), sorted(hit), found


@pytest.mark.parametrize("limits", [decontaminate.Limits(window=4), decontaminate.Limits(window=4, shard_words=60, piece_words=13)])
def test_decontamination_equals_brute_force(spark, limits):
    docs = corpus() + [(500, None), (501, ""), (502, "..!"), (None, "w1 w1 w1 w2"), (503, "w1"), (503, "w1"), (504, LONG)]
    items = [(i, t) for i, t in corpus(seed=8, n=25, words=40)] + [(90, "W3"), (91, "w2 w1"), (92, None), (93, "?"), (94, "w1 w2 w1"), (90, "W3")]
    found = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(items, "item_id long, text string"), limits=limits).collect()
    assert len(found) == len(docs)
    texts = {}
    for i, t in docs:
        texts.setdefault(i, t)
    for r in found:
        n, hit, of = hits(texts[r["doc_id"]], items, 4)
        spanned = [i for s in r["spans"] for i in range(s["start"], s["end"])]
        assert (r["n_words"], spanned, set(r["items"]), r["contaminated"]) == (n, hit, {str(x) for x in of}, bool(hit))
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_longest_match_is_that_of_any_item():
    items = [(i, words_of(t)) for i, t in corpus(seed=5, n=12)]
    automaton = decontaminate.Automaton([(str(i), [w.encode() for w in own]) for i, own in items], 5)
    runs = {tuple(own[a:b]) for _, own in items for a in range(len(own)) for b in range(a + 1, len(own) + 1)}
    for _, text in corpus(seed=6, n=40):
        own = words_of(text)
        longest = max((b - a for a in range(len(own)) for b in range(a + 1, len(own) + 1) if tuple(own[a:b]) in runs), default=0)
        assert automaton.match(iter([[w.encode() for w in own]]))[2] == longest


def test_spans_are_cut_and_covered_documents_go(spark):
    passage = "the quick brown fox jumps over the lazy dog today"
    docs = [(1, f"Before it, é: {passage.upper()}! After: all of these other words stay as they are."), (2, passage), (3, "clean text"), (4, None), (5, ""),
            (6, f"{'x ' * 30}{passage}. {'y ' * 30}{passage}")]
    table = spark.createDataFrame(docs, "doc_id long, Text string").select("*", F.lit(7).alias("__spans"), F.lit("a").alias("n_words"))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    out = decontaminate.clean(table, bench, text="Text")
    assert out.columns == table.columns
    assert {r["doc_id"]: r["Text"] for r in out.collect()} == {
        1: "Before it, é: ! After: all of these other words stay as they are.", 3: "clean text", 4: None, 5: "", 6: f"{'x ' * 30}. {'y ' * 30}"}
    assert decontaminate.clean(table, bench.limit(0), text="Text").count() == len(docs)
    assert decontaminate.find(table.limit(0), bench, text="Text").collect() == []
    none = decontaminate.find(table, bench.limit(0), text="Text").collect()
    assert len(none) == len(docs) and not any(r["contaminated"] for r in none)


def test_leak_digest(spark):
    items = spark.createDataFrame([(10, "a b c"), (9, "b c"), (None, "z z"), (10, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c"), (2, "z z"), (3, "q")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in decontaminate.find(docs, items).collect()}
    assert found[1]["items"] == ["10", "9"] and found[2]["items"] == [] and found[2]["contaminated"] and not found[3]["contaminated"]
    assert found[1]["spans"] == [(1, 4)] and found[1]["longest"] == 3


# --- lexical search ------------------------------------------------------------------------------

def ranked(docs, items, k):
    bags = [(i, Counter(words_of(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for w, f in df.items()}
    out = {}
    for item, text in items:
        asked, scores = Counter(words_of(text)), []
        for i, b in bags:
            m = 100 - 25 + 25 * sum(b.values()) * n // length
            score = sum(q * weight[w] * (10 ** 9 * b[w] // (1000 * b[w] + 12 * m)) for w, q in asked.items() if w in b)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out[item] = [(None if none else i, -s) for s, none, i in sorted(scores)[:k]]
    return {item: rows for item, rows in out.items() if rows}


SMALL = [lexical.Settings(k=5), lexical.Settings(k=5, block=4, rows=30, items=4), lexical.Settings(k=3, block=1, postings=50, item_terms=20)]


@pytest.mark.parametrize("settings", SMALL)
def test_search_equals_brute_force(spark, settings):
    docs = corpus(n=150, words=60) + [(900, None), (901, ""), (902, "-"), (None, "w1 w7 w9"), (903, "w1 w7 w9"), (903, "w1 w7 w9"), (904, LONG), (None, "w1 w7 w9")]
    items = corpus(seed=21, n=12, words=90) + [(70, None), (71, "nothing known"), (72, "w1 W1 w1 w7"), (72, "w1 W1 w1 w7")]
    table = spark.createDataFrame(docs, "doc_id long, text string").select("*", *[F.lit("own").alias(c) for c in ("score", "rank", "key", "n", "ids")])
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = lexical.rank(table, asked, settings=settings).collect()
    own = {}
    for r in sorted(found, key=lambda r: (r["item_id"], r["rank"])):
        own.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
        assert r["rank"] == len(own[r["item_id"]])
    assert own == ranked(docs, items, settings.k)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.rank(docs.limit(0), items).collect() == [] and lexical.rank(docs, items.limit(0)).collect() == []


def shard_of(bags, items, s):
    """A shard and its block of items from bags of term numbers."""
    starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])))
    cols = np.array([t for b in bags for t in sorted(b)], np.int64)
    tfs = np.array([b[t] for b in bags for t in sorted(b)], np.int64)
    n = int(cols.max()) + 1
    df = np.bincount(cols, minlength=n)
    weights = np.floor(1000 * np.log((2 * len(bags) + 2) / (2 * df + 1))).astype(np.int64)
    asked = lexical.Items(list(range(len(items))), np.concatenate(([0], np.cumsum([len(b) for b in items]))), np.array([t for b in items for t in sorted(b)], np.int64),
                          np.array([b[t] for b in items for t in sorted(b)], np.int64), weights, len(bags), sum(sum(b.values()) for b in bags))
    lengths = np.array([sum(b.values()) for b in bags])
    return lexical.Shard(lengths, starts, cols, tfs, np.arange(len(bags)), asked, s), asked


def test_blocks_are_skipped_by_their_bounds_only():
    """Forty topics that share their words: most blocks fall short of the bound, and no result changes."""
    rng = np.random.default_rng(0)
    topics = [rng.choice(200, 20, replace=False) for _ in range(40)]
    bags = [Counter(rng.choice(topics[i % 40], 30).tolist()) + Counter(rng.integers(0, 200, 3).tolist()) for i in range(4000)]
    items = [Counter(bags[i]) for i in range(0, 4000, 400)]
    s = lexical.Settings(k=10)
    shard, asked = shard_of(bags, items, s)
    walked, best = lexical.Walked(), [[] for _ in items]
    shard.search(best, lambda row: (False, int(row)), walked)
    assert walked.scored < 0.5 * walked.blocks
    for i, item in enumerate(items):
        q = np.zeros(len(asked.weights))
        for t, c in item.items():
            q[t] = c
        scores = np.add.reduceat(shard.values * q[shard.cols], shard.starts[:-1]).astype(int)
        order = np.lexsort((np.arange(len(bags)), -scores))[:10]
        assert [(-b[0], b[2]) for b in best[i]] == [(scores[d], d) for d in order]
    # A summary is the coordinatewise maximum of its block.
    term = int(np.argmax(np.diff(shard.lists)))
    docs, first = shard._blocks(term)
    assert sorted(docs) == sorted(shard.posted[shard.lists[term]:shard.lists[term + 1]])
    column = np.arange(len(asked.weights))
    summaries = shard._summaries(docs, first, column, len(column))
    dense = np.zeros((len(bags), len(column)))
    dense[shard.rows, shard.cols] = shard.values
    for b, (a, e) in enumerate(zip(first, [*first[1:], len(docs)])):
        assert (summaries[b] == dense[docs[a:e]].max(axis=0)).all()


def test_large_numbers_use_integers():
    s = lexical.Settings(k=3)
    bags = [Counter({0: 5, 1: 2}), Counter({0: 1}), Counter({1: 9})]
    items = [Counter({0: 10 ** 8, 1: 3})]
    shard, _ = shard_of(bags, items, s)
    assert not shard.exact
    best = [[]]
    shard.search(best, lambda row: (False, int(row)), lexical.Walked())
    score = lambda b: sum(c * int(shard.values[(shard.rows == b) & (shard.cols == t)].sum()) for t, c in items[0].items())
    assert best[0] == sorted((-score(b), False, b) for b in range(3) if score(b) > 0)


# --- hard negatives ------------------------------------------------------------------------------

def negatives(rows, is_anchor, m):
    out = []
    for a, label, u in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(u, v)), i, own) for i, own, v in rows if i != a and len(v) == len(u))
        for p, i in [(-s, i) for s, i, own in scored if own == label][:m.positives]:
            hard = [(-s, n) for s, n, own in scored if own != label and m.low * p <= 100 * -s <= m.high * p][:m.negatives]
            out += [(a, i, r, n, p, s) for r, (s, n) in enumerate(hard, 1)]
    return sorted(out)


def vectors(kind, n=600, size=12):
    rng = np.random.default_rng(4)
    if kind == "even":
        v = rng.normal(size=(n, size))
    elif kind == "ties":
        v = rng.integers(-1, 2, size=(n, size)) / 2
    else:
        v = rng.normal(size=(20, size))[np.arange(n) % 20] * 3 + 0.1 * rng.normal(size=(n, size))
    return [(i, int(x), v[i].astype(np.float32).tolist()) for i, x in enumerate(rng.integers(0, 3, n))]


@pytest.mark.parametrize("kind", ["even", "ties", "clusters"])
@pytest.mark.parametrize("settings", [hard_negatives.Mining(), hard_negatives.Mining(rows_per_centre=40, shard=30, bundle=4, sample=100)])
def test_negatives_equal_brute_force(spark, kind, settings):
    rows = vectors(kind)
    quantised = [(i, x, [math.floor(256 * c) for c in v]) for i, x, v in rows]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    found = hard_negatives.mine(table, F.col("vec_id") % 20 == 0, mining=settings)
    assert sorted(map(tuple, found.collect())) == negatives(quantised, lambda i: i % 20 == 0, settings)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.8, 0.0]), (3, 2, [0.7, 0.5]), (4, 1, [0.0, 0.0]), (50, 3, [0.0, 0.0]), (5, 3, [0.0, 0.0])]
    odd = [(None, 1, [1.0, 0.0]), (6, None, [1.0, 0.0]), (7, 1, None), (8, 1, [nan, 1.0]), (9, 1, [inf, 0.0]), (10, 1, [None, 1.0]), (11, 1, []),
           (12, 2, [1.0, 0.0, 0.0]), (100, 1, [5.0]), (13, 2, [1e300, 1.0]), (2, 2, [0.8, 0.0])]
    table = spark.createDataFrame(good + odd, "vec_id long, label int, embedding array<double>")
    table = table.select("*", *[F.lit("own").alias(c) for c in ("id", "node", "rank", "size", "centre", "score")])
    found = sorted(map(tuple, hard_negatives.mine(table, F.col("vec_id") % 50 == 0).collect()))
    quantised = [(i, x, [math.floor(256 * c) for c in v]) for i, x, v in good]
    assert found == negatives(quantised, lambda i: i % 50 == 0, hard_negatives.Mining())
    assert hard_negatives.mine(table.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert hard_negatives.mine(table, F.lit(None).cast("boolean")).collect() == []


def test_large_components_are_exact(spark):
    rows = [(i, i % 2, [2.0 ** 20 + i, -(2.0 ** 19) + 3 * i]) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    m = hard_negatives.Mining(low=50, high=100)
    found = sorted(map(tuple, hard_negatives.mine(table, F.col("vec_id") % 10 == 0, mining=m).collect()))
    assert found == negatives([(i, x, [math.floor(256 * c) for c in v]) for i, x, v in rows], lambda i: i % 10 == 0, m)


def test_walk_ends_early_on_clusters():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(50, 16))
    v = np.floor(256 * (centres[np.arange(20_000) % 50] + 0.05 * rng.normal(size=(20_000, 16)))).astype(np.int64)
    rows = {"id": np.arange(20_000), "node": np.zeros(20_000, np.int64), "label": np.arange(20_000) % 3, "v": v}
    at = np.arange(0, 1000, 50)
    members = {c: x[at] for c, x in rows.items()}
    low = np.full(len(at), -(1 << 63))
    wants = hard_negatives.Wants(np.arange(len(at)), low, np.full(len(at), (1 << 63) - 1), low, 5)
    centre = hard_negatives.find_centres(hard_negatives.directions(members["v"])[1], 1, 0)[0]
    scored = hard_negatives.walk(members, wants, rows, centre, True)
    assert scored < 0.2 * len(at) * 20_000
    for j, a in enumerate(at):
        scores = v @ v[a]
        order = [i for i in np.lexsort((np.arange(20_000), -scores)) if i != a and rows["label"][i] == rows["label"][a]][:5]
        assert sorted(wants.id[wants.at == j]) == sorted(order)


def test_queries_on_the_tables(spark):
    """Every document, and digests that fit the counts."""
    found = catalog.op13_decontamination(spark, "/root/testdata/sf0.001").collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(found) == 200 and any(r["contaminated"] for r in found)
    assert all((r["n_items"] == 0) == (r["items_sha256"] == empty) for r in found)
