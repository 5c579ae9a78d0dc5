"""The methods against plain versions of what they compute."""

import itertools
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from brontide.llm import catalog, chat, common, graph, langid, lattice, mixing, neighbours, ngram_join, packing, quality, rules, urls

SF = "/root/testdata/sf0.01"


# --- hashing of words ---------------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.text("ab \t\n\x0b\u00e9\U0001f642", max_size=60))
def test_word_hashes_tell_words_apart(text):
    words = [w.decode() for w in text.encode().split()]
    hashes = common.word_hashes(common.code_points(text)).tolist()
    assert len(hashes) == len(words)
    assert all((a == b) == (x == y) for (a, x), (b, y) in itertools.combinations(zip(hashes, words), 2))


# --- packing ------------------------------------------------------------------------------------

def loads(packing_, lengths):
    return [sum(lengths[i] for i in members) for members in packing_]


def test_crossover_keeps_every_piece_once():
    random_ = np.random.default_rng(0)
    lengths = sorted(random_.integers(1, 100, 120).tolist(), reverse=True)
    a, b = (packing.best_fit(random_.permutation(120).tolist(), lengths, 100) for _ in range(2))
    for _ in range(30):
        child = packing.mutate(packing.crossover(a, b, lengths, 100, random_), lengths, 100, random_)
        assert sorted(itertools.chain.from_iterable(child)) == list(range(120)) and max(loads(child, lengths)) <= 100
        a, b = b, child


def test_evolution_beats_the_first_packing():
    """Bins that fill up only in one way: the best fit misses some, the evolution finds more."""
    random_ = np.random.default_rng(3)
    lengths = []
    for _ in range(60):
        a, b = sorted(random_.integers(200, 800, 2))
        lengths += [int(x) for x in (a, b - a, 1000 - b) if x > 0]
    lengths.sort(reverse=True)
    first = packing.best_fit(list(range(len(lengths))), lengths, 1000)
    settings_ = packing.Evolution(population=8, generations=600)
    best = packing.evolve([], lengths, 1000, settings_, np.random.default_rng(1))[0]
    assert len(best) <= len(first) and packing.fitness(best, lengths, 1000) > packing.fitness(first, lengths, 1000)


def test_islands_share_elites(spark):
    items = spark.createDataFrame([(i, int(x)) for i, x in enumerate(np.random.default_rng(1).integers(1, 4097, 400))], "id long, length long")
    packed = packing.pack(items, settings=packing.Evolution(pool=150, islands=3, epochs=3)).toPandas()
    assert sorted(packed["id"]) == list(range(400)) and packed.groupby("sequence_id")["length"].sum().max() <= 4096
    for _, own in packed.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert list(own["offset"]) == [0, *np.cumsum(own["length"])[:-1]]
    with pytest.raises(Exception, match="length out of range"):
        packing.pack(items.withColumn("length", F.lit(5000)))


def test_table_of_hashes(monkeypatch):
    monkeypatch.setattr(packing._Table, "BITS", 8)
    random_, table, known = np.random.default_rng(0), packing._Table(), {}
    for _ in range(10):
        # Few first slots, so that probing goes on, around the end too.
        hashes = np.unique((random_.integers(250, 256, 20).astype(np.uint64) << np.uint64(56)) + random_.integers(1, 1 << 20, 20).astype(np.uint64))
        new = hashes[table.find(hashes) < 0]
        table.add(new, np.arange(len(known), len(known) + len(new)))
        known.update(zip(new.tolist(), range(len(known), len(known) + len(new))))
        every = np.array(list(known), np.uint64)
        assert table.find(every).tolist() == list(known.values()) and (table.find(every + np.uint64(1 << 30)) == -1).all()


def test_words_are_encoded_as_in_their_text():
    from tokenizers import Tokenizer

    tokenizer, cache = Tokenizer.from_file(catalog.tokenizer_path()), packing.WordCache(open(catalog.tokenizer_path()).read())
    random_ = random.Random(1)
    signs = "aAbB'sS\u03a3\u03c3\u0130\u0131\u00e9\u00c9 \t\n\x1c\x85\xa0\u20031\u0663#*-<|>endoftext\u00f1\u6f22\U0001f642'RE'll\u00df\u01c5\u00ba"
    texts = ["".join(random_.choices(signs, k=random_.randint(0, 40))) + random_.choice(["", " <|endoftext|>x", "'tis DON'T!!! "])
             for _ in range(2000)]
    for text, ids in zip(texts, cache.encode_all(pa.array(texts))):
        assert list(ids) == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_task_holds_one_tokenizer():
    from tokenizers import Tokenizer

    cache = packing.WordCache(open(catalog.tokenizer_path()).read())
    assert sum(isinstance(x, Tokenizer) for x in vars(cache).values()) == 1
    before, _ = cache.tokenizer.normalizer.normalize_str("A\u00c9"), list(cache.encode_all(pa.array(["Words and 'S"])))
    assert cache.tokenizer.normalizer.normalize_str("A\u00c9") == before


# --- chat ---------------------------------------------------------------------------------------

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "a", "\n", "{{ x }}", "{% if %}"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "\\</s>"]), st.lists(st.sampled_from(PIECES), max_size=8).map("".join)), max_size=5))
def test_conversations_can_be_read_back(turns):
    text, spans = chat.compile_template()([{"role": r, "text": t} for r, t in turns])
    assert chat.read_back(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@pytest.mark.parametrize("source, text", [
    ("{{ 'a' + 'b' | upper }}{# no #}c", "aBc"), ("{% if 1 == 2 %}x{% elif 'a' in 'cat' %}y{% else %}z{% endif %}", "y"),
    ("{% for m in messages %}{{ loop.index }}{{ m['text'] }}{% if not loop.last %},{% endif %}{% endfor %}", "1p,2q"),
    ("{% set n = messages | length %}{{ n }}{% if n > 1 and messages[0].role != 'user' or false %}!{% endif %}", "2!"),
    ("{{ '}}' }}{{ \"'\" }}{{ none }}", "}}'"), ("{% for m in messages %}{% endfor %}", "")])
def test_templates(source, text):
    assert chat.compile_template(source)([{"role": "system", "text": "p"}, {"role": "user", "text": "q"}])[0] == text


def test_constants_are_folded():
    known = chat.filters()
    assert chat.fold(chat.parse("a{{ 'b' | upper }}{% if true %}c{% else %}{{ x }}{% endif %}{% if false %}d{% endif %}"), known) == [("text", "aBc")]
    assert chat.fold(chat.parse("{{ true and x }}{{ 1 == 1 or x }}"), known) == [("put", ("name", "x")), ("text", "True")]


@pytest.mark.parametrize("source", ["{{ x }}", "{{ messages.__class__ }}", "{{ messages[9] }}", "{{ _x }}", "{{ f('a') }}", "{% for %}{% endfor %}",
                                    "{% if 1 %}", "{% endif %}", "{{ 1 | eval }}", "{% import os %}", "{{ 'a }}", "{% for c in 'ab' %}x{% endfor %}",
                                    "{{ }}", "{{ 1 2 }}", "{% else %}", "{% generation %}"])
def test_the_sandbox_refuses(source):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(source)([{"role": "a", "text": "b"}])


# --- rules --------------------------------------------------------------------------------------

def plain_statistics(text):
    words = [w.decode("utf-8") for w in text.encode().split()]
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, t in enumerate(zip(words, words[1:], words[2:])) if triples[t] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if line.encode().split()]
    return (len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text), len(lines), len(lines) - len(set(lines)), len(covered),
            sum(a == b for a, b in zip(words, words[1:])))


def test_statistics(spark):
    random_ = random.Random(2)
    texts = ["".join(random_.choices(["a", "b", " ", " ", "\n", "\t", "\x0b", "\x0c", "\r", "#", "\u00e9", "\U0001f642", "\xa0"], k=random_.randint(0, 60)))
             for _ in range(400)] + ["a b c a b c", "a a a a", "", "x"]
    df = rules.with_statistics(spark.createDataFrame(list(enumerate(texts)), "i int, text string"))
    for r in df.collect():
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutter")) \
            == plain_statistics(texts[r["i"]]), repr(texts[r["i"]])


def test_order_of_rules():
    made = [rules.Estimate(rules.Rule(n, "true"), s, r) for n, s, r in (("dear", 1.0, 0.5), ("cheap", 0.1, 0.2), ("never", 0.01, 0.0), ("b", 0.1, 0.2))]
    assert [r.name for r in rules.order_rules(made)] == ["b", "cheap", "dear", "never"]


def test_rules_behind_a_rejection_do_not_run(spark):
    made = [rules.Rule("first", "id % 2 = 0"), rules.Rule("second", "assert_true(id % 2 = 1) is not null")]
    verdicts = spark.range(10).withColumn("kept", rules.cascade(made)).collect()
    assert all(r["kept"] == (r["id"] % 2 == 1) for r in verdicts)


# --- near duplicates ----------------------------------------------------------------------------

def edited(random_, words, share):
    return [random_.choice("abcdefgh") * random_.randint(1, 9) if random_.random() < share else w for w in words]


@pytest.mark.parametrize("block", [7, 400])
def test_classes_equal_brute_force(spark, block):
    """Copies, near copies, a passage that all share, and a group larger than a block."""
    random_ = random.Random(4)
    vocabulary = ["".join(random_.choices("abcdefghijk", k=6)) for _ in range(400)]
    passage = random_.choices(vocabulary, k=40)
    texts = []
    for base in range(30):
        words = passage + random_.choices(vocabulary, k=random_.randint(3, 200))
        texts += [" ".join(words)] * random_.randint(1, 3)
        texts += [" ".join(edited(random_, words, random_.choice([0.005, 0.02, 0.05]))) for _ in range(40 if base == 0 else 4)]
    texts += ["", "one two", "one two", "one  two ", "one two three four five"]
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (t.split() for t in texts)]
    links = defaultdict(set)
    for i, j in itertools.combinations(range(len(sets)), 2):
        if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            links[i].add(j)
            links[j].add(i)
    root = list(range(len(sets)))
    for i in range(len(sets)):
        todo = [i]
        while todo:
            k = todo.pop()
            for j in links[k]:
                if root[j] > root[i]:
                    root[j] = root[i]
                    todo.append(j)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = ngram_join.similar_classes(df, forest=ngram_join.Forest(block=block)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in found} == {i: (root[i], len(links[i])) for i in range(len(texts))}
    sizes = Counter(root)
    assert all(r["class_size"] == sizes[r["class_id"]] for r in found)
    assert sorted(r["doc_id"] for r in ngram_join.keep_first(df).collect()) == sorted(sizes)


def test_prefixes_shorten_until_the_recall(spark):
    forest = ngram_join.Forest()
    near = spark.createDataFrame([(8, 0.99)] * 500, "shared int, agree double")
    weak = spark.createDataFrame([(8, 0.99)] * 300 + [(6, 0.82)] * 200 + [(5, 0.8)] * 9, "shared int, agree double")
    assert ngram_join.prefix_depth(near, forest) == 8
    assert ngram_join.prefix_depth(weak, forest) < 8
    assert ngram_join.found_share(0.8, forest.least_depth, forest.trees) > 0.9999
    nothing = near.limit(0)
    k = ngram_join.prefix_depth(nothing, forest)
    assert ngram_join.found_share(0.8, k, forest.trees) >= forest.recall or k == forest.least_depth


def joined_pairs(spark, texts, n_pairs):
    """How many of the pairs of texts 2i and 2i + 1, i < n_pairs, are of one class."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = {r["doc_id"]: r["class_id"] for r in ngram_join.similar_classes(df).collect()}
    return sum(classes[2 * i] == classes[2 * i + 1] for i in range(n_pairs))


def test_links_at_the_threshold_beside_many_near_exact_ones(spark):
    """Pairs of similarity 0.8 sharp are found however many links of the corpus are near exact."""
    random_ = random.Random(11)
    word = lambda: "".join(random_.choices("abcdefghijkl", k=8))
    texts = []
    for _ in range(400):
        words = [word() for _ in range(49)]
        texts += [" ".join(words), " ".join(words[:-5] + [word() for _ in range(5)])]
    for _ in range(1000):
        long = [word() for _ in range(200)]
        texts += [" ".join(long[:-1] + [word()]) for _ in range(4)]
    assert joined_pairs(spark, texts, 400) == 400


def test_links_within_long_runs_of_a_prefix(spark):
    """Linked pairs among texts that share half of what they hold, and so many prefixes."""
    random_ = random.Random(12)
    word = lambda: "".join(random_.choices("abcdefghijkl", k=8))
    passage = [word() for _ in range(64)]
    texts = []
    for _ in range(150):
        words = passage + [word() for _ in range(30)]
        texts += [" ".join(words), " ".join(words[:-9] + [word() for _ in range(9)])]
    texts += [" ".join(passage + [word() for _ in range(30)]) for _ in range(2000)]
    assert joined_pairs(spark, texts, 150) == 150


def test_one_text_per_member_is_verified(spark, monkeypatch):
    """Equal rows of a member's text reach the verification once; it is replaced by a count of its rows."""
    def count(s):
        def run(batches):
            for batch in batches:
                yield batch[["node"]].assign(links=1, to=batch["node"])
        return run

    monkeypatch.setattr(ngram_join, "_verified", count)
    words = [f"w{i}" for i in range(100)]
    copies = spark.range(3000, numPartitions=6).select(F.lit(1).cast("long").alias("doc_id"), F.lit(" ".join(words)).alias("text"))
    df = copies.unionByName(spark.createDataFrame([(2, " ".join(words[:-1]))], "doc_id long, text string"))
    assert {(r["doc_id"], r["n_links"]) for r in ngram_join.similar_classes(df).collect()} == {(1, 2999 + 1), (2, 1)}


def test_components(spark):
    random_ = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100 + random_.randrange(40), 100 + random_.randrange(40)) for _ in range(25)] + [(5, 5), (None, 3)]
    root = {}
    for a, b in edges * 200:
        if a is not None and a != b:
            root[a] = root[b] = min(root.get(a, a), root.get(b, b))
    found = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["root"] for r in found.collect()} == root


# --- quality ------------------------------------------------------------------------------------

def test_linear_time_identity():
    random_ = np.random.default_rng(0)
    linear, factors = random_.normal(size=50), random_.normal(size=(50, 4))
    found, values = np.array([3, 7, 20, 41]), random_.normal(size=4)
    pairs = sum(values[i] * values[j] * factors[found[i]] @ factors[found[j]] for i, j in itertools.combinations(range(4), 2))
    assert quality.score(0.3, linear, factors, found, values) == pytest.approx(0.3 + linear[found] @ values + pairs)


def test_quality_of_rows_not_learned_from(spark):
    scored = catalog.op5_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(scored) > 50 and np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in scored)


# --- URLs ---------------------------------------------------------------------------------------

def test_templates_of_paths(spark):
    paths = ["/en/12.html", "/a/3f2a9c1d77", "/x/Some-Title", "//b//", "/u/abcdefgh12345678xyz", ""]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(urls.typed_segments(F.col("p")).alias("s"))
    assert [r["s"] for r in df.collect()] == [["en", "*.html"], ["a", "*"], ["x", "Some-Title"], ["b"], ["u", "*"], []]


def test_tree_generalises_merges_and_rejects(spark):
    rows = [("h", f"/tag/t{chr(97 + i % 26)}{chr(97 + i // 26)}", 1) for i in range(60)]      # too many children: one wildcard, all blocked
    rows += [("h", f"/news/{i}", 0) for i in range(40)] + [("h", f"/blog/{i}", 0) for i in range(40)]
    rows += [("h", f"/mixed/{i}", i % 2) for i in range(40)] + [("h", "/tag/unseen", None), ("h", "/quiet/1", None), ("g", "/tag/x", None)]
    pages = spark.createDataFrame([(i, f"http://{h}{p}", b) for i, (h, p, b) in enumerate(rows)], "page_id long, url string, bad int")
    found = {r["page_id"]: r for r in urls.judge_urls(pages, [], label="bad").collect()}
    by_path = {(r["host"], r["path"]): r for r in found.values()}
    assert {r["template"] for r in found.values() if r["path"].startswith("/tag") and r["host"] == "h"} == {"/tag/*"}
    assert by_path["h", "/tag/unseen"]["verdict"] == "block" and by_path["g", "/tag/x"]["verdict"] == "allow"
    assert by_path["h", "/quiet/1"]["verdict"] == "allow" and by_path["h", "/mixed/3"]["verdict"] == "allow"
    purity = by_path["h", "/tag/unseen"]["purity"]
    blocked, labelled, overall = 80, 180, 80 / 180
    prior = (blocked + 4 * overall) / (labelled + 4)
    node = (60 + 4 * prior) / (60 + 4)
    assert purity == pytest.approx((60 + 4 * node) / (60 + 4))


def plain_tree(rows, tree):
    """Templates and purities of rows ``host, typed, label`` without Spark."""
    paths = {}
    for host, typed, label in rows:
        own = paths.setdefault((host, tuple(typed)), [0, 0])
        if label is not None:
            own[0] += 1
            own[1] += label
    template = {k: "" for k in paths}
    for level in range(tree.levels):
        below = defaultdict(Counter)
        for (host, typed), t in template.items():
            if len(typed) > level:
                below[host, t][typed[level]] += 1
        wide = {n for n, kids in below.items() if len(kids) > tree.fan_out and len(kids) > tree.variety * sum(kids.values())}
        template = {(h, typed): t if len(typed) <= level else f"{t}/{'*' if (h, t) in wide else typed[level]}" for (h, typed), t in template.items()}
    template = {k: t + ("/**" if len(k[1]) > tree.levels else "") for k, t in template.items()}
    counts, hosts, nodes = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for (h, typed), t in template.items():
        for at in (counts[h, t], hosts[h], nodes[h, re.sub("/[^/]*$", "", t)]):
            at[0] += paths[h, typed][0]
            at[1] += paths[h, typed][1]
    total = [sum(x[i] for x in counts.values()) for i in (0, 1)]
    overall = total[1] / total[0] if total[0] else 0.0
    smooth = lambda x, prior: (x[1] + tree.smoothing * prior) / (x[0] + tree.smoothing)
    group = {}
    for h, node in nodes:
        own = sorted((t for t in counts if t[0] == h and re.sub("/[^/]*$", "", t[1]) == node and counts[t][0] >= tree.support),
                     key=lambda t: (counts[t][1] / counts[t][0], counts[t][0]))
        groups = []
        for i, t in enumerate(own):
            (l, b), (l0, b0) = counts[t], counts[own[i - 1]]
            share = (b + b0) / (l + l0)
            if i and abs(b / l - b0 / l0) <= tree.same * (share * (1 - share) * (1 / l + 1 / l0)) ** 0.5:
                groups[-1].append(t)
            else:
                groups.append([t])
        for g in groups:
            for t in g:
                group[t] = [sum(counts[x][i] for x in g) for i in (0, 1)]
    out = {}
    for t, own in counts.items():
        node = smooth(nodes[t[0], re.sub("/[^/]*$", "", t[1])], smooth(hosts[t[0]], overall))
        pooled = group.get(t, own)
        out[t] = (*pooled, smooth(pooled, node))
    return {k: (t, *out[k[0], t]) for k, t in template.items()}


def test_similar_siblings_are_merged(spark):
    """Two groups under one node: two siblings are blocked alike, two others allowed alike, and one is neither."""
    rows = [("h", ["a", s], b) for s, n, k in (("x", 30, 27), ("y", 20, 18), ("z", 50, 2), ("w", 40, 1), ("m", 60, 30)) for b in [1] * k + [0] * (n - k)]
    found = {r["template"]: (r["labelled"], r["blocked"]) for r in urls.template_tree(spark.createDataFrame(rows, "host string, typed array<string>, blocked int")).collect()}
    assert found == {"/a/x": (50, 45), "/a/y": (50, 45), "/a/z": (90, 3), "/a/w": (90, 3), "/a/m": (60, 30)}


def test_tree_by_brute_force(spark):
    """Templates, groups, purities and verdicts, with labels of their own and of the contract's rules."""
    rng = random.Random(9)
    made = [(f"h{i % 3}.com", "/" + "/".join(rng.choice([["a", "b"], ["x", "y", "z"], [f"slug-{'ab'[j % 2]}{rng.randrange(40)}w" for j in range(9)], [str(rng.randrange(99))], ["q"], ["r"], ["s"], ["t"]][d])
             for d in range(rng.randrange(8))), rng.choice([None, None, 0, 1, 1])) for i in range(900)]
    made = [(h, p, 1 if "/a/x" in p and b is not None else b) for h, p, b in made]
    sets = [spark.createDataFrame([(i, f"http://{h}{p}", b) for i, (h, p, b) in enumerate(made)], "page_id long, url string, bad int"),
            spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")]
    for pages, label, rules_ in ((sets[0], "bad", []), (sets[1], None, catalog.URL_RULES)):
        host, path = urls.split_url("url")
        rule = urls.matching_rule(F.col("h"), F.col("p"), rules_)
        typed = pages.withColumn("h", host).withColumn("p", path).withColumn("t", urls.typed_segments(F.col("p"))).withColumn("rule", rule).toPandas()
        by_rule = [None if r is None else int(r["action"] == "block") for r in typed["rule"]]
        labels = by_rule if label is None else [None if b != b else int(b) for b in typed[label]]
        expected = plain_tree(list(zip(typed["h"], typed["t"], labels)), urls.Tree())
        found = {r["page_id"]: r for r in urls.judge_urls(pages, rules_, label=label).collect()}
        assert len(found) == len(typed)
        for page, h, t, ruled in zip(typed["page_id"], typed["h"], typed["t"], by_rule):
            template, _, _, purity = expected[h, tuple(t)]
            assert (found[page]["template"], found[page]["purity"]) == (template, pytest.approx(purity))
            if ruled is None:
                assert found[page]["verdict"] == ("block" if purity >= 0.8 else "allow")


def test_pages_without_labels_are_judged_by_their_siblings_or_host(spark):
    rows = [(f"http://bad.com/de/{i}", None) for i in range(60)] + [("http://bad.com/xx/7", None), ("http://bad.com/de-at/shop", None)]
    rows += [(f"http://good.com/fr/{i}", None) for i in range(60)] + [("http://good.com/xx/7", None)]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, none int")
    found = {r["url"]: (r["rule"], r["verdict"]) for r in urls.judge_urls(pages, catalog.URL_RULES).collect()}
    assert found["http://bad.com/xx/7"] == (None, "block") and found["http://bad.com/de-at/shop"] == (None, "block")
    assert found["http://good.com/xx/7"] == (None, "allow")


def test_rules_by_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    for r in urls.judge_urls(pages, catalog.URL_RULES).join(pages.withColumnRenamed("url", "u"), "page_id").collect():
        rest = r["u"].partition("://")[2]
        host = rest[:min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))]
        path = rest[len(host):].split("?")[0].split("#")[0]
        host = host.lower()
        fits = [x for x in catalog.URL_RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.prefix), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best.prefix)
        assert r["verdict"] == (best.action if best else r["verdict"]) and r["verdict"] in ("allow", "block")


# --- neighbours ---------------------------------------------------------------------------------

def test_chi_square():
    draws = (np.random.default_rng(0).normal(size=(200_000, 8)) ** 2).sum(axis=1)
    for x in (1.0, 5.0, 8.0, 15.5, 30.0):
        assert neighbours.chi_square(x, 8) == pytest.approx((draws <= x).mean(), abs=0.005)


@pytest.mark.parametrize("rows, queries", [(20_000, 2_000), (120, 2)])
def test_recall_of_neighbours(spark, rows, queries):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"), search=neighbours.Search(rows=rows, queries=queries)).collect()
    table = vectors.toPandas()
    ids, matrix = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    right = 0
    for q in sorted({r["query_id"] for r in found}):
        own = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        distances = np.linalg.norm(matrix - matrix[ids == q][0], axis=1)
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert np.allclose([r["score"] for r in own], [distances[ids == r["vec_id"]][0] for r in own], atol=0, rtol=1e-12)
        distances[ids == q] = np.inf
        right += len({r["vec_id"] for r in own} & set(ids[np.lexsort((ids, distances))[:10]]))
    assert right >= 0.9 * len(found)


def test_copies_of_one_vector(spark):
    """A third of all rows are one vector; the smallest ids among them are found."""
    random_ = np.random.default_rng(5)
    rows = [(i, [0.5] * 16 if i % 3 == 0 else random_.normal(size=16).tolist()) for i in range(900)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours.nearest(vectors, vectors.filter("vec_id = 300"), search=neighbours.Search(rows=200)).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(3 * i, 0.0) for i in range(10)]


def test_repeated_ids_hide_no_neighbours(spark):
    """Many equal rows of one id, and an id with many near vectors, beside others as near."""
    rows = [(1, [1.0, 0.0])] * 30 + [(2, [1.0, 0.0])] * 30 + [(i, [1.0, 0.0]) for i in range(3, 6)]
    rows += [(6, [1.0, 0.001 * i]) for i in range(1, 15)] + [(i, [1.0, 0.1 * i]) for i in range(7, 20)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(vectors, vectors.filter("vec_id = 1")).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert [r["score"] for r in found[:5]] == pytest.approx([0, 0, 0, 0, 0.001])


# --- language -----------------------------------------------------------------------------------

def test_language_of_rows_not_learned_from(spark):
    found = catalog.op8_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").filter("held_out").collect()
    assert len(found) > 300 and np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.98
    assert all(0.25 <= r["score"] <= 1 for r in found)


def test_weights_are_sparse_and_calibrated(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train_language_id(docs)
    assert 0 < model.report["non_zero"] < 0.2 * model.weights.size and model.temperature > 0
    assert np.isfinite(model.weights).all()


def test_letters():
    assert "".join(map(chr, langid.letters("  \u00c9a1!b\n"))) == " \u00e9a b " and "".join(map(chr, langid.letters(None))) == " "


# --- lattice ------------------------------------------------------------------------------------

def segmentations(word, vocabulary):
    arcs = defaultdict(list)
    for i in range(len(word)):
        arcs[i] = vocabulary.steps(word, i)

    def walk(i, log, used):
        if i == len(word):
            yield log, used
        for j, more, pieces in arcs[i]:
            yield from walk(j, log + more, used + pieces)
    return list(walk(0, 0.0, ()))


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return lattice.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("word", ["\u2581the", "\u2581thereing", "\u2581a", "\u2581\u00f1\u00e9\u6f22x", "\u2581", "\u2581\x00\U0001f642"])
def test_marginal_over_all_segmentations(vocabulary, word):
    every = segmentations(word, vocabulary)
    assert lattice.forward(word, vocabulary) == pytest.approx(math.log(sum(math.exp(log) for log, _ in every)))
    total, counts = sum(math.exp(log) for log, _ in every), Counter()
    for log, used in every:
        for p in used:
            counts[p] += 2.5 * math.exp(log) / total
    found = [0.0] * len(vocabulary.values)
    lattice.expected(word, 2.5, vocabulary, found)
    assert {i: pytest.approx(n) for i, n in enumerate(found) if n} == dict(counts)


def test_many_words_at_once(vocabulary):
    random_ = random.Random(6)
    words = [lattice.GAP + "".join(random_.choices("thersionab\u00e9\u6f22\U0001f642\x00", k=random_.choice([0, 1, 3, 9, 41, 120]))) for _ in range(300)]
    assert lattice.forward_all(words, vocabulary) == pytest.approx([lattice.forward(w, vocabulary) for w in words])
    weights, plain = np.array([random_.randint(1, 9) for _ in words]), [0.0] * len(vocabulary.values)
    for word, weight in zip(words, weights):
        lattice.expected(word, float(weight), vocabulary, plain)
    assert lattice.expected_all(words, weights, vocabulary) == pytest.approx(np.array(plain))
    assert not vocabulary.crowded


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text("aBZ\u00c9 \t\n\x0b\x0c\r\x1c\x85\xa0", max_size=12), max_size=6))
def test_words_of_many_texts(texts):
    flat, sizes = lattice.split_words(pa.array(texts, pa.string()))
    own = [[w.decode() for w in lattice.words_of(t)] for t in texts]
    assert flat.to_pylist() == list(itertools.chain.from_iterable(own)) and sizes.tolist() == [len(o) for o in own]


@pytest.mark.parametrize("hot", [0, 50, 200_000])
def test_scores_by_brute_force(spark, vocabulary, hot):
    settings_ = lattice.Settings(hot=hot)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).cache()
    train = ~common.fold("doc_id", 7, 2)
    model = lattice.train_lm(docs, vocabulary, train=train, settings=settings_)
    scores = {r["doc_id"]: r for r in lattice.score_documents(docs, model, settings=settings_).collect()}
    rows = docs.withColumn("use", train).collect()
    counts = Counter(w for r in rows if r["use"] for w in lattice.words_of(r["text"]))
    texts = sum(r["use"] for r in rows)
    n, v = sum(counts.values()) + texts, len(counts) + 1
    lattice_of = {r["word"].encode(): r["lattice"] for r in model.words.collect()}
    for r in rows:
        words, own = lattice.words_of(r["text"]), scores[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((texts + 1) / (n + v + 1))
        assert (own["n_tokens"], own["n_known"], own["train_tokens"]) == (len(words) + 1, sum(w in counts for w in words) + 1, n)
        assert own["base_score"] == pytest.approx(base) and own["score"] == pytest.approx(sum(lattice_of[w] for w in words) + model.end)


def test_expectation_raises_the_likelihood(spark, vocabulary):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    totals = []
    for rounds in (0, 1):
        s = lattice.Settings(rounds=rounds)
        model = lattice.train_lm(docs, vocabulary, settings=s)
        totals.append(lattice.score_documents(docs, model, settings=s).agg(F.sum("score")).first()[0])
    assert totals[1] > totals[0]


# --- mixing -------------------------------------------------------------------------------------

def plain_targets(sizes, weights, epochs):
    """Clamp one source after the other until no target is above its cap."""
    total, clamped = sum(sizes), set()
    while True:
        rest = total - sum(epochs * sizes[i] for i in clamped)
        free = [i for i in range(len(sizes)) if i not in clamped]
        level = rest / sum(weights[i] for i in free) if free else 0
        over = [i for i in free if level * weights[i] > epochs * sizes[i] + 1e-9]
        if not over:
            return [epochs * sizes[i] if i in clamped else level * weights[i] for i in range(len(sizes))]
        clamped |= set(over)


def test_water_filling(spark):
    random_ = random.Random(3)
    for sizes in ([1, 1000, 3, 70, 500, 2], [10] * 7, [1, 1, 1_000_000], [5], [0, 8, 8]):
        rows = [(i * 100 + k, " ".join(["w"] * part), f"s{i}") for i, size in enumerate(sizes) for k, part in enumerate(
            [size // 3, size - size // 3])]
        random_.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        weights = [1 + i % 3 for i in range(len(sizes))]
        found = {r["source"]: (r["source_size"], r["target"]) for r in mixing.source_plan(docs).collect()}
        wanted = plain_targets(sizes, weights, 3)
        for i, size in enumerate(sizes):
            assert found[f"s{i}"][0] == size and found[f"s{i}"][1] == pytest.approx(wanted[i])
        mixed = mixing.mix(docs).collect()
        assert all(0 <= r["repeats"] <= 3 for r in mixed)
        assert {r["doc_id"]: r["repeats"] for r in mixing.mix(docs.repartition(5)).collect()} == {r["doc_id"]: r["repeats"] for r in mixed}


def test_rows_are_repeated(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 3)], "t string, repeats int")
    assert sorted(r["t"] for r in mixing.repeat_rows(df).collect()) == ["b", "c", "c", "c"]


# --- samples and mixes --------------------------------------------------------------------------

def test_quality_sample_is_bounded_in_rows(spark):
    """One labelled key with very many rows, equal and different ones, is one row of the sample."""
    hot = spark.range(15_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("good words "), (F.col("id") % 3).cast("string")).alias("text"))
    others = spark.range(2, 42).select(F.col("id").alias("doc_id"), F.concat(F.lit("bad spam "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(1, 42).select(F.col("id").alias("doc_id"), (F.col("id") == 1).cast("int").alias("quality"))
    model = quality.train_quality(hot.unionByName(others), labels, settings=quality.Settings(sample=100))
    assert model.report["rows"] == 41
    assert quality.train_quality(hot.unionByName(others), labels, settings=quality.Settings(sample=10)).report["rows"] <= 10


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_language_of_equal_rows_is_learned(spark, seed):
    """A language that is one text in very many copies has its share of the sample, and no more."""
    copies = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("Der Hund und die Katze gehen in den Wald").alias("text"), F.lit("de").alias("lang"))
    others = spark.range(20_000).select("id", F.concat(F.lit("The dog and the cat walk into the wood "), F.col("id").cast("string")), F.lit("en"))
    model = langid.train_language_id(copies.unionAll(others), settings=langid.Settings(sample=1000, seed=seed))
    assert 800 <= model.report["rows"] <= 2000
    found = langid.identify_language(copies.limit(1).unionAll(others.limit(1)), model).collect()
    assert [(r["lang"], r["lang_pred"]) for r in found] == [("de", "de"), ("en", "en")]


@pytest.mark.parametrize("seed", range(4))
def test_mix_goes_on_behind_what_does_not_fit(spark, seed):
    """Four long documents among many short ones: the source still ends within half of a short one."""
    sizes = [4000] * 4 + [40] * 200
    rows = [(i, "w " * n, "a") for i, n in enumerate(sizes)] + [(1000 + i, "w " * 50, "b") for i in range(100)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), seed=seed).toPandas()
    for _, own in mixed.groupby("source"):
        taken, target = (own["size"] * own["repeats"]).sum(), own["target"].iloc[0]
        assert abs(taken - target) <= 25 or taken == 3 * own["size"].sum()


def test_full_pieces_go_to_no_pool(spark):
    items = spark.range(3000).select("id", F.when(F.col("id") < 2950, F.lit(64)).otherwise(F.col("id") % 50 + 1).cast("int").alias("length"))
    packed = packing.pack(items, 64).toPandas()
    full = packed[packed["length"] == 64]
    assert full["sequence_id"].is_unique and (full["offset"] == 0).all() and (full["sequence_id"] < 0).all()
    assert not set(full["sequence_id"]) & set(packed[packed["length"] < 64]["sequence_id"]) and len(packed) == 3000


def test_ranges_out_of_reach_are_left_out(spark):
    """On vectors in clusters most queries stay in their own range, and almost every neighbour is found."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(40, 24))[np.arange(6000) % 40] * 4 + 0.2 * rng.normal(size=(6000, 24))
    vectors = spark.createDataFrame([(int(i), v[i].tolist()) for i in range(6000)], "vec_id long, embedding array<double>")
    s = neighbours.Search(rows=300, queries=50)
    queries = vectors.filter("vec_id % 100 = 0")
    found = neighbours.nearest(vectors, queries, search=s).collect()
    right = 0
    for q in range(0, 6000, 100):
        distances = np.linalg.norm(v - v[q], axis=1)
        distances[q] = np.inf
        right += len({r["vec_id"] for r in found if r["query_id"] == q} & set(np.argsort(distances)[:10].tolist()))
    assert right >= 0.97 * 600
    rows = queries.selectExpr("vec_id as id", "embedding as v", "size(embedding) as size")
    everything = vectors.selectExpr("vec_id as id", "embedding as v", "size(embedding) as size")
    ranges = neighbours._find_ranges(everything, s)
    assert ranges[24].n == 20
    placed = neighbours._placed(everything, ranges, s).toPandas()
    points = np.array(placed["point"].tolist())
    assert placed.groupby("range").size().between(100, 900).all()
    extent = {int(r): (24, points[at].min(axis=0), points[at].max(axis=0)) for r, at in placed.groupby("range").indices.items()}
    limits = {q: sorted(r["score"] for r in found if r["query_id"] == q)[-1] for q in range(0, 6000, 100)}
    asked = neighbours._placed(rows, ranges, s).withColumn("limit", F.element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("id").cast("int")))
    assert neighbours._others(asked, extent, s).count() < 0.3 * 60 * 19


def test_ranges_of_equal_points():
    same = neighbours.Ranges(np.ones((50, 4)), 8, 3)
    assert same.n == 1 and (same.of(np.zeros((3, 4))) == 3).all()
    mixed = np.concatenate((np.ones((90, 2)), np.arange(20.0).reshape(10, 2)))
    ranges = neighbours.Ranges(mixed, 8)
    assert sorted(set(ranges.of(mixed))) == list(range(ranges.n)) and ranges.n > 1
    assert neighbours.Ranges(np.zeros((0, 2)), 4).of(np.ones((2, 2))).tolist() == [0, 0]


def test_a_very_long_word_is_streamed():
    """What the recursions hold does not grow with the word, but for a number a character backwards."""
    vocabulary = lattice.Vocabulary(["a", "b", "ab", "abc", "ca"], np.log(np.array([3, 2, 4, 1, 2, *[1] * 257]) / 300))
    plain = {}
    for n in (50_000, 400_000):
        word = "abca" * (n // 4)
        tracemalloc.start()
        plain[n] = lattice.forward(word, vocabulary)
        forward = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        counts = [0.0] * len(vocabulary.logs)
        lattice.expected(word, 1.0, vocabulary, counts)
        backward = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert forward < 100_000 and backward < 16 * n + 100_000
        assert sum(c * len(p) for c, p in zip(counts, ["a", "b", "ab", "abc", "ca"])) + sum(counts[5:]) == pytest.approx(n, rel=1e-4)
    assert plain[400_000] / plain[50_000] == pytest.approx(8, rel=0.01)
