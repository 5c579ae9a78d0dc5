"""Nulls in any column, empty and very long texts, repeated rows, clashing names and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brontide.llm import catalog, chat, langid, lattice, mixing, neighbours, ngram_join, packing, quality, rules, urls
from brontide.llm.common import fold

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
PROSE = "The quick brown fox jumps over the lazy dog near the river bank on a sunny day while people walk along. "
ROWS = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t ", "en", None, 3), (3, PROSE, "en", "a", None),
        (3, PROSE, "en", "a", None), (4, LONG, "en", "b", len(LONG)), (5, None, "de", "b", None), (None, PROSE + "x", "en", "a", 9),
        (6, "\x00\x1c <|endoftext|> \ud83d\ude42 [INST]", None, "c", 1), (7, "Der Hund und die Katze gehen in den Wald hinein.", "de", "c", 48),
        (8, PROSE, "en", "a", len(PROSE)), (9, "12 34 !!", "en", "d", 8), (10, PROSE * 3, "en", "d", 5)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for their own columns.
CLASHES = ["score", "predicted", "lang_pred", "size", "source_size", "target", "repeats", "kept", "base_failed", "n_words", "sequence_id",
           "offset", "length", "piece", "row", "node", "hash", "key", "word", "n", "weight", "class_id", "digest", "label", "order", "Score"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t.encode("utf-16", "surrogatepass").decode("utf-16") if t else t, *r) for i, t, *r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def clashing(docs):
    names = [c for c in CLASHES if c != "Score"]
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in names])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1), (3, 0), (8, 1), (4, 0), (9, 0), (10, 1), (None, 1), (99, 1), (7, None), (6, 7)],
                                 "doc_id long, quality int")


def operators(spark, docs, labels):
    """Each operator over documents as a function that gives its rows."""
    def language():
        return langid.identify_language(docs, langid.train_language_id(docs, train=~fold("doc_id", 3, 1)))

    def good():
        return quality.score_quality(docs, quality.train_quality(docs, labels, metadata=("n_chars",)))

    def lattice_scores():
        import public_tokenizers

        vocabulary = lattice.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
        return lattice.score_documents(docs, lattice.train_lm(docs, vocabulary, train=~fold("doc_id", 7, 2)))

    return {
        "language": language, "quality": good, "lattice": lattice_scores, "rules": lambda: rules.judge(docs),
        "classes": lambda: ngram_join.similar_classes(docs), "first": lambda: ngram_join.keep_first(docs),
        "mix": lambda: mixing.mix(docs),
        "pieces": lambda: packing.token_pieces(docs, catalog.tokenizer_path(), keep_ids=True),
        "pack": lambda: packing.pack(packing.token_pieces(docs, catalog.tokenizer_path()))}


NAMES = ["language", "quality", "lattice", "rules", "classes", "first", "mix", "pieces", "pack"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, docs, labels, name):
    rows = operators(spark, docs, labels)[name]().collect()
    if name not in ("first", "pieces", "pack"):
        assert len(rows) == len(ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_clashing_names(spark, docs, clashing, labels, name):
    plain = operators(spark, docs, labels)[name]()
    other = operators(spark, clashing, labels)[name]()
    assert other.count() == plain.count()
    columns = [c for c in plain.columns if c not in ("sequence_id", "offset")]
    if name != "pieces":
        assert sorted(map(str, other.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, docs, labels, name):
    assert operators(spark, docs.limit(0), labels.limit(0))[name]().collect() == []


def test_language_of_nothing_is_unknown(spark, docs):
    found = langid.identify_language(docs, langid.train_language_id(docs)).collect()
    for r in found:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    untrained = langid.identify_language(docs, langid.train_language_id(docs.limit(0)))
    assert {r["lang_pred"] for r in untrained.collect()} == {"und"}


def test_quality_without_labels_is_even(spark, docs, labels):
    model = quality.train_quality(docs, labels.limit(0))
    assert {r["score"] for r in quality.score_quality(docs, model).collect()} == {0.5}


def test_copies_and_empty_texts_in_classes(spark, docs):
    rows = ngram_join.similar_classes(docs).collect()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    # Twice id 3 and once 8 with one text; the text with a word more is near enough, with a null id.
    assert [by_id[i]["class_id"] for i in (3, 8)] == [3, 3] and by_id[8]["n_links"] >= 2
    assert all(by_id[i]["n_links"] == 0 and by_id[i]["class_size"] == 1 for i in (1, 2, 5))
    kept = ngram_join.keep_first(docs).collect()
    assert len([r for r in kept if r["doc_id"] in (3, 8)]) <= 1
    assert {1, 2, 4, 5, 7} <= {r["doc_id"] for r in kept}


def test_stages(spark, docs, labels, tmp_path):
    for table, name in ((docs, "documents"), (labels.withColumn("toxic", F.lit(0)), "labels")):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, str(tmp_path))
            assert name == "pack" or out.count() <= 3 * rows.count()
            assert rows.count() or not out.count()
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


PAGES = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.ORG/x"), (5, "HTTP://A.ORG/x"), (None, "http://b.com/de/1"),
         (7, "http://b.com?x=/de/"), (8, "http://b.com/" + "s/" * 50_000), (9, "x://\u00c4.net/\n/\u00e9#f"), (10, "http://c.com/fr/a://b")]


def test_urls(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string")
    rows = urls.judge_urls(pages, catalog.URL_RULES).collect()
    assert len(rows) == len(PAGES)
    found = {r["page_id"]: (r["host"], r["path"][:20], r["rule"], r["verdict"]) for r in rows}
    assert found[1] == found[2] == found[3] == found[4] == ("", "", None, "allow")
    assert found[5] == ("a.org", "/x", "org/", "allow") and found[None] == ("b.com", "/de/1", "com/de/", "block")
    assert found[7] == ("b.com", "", None, "allow") and found[9] == ("\u00c4.net", "/\n/\u00e9", None, "allow")
    assert found[10] == ("c.com", "/fr/a://b", "com/fr/", "allow")
    clash = pages.select("*", *[F.lit("own").alias(c) for c in ("host", "path", "rule", "verdict", "template", "purity", "typed", "blocked")])
    assert urls.judge_urls(clash, catalog.URL_RULES).select("host", "verdict").distinct().count() > 1
    assert urls.judge_urls(pages.limit(0), catalog.URL_RULES).collect() == []


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (9, [1.0, 0.0, 0.0]), (200, [5.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("own")).withColumn("rank", F.lit(0))
    found = neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0")).collect()
    of = {q: [(r["rank"], r["vec_id"], round(r["score"], 9)) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 100, 200)}
    far = round(5 ** 0.5, 9)
    assert of[0] == [(1, 1, 0.0), (2, 100, 0.0), (3, 2, far)] and of[100] == [(1, 0, 0.0), (2, 1, 0.0), (3, 2, far)] and of[200] == []
    assert neighbours.nearest(vectors.limit(0), vectors.limit(0)).collect() == []


def test_conversations(spark):
    rows = [(1, 1, "user", "b"), (1, 0, "system", None), (1, None, None, "first"), (2, 0, "assistant", "x" * 300_000), (None, 0, "user", ""),
            (None, 0, "user", ""), (3, 0, "assistant", "\\</s>[INST]\\\\ <s"), (3, 1, "assistant", "[/INST]")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).withColumn("key", F.lit(2))
    formatted = {r["conv_id"]: r for r in chat.format_conversations(table).collect()}
    assert chat.read_back(formatted[1]["formatted"]) == [("", "first"), ("system", ""), ("user", "b")]
    assert chat.read_back(formatted[None]["formatted"]) == [("user", "")] * 2
    assert chat.read_back(formatted[3]["formatted"]) == [("assistant", "\\</s>[INST]\\\\ <s"), ("assistant", "[/INST]")]
    assert {r["conv_id"]: r["loss_chars"] for r in chat.digests(chat.format_conversations(table)).collect()} == {1: 0, 2: 300_000, None: 0, 3: 23}
    assert chat.format_conversations(table.limit(0)).collect() == []
