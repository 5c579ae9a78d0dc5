"""Registered queries next to their SQL, and the pipeline against brute force."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from brontide.llm import catalog, mixing, packing
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", catalog.SQL)
def test_query_equals_sql(spark, name):
    assert compare(catalog.QUERIES[name], catalog.SQL[name], spark, connect(SF_DIR), SF_DIR) is None


def test_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


def shingle_sets(texts):
    return [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]


def test_pipeline(spark):
    """Each stage on what the one before kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR).cache()
        steps[name] = docs.toPandas()
        if name != "pack":
            assert docs.columns == columns
    labels = dict(map(tuple, spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality").collect()))
    assert len(steps["language"]) == 200  # all of these have letters of a known language
    kept = set(steps["quality"]["doc_id"])
    # Fitted on some sixty labels, so not every one of the others is told rightly.
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(right) > 0.95 * len(right)

    good, distinct = steps["quality"], steps["near duplicates"]
    sets = shingle_sets(good["text"])
    class_of = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = class_of[i], class_of[j]
                class_of = [b if c == a else c for c in class_of]
    firsts = defaultdict(list)
    for c, i in zip(class_of, good["doc_id"]):
        firsts[c].append(i)
    assert sorted(distinct["doc_id"]) == sorted(min(ids) for ids in firsts.values())

    taken = Counter(steps["mix"]["doc_id"])
    assert max(taken.values()) <= 3 and set(taken) <= set(distinct["doc_id"])
    packed = steps["pack"]
    assert Counter(packed[packed["piece"] == 0]["doc_id"]) == taken
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096


def test_mix_meets_targets(spark):
    mixed = catalog.op10_mixing(spark, SF_DIR).toPandas()
    for _, own in mixed.groupby("source_size"):
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= own["size"].max()
    assert mixing.mix(spark.read.parquet(f"{SF_DIR}/documents.parquet")).count() == len(mixed)


def test_packing_covers_every_token(spark):
    packed = catalog.op1_packing(spark, SF_DIR).toPandas()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas().set_index("doc_id")
    from tokenizers import Tokenizer
    import zlib
    import numpy as np

    tokenizer = Tokenizer.from_file(catalog.tokenizer_path())
    for doc, own in packed.sort_values("start").groupby("doc_id"):
        ids = np.array([*tokenizer.encode(docs.loc[doc, "text"], add_special_tokens=False).ids, 1], "<u4")
        assert own["length"].sum() == len(ids) and list(own["piece"]) == list(range(len(own)))
        for row in own.itertuples():
            assert row.start == 4096 * row.piece and (row.length == 4096 or row.start + row.length == len(ids))
            assert row.ids_crc32 == zlib.crc32(ids[row.start:row.start + row.length].tobytes())
    packed = packed.sort_values(["sequence_id", "offset"])
    assert (packed.groupby("sequence_id")["length"].cumsum() - packed["length"] == packed["offset"]).all()
    lengths = sorted(packed["length"], reverse=True)
    assert packed["sequence_id"].nunique() <= len(packing.best_fit(list(range(len(lengths))), lengths, 4096))
