"""Similarity self-join on word n-grams: MinHash LSH forest, then exact verification.

1. Every text becomes its set of five-word shingles as 64-bit hashes (fewer words: one shingle of all).
   Texts with equal sets are one node, however many copies there are.
2. A node's MinHash values label it in each tree of a forest. A tree is a prefix trie, kept as its
   sorted labels: the entries are range-partitioned and sorted, and neighbours in this order share
   the longest prefixes. All that share ``least_depth`` values in a tree are candidates: a link just at the
   threshold is found so with 99.99 %, whatever the other links of the corpus are.
   Where more entries than the neighbours share a prefix, all pairs of them that are not yet connected are
   compared by their signatures, in tiles of bounded size.
3. Candidates whose signatures agree well enough connect the nodes to groups that hold all links.
4. Within each group all pairs are verified on the exact sets. A large group is cut into blocks, and
   each pair of blocks is a task of bounded size, that returns link counts and a spanning forest only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from brontide.llm.common import code_points, give_back, texts_of, windows, word_hashes
from brontide.llm.graph import components
from brontide.session import materialize


@dataclass(frozen=True)
class Forest:
    """``slack`` is how many standard deviations below the threshold a signature may agree."""

    words: int = 5
    similarity: float = 0.8
    trees: int = 24
    depth: int = 8
    least_depth: int = 5
    recall: float = 0.9995
    neighbours: int = 3
    slack: float = 3.5
    block: int = 400
    run_block: int = 2000
    seed: int = 4


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; of all words if they are fewer; none without words."""
    hashes = word_hashes(code_points(text))
    return np.unique(windows(hashes, max(1, min(words, len(hashes)))))


def _multipliers(s: Forest) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(s.seed)
    n = s.trees * s.depth
    return (random.integers(0, 1 << 32, (n, 1), np.uint32) | np.uint32(1)), random.integers(0, 1 << 32, (n, 1), np.uint32)


def signature(found: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """MinHash values, each cut to 16 bits."""
    least = np.full(len(factors), np.uint32(0xFFFFFFFF))
    narrow = (found >> np.uint64(32)).astype(np.uint32) ^ found.astype(np.uint32)
    for i in range(0, len(narrow), 1024):
        h = narrow[i:i + 1024] * factors + shifts
        np.minimum(least, h.min(axis=1), out=least)
    return (least >> np.uint32(8)).astype(np.uint16)


def _node(shingle_bytes: bytes) -> bytes:
    return hashlib.blake2b(shingle_bytes, digest_size=16).digest()


def _sketches(s: Forest, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _multipliers(s)
        for batch in batches:
            nodes, sizes, signatures = [], [], []
            for text in texts_of(batch.column(2)):
                found = shingles(text, s.words)
                nodes.append(_node(found.tobytes()))
                sizes.append(len(found))
                signatures.append(signature(found, factors, shifts).tobytes())
            own = [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *own], names=names)
    return run


def _trie_neighbours(s: Forest):
    """Pairs of entries near each other in a tree's sorted labels, and how long a prefix they share.

    Rows without a pair name the ``run`` of entries with a common prefix, by tree and prefix, where there are more
    of them than neighbours, or where a partition of the sorted labels may cut it.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, first = None, True
        for batch in batches:
            # The last entries of a batch are compared with the first of the next.
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            fresh = 0 if kept is None else len(kept)
            kept = rows.tail(s.neighbours + 1)
            if not len(rows):
                continue
            labels = np.frombuffer(b"".join(rows["label"]), np.uint16).reshape(len(rows), s.depth)
            tree, node = rows["tree"].to_numpy(), rows["node"].to_numpy()
            out = []
            for step in range(1, s.neighbours + 2):
                shared = np.cumprod(labels[:-step] == labels[step:], axis=1).sum(axis=1)
                ok = (tree[:-step] == tree[step:]) & (shared >= s.least_depth) & (np.arange(step, len(rows)) >= fresh)
                at = np.flatnonzero(ok)
                if step <= s.neighbours:
                    out.append(pd.DataFrame({"a": node[at], "b": node[at + step], "shared": shared[at], "run": None}))
            if first:
                at, first = np.append(at, 0), False
            out.append(_runs(rows.iloc[at], s))
            yield pd.concat(out, ignore_index=True)
        if kept is not None:
            yield _runs(kept.tail(1), s)
    return run


def _runs(rows: pd.DataFrame, s: Forest) -> pd.DataFrame:
    names = {bytes([t]) + label[:2 * s.least_depth] for t, label in zip(rows["tree"], rows["label"])}
    return pd.DataFrame({"a": None, "b": None, "shared": 0, "run": list(names)}, columns=["a", "b", "shared", "run"])


def link_tile(node: list[bytes], root: list[bytes], signatures: np.ndarray, left: np.ndarray, right: np.ndarray,
              least: int) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the pairs of left and right whose signatures agree in ``least`` values, between nodes that
    neither their roots nor pairs before them connect."""
    label = np.unique(np.array(root, object), return_inverse=True)[1]
    out = []
    for i in left:
        others = right[label[right] != label[i]]
        for k in range(0, len(others), 4096):
            some = others[k:k + 4096]
            near = some[(signatures[some] == signatures[i]).sum(axis=1) >= least]
            for other in np.unique(label[near]):
                if other != label[i]:
                    out.append((node[i], node[near[label[near] == other][0]]))
                    label[label == other] = label[i]
    return out


def _linked_runs(s: Forest, least: int):
    """Links of the tiles of rows that come sorted by tile; holds one tile at a time."""
    def tile(rows: list[tuple]) -> list[tuple]:
        (_, i, j), blocks = rows[0][:3], np.array([r[5] for r in rows])
        left = np.flatnonzero(blocks == i)
        right = left if i == j else np.flatnonzero(blocks == j)
        signatures = np.frombuffer(b"".join(r[6] for r in rows), np.uint16).reshape(len(rows), -1)
        return link_tile([r[3] for r in rows], [r[4] for r in rows], signatures, left, right, least)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[batch[c] for c in ("run", "i", "j", "node", "root", "block", "signature")]):
                if current and current[0][:3] != row[:3]:
                    out += tile(current)
                    current = []
                current.append(row)
            yield pd.DataFrame(out, columns=["a", "b"])
        yield pd.DataFrame(tile(current) if current else [], columns=["a", "b"])
    return run


def _run_links(runs: DataFrame, entries: DataFrame, groups: DataFrame, signatures: DataFrame, s: Forest, least: int) -> DataFrame:
    """Links between the groups of a run. Runs of one group need none, as all its pairs are verified."""
    prefix = F.concat(F.expr("unhex(lpad(hex(tree), 2, '0'))"), F.substring("label", 1, 2 * s.least_depth))
    members = entries.select(prefix.alias("run"), "node").join(runs, "run").join(groups, "node", "left")
    members = materialize(members.select("run", "node", F.coalesce("root", "node").alias("root")), "join-runs")
    sizes = members.groupBy("run").agg(F.ceil(F.count("*") / s.run_block).cast("int").alias("blocks"),
                                       F.min("root").alias("low"), F.max("root").alias("high"))
    sizes = sizes.filter("low <> high").select("run", "blocks")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = (members.join(sizes, "run").join(signatures, "node")
                    .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("other", other)
                    .select("run", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                            "node", "root", "block", "signature"))
    tiles = tiles.repartition("run", "i", "j").sortWithinPartitions("run", "i", "j")
    return materialize(tiles.mapInPandas(_linked_runs(s, least), "a binary, b binary"), "join-run-links")


def _agreement(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        agree = [float((np.frombuffer(x, np.uint16) == np.frombuffer(y, np.uint16)).mean())
                 for x, y in zip(batch["x"], batch["y"])]
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "shared": batch["shared"], "agree": agree})


def found_share(similarity, depth: int, trees: int):
    """Probability that two texts of this similarity share a prefix of this length in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def prefix_depth(candidates: DataFrame, s: Forest) -> int:
    """The longest prefix at which the forest finds the target share of all links.

    An average over the links of the corpus, and so no bound for a single one: links at the threshold are found
    less often. It tells how deep the tries need to be, and no candidate is dropped by it.
    Each link found with the shortest prefix stands for as many as the inverse of its chance to be found so.
    From there on, the longest prefix is taken that still finds the target share of this estimate. A link just
    at the threshold is added to both, so the answer also holds where nothing was found.
    """
    depths = list(range(s.depth, s.least_depth - 1, -1))
    chance = 1 - F.pow(1 - F.pow("agree", F.lit(s.least_depth)), F.lit(s.trees))
    found = candidates.filter(F.col("agree") >= s.similarity).agg(
        F.coalesce(F.sum(1 / chance), F.lit(0.0)).alias("all"), *[F.count(F.when(F.col("shared") >= k, 1)).alias(f"n{k}") for k in depths]).first()
    for k in depths:
        if (found[f"n{k}"] + found_share(s.similarity, k, s.trees)) / (found["all"] + 1.0) >= s.recall:
            return k
    return s.least_depth


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs of left and right reach the similarity, by one product of incidence matrices."""
    sizes = np.array([len(x) for x in sets], np.float64)
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    shared = values[counts > 1]
    common = np.zeros((len(left), len(right)))
    for i in range(0, len(shared), 4096):
        part = shared[i:i + 4096]
        rows = np.zeros((len(sets), len(part)), np.float32)
        for k, x in enumerate(sets):
            own = x[np.searchsorted(x, part[0]):np.searchsorted(x, part[-1], "right")]
            at = np.searchsorted(part, own)
            rows[k, at[part[np.minimum(at, len(part) - 1)] == own]] = 1
        common += rows[left] @ rows[right].T
    return common >= similarity * (sizes[left][:, None] + sizes[right][None, :] - common) - 1e-9


def verify_tile(node: list[bytes], weight: list[int], sets: list[np.ndarray], left: np.ndarray, right: np.ndarray,
                similarity: float) -> list[tuple[bytes, int, bytes]]:
    """Of each node with links in the tile: the weight of its links, and the least node of those that the
    tile connects with it. ``left`` and ``right`` are positions; the same ones in a tile on the diagonal."""
    linked = _links(sets, left, right, similarity)
    weight = np.array(weight, np.int64)
    diagonal = left is right
    if diagonal:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return []
    links = np.zeros(len(node), np.int64)
    links[left] += linked @ weight[right]
    if not diagonal:
        links[right] += linked.T @ weight[left]
    order = sorted(range(len(node)), key=node.__getitem__)
    label = np.empty(len(node), np.int64)
    label[order] = np.arange(len(node))
    while True:
        before = label.copy()
        for a, b, m in ((left, right, linked), (right, left, linked.T)):
            label[a] = np.minimum(label[a], np.where(m, label[b][None, :], len(node)).min(axis=1))
        if (before == label).all():
            break
    return [(node[k], int(links[k]), node[order[label[k]]]) for k in np.flatnonzero(links)]


def _verified(s: Forest):
    """Verifies the tiles of rows that come sorted by tile; holds one tile at a time."""
    def tile(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        (_, i, j), blocks = rows[0][:3], np.array([r[5] for r in rows])
        left = np.flatnonzero(blocks == i)
        right = left if i == j else np.flatnonzero(blocks == j)
        if not len(left) or not len(right):
            return []
        sets = [np.frombuffer(r[6], np.uint64) for r in rows]
        return verify_tile([r[3] for r in rows], [r[4] for r in rows], sets, left, right, s.similarity)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[batch[c] for c in ("part", "i", "j", "node", "weight", "block", "shingles")]):
                if current and current[0][:3] != row[:3]:
                    out += tile(current)
                    current = []
                current.append(row)
            yield pd.DataFrame(out, columns=["node", "links", "to"])
        yield pd.DataFrame(tile(current) if current else [], columns=["node", "links", "to"])
        current.clear()
        give_back()
    return run


# Bits of the filter below for each member, and the least and most of all: 2 and 32 megabytes.
_FILTER_BITS = (16, 1 << 24, 1 << 28)


def _marks(rows: DataFrame) -> np.ndarray:
    """A bitmap, its size by the number of rows, in which the bit of each ``mark``, a 64-bit hash, is set."""
    each, least, most = _FILTER_BITS
    n_bits = min(most, max(least, 1 << (each * rows.count()).bit_length()))
    words = rows.groupBy(F.floor(F.pmod("mark", F.lit(n_bits)) / 64).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(mark, 64) as int))")).alias("bits")).toPandas()
    out = np.zeros(n_bits // 64, np.uint64)
    out[words["at"]] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _shingled(s: Forest, marks):
    """Marks, nodes and sets of the rows whose bit is set, one row of each mark and node in a task. A bit may be
    set by chance: a join follows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = marks.value, set()
        for batch in batches:
            mark = batch.column(1).to_numpy()
            at = np.mod(mark, len(bits) * 64)
            found = np.flatnonzero((bits[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1))
            kept, nodes, sets = [], [], []
            for k, text in zip(found.tolist(), texts_of(batch.column(0).take(pa.array(found)))):
                own = shingles(text, s.words).tobytes()
                node = _node(own)
                if (mark[k], node) not in seen:
                    seen.add((mark[k], node))
                    kept.append(mark[k])
                    nodes.append(node)
                    sets.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())],
                                             names=["mark", "node", "shingles"])
    return run


def similar_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", forest: Forest = Forest()) -> DataFrame:
    """The key of each row of ``docs``, with its class under Jaccard similarity of the shingles.

    ``class_id`` is the least key of the texts connected by links, ``n_links`` the number of other rows
    whose similarity reaches the threshold, and ``class_size`` the rows of the class. Copies count as links
    of similarity one. A null text and one without words has no shingles and is a class of its own with
    its key, null or not. Rows with equal keys are rows of their own. An empty table gives no rows.
    Other columns, whatever their names, are not looked at.
    """
    return _classes(docs, text, key, forest).withColumnRenamed("row", key).drop("hash", "is_first")


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", forest: Forest = Forest()) -> DataFrame:
    """``docs`` with one row of each class, that with the least key, in all its columns.

    Rows equal in key and text count as one, also without words.
    """
    firsts = _classes(docs, text, key, forest).filter("is_first").select(F.col("row").alias("__row"), F.col("hash").alias("__h")).distinct()
    hashed = docs.withColumn("__hash", F.xxhash64(text))
    kept = hashed.join(firsts, (F.col("__hash") == F.col("__h")) & F.col(key).eqNullSafe(F.col("__row")), "left_semi")
    return kept.dropDuplicates([key, "__hash"]).drop("__hash")


def _classes(docs: DataFrame, text: str, key: str, s: Forest) -> DataFrame:
    keyed = docs.select(F.col(key).alias("row"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    # Through Arrow, as pandas would turn keys with nulls into floats.
    schema = T.StructType([T.StructField("row", docs.schema[key].dataType), *T.StructType.fromDDL("hash long, node binary, n int, signature binary")])
    sketches = materialize(keyed.select("row", "hash", "text").mapInArrow(_sketches(s, schema.names), schema), "join-sketches")
    worded = sketches.filter("n > 0")
    nodes = materialize(worded.groupBy("node").agg(F.count("*").alias("weight"), F.min(F.struct("row", "hash")).alias("one"),
                                                   F.min("signature").alias("signature")), "join-nodes")

    label = [F.struct(F.lit(t).cast("byte").alias("tree"), F.substring("signature", 2 * s.depth * t + 1, 2 * s.depth).alias("label"))
             for t in range(s.trees)]
    entries = nodes.select("node", F.explode(F.array(*label)).alias("e")).select("e.tree", "e.label", "node")
    sorted_tries = entries.repartitionByRange("tree", "label").sortWithinPartitions("tree", "label", "node")
    near = sorted_tries.mapInPandas(_trie_neighbours(s), "a binary, b binary, shared int, run binary")
    near = near.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "run").agg(F.max("shared").alias("shared"))
    near = materialize(near, "join-near")
    runs, near = near.filter("run is not null").select("run"), near.filter("run is null").drop("run")
    signatures = nodes.select("node", "signature")
    near = (near.join(signatures.toDF("a", "x"), "a").join(signatures.toDF("b", "y"), "b")
                .mapInPandas(_agreement, "a binary, b binary, shared int, agree double"))
    near = materialize(near, "join-candidates")
    deviation = (s.similarity * (1 - s.similarity) / (s.trees * s.depth)) ** 0.5
    least = s.similarity - s.slack * deviation
    linked = near.filter(F.col("agree") >= least).select("a", "b")
    groups = components(linked)
    more = _run_links(runs, entries, groups, signatures, s, math.ceil(least * s.trees * s.depth))
    if not more.isEmpty():
        groups = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    # Blocks of a bounded expected size; a node goes to the tiles of its block with every block.
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / s.block).cast("int").alias("blocks"))
    members = (groups.join(sizes, "root").join(nodes.select("node", "weight", "one"), "node")
                     .select(F.col("root").alias("part"), "node", "weight", "blocks", "one.*",
                             F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"))
                     .withColumn("mark", F.xxhash64("row", "hash")).drop("row", "hash"))
    members = materialize(members, "join-members")
    # Of all texts only those that stand for a member are hashed again and move; the bitmap finds them.
    marks = docs.sparkSession.sparkContext.broadcast(_marks(members.select("mark")))
    sets = keyed.select("text", F.xxhash64("row", "hash").alias("mark")).mapInArrow(_shingled(s, marks), "mark long, node binary, shingles binary")
    # Copies in different tasks have one mark; one of them goes on, before it is dealt to the tiles.
    sets = sets.join(members, ["node", "mark"]).dropDuplicates(["node", "mark"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = sets.withColumn("other", other).select(
        "part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "weight", "block", "shingles")
    tiles = tiles.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j")
    found = materialize(tiles.mapInPandas(_verified(s), "node binary, links long, to binary"), "join-links")

    classes = components(found, "node", "to")
    weights = nodes.select("node", "weight", "one", F.col("one.row").alias("row"))
    linked = (found.groupBy("node").agg(F.sum("links").alias("links")).join(classes, "node", "left").join(weights, "node")
                   .withColumn("root", F.coalesce("root", "node")))
    roots = linked.groupBy("root").agg(F.min("row").alias("class_id"), F.sum("weight").alias("class_size"),
                                       F.min("one").alias("first"))
    known = linked.join(roots, "root").select("node", "links", "class_id", "class_size", "first")
    known = materialize(known, "join-classes")
    # All rows of a text with its own weight, row and links, if any.
    info = weights.join(known, "node", "left").select(
        "node", "weight", F.coalesce("class_id", "row").alias("class_id"), F.coalesce("class_size", "weight").alias("class_size"),
        F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("first", "one").alias("first"))
    out = sketches.select("row", "hash", "node", "n").join(info, "node", "left")
    return out.select(
        "row", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("row")).alias("class_id"),
        F.when(F.col("n") > 0, F.col("weight") - 1 + F.col("links")).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("n") > 0, F.col("class_size")).otherwise(1).cast("long").alias("class_size"),
        F.col("n").alias("n_shingles"), "hash",
        ((F.col("n") == 0) | F.struct("row", "hash").eqNullSafe(F.col("first"))).alias("is_first"))
