"""The ingestion chain, its gates and what a failed run leaves behind."""

import datetime as dt
import json
import time

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from brontide import session
from brontide.errors import DataQualityError
from brontide.operators import project as P, quality as Q
from brontide.plans import ingest as I
from brontide.session import work_dir
from brontide.sources import artifacts, csv, documents, files, relational, tables

LINEITEM = "/root/testdata/sf0.001/lineitem.parquet"


@pytest.fixture
def folders(spark):
    return I.Folders.under(work_dir(spark, "test-ingest"))


def ingested(spark, folders, table):
    return sorted(map(tuple, tables.scan_table(spark, folders.target, table).collect()), key=str)


def test_chain(spark, folders):
    rows = [(1, " a "), (1, "a"), (2, "  "), (3, 'x "y", z\nw'), (4, "\tt\t")]
    source = spark.createDataFrame(rows, "Id int, `Name` string")
    report = I.ingest_table(source, I.TableSpec("Item", ("Id",), min_rows=4), folders).first()
    assert (report["source_rows"], report["cleansed_rows"], report["duplicate_rows_removed"],
            report["target_rows"], report["primary_keys"]) == (5, 4, 1, 4, ["Id"])
    assert ingested(spark, folders, "Item") == [
        (1, "a"), (2, None), (3, 'x "y", z\nw'), (4, "\tt\t")]
    written = documents.read_dq_report(spark, folders.metadata, "Item").first()
    assert written["cleansed_rows"] == 4


def test_inferred_types(spark, folders):
    rows = [("1", "2009-01-01", "0.5", "true")]
    source = spark.createDataFrame(rows, "a string, b string, c string, d string")
    I.ingest_table(source, I.TableSpec("t", ("a",)), folders, infer_types=True)
    assert dict(tables.scan_table(spark, folders.target, "t").dtypes) == {
        "a": "int", "b": "date", "c": "double", "d": "boolean"}


@pytest.mark.parametrize("rows, match", [
    ([(1, "a"), (None, "b")], "NULLs in key column id"),
    ([(1, "a"), (1, "b")], "1 duplicate keys"),
])
def test_bad_keys_publish_nothing(spark, folders, rows, match):
    good = spark.createDataFrame([(9, "old")], "id int, v string")
    spec = I.TableSpec("t", ("id",))
    I.ingest_table(good, spec, folders)
    with pytest.raises(DataQualityError, match=match):
        I.ingest_table(spark.createDataFrame(rows, "id int, v string"), spec, folders)
    assert ingested(spark, folders, "t") == [(9, "old")]
    assert [tuple(r) for r in I.read_cleansed(spark, folders, "t").collect()] == [(9, "old")]


def test_lineitem_key_is_refused(spark, folders):
    source = spark.read.parquet(LINEITEM)
    with pytest.raises(DataQualityError, match="duplicate keys"):
        I.ingest_table(source, I.TableSpec("lineitem", ("l_orderkey", "l_linenumber")), folders)
    assert not tables.table_exists(spark, folders.target, "lineitem")
    assert not tables.table_exists(spark, folders.cleansed, "lineitem")


def test_missing_key_column(spark, folders):
    source = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(DataQualityError, match="key columns missing: \\['nope'\\]"):
        I.ingest_table(source, I.TableSpec("t", ("nope",)), folders)
    assert not tables.table_exists(spark, folders.cleansed, "t")


def test_too_few_rows(spark, folders):
    source = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(DataQualityError, match="1 rows, at least 2 wanted"):
        I.ingest_table(source, I.TableSpec("t", ("id",), min_rows=2), folders)
    assert not tables.table_exists(spark, folders.target, "t")
    I.ingest_table(source, I.TableSpec("t", ("id",)), folders)
    with pytest.raises(DataQualityError, match="1 rows, at least 2 wanted"):
        I.validate_table(spark, "t", folders, 2)


def test_lost_rows_publish_nothing(spark, folders, monkeypatch):
    """The target holds fewer rows than were read."""
    source = spark.createDataFrame([(1,), (2,)], "id int")
    I.ingest_table(source, I.TableSpec("t", ("id",)), folders)
    stage = tables.stage_snapshot

    def losing(df, base, table):
        staged = stage(df, base, table)
        return tables.Snapshot(staged.root, staged.name, staged.n_rows + 1)

    monkeypatch.setattr(tables, "stage_snapshot", losing)
    with pytest.raises(DataQualityError, match="source has 3 rows, target 2"):
        I.load_table(spark, "t", folders)
    assert tables._latest(spark, tables.table_path(folders.target, "t"))["version"] == 1


def test_counts_must_agree():
    with pytest.raises(DataQualityError):
        Q.require_equal_counts("t", 3, 2)
    with pytest.raises(DataQualityError):
        Q.require_not_increased("t", 1, 2)


def test_empty_or_missing_landing_file(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(DataQualityError):
        artifacts.require_artifact(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(DataQualityError):
        artifacts.require_artifact(spark, str(tmp_path / "none.csv"))


def test_table_without_rows(spark, folders):
    source = spark.createDataFrame([], "id int, v string")
    report = I.ingest_table(source, I.TableSpec("t", ("id",)), folders).first()
    assert (report["source_rows"], report["target_rows"]) == (0, 0)
    assert tables.scan_table(spark, folders.target, "t").columns == ["id", "v"]


def test_no_metadata_means_no_key_checks(spark, folders, tmp_path):
    csv.write_csv(spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string"), folders.csv_path("t"))
    report = I.cleanse_table(spark, "t", folders).first()
    assert report["primary_keys"] == [] and report["cleansed_rows"] == 2


def test_metadata_document_of_another_writer(spark, tmp_path):
    """One pretty-printed JSON object in a plain file."""
    document = {"table": "T", "columns": [{"cid": 0, "name": "b", "type": "INTEGER", "notnull": 1,
                                           "dflt_value": None, "pk": 2}],
                "primary_keys": ["a", "b"], "foreign_keys": [], "row_count": 3, "csv_path": "x"}
    (tmp_path / "T.json").write_text(json.dumps(document, indent=2))
    assert documents.declared_primary_keys(spark, str(tmp_path), "T") == ["a", "b"]
    assert documents.declared_primary_keys(spark, str(tmp_path), "U") == []
    assert documents.declared_schema(spark, str(tmp_path), "T") is None  # not a type of Spark's
    assert documents.declared_schema(spark, str(tmp_path), "U") is None


def test_types_come_from_the_metadata_of_an_export(spark, folders):
    source = spark.createDataFrame([(1, "007", None)], "a bigint, b string, c decimal(9,2)")
    I.export_table(source, I.TableSpec("t", ("a",)), folders)
    assert documents.declared_schema(spark, folders.metadata, "t") == source.schema
    I.cleanse_table(spark, "t", folders)
    assert [tuple(r) for r in I.read_cleansed(spark, folders, "t").collect()] == [(1, "007", None)]
    I.cleanse_table(spark, "t", folders, infer_types=True)
    assert I.read_cleansed(spark, folders, "t").first()["b"] == 7


def test_plain_csv_file_as_landing(spark, folders, tmp_path):
    (tmp_path / "t.csv").write_text(' id ,name\n1," a ""q"" "\n1,"a ""q"""\n2,"x\r\ny"\n3,\n')
    found = Q.cleanse(csv.scan_csv(spark, str(tmp_path / "t.csv"))).collect()
    assert sorted(map(tuple, found), key=str) == [
        (1, 'a "q"', 2), (2, "x\r\ny", 1), (3, None, 1)]


def test_colliding_names(spark):
    with pytest.raises(ValueError, match="collide"):
        P.trim_column_names(spark.createDataFrame([(1, 2)], ["a", " a"]))


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(" x ", 1), ("x", 1)], ["a.b", "c`d"])
    assert [tuple(r) for r in Q.cleanse(df).collect()] == [("x", 1, 2)]


def test_primary_keys_follow_key_order(spark):
    schema = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"]).schema
    row = Q.table_metadata(spark, "t", schema, ["c", "a"]).first()
    assert row["primary_keys"] == ["c", "a"]
    assert [(c["name"], c["pk"]) for c in row["columns"]] == [("a", 2), ("b", 0), ("c", 1)]


def test_table_without_columns(spark):
    from pyspark.sql.types import StructType
    with pytest.raises(ValueError, match="no columns"):
        Q.table_metadata(spark, "t", StructType())


cell = st.one_of(st.none(), st.text(st.sampled_from('a", \t\\#é;\'1'), max_size=6),
                 st.sampled_from(["a\nb", "a\r\nb", "\n", "\r", '"', '""', '\\"', "  ", "null"]))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(cell, cell), min_size=1, max_size=60))
def test_csv_keeps_text(spark, rows):
    """But for the difference between NULL and ''."""
    df = spark.createDataFrame(rows, "a string, b string")
    path = work_dir(spark, "test-csv")
    csv.write_csv(df, path)
    found = csv.scan_csv(spark, path, df.schema).collect()
    expected = [tuple(v or None for v in r) for r in rows]
    assert sorted([tuple(v or None for v in r) for r in found], key=str) == sorted(expected, key=str)


def test_csv_of_one_column_keeps_empty_rows(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",)], "a string")
    path = work_dir(spark, "test-csv")
    csv.write_csv(df, path)
    assert csv.scan_csv(spark, path, df.schema).count() == 3
    numbers, path = spark.createDataFrame([(None,), (1,)], "a int"), work_dir(spark, "test-csv")
    csv.write_csv(numbers, path)
    assert {r["a"] for r in csv.scan_csv(spark, path, numbers.schema).collect()} == {None, 1}


def test_csv_keeps_microseconds(spark):
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([(at, at)], "a timestamp_ntz, b timestamp_ntz").withColumn(
        "b", F.col("b").cast("timestamp"))
    path = work_dir(spark, "test-csv")
    csv.write_csv(df, path)
    assert csv.scan_csv(spark, path, df.schema).exceptAll(df).count() == 0


def test_csv_value_of_wrong_type_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a\nx\n")
    with pytest.raises(Exception):
        csv.scan_csv(spark, str(tmp_path / "t.csv"), spark.createDataFrame([], "a int").schema).collect()


def test_cleansing_twice_changes_nothing(spark):
    df = spark.createDataFrame([(" a", 1), ("a ", 1), ("", 2), (None, 2)], "v string, n int")
    once = Q.cleanse(df).drop(Q.COPIES)
    twice = Q.cleanse(once)
    assert sorted(map(tuple, once.collect()), key=str) == [("a", 1), (None, 2)]
    assert twice.filter(F.col(Q.COPIES) > 1).count() == 0 and twice.count() == 2


def test_snapshots(spark):
    base = work_dir(spark, "test-tables")
    first = spark.createDataFrame([(1,)], "a int")
    tables.write_table(first, base, "T", "parquet")
    reader = tables.scan_table(spark, base, "t", "parquet")
    staged = tables.stage_snapshot(first.union(first), base, "T")
    assert tables.scan_table(spark, base, "T", "parquet").count() == 1  # not published yet
    assert tables.publish_snapshot(spark, staged) == 2
    assert tables.scan_table(spark, base, "T", "parquet").count() == 2
    assert reader.count() == 1  # keeps what it started with


def test_table_can_be_rewritten_from_itself(spark):
    base = work_dir(spark, "test-tables")
    tables.write_table(spark.createDataFrame([(1,)], "a int"), base, "t", "parquet")
    current = tables.scan_table(spark, base, "t", "parquet")
    assert tables.write_table(current.union(current), base, "t", "parquet") == 2


def test_other_table_format(spark, folders):
    """A format that Spark itself overwrites; checked after the load."""
    source = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    for _ in range(2):
        report = I.ingest_table(source, I.TableSpec("T", ("id",)), folders, fmt="orc").first()
        assert report["target_rows"] == 2
    assert tables.table_exists(spark, folders.target, "t", "orc")
    assert tables.scan_table(spark, folders.target, "T", "orc").count() == 2
    assert tables.default_format(spark) == "parquet"


def test_big_landing_is_cut_into_files(spark):
    path = work_dir(spark, "test-csv")
    csv.write_csv(spark.range(0, 25, numPartitions=1), path, rows_per_file=10)
    found = csv.scan_csv(spark, path)
    assert found.count() == 25 and len(found.inputFiles()) == 3


def test_missing_table(spark):
    with pytest.raises(FileNotFoundError):
        tables.scan_table(spark, work_dir(spark, "nothing"), "t", "parquet")


def test_metrics_in_one_pass_equal_the_single_ones(spark):
    df = spark.createDataFrame(
        [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (None, "b", "x"), (2, None, "x")],
        "k1 int, k2 string, v string")
    cleansed = Q.cleanse(df)
    metrics = Q.quality_metrics(cleansed, ["k1", "k2"]).first().asDict()
    assert metrics == {"source_rows": 5, "cleansed_rows": 4, "duplicate_rows_removed": 1,
                       "nulls_0": 1, "nulls_1": 1, "duplicate_keys": 1}
    assert {r["pk"]: r["nulls"] for r in Q.pk_null_counts(cleansed, ["k1", "k2"]).collect()} == {
        "k1": 1, "k2": 1}
    assert Q.pk_duplicate_keys(cleansed, ["k1", "k2"]).first()["duplicate_keys"] == 1


def test_jdbc_options():
    assert relational.jdbc_options("jdbc:x", "t")["dbtable"] == "t"
    options = relational.jdbc_options("jdbc:x", "t", partition_column="id", lower_bound=0,
                                      upper_bound=100, num_partitions=8)
    assert (options["partitionColumn"], options["numPartitions"]) == ("id", "8")
    with pytest.raises(ValueError):
        relational.jdbc_options("jdbc:x", "t", partition_column="id")


def test_lookup(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert [tuple(r) for r in P.lookup(df, id=2).collect()] == [(2, "b")]
    assert [tuple(r) for r in P.lookup(df, id=1, v="a").collect()] == [(1, "a")]
    assert P.lookup(df, id=3).collect() == []


def test_wide_rows_make_small_files(spark, folders):
    """Files are bounded by bytes, however wide the rows."""
    source = spark.range(0, 400, numPartitions=4).select("id", F.concat_ws("", F.transform(
        F.sequence(F.lit(1), F.lit(1500)), lambda i: F.md5(F.concat("id", i).cast("string")))).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        I.export_table(source, I.TableSpec("wide", ("id",)), folders)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    sizes = [r["length"] for r in spark.read.format("binaryFile").load(folders.csv_path("wide")).select("length").collect()]
    assert sum(sizes) > 18_000_000 and max(sizes) < 4_000_000


def test_rows_of_like_width_are_landed_without_a_shuffle(spark, folders):
    source = spark.range(0, 50_000, numPartitions=2).select("id", F.concat(F.lit("name "), "id").alias("v"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        dealt, rows_per_file = csv.in_files(source)
        uneven, _ = csv.in_files(source.withColumn("v", F.expr("repeat(v, if(id = 7, 1000, 1))")))
        assert I.export_table(source, I.TableSpec("even", ("id",)), folders) == 50_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (dealt, uneven)]
    assert ["Exchange" in p for p in plans] == [False, True]
    files = spark.read.format("binaryFile").load(folders.csv_path("even")).select("length").collect()
    assert 10 < len(files) and max(r["length"] for r in files) <= 65_536
    assert csv.scan_csv(spark, folders.csv_path("even"), source.schema).exceptAll(source).count() == 0
    assert csv.in_files(source.limit(0))[1] > 0 and csv.in_files(spark.range(3))[1] > 0


def test_a_large_landing_is_grouped_by_digests(spark, folders, monkeypatch):
    """Also where its text is large and what is stored of it is not."""
    source = spark.range(0, 20_000, numPartitions=2).select("id", F.repeat(F.lit(" long text"), 20).substr(2, 300).alias("v"))
    I.export_table(source.unionByName(source.filter("id % 100 = 0")), I.TableSpec("t", ("id",)), folders)
    marked, taken = Q._marked_repeats, []
    monkeypatch.setattr(Q, "_marked_repeats", lambda df: taken.append(df.columns) or marked(df))
    monkeypatch.setattr(Q, "DIGEST_FROM", 1 << 20)
    report = I.cleanse_table(spark, "t", folders).first()
    assert taken == [["id", "v"]]
    assert (report["source_rows"], report["cleansed_rows"]) == (20_200, 20_000)
    assert I.read_cleansed(spark, folders, "t").exceptAll(source).count() == 0


def test_a_large_landing_is_compressed(spark, folders, monkeypatch):
    """And read as if it were not: quotes, line breaks, NULLs and the counts of the report."""
    text = F.expr("case id % 4 when 0 then concat('a \"q\", ', id) when 1 then concat('x\\ny ', id) when 2 then null else repeat('b ', 60) end")
    source = spark.range(0, 20_000, numPartitions=2).select("id", text.alias("v"), F.expr("id / 7").alias("d"))
    I.export_table(source, I.TableSpec("small", ("id",)), folders)
    monkeypatch.setattr(csv, "PACK_FROM", 1 << 20)
    report = I.ingest_table(source, I.TableSpec("t", ("id",)), folders).first()
    assert (report["source_rows"], report["target_rows"]) == (20_000, 20_000)
    plain, packed = (files.list_sizes(spark, folders.csv_path(t)) for t in ("small", "t"))
    assert all(name.endswith(".csv") for name, _ in plain) and all(name.endswith(".csv.gz") for name, _ in packed)
    assert 3 * sum(n for _, n in packed) < sum(n for _, n in plain) < 4 * csv.text_bytes(spark, folders.csv_path("t"))
    found = tables.scan_table(spark, folders.target, "t")
    assert found.exceptAll(source.withColumn("v", F.trim("v"))).count() == 0 and found.count() == 20_000
    I.cleanse_table(spark, "t", folders, infer_types=True)
    assert I.read_cleansed(spark, folders, "t").count() == 20_000


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def test_an_ingestion_leaves_what_it_publishes(spark, folders, monkeypatch):
    """No files of shuffles, no intermediate tables and nothing of a table that is refused, whether it is large or not."""
    rows = spark.range(0, 20_000, numPartitions=2).select("id", F.repeat(F.lit(" long text"), 20).substr(2, 300).alias("v"))
    sources = {"once": rows, "twice": rows.unionByName(rows.filter("id % 100 = 0")), "few": rows.limit(500),
               "bad": rows.unionByName(rows.limit(7).withColumn("v", F.lit("other"))), "bad_few": rows.limit(5).unionByName(spark.createDataFrame([(1, "x")], rows.schema))}
    staged, stage = [], tables.stage_snapshot
    monkeypatch.setattr(tables, "stage_snapshot", lambda df, base, table: staged.append((base, table)) or stage(df, base, table))
    monkeypatch.setattr(Q, "DIGEST_FROM", 1 << 20)
    stored, made = [], session.work_dir
    monkeypatch.setattr(session, "work_dir", lambda spark, label: stored.append(made(spark, label)) or stored[-1])
    before, setting = _shuffle_files(spark), spark.conf.get(session._DROP_SHUFFLES)
    report = {r["table"]: r for r in I.ingest_tables(sources, [I.TableSpec(n, ("id",)) for n in sources], folders).collect()}
    assert {t: (r["source_rows"], r["cleansed_rows"], r["target_rows"], r["reason"]) for t, r in report.items()} == {
        "once": (20_000, 20_000, 20_000, None), "twice": (20_200, 20_000, 20_000, None), "few": (500, 500, 500, None),
        "bad": (None, None, None, "bad: 7 duplicate keys"), "bad_few": (None, None, None, "bad_few: 1 duplicate keys")}
    for _ in range(50):  # they are deleted in the background
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before and spark.conf.get(session._DROP_SHUFFLES) == setting
    assert len(stored) >= 3 and not any(files.path_exists(spark, path) for path in stored)
    for t in sources:
        kept = [files.list_names(spark, f"{tables.table_path(base, t)}/snapshots") for base in (folders.cleansed, folders.target)]
        assert list(map(len, kept)) == ([0, 0] if t.startswith("bad") else [1, 1])
        assert t.startswith("bad") or tables.scan_table(spark, folders.target, t).exceptAll(sources[t]).count() == 0
    # All rows of a large table are staged once, and again only if some repeat.
    assert [staged.count((folders.cleansed, t)) for t in ("once", "twice", "few")] == [1, 2, 1]


def test_files_that_pass_are_deleted_also_after_a_failure(spark):
    with pytest.raises(RuntimeError), session.passing_files(spark), session.passing_shuffles(spark):
        with session.passing_shuffles(spark):
            path = session.materialize(spark.range(3), "passing").inputFiles()[0]
        assert spark.conf.get(session._DROP_SHUFFLES) == "true" and files.path_exists(spark, path)
        raise RuntimeError
    assert not files.path_exists(spark, path) and not session._dropping
    assert session.materialize(spark.range(3), "kept").count() == 3


def test_a_failed_table_is_a_row_of_the_report(spark, folders):
    good, bad = spark.range(3).toDF("id"), spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    odd = spark.createDataFrame([([1.0],)], "id array<double>")
    rows = I.ingest_tables({"good": good, "bad": bad, "odd": odd}, [I.TableSpec(n, ("id",)) for n in ("bad", "good", "odd")], folders)
    found = {r["table"]: r for r in rows.collect()}
    assert (found["good"]["status"], found["good"]["target_rows"], found["good"]["reason"]) == ("ok", 3, None)
    assert (found["bad"]["status"], found["bad"]["reason"], found["bad"]["target_rows"]) == ("failed", "bad: 1 duplicate keys", None)
    assert found["odd"]["status"] == "failed" and found["odd"]["reason"]
    assert not tables.table_exists(spark, folders.target, "bad")
    assert spark.sparkContext.getConf().get("spark.scheduler.mode") == "FAIR"


def test_only_unknown_types_are_inferred(spark, folders):
    source = spark.createDataFrame([("007", 1, "5")], "code string, n int, other string")
    I.export_table(source, I.TableSpec("t"), folders)
    document = documents.read_metadata(spark, folders.metadata, "t").first().asDict(recursive=True)
    document["columns"][2]["type"] = "NVARCHAR(10)"
    documents.write_metadata(spark.createDataFrame([document], documents.TABLE_METADATA), folders.metadata, "t")
    schema = documents.declared_schema(spark, folders.metadata, "t", lambda: csv.scan_csv(spark, folders.csv_path("t")).schema)
    assert schema.simpleString() == "struct<code:string,n:int,other:int>"
    assert documents.declared_schema(spark, folders.metadata, "t") is None


def test_the_name_of_the_copies_is_reserved(spark):
    with pytest.raises(DataQualityError, match="_source_copies"):
        Q.cleanse(spark.createDataFrame([(1,)], "_source_copies int"))
