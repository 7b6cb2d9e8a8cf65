import gzip
from pathlib import Path

import pytest
from helpers import apply, plan_of, rows_of
from pyspark.sql import functions as F

from bugtide import vocabulary as v
from bugtide.operators import dedup, unify
from bugtide.plans.ingest import ingest_trackers
from bugtide.sources import headers, tables, trackers

HEADER = "Issue id,Summary,Priority,Resolution,Created,Resolved,Description,Status,Affects Version/s\n"


def write(root, name, text):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, newline="")


@pytest.fixture
def folders(tmp_path):
    write(
        tmp_path,
        "alpha/alpha_bugs.csv",
        HEADER
        + '1,"first, with comma",High,Fixed,2024-01-01,2024-01-03,"body over\ntwo lines and ""quotes""",Closed,1.0\n'
        + " 2 ,listed as issue,High,Fixed,2024-01-01,2024-01-03,b,Closed,1.0\n"
        + "3,listed as duplicate,High,Fixed,2024-01-01,2024-01-03,b,Closed,1.0\n"
        + "4,no priority,NaN,Fixed,2024-01-01,2024-01-03,b,Closed,1.0\n"
        + "5,placeholder,--,Fixed,2024-01-01,2024-01-03,b,Closed,1.0\n"
        + "6,unresolved,Low,N/A,2024-01-01,,b,Open,1.0\n"
        + ",no id,Low,Fixed,2024-01-01,2024-01-02,b,Closed,1.0\n"
        + "1,same id again,Low,Invalid,2024-01-01,2024-01-02,null,Closed,1.0\n",
    )
    write(tmp_path, "alpha/alpha_bugs-combined.csv", 'Issue ID,Duplicated Bug Id\n"2","3; 99|"\n"""7""",\n')
    # Other header order and spelling; id 2 is listed in alpha only.
    write(
        tmp_path,
        "my beta+x/Beta_bugs.csv",
        "Summary,bug_id,Priority,Resolution,Created,Resolved,Description\n"
        "kept here,2,Major,Fixed,2024-01-01,2024-01-02,b\n"
        "gone,8,Major,Fixed,2024-01-01,2024-01-02,b\n",
    )
    write(
        tmp_path,
        "my beta+x/extra_bugs.csv",
        "Summary,bug_id,Priority,Resolution,Created,Resolved,Description\n"
        "kept in extra,8,Major,Fixed,2024-01-01,2024-01-02,b\n"
        "gone in extra,9,Major,Fixed,2024-01-01,2024-01-02,b\n",
    )
    write(tmp_path, "my beta+x/beta_bugs-combined.csv", "a,b\n8,\n")
    write(tmp_path, "my beta+x/extra-combined.csv", "a,b\n,9\n")
    write(tmp_path, "gamma/gamma_bugs.csv", HEADER)
    write(tmp_path, "delta/delta_bugs-combined.csv", "a,b\n1,2\n")
    write(tmp_path, "alpha/alpha_bugs-train.csv", HEADER)
    return str(tmp_path)


def test_file_names(spark):
    accepted = ["cassandra_bugs.csv", "Core_BUGS.CSV", "x_bugs_2.csv"]
    refused = ["x_bugs-combined.csv", "x_bugs-train.csv", "x_bugs-test.csv", "x_bugs_minus_combined.csv", "x.csv", "x_bugs.txt"]
    assert apply(spark, accepted + refused, trackers.is_bug_file) == [True] * 3 + [False] * 6
    assert apply(spark, ["Core_bugs.csv", "plain.csv"], trackers.bug_prefix) == ["core", "plain"]


def test_pairing(spark, folders):
    files = trackers.list_files(spark, folders)
    pairs = trackers.find_pairs(files)
    names = sorted((p.folder, p.bugs.rsplit("/", 1)[1], p.duplicates.rsplit("/", 1)[1]) for p in pairs.collect())
    assert names == [
        ("alpha", "alpha_bugs.csv", "alpha_bugs-combined.csv"),
        ("my beta+x", "Beta_bugs.csv", "beta_bugs-combined.csv"),
        ("my beta+x", "extra_bugs.csv", "extra-combined.csv"),
    ]
    assert rows_of(trackers.unpaired_folders(files)) == [("delta", "bug file"), ("gamma", "duplicate list")]
    with pytest.warns(UserWarning, match="delta: no bug file; gamma: no duplicate list"):
        ingest_trackers(spark, folders)


def test_headers_are_read_in_one_job_that_stops_early(spark, tmp_path):
    long = "1,x\n" * 200_000
    write(tmp_path, "a/a_bugs.csv", "\ufeffId,\"two\nlines, \"\"q\"\"\",,x,X\n" + long)
    write(tmp_path, "a/empty_bugs.csv", "")
    write(tmp_path, "b/B_bugs.CSV", "only")
    write(tmp_path, "b/open_bugs.csv", 'a,"open\nb,c\n')
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = trackers.header_table(spark, str(tmp_path))
        assert len(tracker.getJobIdsForGroup("headers")) == 1
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert found == {
        "a/a_bugs.csv": ("Id", 'two\nlines, "q"', "_c2", "x3", "X4"), "b/B_bugs.CSV": ("only",),
        "b/open_bugs.csv": ("a", "open\nb,c\n".rstrip("\n")),
    }
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_bad_records_are_set_aside(spark, tmp_path):
    head = "Issue id,Summary,Priority,Resolution,Description\n"
    write(
        tmp_path, "p/p_bugs.csv",
        head + '1,fine,High,Fixed,"over\ntwo lines"\n2,one, comma too many,High,Fixed,b\n3,short\n4,fine too,Low,Fixed,NaN\n',
    )
    write(tmp_path, "p/p-combined.csv", "a,b\n9,\n1,2,3\n")
    # A quote stays open; taken as a whole, the file would be one record from there on.
    write(tmp_path, "q/q_bugs.csv", head + '5,ok,High,Fixed,"b, ""b"""\n6,"open,High,Fixed,b\n7,ok,High,Fixed,b\n\n8,too,many,High,Fixed,b\n')
    write(tmp_path, "q/q-combined.csv", "a,b\n,\n")
    out = str(tmp_path / "out")
    done = ingest_trackers(spark, str(tmp_path), out)
    assert sorted(r["Issue id"] for r in done.cleaned.collect()) == ["1", "4", "5", "7"]
    assert done.cleaned.where("`Issue id` = '5'").first()["Description"] == 'b, "b"'
    assert trackers.BROKEN not in done.cleaned.columns
    found = {(r.pair, r.kind): set() for r in done.rejected.collect()}
    for r in done.rejected.collect():
        found[r.pair, r.kind].add(r.record.strip())
    assert found == {
        ("p/p_bugs.csv", "bugs"): {"2,one, comma too many,High,Fixed,b", "3,short"},
        ("p/p_bugs.csv", "duplicates"): {"1,2,3"},
        ("q/q_bugs.csv", "bugs"): {'6,"open,High,Fixed,b', "8,too,many,High,Fixed,b"},
    }
    statistics = {r.pair: (r.before_rows, r.rejected_records) for r in done.statistics.collect()}
    assert statistics == {"p/p_bugs.csv": (2, 3), "q/q_bugs.csv": (2, 2)}
    assert tables.read_table(spark, f"{out}/rejected", "csv").count() == 5


def test_names_of_columns():
    assert trackers.safe_names(["a", "", "A", "b"]) == ["a0", "_c1", "A2", "b"]


def test_header_detection():
    assert headers.issue_id_column(["Id", "Issue Key", "BUG_ID"]) == "BUG_ID"
    assert headers.issue_id_column(["The issue's id", "Summary"]) == "The issue's id"
    assert headers.issue_id_column(["Summary", "my bug ident"]) == "my bug ident"
    with pytest.raises(ValueError, match="no issue id"):
        headers.issue_id_column(["Summary"])
    assert headers.duplicate_list_columns(["dup id", "ID"]) == ("ID", "dup id")
    assert headers.duplicate_list_columns(["Duplicate ids", "Issue ids"]) == ("Issue ids", "Duplicate ids")
    assert headers.duplicate_list_columns(["a", "b"]) == ("a", "b")
    with pytest.raises(ValueError, match="two columns"):
        headers.duplicate_list_columns(["a"])


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_ingest(spark, folders, tmp_path):
    out = str(tmp_path / "out")
    done = ingest_trackers(spark, folders, out)
    reports = done.reports
    assert set(v.TRACKER_COLUMNS) <= set(reports.columns) and "Status" not in reports.columns
    found = {(r.project, r.title) for r in reports.collect()}
    assert found == {
        ("alpha", "first, with comma"), ("alpha", "no id"), ("alpha", "same id again"),
        ("my beta+x", "kept here"), ("my beta+x", "kept in extra"),
    }
    body = reports.where("title like 'first%'").first().body
    assert body == 'body over\ntwo lines and "quotes"'
    assert reports.where("title = 'same id again'").first().body is None
    stats = {r.pair: r for r in done.statistics.collect()}
    alpha = stats["alpha/alpha_bugs.csv"]
    assert (alpha.before_rows, alpha.after_rows, alpha.removed_rows, alpha.listed_ids) == (8, 6, 2, 4)
    beta = stats["my beta+x/extra_bugs.csv"]
    assert beta.removed_rows == 1
    assert (alpha.bug_id_column, alpha.issue_column, alpha.duplicate_column) == (
        "Issue id", "Issue ID", "Duplicated Bug Id"
    )
    assert (beta.bug_id_column, beta.issue_column, beta.duplicate_column) == ("bug_id", "a", "b")

    by_project = tables.read_table(spark, f"{out}/by_project", "csv")
    assert by_project.count() == done.cleaned.count() == 8
    again = tables.read_table(spark, f"{out}/canonical", "csv").select(reports.columns)
    assert rows_of(again) == rows_of(reports)


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_ingest_then_unify(spark, folders):
    # One project names its id column otherwise, so its rows have no canonical id.
    unified = unify.unify_tracker(ingest_trackers(spark, folders).reports)
    assert unified.columns == [*v.UNIFIED_COLUMNS, "report_key"]
    row = unified.where("title like 'first%'").first()
    assert (row.raw_priority, row.resolution, row.resolution_time_days) == ("HIGH", "fixed", 2.0)


def test_ingest_without_pairs(spark, tmp_path):
    write(tmp_path, "p/notes.csv", "a\n1\n")
    with pytest.warns(UserWarning), pytest.raises(ValueError, match="no bug file"):
        ingest_trackers(spark, str(tmp_path))


def test_anti_join_keeps_missing_ids_and_multiplicity(spark):
    bugs = spark.createDataFrame(
        [("1", "a")] * 3 + [(" 2 ", "a"), (None, "a"), (None, "a"), ("1", "b"), ("3", None), ("4", None)], "id string, p string"
    )
    lists = spark.createDataFrame([("2", "9", "a"), ('"1"', None, "b"), ("4", "", None)], "issue_id string, duplicate_ids string, p string")
    ids = dedup.listed_ids(lists, scope="p")
    out = dedup.subtract_listed(bugs, ids, "id", "p")
    assert out.columns == ["id", "p"]
    assert rows_of(out) == sorted([("1", "a")] * 3 + [(None, "a")] * 2 + [("3", None)], key=repr)
    assert "LeftAnti" in plan_of(out)


def test_hot_id_is_split_by_the_adaptive_join(spark):
    """One id carries a third of the rows; its partition is read in several pieces."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, x in settings.items():
        spark.conf.set(k, x)
    try:
        n = 30_000
        bugs = spark.range(n).repartition(8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
            F.sha2(F.col("id").cast("string"), 256).alias("body"),
        )
        lists = spark.range(0, n, 7).select(F.col("id").cast("string").alias("issue_id"), F.lit("").alias("duplicate_ids"))
        out = dedup.subtract_listed(bugs, dedup.listed_ids(lists))
        listed = sum(1 for i in range(0, n, 7) if i % 3)
        assert len(out.collect()) == n - listed
        assert "skewed" in plan_of(out)
    finally:
        for k, x in before.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def test_missing_values_and_columns(spark):
    df = spark.createDataFrame([("NaN", 1), ("n/a", 2), ("none", 3), ("", 4), (" NA", 5)], "x string, n int")
    assert [r.x for r in unify.missing_to_null(df).orderBy("n").collect()] == [None, None, "none", None, " NA"]
    with pytest.raises(ValueError, match="missing columns: body, closed_at"):
        unify.unify_tracker(spark.createDataFrame([(1, 2, 3, 4, 5, 6)], "id int, title int, priority int, resolution int, created_at int, project int"))


def test_unify_bugzilla(spark):
    df = spark.createDataFrame(
        [(7, None, "MAJOR", None, "t"), (8, "p", None, "WontFix", None)],
        "`Bug ID` int, Project string, `Severity Label` string, `Resolution Status` string, `Short Description` string",
    )
    a, b = unify.unify_bugzilla(df, source="legacy").orderBy("id").collect()
    assert a[:11] == ("7", "legacy", "t", "", "major", "", "fixed", "", None, None, None)
    assert b[:11] == ("8", "legacy", "", "", "", "", "wontfix", "p", None, None, None)


def test_load_all_skips_missing_optional_sources(spark, tmp_path):
    spark.createDataFrame(
        [(1, "p", "major", "FIXED", "t")],
        "`Bug ID` int, Project string, `Severity Label` string, `Resolution Status` string, `Short Description` string",
    ).write.parquet(str(tmp_path / "bz"))
    loaded = tables.load_all(spark, str(tmp_path / "bz"), tracker=str(tmp_path / "absent.csv"))
    assert loaded.count() == 1
    write(tmp_path, "tracker.csv", ",".join(v.TRACKER_COLUMNS) + ",extra\n007,t,b,P1,fixed,2024-01-01,2024-01-02,p,z\n")
    both = tables.load_all(spark, str(tmp_path / "bz"), tracker=str(tmp_path / "tracker.csv"))
    assert [r.id for r in both.orderBy("id").collect()] == ["007", "1"]
    with pytest.raises(FileNotFoundError):
        tables.load_all(spark, str(tmp_path / "absent"))


def test_rename_round_trip(spark):
    df = spark.createDataFrame([tuple("abcdefgh")], ", ".join(f"`{c}` string" for c in v.EXPORT_TO_CANONICAL))
    renamed = unify.to_canonical_names(df)
    assert set(renamed.columns) == set(v.TRACKER_COLUMNS)
    assert unify.to_export_names(renamed).columns == df.columns
    assert unify.drop_unused(df).columns == df.columns


def test_filters(spark):
    df = spark.createDataFrame(
        [("--", "x", -1.0), (None, "x", 0.0), ("High", None, None), (" --", "y", 2.0)],
        "priority string, resolution string, resolution_time_days double",
    )
    assert [r.priority for r in unify.with_real_priority(df).collect()] == ["High", " --"]
    assert unify.resolved_only(df).count() == 3
    assert [r[2] for r in unify.with_valid_duration(df).collect()] == [0.0, 2.0]


def test_csv_round_trip_keeps_text(spark, tmp_path):
    texts = ["  padded ", "line\nbreak\n", "\r\n both", "a\\", 'say "x"', "\\\"", ",;|", "#hash", "\ttab\t", "'q'", "é語"]
    df = spark.createDataFrame([(str(i), t, "z") for i, t in enumerate(texts)], "id string, text string, last string")
    tables.write_csv(df, str(tmp_path / "csv"))
    assert rows_of(tables.read_table(spark, str(tmp_path / "csv"), "csv")) == rows_of(df)


def test_subtraction_neither_sorts_rows_nor_shuffles_missing_ids(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bugs = spark.createDataFrame([("1", "x"), (" 2", "y"), (None, "z"), (None, "z")], "id string, body string")
        lists = spark.createDataFrame([("2", "9")], "issue_id string, duplicate_ids string")
        out = dedup.subtract_listed(bugs, dedup.listed_ids(lists))
        assert rows_of(out) == sorted([("1", "x"), (None, "z"), (None, "z")], key=repr)
        assert "ShuffledHashJoin" in plan_of(out) and "Sort" not in plan_of(out).replace("SortMerge", "Sort")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_published_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(tables.CSV_OUT, "maxRecordsPerFile", 10)
    tables.write_csv(spark.range(0, 35, 1, 1).selectExpr("cast(id as string) id"), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.csv"))) == 4
    assert tables.read_table(spark, str(tmp_path / "out"), "csv").count() == 35


def test_a_list_is_read_once_for_all_the_files_it_serves(spark, tmp_path):
    """Five files by three listed reports are not fifteen rows."""
    for i in range(5):
        write(tmp_path, f"p/p_bugs_{i}.csv", HEADER + "".join(f"{k},t,High,Fixed,2024-01-01,2024-01-03,b,Closed,1.0\n" for k in (i, 9, 9)))
    write(tmp_path, "p/p_bugs_9.csv", HEADER)
    write(tmp_path, "p/p_bugs-combined.csv", "a,b\n0,1\n9,9\n7,\n8,9,broken\n")
    layout = trackers.inspect(spark, str(tmp_path), trackers.find_pairs(trackers.list_files(spark, str(tmp_path))))
    assert len(layout.pairs) == 6
    assert len(trackers.sound(trackers.read_duplicate_lists(spark, layout)).collect()) == 3
    done = ingest_trackers(spark, str(tmp_path))
    assert sorted(r["Issue id"] for r in done.cleaned.collect()) == ["2", "3", "4"]
    found = {r.pair[-5]: (r.before_rows, r.after_rows, r.removed_rows, r.listed_ids, r.rejected_records) for r in done.statistics.collect()}
    assert found == {
        "0": (3, 0, 3, 4, 1), "1": (3, 0, 3, 4, 1), "2": (3, 1, 2, 4, 1), "3": (3, 1, 2, 4, 1), "4": (3, 1, 2, 4, 1), "9": (0, 0, 0, 4, 1),
    }
    assert done.rejected.count() == 6


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_gzipped_exports(spark, folders, tmp_path):
    """The same tables from gzipped files, published so; they are left alone unless asked for."""
    plain = ingest_trackers(spark, folders)
    root, out = tmp_path / "zipped", str(tmp_path / "out")
    for path in sorted(tmp_path.glob("*/*.csv")):
        (root / path.parent.name).mkdir(parents=True, exist_ok=True)
        (root / path.parent.name / f"{path.name}.gz").write_bytes(gzip.compress(path.read_bytes()))
    done = ingest_trackers(spark, str(root), out, gzipped=True)
    assert rows_of(done.reports) == rows_of(plain.reports)
    assert rows_of(done.cleaned) == rows_of(plain.cleaned)
    assert rows_of(tables.read_table(spark, f"{out}/canonical", "csv").select(done.reports.columns)) == rows_of(done.reports)
    assert not [*Path(out).rglob("part-*.csv")] and [*Path(out).rglob("part-*.csv.gz")]
    with pytest.raises(ValueError, match="no bug file"):
        ingest_trackers(spark, str(root))


@pytest.mark.parametrize("bits", [64, dedup.LISTED_BITS])
def test_sieve_gives_the_same_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(dedup, "LISTED_BITS", bits)
    ids = [None, "", " ", *(f" {i} " for i in range(40)), *(str(i) for i in range(60))]
    bugs = spark.createDataFrame([(i, p, n) for n, i in enumerate(ids * 2) for p in ("a", "b", None)], "`the.id` string, p string, n int")
    lists = spark.createDataFrame([(str(i), f"{i + 1}; x", p) for i in range(0, 50, 9) for p in ("a", None)], "issue_id string, duplicate_ids string, p string")
    listed = dedup.listed_ids(lists, scope="p")
    plain = dedup.subtract_listed(bugs, listed, "the.id", "p")
    sifted = dedup.subtract_listed(bugs, listed, "the.id", "p", sieve=True)
    assert sifted.columns == bugs.columns and rows_of(sifted) == rows_of(plain)
    everything = dedup.subtract_listed(bugs, listed.limit(0), "the.id", "p", sieve=True)
    assert rows_of(everything) == rows_of(bugs)


def test_sieve_shuffles_only_rows_that_may_be_listed(spark):
    """One row in ten is listed; the texts of the others do not move."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bugs = spark.range(0, 5_000, 1, 4).select(F.col("id").cast("string").alias("id"), F.repeat(F.lit("x"), F.lit(100)).alias("body"))
        lists = spark.range(0, 5_000, 10).select(F.col("id").cast("string").alias("issue_id"), F.lit("").alias("duplicate_ids"))
        out = dedup.subtract_listed(bugs, dedup.listed_ids(lists), sieve=True)
        assert out.count() == 4_500
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().finalPhysicalPlan()
        joins, todo = [], [plan]
        while todo:
            node = todo.pop()
            kind = node.nodeName()
            if kind == "ShuffledHashJoin":
                joins.append(node)
            if hasattr(node, "plan") and kind.endswith("QueryStage"):
                todo.append(node.plan())
            todo += [node.children().apply(i) for i in range(node.children().size())]
        (join,) = joins
        side = join.left()
        while not side.nodeName().startswith(("ShuffleQueryStage", "Exchange")):
            side = side.children().apply(0)
        stage = side.plan() if side.nodeName() == "ShuffleQueryStage" else side
        assert stage.metrics().apply("shuffleRecordsWritten").value() < 600
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)
