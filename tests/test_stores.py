"""Exports that are staged once, accounts listed by tasks, batches that are written once."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from spendlake.plans import billing
from spendlake.sinks import batches
from spendlake.sinks.batches import BatchLedger
from spendlake.sinks.tables import replace_period
from spendlake.sources import exports
from spendlake.sources.accounts import account_listing, collect_accounts
from spendlake.sources.exports import find_exports, read_exports, scan_exports
from spendlake.streaming.ingest import ingest_incremental


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()))


@pytest.fixture
def opened(spark, monkeypatch):
    """Counts the files that tasks open."""
    counter = spark.sparkContext.accumulator(0)
    plain = exports.open_stream

    def counted(path):
        counter.add(1)
        return plain(path)

    monkeypatch.setattr(exports, "open_stream", counted)
    return counter


def rows_of(read):
    return sorted(tuple(r) for r in read.lines.collect())


def test_a_file_is_opened_once(spark, tmp_path, opened):
    for i in range(5):
        put(tmp_path / "m" / f"{i}.csv.gz", "a,b\n" + f"{i},x\n" * 50_000)
    put(tmp_path / "m" / "wide.csv.gz", "a,b\n" + "1,x\n" * 30_000 + "1,x,y\n")
    read = read_exports(spark, find_exports(spark, str(tmp_path)), ["a", "b"])
    assert read.lines.count() == 250_000 and read.rejected.count() == 1
    assert read.lines.groupBy("a").count().count() == 5
    assert opened.value == 6
    again = {r.n_rows for r in read.files.where("problem IS NULL").collect()}
    assert again == {50_000} and opened.value == 6


def test_short_rows_are_counted_and_empty_cells_told_apart(spark, tmp_path):
    put(tmp_path / "m" / "f.csv.gz", 'a,b,c\n1\n2,"",\n3,x,y\n\n4,z\n')
    read = read_exports(spark, find_exports(spark, str(tmp_path)))
    assert set(rows_of(read)) == {("1", None, None), ("2", "", None), ("3", "x", "y"), ("4", "z", None)}
    assert [(r.n_rows, r.n_short) for r in read.files.collect()] == [(4, 2)]


def test_unchanged_files_are_not_opened_again(spark, tmp_path, opened):
    root, store = tmp_path / "in", f"{tmp_path}/store"

    def run(*columns):
        before = opened.value
        read = read_exports(spark, find_exports(spark, str(root)), list(columns) or None, store=store)
        return rows_of(read), sorted(os.path.basename(r.path) for r in read.rejected.collect()), opened.value - before

    put(root / "m" / "1.csv.gz", "a,b\n1,x\n")
    put(root / "m" / "2.csv.gz", "a,b\n2,y\n2,y\n")
    put(root / "m" / "bad.csv.gz", 'a,b\n3,"z\n')
    first = [("1", "x"), ("2", "y"), ("2", "y")]
    assert run() == (first, ["bad.csv.gz"], 3)
    assert run() == (first, ["bad.csv.gz"], 0)
    put(root / "m" / "3.csv.gz", "b,a,c\nv,4,new\n")  # another layout
    wide = [(a, b, None) for a, b in first] + [("4", "v", "new")]
    assert run() == (sorted(wide, key=repr), ["bad.csv.gz"], 1) or run()[0] == sorted(wide)
    put(root / "m" / "bad.csv.gz", "a,b\n3,mended\n")
    os.utime(root / "m" / "bad.csv.gz", (1, 1))
    put(root / "m" / "2.csv.gz", "a,b\n2,changed\n")
    os.unlink(root / "m" / "1.csv.gz")
    lines, rejected, n = run()
    assert lines == [("2", "changed", None), ("3", "mended", None), ("4", "v", "new")]
    assert rejected == [] and n == 2
    assert run("a")[::2] == ([("2",), ("3",), ("4",)], 3)  # other columns are staged for themselves
    assert run("a")[2] == 0
    with pytest.raises(ValueError, match="listing with the files' times"):
        read_exports(spark, find_exports(spark, str(root)).drop("modified"), store=store)


def test_a_run_that_fails_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch):
    root, store = tmp_path / "in", f"{tmp_path}/store"
    put(root / "m" / "1.csv.gz", "a\n1\n")
    read_exports(spark, find_exports(spark, str(root)), ["a"], store=store)
    put(root / "m" / "2.csv.gz", "a\n2\n")

    def broken(*args):
        return scan_exports(*args).withColumn("a", F.raise_error(F.lit("broken")))

    monkeypatch.setattr(exports, "scan_exports", broken)
    with pytest.raises(Exception, match="broken"):
        read_exports(spark, find_exports(spark, str(root)), ["a"], store=store)
    monkeypatch.undo()
    assert rows_of(read_exports(spark, find_exports(spark, str(root)), ["a"], store=store)) == [("1",), ("2",)]


def test_unverified_reading_equals_verified(spark, tmp_path):
    put(tmp_path / "m" / "1.csv.gz", 'a,b\n1,"x,\ny"\n2,\n')
    put(tmp_path / "n" / "2.csv.gz", "b,a,c\nv,4,w\n")
    found = find_exports(spark, str(tmp_path))
    tags = {f"{tmp_path}/m": "M", f"{tmp_path}/n": "N"}
    for wanted in (None, ["a", "b"]):
        both = [read_exports(spark, found, wanted, verify=v, tags=tags) for v in (True, False)]
        assert both[0].lines.columns == both[1].lines.columns
        assert sorted(map(repr, both[0].lines.collect())) == sorted(map(repr, both[1].lines.collect()))
    with pytest.raises(ValueError, match="verified"):
        read_exports(spark, found, verify=False, store=f"{tmp_path}/s")


REGISTRY = "aws_id string, bucket string, monthly_dir string"


def test_many_missing_accounts_are_one_job(spark, tmp_path):
    put(tmp_path / "b" / "one" / "2025" / "f.csv.gz", "a\n1\n")
    put(tmp_path / "b" / "one" / "_temporary" / "f.csv.gz", "a\n1\n")
    put(tmp_path / "b" / "one" / "inner" / "g.csv.gz", "a\n2\n")
    (tmp_path / "b" / "empty").mkdir()
    rows = [(f"m{i}", str(tmp_path / "b"), f"missing{i}") for i in range(10_000)]
    rows += [("1", str(tmp_path / "b"), "one"), ("2", str(tmp_path / "b"), "one/inner"), ("3", str(tmp_path / "b"), "empty")]
    rows += [("4", None, "one"), ("1", str(tmp_path / "b"), "one")]
    registry = spark.createDataFrame(rows, REGISTRY)
    tracker, group = spark.sparkContext.statusTracker(), "listing"
    spark.sparkContext.setJobGroup(group, "listing")
    try:
        found = account_listing(registry).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup(group)) < 20  # however many accounts there are
    files = sorted((r.source_account_id, os.path.basename(r.path)) for r in found if r.path)
    assert files == [("1", "f.csv.gz"), ("2", "g.csv.gz")]
    assert sum(r.path is None for r in found) == 10_001
    read = collect_accounts(spark, registry)
    assert sorted(tuple(r) for r in read.lines.collect()) == [("1", "1"), ("2", "2")]
    kinds = {r.problem: r["count"] for r in read.rejected.groupBy("problem").count().collect()}
    assert kinds == {"no such directory": 10_000, "no directory in the registry": 1}
    with pytest.raises(ValueError, match="registry is empty"):
        collect_accounts(spark, registry.where("false"))
    with pytest.raises(FileNotFoundError):
        collect_accounts(spark, registry.where("aws_id = 'm1'"))


KINDS = "kind string, usage_period string"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), KINDS)


def table(spark, target):
    return sorted(tuple(r) for r in spark.read.schema(KINDS).parquet(target).select("kind", "usage_period").collect())


@pytest.mark.parametrize("stop", ["before staging", "before the note", "half-way", "before the last note", "no"])
def test_a_batch_that_runs_twice_is_written_once(spark, tmp_path, monkeypatch, stop):
    target, state = f"{tmp_path}/t", f"{tmp_path}/c"
    rows = [("a", "2025-06"), ("b", "2025-07"), ("c", "2025-07")]
    ledger = BatchLedger(spark, state, target)
    ledger.finish()
    ledger.write(batch(spark, ("z", "2025-05")), 0, "usage_period")
    plain, move = BatchLedger._note, batches._moved
    if stop == "half-way":
        def one_only(stage, goal):
            def run(found):
                for x in move(stage, goal)(b.slice(0, 1) for b in found):
                    yield x
                    raise RuntimeError("stopped")
            return run
        monkeypatch.setattr(batches, "_moved", one_only)
    elif stop != "no":
        state_of = {"before the note": "staged", "before the last note": "published"}.get(stop)

        def note(self, number, what):
            if what == state_of:
                raise RuntimeError("stopped")
            plain(self, number, what)

        monkeypatch.setattr(BatchLedger, "_note", note)
    broken = batch(spark, *rows)
    if stop == "before staging":
        broken = broken.withColumn("kind", F.raise_error(F.lit("stopped")))
    if stop == "no":
        ledger.write(broken, 1, "usage_period")
    else:
        with pytest.raises(Exception, match="stopped"):
            ledger.write(broken, 1, "usage_period")
    monkeypatch.undo()
    again = BatchLedger(spark, state, target)
    again.finish()
    for _ in range(2):
        again.write(batch(spark, *rows), 1, "usage_period")
    assert table(spark, target) == sorted([("z", "2025-05"), *rows])
    assert not os.path.exists(f"{state}/batches/stage/1")


def test_ingest_and_replace_share_a_target(spark, tmp_path, monkeypatch):
    source, target, state = (f"{tmp_path}/{x}" for x in "stc")
    schema = batch(spark, ("a", "m")).schema

    def ingest():
        ingest_incremental(spark, source, target, state, schema)

    batch(spark, ("a", "2025-06"), ("b", "2025-07")).write.parquet(source)
    ingest()
    replace_period(batch(spark, ("new", "2025-06")), target, "2025-06", checkpoint=state)
    ingest()
    assert table(spark, target) == [("b", "2025-07"), ("new", "2025-06")]
    batch(spark, ("late", "2025-06")).write.mode("append").parquet(source)
    plain = BatchLedger._publish
    monkeypatch.setattr(BatchLedger, "_publish", lambda self, n: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(Exception, match="stopped"):
        ingest()
    monkeypatch.setattr(BatchLedger, "_publish", plain)
    replace_period(batch(spark, ("whole", "2025-06")), target, "2025-06", checkpoint=state)
    ingest()  # the batch that was stopped was finished before the month was replaced
    assert table(spark, target) == [("b", "2025-07"), ("whole", "2025-06")]
    lines = batch(spark, ("x", "2025-06")).select(
        F.lit("Usage").alias("line_item_line_item_type"),
        F.lit("2025-07-02").cast("timestamp_ntz").alias("line_item_usage_start_date"),
        "kind",
    )
    assert billing.run(spark, lines, target, "2025-07", checkpoint=state) == 1
    assert table(spark, target) == [("whole", "2025-06"), ("x", "2025-07")]


def test_a_target_with_a_private_file_list_is_refused(spark, tmp_path):
    os.makedirs(f"{tmp_path}/t/_spark_metadata")
    with pytest.raises(ValueError, match="_spark_metadata"):
        BatchLedger(spark, f"{tmp_path}/c", f"{tmp_path}/t").finish()
