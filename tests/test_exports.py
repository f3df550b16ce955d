import csv
import gzip
import io
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.operators import savings as S
from spendlake.operators.columns import RI_COLUMNS
from spendlake.operators.typed import to_typed
from spendlake.plans import convert
from spendlake.plans import savings as plans
from spendlake.registry import exports as registry
from spendlake.sources import accounts, exports, files, lists


def write_gz(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    text = io.StringIO()
    writer = csv.writer(text)
    writer.writerow(header)
    writer.writerows(rows)
    with gzip.open(path, "wt", newline="") as f:
        f.write(text.getvalue())


def listing(spark, root):
    return files.list_files(spark, str(root), "*.csv.gz", recursive=True)


def test_values_follow_names(spark, tmp_path):
    write_gz(f"{tmp_path}/a/1.csv.gz", ["acct", "x"], [["012345678901", "1"]])
    write_gz(f"{tmp_path}/b/2.csv.gz", ["x", "acct", "only_here"], [["2", "000000000002", "y"]])
    lines = exports.read_exports(spark, listing(spark, tmp_path)).lines
    rows = {(r.acct, r.x, r.only_here) for r in lines.collect()}
    assert rows == {("012345678901", "1", None), ("000000000002", "2", "y")}


def test_names_that_repeat_or_differ_in_case(spark, tmp_path):
    write_gz(f"{tmp_path}/1.csv.gz", ["x", "X", "x"], [["1", "2", "3"]])
    lines = exports.read_exports(spark, listing(spark, tmp_path)).lines
    assert lines.columns == ["x", "X.1", "x.2"]
    assert tuple(lines.first()) == ("1", "2", "3")


def test_case_decides_between_spellings(spark, tmp_path):
    header = ["usageAmount", "UsageAmount"]
    write_gz(f"{tmp_path}/1.csv.gz", header, [["camel", "title"]])
    read = exports.read_exports(spark, listing(spark, tmp_path), ["line_item_usage_amount"])
    assert read.lines.first()[0] == "title"


def test_quotes_commas_and_line_breaks(spark, tmp_path):
    cells = ['say "hi"', "a,b", "two\nlines", "back\\slash", "é", " pad "]
    write_gz(f"{tmp_path}/1.csv.gz", [f"h{i}" for i in range(len(cells))], [cells, cells])
    rows = exports.read_exports(spark, listing(spark, tmp_path)).lines.collect()
    assert [list(r) for r in rows] == [cells, cells]


def test_broken_files_are_left_out_whole(spark, tmp_path):
    many = [[str(i), "usage"] for i in range(50000)]
    write_gz(f"{tmp_path}/good.csv.gz", ["acct", "kind"], [["7", "good"]])
    write_gz(f"{tmp_path}/long.csv.gz", ["acct", "kind"], many)
    whole = open(f"{tmp_path}/long.csv.gz", "rb").read()
    open(f"{tmp_path}/cut.csv.gz", "wb").write(whole[: len(whole) * 2 // 3])
    os.unlink(f"{tmp_path}/long.csv.gz")
    flipped = bytearray(whole)
    flipped[-6] ^= 255  # length and checksum at the end no longer fit
    open(f"{tmp_path}/flipped.csv.gz", "wb").write(bytes(flipped))
    open(f"{tmp_path}/plain.csv.gz", "wb").write(b"acct,kind\n1,no gzip\n")
    open(f"{tmp_path}/empty.csv.gz", "wb").write(gzip.compress(b""))
    open(f"{tmp_path}/latin.csv.gz", "wb").write(gzip.compress(b"acct,kind\n1,caf\xe9\n" * 9999))
    write_gz(f"{tmp_path}/other.csv.gz", ["acct"], [["1"]])
    read = exports.read_exports(spark, listing(spark, tmp_path), ["acct", "kind"])
    assert [tuple(r) for r in read.lines.collect()] == [("7", "good")]
    problems = {os.path.basename(r.path): r.problem for r in read.rejected.collect()}
    assert sorted(problems) == [
        "cut.csv.gz", "empty.csv.gz", "flipped.csv.gz", "latin.csv.gz", "other.csv.gz",
        "plain.csv.gz",
    ]
    assert problems["cut.csv.gz"].startswith("EOFError")
    assert problems["empty.csv.gz"] == "no header"
    assert problems["other.csv.gz"] == "Missing required columns: kind"


def test_blank_lines_before_the_header(spark, tmp_path):
    open(f"{tmp_path}/f.csv.gz", "wb").write(gzip.compress(b"\n\nx,y\n1,2\n\n3,4\n"))
    rows = exports.read_exports(spark, listing(spark, tmp_path)).lines
    assert rows.columns == ["x", "y"]
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "2"), ("3", "4")]


def test_files_of_several_gzip_members(spark, tmp_path):
    parts = [b"x\n", b"1\n2\n", b"3\n"]
    open(f"{tmp_path}/f.csv.gz", "wb").write(b"".join(gzip.compress(p) for p in parts))
    rows = exports.read_exports(spark, listing(spark, tmp_path)).lines
    assert sorted(r.x for r in rows.collect()) == ["1", "2", "3"]


def test_errors_when_nothing_is_left(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        exports.find_exports(spark, str(tmp_path), "2025")
    write_gz(f"{tmp_path}/1.csv.gz", ["x"], [["1"]])
    with pytest.raises(ValueError, match="Every file was rejected.*Missing required columns: y"):
        exports.read_exports(spark, listing(spark, tmp_path), ["y"])


def test_only_directories_with_the_prefix(spark, tmp_path):
    for name in ("2025-06", "2025-07", "2024-12", "notes"):
        write_gz(f"{tmp_path}/{name}/f.csv.gz", ["x"], [[name]])
    write_gz(f"{tmp_path}/2025-06/deeper/f.csv.gz", ["x"], [["deeper"]])
    found = exports.find_exports(spark, str(tmp_path), "2025")
    rows = exports.read_exports(spark, found).lines.collect()
    assert sorted(r.x for r in rows) == ["2025-06", "2025-07"]


HEADER = [
    "lineItem/LineItemType", "reservation/SubscriptionId", "reservation/ReservationARN",
    "lineItem/UsageAccountId", "pricing/PublicOnDemandCost", "reservation/EffectiveCost",
    "lineItem/UsageStartDate",
]


def test_report_job(spark, tmp_path):
    inside, outside = "2025-06-30T23:59:59Z", "2025-07-01T00:00:00Z"
    rows = [
        ["DiscountedUsage", "9", "arn/ri-1", "012345678901", "10.005", "4", inside],
        ["DiscountedUsage", "9", "arn/ri-1", "012345678901", "", "1", inside],
        ["DiscountedUsage", "9", "arn/ri-2", "012345678901", "1", "1", inside],
        ["DiscountedUsage", "NA", "arn/ri-1", "012345678901", "1", "1", inside],
        ["DiscountedUsage", "9", "arn/ri-1", "012345678901", "1", "1", outside],
        ["Usage", "9", "arn/ri-1", "012345678901", "1", "1", inside],
    ]
    write_gz(f"{tmp_path}/2025x/a.csv.gz", HEADER, rows)
    write_gz(f"{tmp_path}/2025y/b.csv.gz", list(RI_COLUMNS), rows[:1])
    (tmp_path / "ri-id").write_text(" ri-1 \n\n")
    report = f"{tmp_path}/report"
    result = plans.ri_from_exports(
        spark, str(tmp_path), "2025-06", "2025", f"{tmp_path}/ri-id", report
    )
    # The second file has the columns in the order of RI_COLUMNS, which is that of HEADER.
    assert [tuple(map(str, r)) for r in result.details.collect()] == [
        ("9", "arn/ri-1", "012345678901", "20.010000000000", "9.000000000000", "11.010000000000")
    ]
    written = spark.read.option("header", True).csv(report).collect()
    assert [tuple(r) for r in written] == [
        ("arn/ri-1", "012345678901", "$20.01", "$9.00", "$11.01"),
        (None, None, "$20.01", "$9.00", "$11.01"),
    ]


def test_savings_plan_job(spark, tmp_path):
    header = [
        "LineItemType", "UsageAccountId", "UsageAmount", "UnblendedCost",
        "SavingsPlanEffectiveCost", "SavingsPlanId", "UsageStartDate", "PayerAccountId", "UsageType",
    ]
    rows = [
        ["SavingsPlanCoveredUsage", account, "2", "10", "4", plan, "2025-06-03T00:00:00Z", payer, "box"]
        for account, plan, payer in (
            ("2", "sp-1", "b"), ("1", "sp-2", "b"), ("1", "sp-1", "b"), ("1", "sp-2", "a"),
            ("1", "sp-3", "a"),
        )
    ]
    write_gz(f"{tmp_path}/2025-06/a.csv.gz", header, rows)
    (tmp_path / "sp-id").write_text("sp-1\nsp-2\n")
    result = plans.sp_from_exports(
        spark, str(tmp_path), "2025-06", f"{tmp_path}/sp-id", "2025", f"{tmp_path}/report"
    )
    written = spark.read.option("header", True).csv(f"{tmp_path}/report").collect()
    assert [tuple(r)[:3] for r in written] == [
        ("1", "sp-2", "a"), ("1", "sp-1", "b"), ("1", "sp-2", "b"), ("2", "sp-1", "b"),
        ("GRAND TOTAL", None, None),
    ]
    assert tuple(written[-1])[4:] == ("8.00", "$40.00", "$16.00", "$24.00")
    totals = result.totals.first()
    assert (totals.n_accounts, float(totals.savings)) == (3, 24.0)


def test_id_files(spark, tmp_path):
    (tmp_path / "ids").write_text("  sp-1\r\n\n sp-2\t\nsp-1\n   \n")
    assert sorted(r.id for r in lists.read_ids(spark, f"{tmp_path}/ids").collect()) == ["sp-1", "sp-2"]
    assert lists.read_optional_ids(spark, f"{tmp_path}/none") is None
    (tmp_path / "blank").write_text("\n \n")
    assert lists.read_optional_ids(spark, f"{tmp_path}/blank").count() == 0
    with pytest.raises(ValueError, match="names no id"):
        lists.read_ids(spark, f"{tmp_path}/blank")
    with pytest.raises(FileNotFoundError):
        lists.read_ids(spark, f"{tmp_path}/none")


def test_typed_columns(spark, tmp_path):
    header = [
        "line_item_usage_account_id", "line_item_usage_start_date", "line_item_usage_amount",
        "discount", "resource_tags", "bill_bill_type", "own_column", "bill_invoice_id",
    ]
    write_gz(
        f"{tmp_path}/in/1.csv.gz",
        header,
        [
            ["012345678901", "2025-03-09T02:30:00.123999Z", "1.5", '{"a":"0.5"}', '{"t":"v"}', "NA", "007", ""],
            ["", "", "x", "", "", "Anniversary", "", "5"],
        ],
    )
    rejected = convert.run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert rejected.count() == 0
    back = spark.read.parquet(f"{tmp_path}/out")
    assert dict(back.dtypes) == {
        "line_item_usage_account_id": "string", "line_item_usage_start_date": "timestamp_ntz",
        "line_item_usage_amount": "double", "discount": "string", "resource_tags": "string",
        "bill_bill_type": "string", "own_column": "string", "bill_invoice_id": "string",
    }
    first, second = back.orderBy("bill_bill_type").collect()
    assert [str(v) for v in first] == [
        "012345678901", "2025-03-09 02:30:00.123000", "1.5", '{"a": 0.5}', '{"t": "v"}', "None",
        "007", "",
    ]
    assert list(second) == ["", None, None, "{}", "{}", "Anniversary", None, "5"]


def test_real_maps(spark):
    rows = spark.createDataFrame([('{"a":"0.5"}', '{"t":1}'), ("x", "x")], "discount string, product string")
    typed = to_typed(rows, maps_as="map")
    assert dict(typed.dtypes) == {"discount": "map<string,double>", "product": "map<string,string>"}
    assert [tuple(r) for r in typed.collect()] == [({"a": 0.5}, {"t": "1"}), (None, None)]


def test_accounts(spark, tmp_path):
    for account, folder in (("a1", "one/monthly"), ("a2", "one/monthly2"), ("a3", "three")):
        write_gz(f"{tmp_path}/{folder}/2025/06/f.csv.gz", ["x"], [[account]])
    registry = spark.createDataFrame(
        [
            ("a1", f"{tmp_path}/one", "monthly", "key"),
            ("a2", f"{tmp_path}/one/", "/monthly2/", "key"),
            ("a3", f"file:{tmp_path}", "three", "key"),
        ],
        "aws_id string, bucket string, monthly_dir string, secret_access_key string",
    )
    safe = accounts.without_keys(registry)
    assert safe.columns == ["aws_id", "bucket", "monthly_dir"]
    rows = accounts.collect_accounts(spark, safe, "monthly").lines.collect()
    assert sorted((r.x, r.source_account_id) for r in rows) == [("a1", "a1"), ("a2", "a2"), ("a3", "a3")]
    with pytest.raises(ValueError, match="granularity"):
        accounts.collect_accounts(spark, safe, "yearly")


def test_account_directories(spark):
    rows = [("1", "name", "/daily/"), ("2", "s3://name/", "daily"), ("3", "/mnt/name", "daily"), ("4", None, "daily")]
    registry = spark.createDataFrame(rows, "aws_id string, bucket string, daily_dir string")
    found = accounts.account_folders(registry, "daily")
    assert {r.source_account_id: r.folder for r in found.collect()} == {
        "1": "s3a://name/daily", "2": "s3://name/daily", "3": "/mnt/name/daily", "4": None,
    }
    assert exports._without_store("hdfs://host:8020/a/b") == "/a/b"


def test_files_outside_the_directories(spark, tmp_path):
    write_gz(f"{tmp_path}/a/f.csv.gz", ["x"], [["1"]])
    with pytest.raises(ValueError, match="none of the given directories"):
        exports.read_exports(spark, listing(spark, tmp_path), tags={"/elsewhere": "a"})


def test_names_with_odd_characters(spark, tmp_path):
    root = tmp_path / "a b+c%20d é#x[1]{2}"
    write_gz(f"{root}/f 1%.csv.gz", ["x"], [["1"]])
    found = files.list_files(spark, f"{tmp_path}/*", "*.csv.gz", recursive=True)
    tags = {f"{root}/": "a1"}
    rows = exports.read_exports(spark, found, tags=tags).lines.collect()
    assert [(r.x, r.source_account_id) for r in rows] == [("1", "a1")]


def test_registry_is_read_without_keys(spark, tmp_path):
    spark.createDataFrame([("a", "k", "s")], "aws_id string, access_key_id string, secret_access_key string").write.parquet(
        f"{tmp_path}/payer"
    )
    assert accounts.read_registry(spark, f"{tmp_path}/payer").columns == ["aws_id"]


def test_result_does_not_depend_on_the_split(spark, tmp_path):
    rows = [
        ["DiscountedUsage", str(i % 3), f"arn/ri-{i % 5}", "1", f"{i}.1", f"0.{i}", "2025-06-01"]
        for i in range(60)
    ]
    write_gz(f"{tmp_path}/whole/f.csv.gz", HEADER, rows)
    for i in range(6):
        order = list(range(len(HEADER)))[:: (-1) ** i]
        part = [[r[j] for j in order] for r in rows[i::6]]
        write_gz(f"{tmp_path}/parts/{i}.csv.gz", [HEADER[j] for j in order], part)
    results = []
    for name in ("whole", "parts"):
        read = exports.read_exports(spark, listing(spark, tmp_path / name), RI_COLUMNS)
        results.append(sorted(S.ri_savings(exports.typed_lines(read.lines), "2025-06").collect()))
    assert results[0] == results[1] and len(results[0]) == 15


def test_rows_of_a_large_file_are_spread_without_a_shuffle(spark, tmp_path, monkeypatch):
    write_gz(f"{tmp_path}/in/1.csv.gz", ["a", "b"], [[str(i), str(i * 7919 % 10007)] for i in range(20_000)])
    monkeypatch.setattr(exports, "SPREAD_BYTES", 20_000)
    typed = []
    monkeypatch.setattr(convert, "write_typed", lambda rows, *_: typed.append(rows))
    convert.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", rebalance=True)
    plan = typed[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    staged = [f.removeprefix("file://") for f in typed[0].inputFiles()]
    assert sum(pq.ParquetFile(f).num_row_groups for f in staged) > 4
    assert typed[0].count() == 20_000


def test_no_position_is_asked_for_rows(monkeypatch):
    class Untold(io.BytesIO):
        def tell(self):
            raise AssertionError("asked for a position")

    monkeypatch.setattr(exports, "_unzipped", lambda raw, path: Untold(b"a,b\n1,2\n3\n\n"))
    monkeypatch.setattr(exports, "open_stream", lambda path: io.BytesIO())
    file = pa.RecordBatch.from_arrays([pa.array(["x"])], ["path"])
    *rows, last = exports._staged(["path"], None, ())(iter([file]))
    assert [r["cells"] for b in rows for r in b.to_pylist()] == [["1", "2"], ["3", None]]
    assert last.to_pylist()[0]["__state"] == {"header": ["a", "b"], "problem": None, "n_rows": 2, "n_short": 1}


def test_exports_are_written_where_a_join_left_them(spark, monkeypatch, tmp_path):
    moved = []
    monkeypatch.setattr(DataFrame, "repartition", lambda self, *_: moved.append(self) or self)
    registry._write_csv(spark.range(5).withColumn("b", F.lit("x")), f"{tmp_path}/out")
    assert not moved
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").count() == 5
