import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrid.operators.contracts import roles_table
from tidegrid.sources.months import missing_months, month_partitions, require_months
from tidegrid.sources.readers import (
    FeedSpec,
    harmonise,
    load_union,
    read_dim_csv,
    read_parquet,
    reduce_feed,
    retention_report,
    stable_sample,
)
from tidegrid.sources.staging import stage
from tidegrid.sources.writers import (
    metric_rows,
    read_metrics,
    read_roles,
    write_csv,
    write_metrics,
    write_partitioned,
    write_roles,
    write_sorted,
)

SPEC = FeedSpec(integers=("id",), doubles=("fee",))


@pytest.fixture
def feed(spark, tmp_path):
    first = spark.createDataFrame([(1, 2)], "id long, airport_fee int").withColumnRenamed("airport_fee", "fee")
    second = spark.createDataFrame([(2.5, 3)], "Fee double, ID int")
    third = spark.createDataFrame([(1.5, 4)], "Fee double, ID int")
    for i, frame in enumerate((first, second, third)):
        frame.coalesce(1).write.parquet(str(tmp_path / f"m{i}"))
    return tmp_path


def test_drifting_files_settle_on_one_schema(spark, feed):
    df = load_union(spark, [str(feed / f"m{i}") for i in range(3)], SPEC)
    assert dict(df.dtypes) == {"id": "int", "fee": "double"}
    assert {tuple(r) for r in df.select("id", "fee").collect()} == {(1, 2.0), (3, 2.5), (4, 1.5)}
    assert load_union(spark, str(feed / "m*" / "*.parquet"), SPEC).count() == 3


def test_files_of_one_schema_share_a_scan(spark, feed):
    df = load_union(spark, [str(feed / f"m{i}") for i in range(3)], SPEC)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert plan.count("FileScan") == 2


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_union(spark, str(tmp_path / "none" / "*.parquet"), SPEC)


def test_absent_columns_stay_absent(spark):
    assert harmonise(spark.createDataFrame([(1,)], "ID long"), SPEC).columns == ["id"]


def test_partitioned_write_reads_back_and_prunes(spark, tmp_path):
    df = spark.range(100).select("id", F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("month"))
    for files in (1, 4):
        path = str(tmp_path / f"t{files}")
        write_partitioned(df, path, "month", files_per_value=files)
        back = read_parquet(spark, path, casts={"id": "int"})
        assert back.count() == 100 and dict(back.dtypes)["id"] == "int"
        assert back.where("month = '2024-02'").count() == 33


def test_sorted_write_is_one_ordered_file(spark, tmp_path):
    path = str(tmp_path / "s")
    write_sorted(spark.range(50).select((50 - F.col("id")).alias("k")), path, ["k"], single_file=True)
    assert len(list((tmp_path / "s").glob("part-*"))) == 1
    assert [r["k"] for r in spark.read.parquet(path).collect()] == list(range(1, 51))


def test_csv_keeps_na_as_a_value(spark, tmp_path):
    path = tmp_path / "z.csv"
    path.write_text("LocationID,Borough\n264,Unknown\n265,N/A\n1,EWR\n")
    df = read_dim_csv(
        spark,
        str(path),
        "LocationID int, Borough string",
        rename={"LocationID": "zone", "Borough": "borough"},
        relabel={"borough": {"N/A": "Outside", "Unknown": "Unknown zone"}},
    )
    assert {r["zone"]: r["borough"] for r in df.collect()} == {264: "Unknown zone", 265: "Outside", 1: "EWR"}
    write_csv(df, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 3


def test_metrics_and_roles_round_trip(spark, tmp_path):
    metrics = metric_rows(spark.range(10), {"rows": F.count("*"), "top": F.max("id")})
    write_metrics(metrics, str(tmp_path / "m"))
    assert {r["metric"]: r["value"] for r in read_metrics(spark, str(tmp_path / "m")).collect()} == {"rows": 10.0, "top": 9.0}
    roles = roles_table(spark, {"key": ["a"]}, {"g": ["b", "c"]})
    write_roles(roles, str(tmp_path / "r"))
    assert {tuple(r) for r in read_roles(spark, str(tmp_path / "r")).collect()} == {tuple(r) for r in roles.collect()}


def test_reduction_keeps_either_end(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text("o,d,x,y\nA,B,1,2\nB,C,3,4\nC,A,5,6\n")
    wide = spark.read.csv(str(path), header=True, schema="o string, d string, x int, y int")
    keep = F.col("o").isin("A") | F.col("d").isin("A")
    assert {tuple(r) for r in reduce_feed(wide, ["o", "d"], keep).collect()} == {("A", "B"), ("C", "A")}
    assert retention_report(wide, keep).head()["pct_kept"] == pytest.approx(200 / 3)


def test_months_lead_and_requirement(spark):
    months = month_partitions(spark, "2023-01-01", "2023-03-01", lead=1).orderBy("month").collect()
    assert [(r["month"], r["is_lead"]) for r in months] == [("2022-12", True), ("2023-01", False), ("2023-02", False)]
    assert months[0]["month_end"] == dt.date(2023, 1, 1)
    required = month_partitions(spark, "2023-01-01", "2023-03-01").select("month")
    present = spark.createDataFrame([("2023-01",), ("2023-02",)], "month string")
    assert [r["month"] for r in missing_months(present, required).collect()] == ["2022-12"]
    with pytest.raises(ValueError):
        require_months(present, required)


def test_stable_sample_ignores_layout(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    once = {r["k"] for r in stable_sample(df, "k", 0.05).collect()}
    again = {r["k"] for r in stable_sample(df.repartition(7), "k", 0.05).collect()}
    assert once == again and 800 < len(once) < 1200


def test_stage_cuts_the_plan(spark):
    staged = stage(spark.range(10).select((F.col("id") * 2).alias("x")))
    assert staged.agg(F.sum("x")).head()[0] == 90
    assert spark.sparkContext.getCheckpointDir()
