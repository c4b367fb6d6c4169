"""Readers, writers and the catalog."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.fixtures import MESSY_LINES, ORDER_HEADER, STAFF, orders, plan_of, rows, staff, write_csv, write_lines
from tidemark import schemas
from tidemark.session import checkpoint_root
from tidemark.sources import catalog, files, sinks


def test_csv_typed(spark, tmp_path):
    df = files.read_csv(spark, write_csv(tmp_path / "orders.csv"), schemas.landing_orders())
    assert df.schema == schemas.landing_orders()
    assert rows(df) == rows(orders(spark))


def test_inference_loses_leading_zeros(spark, tmp_path):
    path = write_lines(tmp_path / "parts.csv", ["part_no,bin", "0077,left", "4100,right"])
    assert rows(files.read_csv_inferred(spark, path), "part_no") == [(4100,), (77,)]
    typed = files.read_csv(spark, path, spark.createDataFrame([], "part_no string, bin string").schema)
    assert rows(typed, "part_no") == [("0077",), ("4100",)]


@pytest.fixture
def messy(tmp_path):
    return write_lines(tmp_path / "messy.csv", [ORDER_HEADER, *MESSY_LINES])


def test_csv_permissive_nulls_the_bad_field(spark, messy):
    got = {r["order_id"]: r for r in files.read_csv(spark, messy, schemas.landing_orders()).collect()}
    assert len(got) == 8
    assert got[1003]["amount"] is None and got[1003]["region"] == "East"
    assert got[1005]["region"] is None
    assert got[1007]["region"] == "West"


def test_csv_dropmalformed(spark, messy):
    df = files.read_csv(spark, messy, schemas.landing_orders(), mode="DROPMALFORMED")
    assert [r["order_id"] for r in df.orderBy("order_id").collect()] == [1001, 1002, 1004, 1006, 1008]
    assert files.reliable_count(df) == 5


def test_csv_failfast(spark, messy):
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.read_csv(spark, messy, schemas.landing_orders(), mode="FAILFAST").collect()


def test_csv_quarantine_keeps_raw_text(spark, messy):
    clean, bad = files.read_with_quarantine(spark, messy, schemas.landing_orders())
    assert (clean.count(), bad.count()) == (5, 3)
    assert files.CORRUPT not in clean.columns
    assert MESSY_LINES[2] in [r[files.CORRUPT] for r in bad.collect()]


JSON_LINES = [
    '{"reading": 10, "sensor": "roof", "celsius": 21.5}',
    '{"reading": 11, "sensor": "cellar", "celsius": "cold"}',
    '{"reading": 12, "sensor": "roof", "celsius": 22.0}',
    '{"reading": 13 "sensor": "garden"}',
]


def test_json_quarantine(spark, tmp_path):
    path = write_lines(tmp_path / "in.json", JSON_LINES)
    schema = spark.createDataFrame([], "reading int, sensor string, celsius double").schema
    clean, bad = files.read_with_quarantine(spark, path, schema, "json")
    assert rows(clean, "reading") == [(10,), (12,)]
    # Broken syntax loses the row, a wrong type only its field; both keep the text.
    assert rows(bad) == [(11, "cellar", None, JSON_LINES[1]), (None, None, None, JSON_LINES[3])]


def test_schema_is_not_changed_by_the_corrupt_column():
    base = schemas.landing_orders()
    files.with_corrupt(base)
    assert base == schemas.landing_orders()


def test_quarantine_format_is_checked(spark):
    with pytest.raises(ValueError):
        files.read_marked(spark, "x", schemas.staff(), "orc")


def test_json_lines_and_document(spark, tmp_path):
    lines = ['{"emp_id": %d, "manager_id": null}' % r[0] for r in STAFF[:8]]
    assert files.read_json_lines(spark, write_lines(tmp_path / "a.json", lines)).count() == 8
    pretty = ["[", *[f'  {{\n    "emp_id": {i},\n    "name": "n{i}"\n  }}{"," if i < 3 else ""}' for i in (1, 2, 3)], "]"]
    path = write_lines(tmp_path / "b.json", pretty)
    assert rows(files.read_json_document(spark, path), "emp_id") == [(1,), (2,), (3,)]
    assert "_corrupt_record" in files.read_json_lines(spark, path).columns


def test_merged_schemas(spark, tmp_path):
    people = staff(spark)
    sinks.write(people.select("emp_id", "name", "department"), str(tmp_path / "v1"))
    sinks.write(people.select("emp_id", "name", "department", "salary"), str(tmp_path / "v2"))
    both = files.read_evolving(spark, str(tmp_path / "v1"), str(tmp_path / "v2"))
    assert both.count() == 30
    assert both.filter("salary IS NULL").count() == 16  # 15 without the column, one unknown salary


def test_orc_round_trip(spark, tmp_path):
    sinks.write(staff(spark), str(tmp_path / "o"), fmt="orc")
    assert rows(files.read_orc(spark, str(tmp_path / "o"))) == rows(staff(spark))


def test_write_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), staff(spark)
    sinks.write(df, path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.write(df, path)
    sinks.write(df, path, "ignore")
    assert spark.read.parquet(path).count() == 15
    sinks.write(df, path, "append")
    assert spark.read.parquet(path).count() == 30
    sinks.write(df, path, "overwrite")
    assert spark.read.parquet(path).count() == 15
    with pytest.raises(ValueError):
        sinks.write(df, path, "replace")


def test_file_count(spark, tmp_path):
    sinks.write(orders(spark), str(tmp_path / "three"), files=3)
    assert len(list((tmp_path / "three").glob("part-*.parquet"))) == 3


def test_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write(orders(spark), path, partition_by=["region"])
    assert sorted(p.name for p in (tmp_path / "p").glob("region=*")) == [
        "region=East", "region=North", "region=South", "region=West",
    ]
    west = spark.read.parquet(path).filter("region = 'West'")
    assert west.count() == 7
    assert "PartitionFilters: [isnotnull(region" in plan_of(west)


def batch(spark, amounts, day="2024-01-01"):
    return spark.createDataFrame([(i, a, day) for i, a in enumerate(amounts)], "id int, amount double, load_date string")


def test_replace_slice_is_retry_safe(spark, tmp_path):
    path = str(tmp_path / "facts")
    sinks.replace_slice(batch(spark, [1.0, 2.0], "2024-01-01"), path, "load_date", ["2024-01-01"])
    for _ in range(2):
        sinks.replace_slice(batch(spark, [5.0, 6.0], "2024-01-02"), path, "load_date", ["2024-01-02"])
    got = spark.read.parquet(path)
    assert rows(got.groupBy(F.col("load_date").cast("string")).agg(F.sum("amount"))) == [
        ("2024-01-01", 3.0), ("2024-01-02", 11.0),
    ]


def test_replace_slice_empties_a_slice_without_rows(spark, tmp_path):
    path = str(tmp_path / "facts")
    sinks.replace_slice(batch(spark, [1.0], "a").union(batch(spark, [2.0], "b")), path, "load_date", ["a", "b"])
    sinks.replace_slice(batch(spark, [9.0], "a"), path, "load_date", ["a", "b"])
    assert rows(spark.read.parquet(path), "load_date", "amount") == [("a", 9.0)]
    sinks.replace_slice(batch(spark, [], "a"), path, "load_date", ["a"])
    assert spark.read.parquet(path).count() == 0


def test_replace_slice_refuses_rows_outside(spark, tmp_path):
    with pytest.raises(sinks.OutsideSliceError, match="1 row"):
        sinks.replace_slice(batch(spark, [1.0], "x"), str(tmp_path / "f"), "load_date", ["y"])
    unknown = batch(spark, [1.0], "x").withColumn("load_date", F.lit(None).cast("string"))
    with pytest.raises(sinks.OutsideSliceError):
        sinks.replace_slice(unknown, str(tmp_path / "f"), "load_date", ["y"])


@pytest.mark.parametrize("kind, values", [
    ("date", ["2024-01-01", "2024-01-02"]), ("int", ["1996", "1997"]), ("boolean", ["true", "false"]), ("string", ["a b", "1"]),
])
def test_slice_values_as_text_or_typed(spark, tmp_path, kind, values):
    from tests.fixtures import rows as collected

    both = spark.createDataFrame([(1, values[0]), (2, values[1])], "n int, part string")
    both = both.withColumn("part", F.col("part").cast(kind))
    typed = [r["part"] for r in both.orderBy("n").collect()]
    for names in (values, typed):
        path = str(tmp_path / f"{kind}-{type(names[0]).__name__}")
        sinks.replace_slice(both, path, "part", names)
        sinks.replace_slice(both.filter("n = 1"), path, "part", names)
        assert collected(spark.read.parquet(path), "n") == [(1,)]
    if kind != "string":
        with pytest.raises(ValueError, match="cannot be read"):
            sinks.replace_slice(both, path, "part", ["no value"])


def test_slice_of_nulls(spark, tmp_path):
    path = str(tmp_path / "nulls")
    frame = spark.createDataFrame([(1, None), (2, "x")], "n int, part string")
    sinks.replace_slice(frame, path, "part", [None, "x"])
    sinks.replace_slice(frame.filter("n = 1").withColumn("n", F.lit(9)), path, "part", [None])
    assert rows(spark.read.parquet(path), "n") == [(2,), (9,)]
    sinks.replace_slice(frame.limit(0), path, "part", [None])
    assert rows(spark.read.parquet(path), "n") == [(2,)]


def test_slice_folder_is_escaped_as_spark_does(spark, tmp_path):
    path = str(tmp_path / "esc")
    value = "a:b/c d%e"
    sinks.write(batch(spark, [1.0], value), path, partition_by=["load_date"])
    folder = sinks.slice_folder(path, "load_date", value)
    assert (tmp_path / "esc" / folder.rsplit("/", 1)[1]).is_dir()


def test_compact(spark, tmp_path):
    src, dst = tmp_path / "many", tmp_path / "few"
    for i in range(8):
        spark.createDataFrame([(i, "u", float(i))], "event_id int, user string, value double").coalesce(1).write.mode(
            "append"
        ).parquet(str(src))
    assert sinks.compact(spark, str(src), str(dst)) == 1
    assert len(list(dst.glob("part-*.parquet"))) == 1
    assert len(list(src.glob("part-*.parquet"))) == 8
    assert rows(spark.read.parquet(str(dst))) == rows(spark.read.parquet(str(src)))


def test_managed_and_external_tables(spark, tmp_path):
    catalog.save_managed(staff(spark), "people", "overwrite")
    path = str(tmp_path / "ext")
    sinks.write(staff(spark), path)
    catalog.register_external(spark, "people_ext", path)
    kinds = {name: kind for name, kind, _ in catalog.describe_tables(spark)}
    assert kinds["people"] == "MANAGED" and kinds["people_ext"] == "EXTERNAL"
    assert ("salary", "double") in catalog.describe_columns(spark, "people")
    with pytest.raises(PermissionError):
        catalog.drop_table(spark, "people")
    catalog.drop_table(spark, "people_ext")
    assert spark.read.parquet(path).count() == 15
    catalog.drop_table(spark, "people", delete_files=True)
    assert not spark.catalog.tableExists("people")


def test_views(spark):
    catalog.session_view(staff(spark), "v_staff")
    name = catalog.global_view(staff(spark), "g_staff")
    other = spark.newSession()
    assert other.sql(f"SELECT count(*) FROM {name}").first()[0] == 15
    assert not other.catalog.tableExists("v_staff")


def test_column_pruning_and_pushdown_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write(orders(spark), path)
    plan = plan_of(files.read_parquet(spark, path).filter("amount > 500").select("order_id"))
    assert "PushedFilters: [IsNotNull(amount), GreaterThan(amount,500.0)]" in plan
    assert "ReadSchema: struct<order_id:int,amount:double>" in plan


def test_quarantine_writes_nothing_and_parses_whole_records(spark, tmp_path):
    """Headers of every file, blank lines, short and long lines, a wrong type; only the corrupt column is asked for."""
    for name, lines in {"a": ["id,at,v", "1,2024-01-05,1.5", "", "2,2024-01-06,bad", "3,not a day,2.5"],
                        "b": ["id,at,v", "4,2024-01-07,3.5", "5,2024-01-08", "6,2024-01-09,1.0,7", '7,"2024-01-10",4.5']}.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    schema = StructType.fromDDL("id int, at date, v double")
    scratch = set(os.listdir(checkpoint_root(spark))) if os.path.isdir(checkpoint_root(spark)) else set()
    clean, bad = files.read_with_quarantine(spark, str(tmp_path), schema)
    assert rows(clean.select("id")) == [(1,), (4,), (7,)] and clean.columns == ["id", "at", "v"]
    assert rows(bad.select(files.CORRUPT)) == [
        ("2,2024-01-06,bad",), ("3,not a day,2.5",), ("5,2024-01-08",), ("6,2024-01-09,1.0,7",),
    ]
    assert (clean.count(), bad.count()) == (3, 4)
    marked = rows(files.read_marked(spark, str(tmp_path), schema).select("id", "at", "v", files.CORRUPT))
    assert marked == rows(clean.withColumn(files.CORRUPT, F.lit(None)).unionByName(bad))
    now = set(os.listdir(checkpoint_root(spark))) if os.path.isdir(checkpoint_root(spark)) else set()
    assert now == scratch


def test_quarantine_of_records_over_several_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,v\n1,"two\nlines"\nx,"one"\n')
    clean, bad = files.read_with_quarantine(spark, str(tmp_path / "a.csv"), StructType.fromDDL("id int, v string"), multiLine=True)
    assert rows(clean) == [(1, "two\nlines")] and bad.count() == 1


def test_quarantine_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    clean, bad = files.read_with_quarantine(spark, str(tmp_path), StructType.fromDDL("id int"))
    assert (clean.count(), bad.count()) == (0, 0)
