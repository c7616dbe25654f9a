from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txlake.sources import (
    Layout,
    SchemaDriftError,
    land_snapshot,
    overwrite_table,
    read_csv_strings,
    read_table,
    table_exists,
    write_csv_strings,
    write_json,
    write_partitions,
)

KEYS = ["processing_date"]


def csv(base, *lines):
    path = Path(base) / "source.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_reading(spark, base):
    path = csv(
        base,
        "\ufeffid,v,w",
        '1,"",x',
        "2,short",
        "3,a,b,too long",
        "",
        "4, ,x",
        '5,"a ""b"" c",x',
        "6, US ,x",
        '7,"x,y",z',
        "8,1.0,2",
    )
    df = read_csv_strings(spark, path)
    assert df.dtypes == [("id", "string"), ("v", "string"), ("w", "string")]
    assert rows(df) == [
        ("1", None, "x"),
        ("2", "short", None),
        ("3", "a", "b"),
        ("4", " ", "x"),
        ("5", '"a ""b"" c"', "x"),
        ("6", " US ", "x"),
        ("7", "x,y", "z"),
        ("8", "1.0", "2"),
    ]


NASTY = [
    "a,b\\",
    "\\",
    'a"b',
    '"q"',
    'x\\"y',
    " lead",
    "trail ",
    "#c",
    "a\\,b",
    '"',
    '""',
    '\\"',
    "a'b",
    ",",
    'a ""b"" c',
    "é",
    "\t",
    " ",
    "\\\\",
    "end\\\\,",
    None,
    'a\\"b,c',
    "\\n",
    '"a\\",',
]


def test_landing_keeps_values_in_every_part(spark, base):
    """Many part files: none may lose its first row, or any value's exact text."""
    source, landed = f"{base}/source", Layout(base).landing("2024-02-01")
    df = spark.createDataFrame(
        [(str(i), NASTY[i % len(NASTY)], "z") for i in range(500)], "id string, v string, w string"
    )
    write_csv_strings(df.repartition(7), source)
    assert len(list(Path(source).glob("*.csv"))) == 7
    land_snapshot(spark, source, landed)
    landing = read_csv_strings(spark, landed)
    assert landing.columns == ["id", "v", "w"]
    assert rows(landing) == rows(df)


def test_landing_again_replaces_the_day(spark, base):
    landed = Layout(base).landing("2024-02-01")
    for id_ in ("1", "2"):
        land_snapshot(spark, csv(base, "id, Location Region ", f"{id_}, x "), landed)
    df = read_csv_strings(spark, landed)
    assert df.columns == ["id", " Location Region "]
    assert rows(df) == [("2", " x ")]


def test_landing_an_empty_file_keeps_the_header(spark, base):
    landed = Layout(base).landing("2024-02-01")
    land_snapshot(spark, csv(base, "id,v"), landed)
    df = read_csv_strings(spark, landed)
    assert df.columns == ["id", "v"]
    assert df.count() == 0


def dated(spark, *pairs):
    return spark.createDataFrame(list(pairs), "v string, processing_date string")


def test_partitions_are_replaced_one_by_one(spark, base):
    path = f"{base}/t"
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"

    def stored():
        return rows(read_table(spark, path, partition_types={"processing_date": "string"}))

    write_partitions(dated(spark, ("a", "2024-01-01"), ("b", "2024-01-02")), path, KEYS)
    write_partitions(dated(spark, ("c", "2024-01-01")), path, KEYS)
    write_partitions(dated(spark, ("n", None)), path, KEYS)
    want = [("b", "2024-01-02"), ("c", "2024-01-01"), ("n", None)]
    assert stored() == want
    write_partitions(dated(spark).limit(0), path, KEYS)
    assert stored() == want
    write_partitions(dated(spark, ("c", "2024-01-01")), path, KEYS)
    assert stored() == want


def test_first_write_may_be_empty(spark, base):
    path = f"{base}/t"
    write_partitions(dated(spark).limit(0), path, KEYS)
    write_partitions(dated(spark, ("a", "2024-01-01")), path, KEYS)
    assert read_table(spark, path).count() == 1


@pytest.mark.parametrize("dtype", ["string", "date"])
def test_partition_type_is_as_asked(spark, base, dtype):
    write_partitions(dated(spark, ("a", "2024-01-01")), f"{base}/t", KEYS)
    df = read_table(spark, f"{base}/t", partition_types={"processing_date": dtype})
    assert dict(df.dtypes)["processing_date"] == dtype


def test_schema_drift_is_refused(spark, base):
    path = f"{base}/t"
    df = dated(spark, ("a", "2024-01-01"))
    write_partitions(df, path, KEYS)
    with pytest.raises(SchemaDriftError, match="extra"):
        write_partitions(df.withColumn("extra", F.lit(1)), path, KEYS)
    with pytest.raises(SchemaDriftError, match="v"):
        write_partitions(df.withColumn("v", F.lit(1)), path, KEYS)
    with pytest.raises(SchemaDriftError, match="v"):
        write_partitions(df.drop("v").withColumn("w", F.lit("x")), path, KEYS)
    assert read_table(spark, path).columns == ["v", "processing_date"]


def test_full_overwrite_leaves_nothing(spark, base):
    overwrite_table(spark.range(10), f"{base}/t")
    overwrite_table(spark.range(2).selectExpr("id as other"), f"{base}/t")
    assert rows(read_table(spark, f"{base}/t")) == [(0,), (1,)]


def test_other_formats(spark, base):
    overwrite_table(spark.range(3), f"{base}/o", fmt="orc")
    assert read_table(spark, f"{base}/o", fmt="orc").count() == 3


def test_table_exists(spark, base):
    assert not table_exists(spark, f"{base}/absent")
    (Path(base) / "empty").mkdir()
    assert not table_exists(spark, f"{base}/empty")
    overwrite_table(spark.range(1), f"{base}/t")
    assert table_exists(spark, f"{base}/t")
    assert table_exists(spark, f"file://{base}/t")


def test_json_report_is_one_file(spark, base):
    write_json(spark.range(0, 3, 1, 3), f"{base}/j")
    write_json(spark.sql("select 'São' as city, named_struct('a', 1) as s"), f"{base}/j")
    files = list(Path(base, "j").glob("*.json"))
    assert [f.read_text(encoding="utf-8") for f in files] == ['{"city":"São","s":{"a":1}}\n']


def test_layout():
    layout = Layout("s3a://bucket/lake/")
    assert layout.landing("2024-02-01") == (
        "s3a://bucket/lake/landing/transactions/ingest_date=2024-02-01"
    )
    assert layout.raw == "s3a://bucket/lake/raw/transactions"


@pytest.mark.parametrize("other", ["region,amount\nEUROPE,2\n", "amount,region,x\n2,EUROPE,y\n", "amount\n2\n"])
def test_files_with_different_headers_are_refused(spark, base, other):
    folder = Path(base) / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("amount,region\n1,ASIA\n1,ASIA\n")
    (folder / "b.csv").write_text(other)
    with pytest.raises(Exception, match="header"):
        read_csv_strings(spark, str(folder)).collect()
