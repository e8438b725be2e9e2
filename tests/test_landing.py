from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lamina.sources import catalogue, files, jdbc, layout
from lamina.sources.commitlog import Commit, CommitLog, decode_watermark, encode_watermark
from lamina.sources.landing import (
    Source, compact, current_view, delta_since, land_all, land_table, read_dataset, read_source,
)
from lamina.streaming.landing import land_new_files

PARTNERS = "CardCode string, CardName string, CardType string, Phone1 string, UpdateDate date"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def partners(spark, *rows):
    return spark.createDataFrame([(c, n, "C", "555", d) for c, n, d in rows], PARTNERS)


# ---------------------------------------------------------------- paths and files


def test_paths():
    assert layout.layer_path("/lake/", "bronze", "erp", "OINV") == "/lake/bronze/erp/OINV"
    named = layout.layer_path("/lake", "gold", "metrics", "x", "{stage}/{source}/{table}.parquet")
    assert named == "/lake/gold/metrics/x"
    assert layout.raw_table_path("abfss://raw/sap/", "OCRD") == "abfss://raw/sap/ocrd/OCRD.parquet"
    assert layout.raw_table_path("/b", "OINV", "dt=*/x.parquet") == "/b/oinv/dt=*/x.parquet"
    assert layout.raw_table_path("/b", "OINV", "s3://other/p.parquet") == "s3://other/p.parquet"


def test_raw_layouts(spark, folder):
    df = spark.range(6).withColumn("dt", F.expr("date'2024-01-15' + cast(id % 2 as int)"))
    df.write.partitionBy("dt").parquet(f"{folder}/ocrd")
    df.drop("dt").write.parquet(f"{folder}/flat/data.parquet")
    df.drop("dt").write.parquet(f"{folder}/deep/a/b")
    root = files.read_raw(spark, f"{folder}/ocrd")
    assert dict(root.dtypes)["dt"] == "date" and root.count() == 6
    glob = files.read_raw(spark, f"{folder}/ocrd/dt=2024-01-15/*.parquet")
    assert glob.count() == 3 and "dt" in files.read_raw(spark, f"{folder}/ocrd/dt=*").columns
    assert files.read_raw(spark, f"{folder}/flat/data.parquet").count() == 6
    assert files.read_raw(spark, f"{folder}/deep/**/*.parquet").count() == 6
    pruned = root.filter(F.col("dt") == F.lit(date(2024, 1, 15)))
    assert "PartitionFilters: [isnotnull(dt" in pruned._jdf.queryExecution().executedPlan().toString()


def test_delimited_and_any(spark, folder):
    for name, sep in (("a.csv", ","), ("b.tsv", "\t")):
        with open(f"{folder}/{name}", "w") as out:
            out.write(sep.join(["id", "amount", "day"]) + "\n" + sep.join(["1", "2.5", "2024-01-02"]) + "\n")
        df = files.read_any(spark, f"{folder}/{name}")
        assert df.dtypes == [("id", "int"), ("amount", "double"), ("day", "date")]
    assert files.read_any(spark, query="SELECT 1 AS x").first()["x"] == 1
    with pytest.raises(ValueError, match="Unsupported file format"):
        files.read_any(spark, "x.xlsx")
    with pytest.raises(ValueError):
        files.read_any(spark)


def test_read_layer_registers_view(spark, folder):
    spark.range(3).write.parquet(f"{folder}/t")
    files.read_layer(spark, f"{folder}/t", "three_rows")
    assert spark.sql("SELECT count(*) FROM three_rows").first()[0] == 3


# ---------------------------------------------------------------- catalogue and JDBC


def test_catalogue():
    assert len(catalogue.STRATEGIES) == 16 and len(catalogue.MASKING) == 16
    assert catalogue.load_strategy("ocrd").delta_column == "UpdateDate"
    assert catalogue.load_strategy("JDT1").delta_column == "RefDate"
    assert catalogue.load_strategy("OITM").delta_column is None
    assert catalogue.load_strategy("nope") is None and catalogue.masking_rule("nope") is None
    assert catalogue.masking_rule("oinv").keep_all
    assert set(catalogue.due_tables("weekly")) == {"OITM", "OACT", "OCRG", "OITB", "OOCR"}
    assert catalogue.table_config("oitm") == {"name": "OITM"}


def test_jdbc_targets_and_options():
    ms = jdbc.sql_server_target(
        "Driver={ODBC Driver 18 for SQL Server};Server=tcp:srv.example.org,1444;Database=db;"
        "Uid=me;Pwd=a=b;Encrypt=yes;"
    )
    assert ms.url == "jdbc:sqlserver://srv.example.org:1444;databaseName=db;encrypt=true"
    assert (ms.user, ms.password) == ("me", "a=b")
    pg = jdbc.postgres_target("postgres://me:p%40w@host:5433/db?sslmode=require")
    assert pg.url == "jdbc:postgresql://host:5433/db?sslmode=require"
    assert (pg.user, pg.password) == ("me", "p@w")
    assert jdbc.postgres_target("host=h dbname=d user=u").url == "jdbc:postgresql://h:5432/d"
    plain = jdbc.read_options(pg, "SELECT 1")
    assert plain["query"] == "SELECT 1" and "dbtable" not in plain
    split = jdbc.read_options(pg, "SELECT * FROM t", "id", 1, 100, 8)
    assert split["dbtable"] == "(SELECT * FROM t) src" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc.read_options(pg, "q", "id")
    with pytest.raises(ValueError):
        jdbc.sql_server_target("Database=x")


def test_unknown_source_type(spark):
    with pytest.raises(ValueError, match="Unsupported source type"):
        read_source(spark, Source("x", "mainframe", {}), {"name": "t"})


# ---------------------------------------------------------------- watermarks


@pytest.mark.parametrize(
    "kind,value",
    [("date", "2024-02-03"), ("timestamp", "2024-02-03 04:05:06.789012"), ("bigint", "77"),
     ("timestamp_ntz", "2024-02-03 04:05:06.789012"), ("decimal(12,3)", "12.345"), ("string", "ab")],
)
def test_watermark_round_trip(spark, kind, value):
    df = spark.range(1).select(F.lit(value).cast(kind).alias("c"))
    text, type_name = encode_watermark(df.first()["c"], df.schema["c"].dataType)
    assert df.filter(F.col("c") == decode_watermark(text, type_name)).count() == 1
    assert delta_since(df, "c", (text, type_name)).count() == 0
    assert delta_since(df, "c", (text, type_name), inclusive=True).count() == 1


def test_delta_reaches_the_scan(spark, folder):
    df = partners(spark, ("1", "a", date(2024, 1, 1)))
    df.write.parquet(f"{folder}/t")
    plan = delta_since(spark.read.parquet(f"{folder}/t"), "UpdateDate", ("2024-01-01", "date"))
    assert "GreaterThan(UpdateDate,2024-01-01)" in plan._jdf.queryExecution().executedPlan().toString()


def test_incremental_landing(spark, folder):
    log = CommitLog(spark, f"{folder}/_commits")
    source = Source("erp", "sap_b1", {"source_storage_path": f"{folder}/raw"})
    table = {"name": "OCRD", "incremental_column": "UpdateDate"}
    first = partners(spark, ("1", "a", date(2024, 1, 1)), ("2", "b", date(2024, 1, 2)))
    done = land_table(spark, source, table, folder, log, first)
    assert (done.mode, done.watermark_value, done.rows_out) == ("full", "2024-01-02", 2)

    again = land_table(spark, source, table, folder, log, first)
    assert (again.mode, again.watermark_value, again.rows_out) == ("incremental", "2024-01-02", 0)

    later = first.union(partners(spark, ("1", "a2", date(2024, 1, 3)), ("3", "c", None)))
    third = land_table(spark, source, table, folder, log, later)
    assert (third.watermark_value, third.rows_out) == ("2024-01-03", 1)

    landed = read_dataset(spark, folder, log, "bronze", "erp", "OCRD")
    assert landed.columns == ["CardCode", "CardName_Hash", "CardType", "UpdateDate"]
    assert landed.count() == 3
    current = current_view(spark, folder, log, "erp", "OCRD", ["CardCode"], ["UpdateDate"])
    assert {(r["CardCode"], r["UpdateDate"]) for r in current.collect()} == {
        ("1", date(2024, 1, 3)), ("2", date(2024, 1, 2)),
    }
    assert log.watermarks().filter("dataset = 'OCRD'").first()["watermark_value"] == "2024-01-03"

    packed = compact(spark, folder, log, "erp", "OCRD", ["CardCode"], ["UpdateDate"])
    assert (packed.rows_out, packed.watermark_value) == (2, "2024-01-03")
    assert log.load_ids("bronze", "erp", "OCRD") == [packed.load_id]
    assert land_table(spark, source, table, folder, log, later).rows_out == 0
    assert read_dataset(spark, folder, log, "bronze", "erp", "OCRD").count() == 2

    log.reset("bronze", "erp", "OCRD")
    full = land_table(spark, source, table, folder, log, later)
    assert full.mode == "full" and full.rows_out == 4
    assert read_dataset(spark, folder, log, "bronze", "erp", "OCRD").count() == 4


def test_inclusive_takes_late_rows_of_the_same_day(spark, folder):
    log = CommitLog(spark, f"{folder}/_commits")
    source = Source("erp", "sap_b1", {"source_storage_path": "", "apply_gdpr": False})
    table = {"name": "OCRD", "incremental_column": "UpdateDate", "inclusive": True}
    day = date(2024, 1, 1)
    land_table(spark, source, table, folder, log, partners(spark, ("1", "a", day)))
    land_table(spark, source, table, folder, log, partners(spark, ("1", "a", day), ("2", "b", day)))
    current = current_view(spark, folder, log, "erp", "OCRD", ["CardCode"], ["UpdateDate"])
    assert current.count() == 2 and "CardName" in current.columns


def test_full_snapshots_replace_each_other(spark, folder):
    log = CommitLog(spark, f"{folder}/_commits")
    source = Source("erp", "sap_b1", {"source_storage_path": ""})
    for n in (5, 3):
        land_table(spark, source, {"name": "OITM"}, folder, log, spark.range(n))
    assert read_dataset(spark, folder, log, "bronze", "erp", "OITM").count() == 3


def test_unfinished_load_is_invisible_and_repeatable(spark, folder):
    log = CommitLog(spark, f"{folder}/_commits")
    source = Source("erp", "sap_b1", {"source_storage_path": ""})
    table = {"name": "OITM"}
    land_table(spark, source, table, folder, log, spark.range(5))
    # A load that wrote its files and died before its commit.
    spark.range(99).write.parquet(f"{folder}/bronze/erp/OITM/load_id=2")
    assert read_dataset(spark, folder, log, "bronze", "erp", "OITM").count() == 5
    land_table(spark, source, table, folder, log, spark.range(7))
    assert read_dataset(spark, folder, log, "bronze", "erp", "OITM").count() == 7


def test_land_all_from_raw_lake(spark, folder):
    raw = f"{folder}/raw"
    partners(spark, ("1", "a", date(2024, 1, 1))).write.parquet(f"{raw}/ocrd/dt=2024-01-15")
    spark.range(2).withColumnRenamed("id", "DocEntry").write.parquet(f"{raw}/oinv/OINV.parquet")
    source = Source.from_config(
        {"name": "erp", "type": "sap_b1", "connection": {"source_storage_path": raw},
         "tables": [{"name": "OCRD", "incremental_column": "UpdateDate",
                     "source_file_pattern": "dt=*/*.parquet"}, {"name": "OINV"}]}
    )
    log = CommitLog(spark, f"{folder}/_commits")
    done = land_all(spark, [source], folder, log)
    assert [(c.dataset, c.rows_out) for c in done] == [("OCRD", 1), ("OINV", 2)]
    landed = read_dataset(spark, folder, log, "bronze", "erp", "OCRD")
    # The masking rule keeps listed columns only, so the folder column and the phone are gone.
    assert landed.columns == ["CardCode", "CardName_Hash", "CardType", "UpdateDate"]


def test_tables_of_a_source_have_their_own_watermark(spark, folder):
    log = CommitLog(spark, f"{folder}/_commits")
    log.append(Commit("bronze", "s", "a", 1, "full", "u", "2024-01-01", "date"))
    log.append(Commit("bronze", "s", "b", 1, "full", "u", "2023-01-01", "date"))
    assert log.latest("bronze", "s", "a")["watermark_value"] == "2024-01-01"
    assert log.latest("bronze", "s", "b")["watermark_value"] == "2023-01-01"
    assert log.latest("bronze", "s", "c") is None
    with pytest.raises(FileNotFoundError):
        read_dataset(spark, folder, log, "bronze", "s", "c")


# ---------------------------------------------------------------- stream form


def test_stream_lands_each_file_once(spark, folder):
    source, state = f"{folder}/in", f"{folder}/state"
    schema, log = spark.range(1).schema, CommitLog(spark, f"{folder}/_commits")

    def land():
        return land_new_files(spark, source, schema, folder, "app", "t", state, log)

    spark.range(5).coalesce(1).write.parquet(source)
    assert land() == 1
    assert land() == 0
    spark.range(5, 8).coalesce(1).write.mode("append").parquet(source)
    assert land() == 1
    landed = read_dataset(spark, folder, log, "bronze", "app", "t")
    assert rows_of(landed.select("id")) == [(i,) for i in range(8)]
    assert [r["rows_out"] for r in log.commits("bronze", "app", "t")] == [5, 3]


def test_timestamps_keep_microseconds(spark, folder):
    log = CommitLog(spark, f"{folder}/_commits")
    source = Source("s", "sap_b1", {"source_storage_path": ""})
    table = {"name": "T", "incremental_column": "u"}
    stamp = datetime(2024, 1, 1, 12, 0, 0, 123456)
    df = spark.createDataFrame([(1, stamp)], "id int, u timestamp")
    land_table(spark, source, table, folder, log, df)
    assert land_table(spark, source, table, folder, log, df).rows_out == 0
