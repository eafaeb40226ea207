"""Readers and writers on small files."""

import datetime as dt
import gzip
import json

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from tidemark.operators import materialise as mat
from tidemark.sources import connector, files, schemas, tables


def gz(path, text):
    with gzip.open(path, "wt") as out:
        out.write(text)


def test_headerless_gzip_csv_by_position(spark, tmp_path):
    gz(tmp_path / "a.csv.gz", "1,2019-04-01 00:00:31,596,3156,57.16,31,0,0,0\n2,2019-04-01 00:02:10,4961,,81.5,130,0,1,1\n")
    df = files.read_headerless_csv(spark, str(tmp_path), schemas.TRANSACTIONS, partitions=3)
    assert dict(df.dtypes)["tx_datetime"] == "timestamp_ntz" and df.rdd.getNumPartitions() == 3
    got = df.orderBy("transaction_id").collect()
    assert got[0]["tx_datetime"] == dt.datetime(2019, 4, 1, 0, 0, 31) and got[0]["tx_amount"] == 57.16
    assert got[1]["terminal_id"] is None and got[1]["tx_fraud"] == 1


def test_bulk_load_takes_matching_files_and_skips_headers(spark, tmp_path):
    head = "any,names,at,all,here,are,skipped,x,y\n"
    (tmp_path / "sub").mkdir()
    gz(tmp_path / "trips-1.csv.gz", head + "300,2019-05-01 10:00:00,2019-05-01 10:05:00,1,2,77,Subscriber,1980,1\n")
    gz(tmp_path / "sub" / "trips-2.csv.gz", head + "60,2019-05-02 23:59:00,2019-05-03 00:00:00,3,4,78,Customer,,0\n")
    gz(tmp_path / "weather-1.csv.gz", head + "not,a,trip,1,1,1,x,1,1\n")
    df = files.load_directory(spark, str(tmp_path), schemas.TRIPS, "*trips*.csv.gz")
    assert [r["bikeid"] for r in df.orderBy("bikeid").collect()] == [77, 78]
    assert df.filter(F.col("birth_year").isNull()).count() == 1


def test_seed_becomes_a_view(spark, tmp_path):
    (tmp_path / "customers.csv").write_text("id,first_name,last_name,birthdate,membership_no\n1,ann,lee,1989-03-19,12\n")
    files.load_seed(spark, str(tmp_path / "customers.csv"), schemas.CUSTOMERS, view="seed_customers")
    assert tables.table(spark, "seed_customers").first()["birthdate"] == dt.date(1989, 3, 19)


def test_inferred_csv_keeps_the_word_none(spark, tmp_path):
    (tmp_path / "c.csv").write_text("ID,OTHER_PARTIES,BALANCE\n1,None,-728.12\n2,none,\n3,guarantor,4\n")
    df = files.read_inferred_csv(spark, str(tmp_path / "c.csv"), table="inferred_credit")
    assert [t for _, t in df.dtypes] == ["int", "string", "double"]
    assert [r["OTHER_PARTIES"] for r in df.orderBy("ID").collect()] == ["None", "none", "guarantor"]
    assert df.filter(F.col("BALANCE").isNull()).count() == 1
    mat.drop_table(spark, "inferred_credit")


def test_rows_frame_by_names_and_by_schema(spark):
    named = tables.rows_frame(spark, [(1, "a")], ["id", "name"])
    typed = tables.rows_frame(spark, [(1, "a")], "id int, name string")
    assert named.dtypes[0] == ("id", "bigint") and typed.dtypes[0] == ("id", "int")


def test_create_insert_select(spark):
    tables.create_table(spark, "stock", "item string, place string", replace=True)
    tables.insert_rows(spark, "stock", [("rope", "shed"), ("lamp", "hall"), ("bench", "yard")])
    got = tables.run_sql(spark, "SELECT item, place FROM stock").collect()
    assert len(got) == 3 and {("rope", "shed"), ("lamp", "hall")} <= {tuple(r) for r in got}
    tables.create_table(spark, "stock", "item string", replace=True)
    assert spark.table("stock").columns == ["item"] and spark.table("stock").count() == 0
    mat.drop_table(spark, "stock")
    mat.drop_table(spark, "stock")


def test_temporary_table(spark):
    tables.create_table(spark, "scratch_trips", schemas.TRIPS, temporary=True)
    assert spark.table("scratch_trips").count() == 0
    assert dict(spark.table("scratch_trips").dtypes)["starttime"] == "timestamp_ntz"


def test_sql_binds_are_values_not_text(spark):
    got = tables.run_sql(spark, "SELECT ? AS a, ? AS b", ["1); DROP", 2]).first()
    assert tuple(got) == ("1); DROP", 2)
    before = dt.datetime.now() - dt.timedelta(minutes=5)
    assert tables.run_sql(spark, "SELECT current_timestamp() AS t").first()["t"] > before


def pushed_rows():
    """A format that stands in for a store which answers queries itself."""

    class PushedRows(DataSource):
        @classmethod
        def name(cls):
            return "pushed_rows"

        def schema(self):
            return "id int, name string, status boolean, asked string"

        def reader(self, schema):
            asked = self.options["query"]

            class Reader(DataSourceReader):
                def read(self, partition):
                    yield 1, "rope", True, asked
                    yield 2, "lamp", False, asked

            return Reader()

    return PushedRows


def test_query_is_handed_to_the_source_and_copied(spark):
    spark.dataSource.register(pushed_rows())
    query = "SELECT * FROM src"
    df = connector.read_query(spark, "pushed_rows", {"url": "x"}, query)
    assert rows(df) == [(1, "rope", True, query), (2, "lamp", False, query)]
    assert rows(connector.copy_query(spark, "pushed_rows", {}, query, "copied_rows")) == rows(df)
    mat.drop_table(spark, "copied_rows")


def test_connector_options():
    assert connector.connector_options({"url": "u"}, "SELECT 1") == {"url": "u", "query": "SELECT 1"}
    split = connector.connector_options({}, "SELECT * FROM t", partition_column="id", bounds=(0, 100), partitions=8)
    assert split["dbtable"] == "(SELECT * FROM t) pushed" and split["numPartitions"] == "8" and "query" not in split
    with pytest.raises(ValueError):
        connector.connector_options({}, "q", partition_column="id")


def test_overwrite_table(spark):
    mat.overwrite_table(spark.range(5), "overwritten")
    assert mat.overwrite_table(spark.range(2), "overwritten").count() == 2
    mat.drop_table(spark, "overwritten")


def test_sorted_table_splits_one_hot_key_and_keeps_order(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"))
    stored = mat.write_sorted(df, "laid_out", "k", files=8)
    assert rows(stored) == rows(df)
    spread = stored.filter("k = 7").select(F.input_file_name()).distinct().count()
    ranges = stored.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a", "b").collect()
    assert spread > 1 and len(ranges) > 2
    assert all(x["b"] <= y["a"] for x, y in zip(ranges, ranges[1:]))
    mat.drop_table(spark, "laid_out")


def test_snapshot_does_not_follow_the_table(spark):
    mat.overwrite_table(spark.range(10), "origin")
    name, copy = mat.snapshot(spark, "origin", dt.datetime(2024, 5, 6, 7, 8, 9), where="id < 8")
    assert name == "origin_2024_05_06__07_08_09"
    mat.overwrite_table(spark.range(3), "origin")
    assert spark.table(name).count() == copy.count() == 8
    with pytest.raises(AnalysisException):
        mat.snapshot(spark, "origin", dt.datetime(2024, 5, 6, 7, 8, 9))
    mat.drop_table(spark, name)
    mat.drop_table(spark, "origin")


def test_csv_and_json_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, name string")
    mat.write_csv(df, str(tmp_path / "out"))
    back = spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["id", "name"] and rows(back) == rows(df)
    assert [json.loads(r[0]) for r in mat.json_rows(df).orderBy("value").collect()] == [{"id": 1, "name": "a,b"}, {"id": 2}]


def test_csv_keeps_microseconds(spark, tmp_path):
    at = dt.datetime(2024, 1, 6, 18, 24, 46, 525460)
    df = spark.createDataFrame([(at, at), (at.replace(microsecond=0), None)], "a timestamp_ntz, b timestamp")
    mat.write_csv(df, str(tmp_path / "out"), header=False, compression="gzip")
    assert rows(files.read_headerless_csv(spark, str(tmp_path / "out"), df.schema)) == rows(df)


def test_checkpoint_and_resume(spark, tmp_path):
    df = spark.range(4).select("id", (F.col("id") / 2).alias("half"), F.lit(dt.date(2024, 1, 1)).alias("day"))
    mat.checkpoint_frame(df, str(tmp_path / "point"))
    back = files.read_checkpoint(spark, str(tmp_path / "point"))
    assert back.dtypes == df.dtypes and rows(back) == rows(df)
    assert "Physical Plan" in spark.read.text(str(tmp_path / "point" / "plan"), wholetext=True).first()[0]


def test_cut_lineage_uses_the_shared_folder(spark):
    folder = mat.shared_folder(spark)
    assert folder == mat.shared_folder(spark) and folder == spark.conf.get("spark.checkpoint.dir", folder)
    out = mat.cut_lineage(spark.range(10).filter("id > 3"))
    assert out.count() == 6 and all(folder.removeprefix("file:") in f for f in out.inputFiles())


def test_schema_name():
    assert mat.schema_name(" analysis ", "public") == "analysis" and mat.schema_name(None, "public") == "public"


def test_actions(spark):
    df = spark.range(30)
    assert len(df.head(10)) == 10 and len(df.take(3)) == 3 and df.count() == 30 and len(df.toPandas()) == 30
