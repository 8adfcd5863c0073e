"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewire.functions import protection, serialization
from tidewire.plans import cdc, queries
from tidewire.sources import changes

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(map(tuple, df[cols].astype(object).where(df[cols].notna(), None).astype(str).values.tolist()))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, duck, name):
    assert rows(queries.QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(queries.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_messages_are_packed_once(spark):
    events = spark.createDataFrame([("1", "inventory", "insert", "k", None, '{"product_id":"P1","warehouse_id":"W1","quantity":70000,"last_updated":"2024-01-01T00:00:00Z"}')], changes.SCHEMA)
    messages, _ = cdc.split(cdc.checked(events), queries.TOPICS, "msgpack")
    read = messages.select(serialization.parsed(F.col("value"), "msgpack", "data struct<fullDocument:struct<quantity:bigint>>").alias("m"), "attributes")
    assert read.first().m.data.fullDocument.quantity == 70000
    assert read._jdf.queryExecution().optimizedPlan().toString().count("json_to_msgpack(") == 1


def test_published_documents_are_made_once(spark):
    plan = queries.published_documents(spark, SF)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    walks = [line for line in plan if "ArrowEvalPython [taken(" in line or "ArrowEvalPython [put(" in line]
    assert walks and not any("StructsToJson" in line for line in walks)


def test_documents_are_walked_in_parts(spark):
    rows = spark.range(0, 3 * protection.WALKED - 1, 1, 1).select("id", F.format_string('{"ssn":"%d","n":%d}', "id", "id").alias("doc"))
    got = protection.Protector([protection.Rule("ssn", "hash")]).protected_documents(rows, "doc").withColumn("want", protection.hashed(F.col("id"), "ssn"))
    assert got.where((F.get_json_object("doc", "$.ssn") == F.col("want")) & (F.get_json_object("doc", "$.n") == F.col("id").cast("string"))).count() == rows.count()
