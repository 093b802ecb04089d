"""Contracts: definitions, JSON round trip, metadata, diff, report."""

import json

from pyspark.sql.types import StructType

from staykit.plans import contracts as C


def test_field_counts():
    assert len(C.LISTING_CONTRACT.fields) == 74
    assert len(C.CALENDAR_CONTRACT.fields) == 6
    assert len(C.AGG_LISTING_CONTRACT.fields) == 17
    assert all(f.nullable for f in C.LISTING_CONTRACT.fields)


def test_json_round_trip_is_identity(spark, tmp_dir):
    for name, contract in C.CONTRACTS.items():
        path = C.save_contract(spark, contract, f"{tmp_dir}/{name}.json")
        assert C.load_contract(spark, path) == contract
        assert StructType.fromJson(json.loads(contract.json())) == contract


def test_save_overwrites(spark, tmp_dir):
    path = f"{tmp_dir}/c.json"
    C.save_contract(spark, C.CALENDAR_CONTRACT, path)
    C.save_contract(spark, C.AGG_LISTING_CONTRACT, path)
    assert C.load_contract(spark, path) == C.AGG_LISTING_CONTRACT


def test_metadata_fields_do_not_mutate():
    before = C.CALENDAR_CONTRACT.json()
    full = C.with_metadata_fields(C.CALENDAR_CONTRACT)
    assert C.CALENDAR_CONTRACT.json() == before
    assert full.fieldNames()[-2:] == ["processing_datetime", "area"]


def test_apply_contract_by_name(spark):
    df = spark.createDataFrame([("3", "x", "2024-01-01")], "minimum_nights string, extra string, date string")
    out = C.apply_contract(df, C.CALENDAR_CONTRACT)
    assert out.schema == C.CALENDAR_CONTRACT
    r = out.first()
    assert (r.date, r.minimum_nights, r.price) == ("2024-01-01", 3, None)


def test_contract_diff(spark):
    df = spark.createDataFrame([("x", "1", 2), ("y", "$3", 4)], "name string, price string, other long")
    got = {r.column_name: (r.status, r.bad_values) for r in C.contract_diff(df, C.AGG_LISTING_CONTRACT).collect()}
    assert got["name"] == ("match", 0)
    assert got["price"] == ("type_mismatch", 1)
    assert got["host_id"] == ("missing", None)
    assert got["other"] == ("extra", None)


def test_schema_report(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, "a", 1.0)], "a long, b string, c double")
    got = [tuple(r) for r in C.schema_report(df).collect()]
    assert got == [("a", "bigint", 1, 2), ("b", "string", 2, 1), ("c", "double", 3, 1)]
