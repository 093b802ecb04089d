"""CSV by contract, GeoJSON, sinks, and incremental ingest."""

import json
import os

import pytest
from pyspark.sql import functions as F

from staykit.plans import contracts as C
from staykit.plans import sinks
from staykit.plans.ingest import ingest_feed, rejects_table
from staykit.sources.csv import ContractViolation, read_csv_contract, write_csv
from staykit.sources.geojson import features_from_docs, read_geojson, rejected_docs
from staykit.streaming.ingest import stream_ingest_once

HAND_CSV = (
    'listing_id,date,available,price,adjusted_price,minimum_nights,maximum_nights\n'
    '7,2024-01-01,t,"$1,000.00",$900.00,2,NA\n'
    '8,2024-01-02,"f","line one\nline ""two""",N/A,,30\n'
)


def hand_file(tmp_dir):
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    with open(f"{tmp_dir}/in/cal.csv", "w") as fh:
        fh.write(HAND_CSV)
    return f"{tmp_dir}/in"


def test_embedded_newline_doubled_quote_and_tokens(spark, tmp_dir):
    df = read_csv_contract(spark, hand_file(tmp_dir), C.CALENDAR_CONTRACT, key="listing_id")
    rows = {r.listing_id: r for r in df.collect()}
    assert df.columns == ["listing_id"] + C.CALENDAR_CONTRACT.fieldNames()
    assert rows[7].price == "$1,000.00" and rows[7].maximum_nights is None
    assert rows[8].price == 'line one\nline "two"'
    assert rows[8].adjusted_price is None and rows[8].minimum_nights is None
    assert rows[8].maximum_nights == 30


def test_drop_key_matches_contract(spark, tmp_dir):
    df = read_csv_contract(spark, hand_file(tmp_dir), C.CALENDAR_CONTRACT, key="listing_id", drop_key=True)
    assert df.schema == C.CALENDAR_CONTRACT


def test_csv_round_trip_keeps_text(spark, tmp_dir):
    src = spark.createDataFrame([(1, '["a", "b, c", "55\\" TV"]', " padded ", 1.5)],
                                "id long, amenities string, name string, latitude double")
    path = write_csv(src, f"{tmp_dir}/rt")
    back = read_csv_contract(spark, path, C.LISTING_CONTRACT, key="id", missing="allow").first()
    assert back.amenities == '["a", "b, c", "55\\" TV"]'
    assert back.name == " padded " and back.latitude == 1.5 and back.id == 1


def test_geojson_missing_keys_give_null(spark, tmp_dir):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[1, 2]]]},
         "properties": {"neighbourhood": "A"}},
        {"type": "Feature", "properties": {"neighbourhood": "B", "neighbourhood_group": "G"}},
    ]}
    os.makedirs(f"{tmp_dir}/g", exist_ok=True)
    with open(f"{tmp_dir}/g/n.geojson", "w") as fh:
        json.dump(doc, fh, indent=2)
    rows = sorted(tuple(r) for r in read_geojson(spark, f"{tmp_dir}/g").collect())
    assert rows == [("A", None, "Polygon", "Feature"), ("B", "G", None, "Feature")]
    docs = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    assert sorted(tuple(r) for r in features_from_docs(docs).collect()) == rows


def test_append_twice_doubles_overwrite_twice_does_not(spark, tmp_dir):
    path = hand_file(tmp_dir)
    table = "t_append_" + os.path.basename(tmp_dir).replace("-", "_")
    for _ in range(2):
        t = ingest_feed(spark, path, C.CALENDAR_CONTRACT, table, "Athens", "2024-01-01 00:00:00", key="listing_id",
                        location=f"{tmp_dir}/tables/{table}")
    assert t.count() == 4
    assert t.schema == C.with_metadata_fields(C.CALENDAR_CONTRACT)
    assert {r.area for r in t.collect()} == {"Athens"}
    name = "t_over_" + os.path.basename(tmp_dir).replace("-", "_")
    frame = spark.range(3)
    sinks.overwrite_table(frame, name, f"{tmp_dir}/tables/{name}")
    sinks.overwrite_table(frame, name, f"{tmp_dir}/tables/{name}")
    assert spark.read.table(name).count() == 3
    # the new rows may come from the table being replaced
    sinks.overwrite_table(spark.read.table(name).withColumn("twice", F.col("id") * 2), name,
                          f"{tmp_dir}/tables/{name}")
    assert sorted(r.twice for r in spark.read.table(name).collect()) == [0, 2, 4]
    sinks.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_append_by_name_rejects_extra_columns(spark, tmp_dir):
    name = "t_extra_" + os.path.basename(tmp_dir).replace("-", "_")
    sinks.create_table_if_missing(spark, name, C.CALENDAR_CONTRACT, f"{tmp_dir}/tables/{name}")
    sinks.create_table_if_missing(spark, name, C.CALENDAR_CONTRACT, f"{tmp_dir}/tables/{name}")
    ok = spark.createDataFrame([(5, "2024-01-01")], "minimum_nights long, date string")
    sinks.append_by_name(ok, name)
    r = spark.read.table(name).first()
    assert (r.date, r.minimum_nights, r.price) == ("2024-01-01", 5, None)
    bad = ok.withColumn("nope", F.lit(1))
    try:
        sinks.append_by_name(bad, name)
        raise AssertionError("extra column accepted")
    except ValueError:
        pass


def test_stream_ingest_is_incremental(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    os.makedirs(land)
    header = ",".join(C.CALENDAR_CONTRACT.fieldNames())
    for i in range(2):
        with open(f"{land}/f{i}.csv", "w") as fh:
            fh.write(f"{header}\n2024-01-0{i + 1},t,$1.00,$1.00,{i},9\n")
    out = f"{tmp_dir}/stream"
    got = stream_ingest_once(spark, land, C.CALENDAR_CONTRACT, out + "/t", out + "/ck", "Athens",
                             "2024-01-01 00:00:00")
    assert got.count() == 2
    with open(f"{land}/f2.csv", "w") as fh:
        fh.write(f"{header}\n2024-01-03,f,NA,$1.00,2,9\n")
    got = stream_ingest_once(spark, land, C.CALENDAR_CONTRACT, out + "/t", out + "/ck", "Athens",
                             "2024-01-01 00:00:00")
    assert got.count() == 3                      # each file once across runs
    assert got.filter(F.col("price").isNull()).count() == 1


def test_columns_matched_by_name_not_position(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/o")
    with open(f"{tmp_dir}/o/a.csv", "w") as fh:
        fh.write("maximum_nights,date,extra\n9,2024-05-01,x\n")
    df = read_csv_contract(spark, f"{tmp_dir}/o", C.CALENDAR_CONTRACT, extra=["extra"], missing="allow")
    r = df.first()
    assert df.columns == C.CALENDAR_CONTRACT.fieldNames()
    assert (r.date, r.maximum_nights, r.available) == ("2024-05-01", 9, None)


def test_header_mismatch_between_files_is_an_error(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/m")
    with open(f"{tmp_dir}/m/a.csv", "w") as fh:
        fh.write("date,available\n2024-01-01,t\n")
    with open(f"{tmp_dir}/m/b.csv", "w") as fh:
        fh.write("available,date\nt,2024-01-02\n")
    df = read_csv_contract(spark, f"{tmp_dir}/m", C.CALENDAR_CONTRACT, missing="allow")
    try:
        df.collect()
        raise AssertionError("a file with another column order was read positionally")
    except AssertionError:
        raise
    except Exception as e:  # noqa: BLE001
        assert "header" in str(e).lower() or "schema" in str(e).lower()


def dirty_file(tmp_dir):
    os.makedirs(f"{tmp_dir}/d")
    with open(f"{tmp_dir}/d/a.csv", "w") as fh:
        fh.write("date,available,price,adjusted_price,minimum_nights,maximum_nights,new_col\n"
                 "2024-01-01,t,$1.00,$1.00,3.0,9,KEEPME\n2024-01-02,f,$2.00,$2.00,2.5,abc,KEEPME\n")
    return f"{tmp_dir}/d"


def test_ingest_refuses_a_feed_that_breaks_its_contract(spark, tmp_dir):
    table = "t_refused_" + os.path.basename(tmp_dir).replace("-", "_")
    with pytest.raises(ContractViolation) as e:
        ingest_feed(spark, dirty_file(tmp_dir), C.CALENDAR_CONTRACT, table, "Athens", location=f"{tmp_dir}/tables/{table}")
    assert (e.value.extra, e.value.missing) == (["new_col"], [])
    assert not spark.catalog.tableExists(table)


def test_ingest_keeps_rejected_rows_whole_with_reasons(spark, tmp_dir):
    table = "t_rejects_" + os.path.basename(tmp_dir).replace("-", "_")
    t = ingest_feed(spark, dirty_file(tmp_dir), C.CALENDAR_CONTRACT, table, "Athens", "2024-01-01 00:00:00",
                    location=f"{tmp_dir}/tables/{table}", extra=["new_col"])
    assert [(r.date, r.minimum_nights, r.maximum_nights) for r in t.collect()] == [("2024-01-01", 3, 9)]
    bad = spark.read.table(rejects_table(table)).collect()
    assert [r.reasons for r in bad] == ["minimum_nights_not_bigint;maximum_nights_not_bigint"]
    assert json.loads(bad[0].raw)["new_col"] == "KEEPME" and json.loads(bad[0].raw)["maximum_nights"] == "abc"


def test_stream_reads_quoted_newlines_as_the_batch_does(spark, tmp_dir):
    land = f"{tmp_dir}/nl"
    os.makedirs(land)
    with open(f"{land}/a.csv", "w") as fh:
        fh.write(",".join(C.CALENDAR_CONTRACT.fieldNames()) + '\n2024-01-01,"a\nb",$1.00,$1.00,1,9\n')
    out = f"{tmp_dir}/nls"
    got = stream_ingest_once(spark, land, C.CALENDAR_CONTRACT, out + "/t", out + "/ck", "Athens", "2024-01-01 00:00:00")
    batch = read_csv_contract(spark, land, C.CALENDAR_CONTRACT)
    assert [tuple(r) for r in got.select(*batch.columns).collect()] == [tuple(r) for r in batch.collect()]
    assert got.first().available == "a\nb"


def test_geojson_rejects_and_fail_fast(spark):
    docs = spark.createDataFrame([('{"type":"FeatureCollection","features":[]}',), ("{broken",), (None,), ('{"type":"X"}',), ("[1]",)], "doc string")
    assert features_from_docs(docs).collect() == []
    assert len(rejected_docs(docs).collect()) == 4
    with pytest.raises(Exception, match="rejected"):
        features_from_docs(docs, on_error="fail").collect()


def test_overwrite_that_fails_leaves_the_old_table(spark, tmp_dir):
    name = "t_fail_" + os.path.basename(tmp_dir).replace("-", "_")
    loc = f"{tmp_dir}/tables/{name}"
    sinks.overwrite_table(spark.range(3), name, loc)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.overwrite_table(broken, name, loc)
    assert spark.read.table(name).count() == 3
    sinks.overwrite_table(spark.range(5), name, loc)
    sinks.overwrite_table(spark.range(6).withColumn("more", F.lit(1)), name, loc)
    assert spark.read.table(name).count() == 6
    assert len(sinks.vacuum_versions(spark, name, keep=0)) >= 2
    assert spark.read.table(name).count() == 6


def test_overwrite_refuses_a_managed_table(spark, tmp_dir):
    name = "t_managed_" + os.path.basename(tmp_dir).replace("-", "_")
    spark.range(2).write.saveAsTable(name)
    with pytest.raises(ValueError, match="managed"):
        sinks.overwrite_table(spark.range(3), name, f"{tmp_dir}/tables/{name}")
    assert spark.read.table(name).count() == 2
    sinks.drop_table(spark, name)


def test_a_load_that_failed_midway_is_run_again_without_loss_or_double(spark, tmp_dir, monkeypatch):
    from staykit.plans import ingest

    table = "t_retry_" + os.path.basename(tmp_dir).replace("-", "_")
    path, where = dirty_file(tmp_dir), f"{tmp_dir}/tables/{table}"
    load = dict(contract=C.CALENDAR_CONTRACT, table=table, area="Athens", now="2024-01-01 00:00:00", location=where, extra=["new_col"])
    ingest_feed(spark, path, load_id="a", **load)
    whole = ingest.replace_partitions

    def crash(df, name, partition):
        if name == table:
            raise RuntimeError("lost")
        whole(df, name, partition)

    monkeypatch.setattr(ingest, "replace_partitions", crash)
    with pytest.raises(RuntimeError):
        ingest_feed(spark, path, load_id="b", **load)               # its rejects are written, its rows are not
    assert spark.read.table(rejects_table(table)).count() == 2 and spark.read.table(table).count() == 1
    monkeypatch.undo()
    for _ in range(2):
        t = ingest_feed(spark, path, load_id="b", **load)
        assert t.count() == 2 and t.columns == C.with_metadata_fields(C.CALENDAR_CONTRACT).fieldNames()
        assert sorted(r.load_id for r in spark.read.table(rejects_table(table)).collect()) == ["a", "b"]
    assert ingest_feed(spark, path, **load).count() == 3             # without an id a run is a load of its own


def test_stream_keeps_rejected_rows_whole_with_reasons(spark, tmp_dir):
    from staykit.streaming.ingest import rejected

    land, out = dirty_file(tmp_dir), f"{tmp_dir}/out"
    names = [*C.CALENDAR_CONTRACT.fieldNames(), "new_col"]
    args = (spark, land, C.CALENDAR_CONTRACT, out + "/t", out + "/ck", "Athens", "2024-01-01 00:00:00")
    good = stream_ingest_once(*args, header=names)
    assert [(r.date, r.minimum_nights, r.area) for r in good.collect()] == [("2024-01-01", 3, "Athens")]
    assert good.columns == C.with_metadata_fields(C.CALENDAR_CONTRACT).fieldNames()
    bad = rejected(spark, out + "/t").collect()
    assert [r.reasons for r in bad] == ["minimum_nights_not_bigint;maximum_nights_not_bigint"] and json.loads(bad[0].raw)["new_col"] == "KEEPME"
    with open(f"{land}/b.csv", "w") as fh:
        fh.write(",".join(names) + "\n2024-01-03,t,$1.00,$1.00,abc,9,x\n")
    assert stream_ingest_once(*args, header=names).count() == 1 and rejected(spark, out + "/t").count() == 2      # each row once, in one of the two
