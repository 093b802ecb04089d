"""Streaming exact dedup: brute force, weak digests, later files, restarts, edge cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from staykit.llm import exact_dedup as X
from tests.llm.conftest import DOCS

ROWS = [(3, "a  b"), (1, "a\tb"), (2, "a b "), (4, None), (5, ""), (6, " "), (7, "\n\t"), (8, "a b"), (9, "x" * 100_000), (10, "x" * 100_000),
        (10, "x" * 100_000), (None, "a b"), (None, "only"), (11, "a b"), (12, "A b")]


def weak(text):
    """Three digests for all texts."""
    return F.unhex(F.format_string("%02x", F.pmod(F.length(text), F.lit(3))))


def write(spark, path, rows, parts=3, mode="append", **more):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    df.withColumns({k: F.lit(v) for k, v in more.items()}).repartition(parts).write.mode(mode).parquet(path)
    return path


def plain(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    by = {}
    for i, t in norm:
        by.setdefault(t, []).append(i)
    out = []
    for t, ids in by.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        out += [(i, ids[0], len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.drop("file", "row").collect()), key=str)


@pytest.mark.parametrize("digest", [X.sha256, weak])
def test_equals_brute_force_also_where_digests_collide(spark, tmp_dir, digest):
    path = write(spark, f"{tmp_dir}/d", ROWS)
    assert got(X.dedup(spark, path, digest=digest)) == plain(ROWS)


def test_hits_are_checked_on_their_bytes(spark, tmp_dir):
    path = write(spark, f"{tmp_dir}/d", ROWS)
    rows = X.entries(spark.read.parquet(path), weak)
    X.remember(X.landing(spark, path, spark.read.parquet(path).schema), f"{tmp_dir}/h", weak)
    assert 1 <= X.differing(rows, X.groups(spark, f"{tmp_dir}/h")).count() <= 3
    strong = X.entries(spark.read.parquet(path))
    X.remember(X.landing(spark, path, spark.read.parquet(path).schema), f"{tmp_dir}/h2")
    assert X.differing(strong, X.groups(spark, f"{tmp_dir}/h2")).count() == 0


def test_later_files_meet_earlier_ones_and_the_state_is_kept(spark, tmp_dir):
    path = write(spark, f"{tmp_dir}/d", ROWS[:7])
    first = X.dedup(spark, path, home=f"{tmp_dir}/h")
    assert got(first) == plain(ROWS[:7])
    write(spark, path, ROWS[7:] + [(0, "a b")])                         # a smaller id for a known text comes later
    assert got(X.dedup(spark, path, home=f"{tmp_dir}/h", max_files=1)) == plain(ROWS + [(0, "a b")])
    sizes = X.groups(spark, f"{tmp_dir}/h").agg(F.sum("size")).first()[0]
    assert sizes == len(ROWS) + 1                                       # each file was taken once


def test_rows_that_stay_are_found_by_their_locators(spark, tmp_dir):
    path = write(spark, f"{tmp_dir}/d", [(1, "aaa"), (2, "bbb")], parts=1)
    schema = spark.read.parquet(path).schema
    X.remember(X.landing(spark, path, schema), f"{tmp_dir}/h", weak)
    old = {r.file for r in X.entries(spark.read.parquet(path), weak).select(F.element_at(F.split("file", "/"), -1).alias("file")).collect()}
    write(spark, path, [(3, "ccc")], parts=1)
    X.remember(X.landing(spark, path, schema), f"{tmp_dir}/h", weak)
    everything = X.entries(spark.read.parquet(path), weak)
    new = everything.where(~F.element_at(F.split("file", "/"), -1).isin(*old))
    known = X.groups(spark, f"{tmp_dir}/h")
    assert X.differing(new, known).count() == 0                         # alone, the new row differs from none
    assert X.differing(new, known, content=everything).count() == 1     # but it does from the row that stays


def test_a_text_of_most_rows_is_dealt_over_salts(spark, tmp_dir):
    rows = [(i, "same") for i in range(3000)] + [(9000 + i, f"own {i}") for i in range(500)]
    path = write(spark, f"{tmp_dir}/d", rows)
    assert got(X.dedup(spark, path)) == plain(rows)
    X.remember(X.landing(spark, path, spark.read.parquet(path).schema), f"{tmp_dir}/h")
    known = X.groups(spark, f"{tmp_dir}/h")
    dealt, groups = X._salted(X.entries(spark.read.parquet(path)), known)
    most = dealt.groupBy("digest", "salt").count().agg(F.max("count")).first()[0]
    assert most < 40 and groups.count() > 500 + 800


def test_empty_table_and_clashing_columns(spark, tmp_dir):
    assert got(X.dedup(spark, write(spark, f"{tmp_dir}/e", []))) == []
    path = write(spark, f"{tmp_dir}/c", ROWS, digest="x", file="y", row="z", salt="s", size="n", keep_id="k")
    assert got(X.dedup(spark, path)) == plain(ROWS)


def test_no_python_in_the_plan(spark, tmp_dir):
    out = X.dedup(spark, write(spark, f"{tmp_dir}/d", ROWS))
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_the_bitmap_lets_every_hit_through_and_few_others(spark):
    known = spark.range(20_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    rows = spark.range(60_000).select("id", F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    through = X._may_hit(rows, known)
    assert through.columns == ["id", "digest"]
    assert through.where("id < 20000").count() == 20_000 and through.where("id >= 20000").count() < 200
