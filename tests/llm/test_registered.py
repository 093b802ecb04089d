"""Registered training-data queries: SQL where there is one, schema and stability for the rest."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from staykit.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL

CONTRACT = {
    "op1_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op2_simhash": "doc_id fingerprint component_id",
    "op3_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op5_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op7_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op8_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9_html_text": "page_id url text n_chars",
    "op10_toxicity": "doc_id held_out score predicted",
    "op11_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op12_lexical": "item_id rank doc_id score",
    "op13_periodic": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


def test_every_operator_is_registered_once():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(CONTRACT))
def test_columns_and_row_counts(spark, key):
    out = QUERIES[key](spark, SF_SMALL)
    assert out.columns[:len(CONTRACT[key].split())] == CONTRACT[key].split()
    whole = "pages" if key == "op9_html_text" else "documents"
    if key not in ("op7_packing", "op12_lexical"):
        assert out.count() == spark.read.parquet(f"{SF_SMALL}/{whole}.parquet").count()


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_duckdb(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(ORACLE[key])
    names = [d[0] for d in cur.description]
    want = sorted(map(str, cur.fetchall()))
    assert sorted(map(str, (tuple(r) for r in QUERIES[key](spark, SF_SMALL).select(*names).collect()))) == want


CLASHES = ("batch cell key size shard slot fp mark root of row cut clean all base score toxic kept label_id n_docs "
           "sequence_id piece group law kind data bucket digest file salt rank item start runs collapsed words").split()


@pytest.mark.parametrize("key", [k for k in sorted(QUERIES) if k != "op9_html_text"])
def test_extra_columns_with_clashing_names_change_nothing(spark, tmp_dir, key):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 60")
    for home, frame in (("plain", docs), ("more", docs.withColumns({c: F.lit(f"x{c}") for c in CLASHES}))):
        frame.write.parquet(f"{tmp_dir}/{home}/documents.parquet")
        for t in ("labels", "benchmark"):
            spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{tmp_dir}/{home}/{t}.parquet")
    plain, more = (QUERIES[key](spark, f"{tmp_dir}/{home}") for home in ("plain", "more"))
    assert plain.columns == more.columns
    keep = [c for c in plain.columns if c not in ("sequence_id", "offset")]
    assert sorted(map(str, plain.select(*keep).collect())) == sorted(map(str, more.select(*keep).collect()))


@pytest.mark.parametrize("stage", ["simhash", "decontamination", "pii", "toxicity"])
def test_stages_keep_clashing_columns(spark, tmp_dir, stage):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [c for c in CLASHES if c != "score"]
    got = dict(corpus_pipeline.STAGES)[stage](spark, docs.withColumns({c: F.lit(f"x{c}") for c in names}), SF_SMALL)
    assert got.select(*names).distinct().collect() == [tuple(f"x{c}" for c in names)]
