"""Exact dedup: a stateful stream that remembers every text by its digest.

The landing folder is read by a Structured Streaming query. Its state, keyed
by the SHA-256 of the normalised text and kept on disk by the RocksDB state
store, never expires; an entry is a digest, the stable identifier of the row
that stays (smallest id), that row's content locator (file and row number in
it) and the number of rows seen. Texts are never state. The state is
checkpointed in the shared folder after every batch, so later files meet all
earlier ones, and a lost executor or a restart loses nothing.

A digest that is there already is a hit, and hits are checked on their full
bytes: the least and the greatest text of each digest are compared, a
grouped aggregate whose partial result leaves a task as one row a digest, so a
text copied by a third of all rows is no hot key. For files that came later
the rows that stay are found again by their locators and compared too. Rows
whose digests are equal but whose bytes are not (none with SHA-256, but the
digest is a parameter) are grouped by the text itself.

Only rows that may be hits send their texts: the digests of hits are a bitmap
of 2^26 bits (8 MB, whatever the corpus), broadcast, and a join on the digest
then decides. The state is about as large as the corpus has texts, so joins
with it are sort-merge joins at every size.

Digests that hold a thousandth of all rows or more, of which there are 1000 at
most, are broadcast and dealt over as many salts as thousandths, for joins
with rows. Everything is DataFrame functions and Spark's own streaming
source, state store and state reader.

Edge cases: null text is empty, and empty texts are equal; a null id is
greater than any other, ties go by locator, so exactly one row of equal ones
stays; white space only is one space, not empty; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import checkpoint_root, shared_path

_SPACE = r"[\x20\x09-\x0D]+"
#: Groups with a thousandth of all rows or more are dealt over salts.
SHARE = 1000
#: Bits of the bitmap that keeps most texts without a copy at home.
FILTER_BITS = 26
# Settings of the state store while the stream starts.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
_GROUPS = "digest binary, keep_id long, file string, row long, size long"


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _SPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def landing(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Parquet files under ``path`` (a file or a folder) as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # a pattern that only this path fits: the source then takes a single file as well
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def entries(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``doc_id, file, row, text (normalised), digest`` of rows read from files."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.row_index").alias("row"), normalised(F.col("text")).alias("text"))
    # never null, so that joins on it need no null filter, which would digest twice
    return rows.withColumn("digest", F.coalesce(digest(F.col("text")), F.lit(b"")))


def remember(stream: DataFrame, home: str, digest: Callable[[Column], Column] = sha256) -> None:
    """Take all files that have landed into the state under ``home``."""
    spark = stream.sparkSession
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    state = entries(stream, digest).groupBy("digest").agg(F.min(at).alias("keep"), F.count(F.lit(1)).alias("size"))
    before = {k: spark.conf.get(k, None) for k in STORE}
    try:
        for k, v in STORE.items():
            spark.conf.set(k, v)
        query = (state.writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{home}/state")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if query.exception() is not None:
        raise query.exception()


def groups(spark: SparkSession, home: str) -> DataFrame:
    """The state: ``digest, keep_id, file, row, size``, one row a digest."""
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{home}/state/commits")
    if not commits.getFileSystem(spark._jsc.hadoopConfiguration()).exists(commits):
        return spark.createDataFrame([], _GROUPS)                   # no file has landed yet
    state = spark.read.format("statestore").load(f"{home}/state")
    return state.select("key.digest", F.col("value.min.doc_id").alias("keep_id"), "value.min.file", "value.min.row",
                        F.col("value.count").alias("size"))


def _salted(rows: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``salt``: rows of large groups dealt over salts, their groups repeated."""
    total = known.agg(F.sum("size")).first()[0] or 0
    parts = F.ceil(F.col("size") * SHARE / F.lit(max(1, total))).cast("int")
    large = known.where(F.col("size") * SHARE >= max(total, 2 * SHARE)).select(F.col("digest").alias("_large"), parts.alias("_parts"))
    # at most SHARE rows: their sizes add up to the total at most
    dealt = rows.join(F.broadcast(large), F.col("digest") == F.col("_large"), "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("file", "row"), F.col("_parts").cast("long")).cast("int"), F.lit(0))).drop("_large", "_parts")
    copies = F.when(F.col("size") * SHARE >= max(total, 2 * SHARE), parts).otherwise(1)
    return dealt, known.withColumn("salt", F.explode(F.sequence(F.lit(0), copies - 1)))


def _may_hit(rows: DataFrame, many: DataFrame) -> DataFrame:
    """The rows whose digest's bit is set: all of ``many`` and few others."""
    def place(digest: str) -> Column:
        return F.pmod(F.xxhash64(digest), F.lit(1 << FILTER_BITS))

    bits = many.select(F.bitmap_bucket_number(place("digest")).alias("_bucket"), F.bitmap_bit_position(place("digest")).alias("_at")).groupBy(
        "_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    at = F.bitmap_bit_position(place("digest"))
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), F.pmod(at, F.lit(8)).cast("int") + 1)
    # 2^11 rows of 4 KB at most
    there = rows.join(F.broadcast(bits), F.bitmap_bucket_number(place("digest")) == F.col("_bucket"))
    return there.where(byte.bitwiseAND(bit) != 0).drop("_bucket", "_bits")


def differing(rows: DataFrame, known: DataFrame, content: DataFrame | None = None) -> DataFrame:
    """Digests of the ``rows`` whose texts are not all the same bytes.

    ``content``: where the rows that stay can be found by their locators, if
    they are not among ``rows`` themselves.
    """
    many = known.where("size > 1")
    if content is not None:
        places = many.select("file", "row")
        rows = rows.unionByName(content.join(places, ["file", "row"], "left_semi"))
    dealt, groups_ = _salted(_may_hit(rows.select("digest", "file", "row", "text"), many), known)
    hits = dealt.join(groups_.where("size > 1").select("digest", "salt").hint("merge"), ["digest", "salt"], "left_semi")
    ends = hits.groupBy("digest", "salt").agg(F.min("text").alias("a"), F.max("text").alias("b"))
    return ends.groupBy("digest").agg(F.min("a").alias("a"), F.max("b").alias("b")).where("a <> b").select("digest")


def classes(rows: DataFrame, known: DataFrame, unequal: DataFrame | None = None) -> DataFrame:
    """Per row ``doc_id, keep_id, group_size, kept, text_sha256, file, row``.

    ``unequal``: digests that stand for different texts; their rows are
    grouped by the text instead.
    """
    slim = rows.select("doc_id", "file", "row", "digest", F.sha2("text", 256).alias("text_sha256"))
    if unequal is not None:
        slim = slim.join(unequal, "digest", "left_anti")
    dealt, groups_ = _salted(slim, known)
    g = groups_.select("digest", "salt", "keep_id", F.col("file").alias("_file"), F.col("row").alias("_row"), "size")
    out = dealt.join(g.hint("merge"), ["digest", "salt"]).select(
        "doc_id", "keep_id", F.col("size").alias("group_size"), ((F.col("file") == F.col("_file")) & (F.col("row") == F.col("_row"))).alias("kept"),
        "text_sha256", "file", "row")
    if unequal is None:
        return out
    odd = rows.join(unequal, "digest", "left_semi")
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    by_text = odd.groupBy("text").agg(F.min(at).alias("k"), F.count(F.lit(1)).alias("group_size"))
    return out.unionByName(odd.join(by_text, "text").select(
        "doc_id", F.col("k.doc_id").alias("keep_id"), "group_size",
        ((F.col("file") == F.col("k.file")) & (F.col("row") == F.col("k.row"))).alias("kept"), F.sha2("text", 256).alias("text_sha256"), "file", "row"))


def dedup(spark: SparkSession, path: str, home: str | None = None, max_files: int | None = 10_000,
          digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Classes of all rows under ``path`` (see :func:`classes`).

    ``home`` is the state's folder; with the folder of an earlier call only
    files that are new are streamed, with none the state is a new one.
    """
    checkpoint_root(spark)
    home = home or shared_path(spark, "exact_dedup", unique=True)
    docs = spark.read.parquet(path)
    remember(landing(spark, path, docs.schema, max_files), home, digest)
    table = f"{home}/{shared_path(spark, 'groups', unique=True).rsplit('/', 1)[1]}"
    groups(spark, home).write.parquet(table)
    known, rows = spark.read.parquet(table), entries(docs, digest)
    differing(rows, known).write.parquet(f"{table}_unequal")
    unequal = spark.read.parquet(f"{table}_unequal")
    return classes(rows, known, None if unequal.isEmpty() else unequal)


ORACLE = """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
