"""What several operators share: written tables, a bounded sieve, and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavid.session import shared_folder

# One bitmap row of Spark's bitmap functions covers this many positions.
BITMAP_ROW = 32768
# Bytes of rows that a Python worker is handed at a time, and the setting that bounds them.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``; a local one only where that is unset."""
    fallback = None
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.conf.get("spark.master", "local").startswith("local["):
            shared_folder(spark)  # a cluster without a shared folder is an error
        fallback = tempfile.gettempdir()
    return f"{shared_folder(spark, fallback)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    This cuts the lineage: a lost executor costs its own tasks and not the steps before.
    """
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on hands rows to Python about BATCH_BYTES at a time; a longer row goes alone.

    Spark's own bound of 10,000 rows or 64 MB makes a whole input split of texts one batch, which an executor holds
    several times, in Spark's buffers and in each worker, and a worker keeps what it once took. A
    session's own limit stays.
    """
    if df.sparkSession.conf.get(BATCH_SETTING, None) is None:
        df.sparkSession.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df


def sieve(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Bitmap over the hashed keys: at most 2**bits positions, so at most 2**(bits-3) bytes.

    The size is bounded by ``bits`` whatever the number of keys, so it may be broadcast.
    With more keys it lets more strangers through, never fewer members.
    """
    spot = _spot(F.col(key), bits)
    return keys.groupBy(F.bitmap_bucket_number(spot).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("_bits")
    )


def sifted(df: DataFrame, key: str, bitmap: DataFrame, bits: int, keep: bool = True) -> DataFrame:
    """Rows of ``df`` whose key may be in the sieve: every member, and a few strangers.

    With ``keep=False`` the other rows: only such as are certainly no members.
    """
    spot = _spot(F.col(key), bits)
    at = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (at % 8).cast("int") + 1)
    member = F.coalesce(byte, F.lit(0)).bitwiseAND(mask) != 0
    return (
        df.withColumn("_bucket", F.bitmap_bucket_number(spot))
        .join(F.broadcast(bitmap), "_bucket", "left")
        .where(member if keep else ~member)
        .drop("_bucket", "_bits")
    )


def _spot(key: Column, bits: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def components(edges: DataFrame, tag: str) -> DataFrame:
    """Smallest id reachable over undirected ``edges`` (a, b): one row (id, root) per id, of any type with an order.

    Each round links every node's larger neighbours to the least of its neighbourhood, then its
    smaller ones, which joins a chain in about log n rounds. It ends when every node hangs directly
    on one root. Every round is a written table; only whether one is left over reaches the driver.
    Hot hubs: the least neighbour is pre-aggregated, and the join reads two written tables, so
    AQE splits a hot key.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), tag
    )
    while True:
        ends = links.select(F.col("a").alias("id"), F.col("b").alias("up"), F.lit(False).alias("hub")).unionByName(
            links.select(F.col("b").alias("id"), F.lit(None).cast(links.schema["b"].dataType).alias("up"), F.lit(True).alias("hub"))
        )
        nodes = stored(
            ends.groupBy("id").agg(F.min("up").alias("root"), F.max("up").alias("other"), F.max("hub").alias("hub")), tag
        )
        if nodes.where("root <> other OR (root IS NOT NULL AND hub)").isEmpty():
            return nodes.select("id", F.coalesce("root", "id").alias("root"))
        links = stored(_star(stored(_star(links, tag, both=True), tag), tag, both=False).distinct(), tag)


def _star(links: DataFrame, tag: str, both: bool) -> DataFrame:
    """One half round: larger (``both``) or smaller neighbours are linked to the least neighbour."""
    around = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        around = around.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = stored(around.groupBy("u").agg(F.min("v").alias("m")), tag).select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    linked = joined.where("v > u") if both else joined
    new = linked.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not both:
        new = new.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return new.where("a <> b")
