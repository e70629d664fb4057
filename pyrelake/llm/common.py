"""What the operators share: reading tables, cutting lineage, skew-safe joins, connected components."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest number of members of a bucket whose pairs are listed one by one; larger buckets take an exact way without pairs.
SMALL_BUCKET = 64
#: Rows of a few numbers up to which a table is broadcast; of those of a checkpoint, about how many a task reads.
FEW, A_TASK = 500_000, 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Has Python workers get 500 documents at a time unless the session says otherwise than Spark's 10,000, which can be very long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "500")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; only a local session without one gets a folder of its own."""
    sc = spark.sparkContext
    here = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not here:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        here = f"/tmp/checkpoints/run-{uuid.uuid4().hex}"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(here)
    return here


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared checkpoint folder: lost executors do not take it along.

    What was shuffled on the way is not needed once it is written, and is given back at once.
    """
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    checkpoint_dir(spark)
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # the setting is read where a DataFrame is made
    finally:
        spark.conf.set(key, before)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def unused(name: str, *frames: DataFrame) -> str:
    """name, or name with marks behind it that no column of the frames has, in any case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def matched(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """left joined to right on columns of the same names, so that a hot key can be split.

    The second key keeps an aggregation's partitioning from being used again: both sides are
    then dealt out by the join itself, and adaptive execution may cut a hot partition in pieces.
    It is one bit of the first, so that rows compress as well as without it.
    """
    name, twin = unused("_twin", left, right), F.pmod(F.xxhash64(F.lit("twin"), *[F.col(c) for c in on]), F.lit(2)).cast("byte")
    return left.withColumn(name, twin).join(right.withColumn(name, twin), [*on, name], how).drop(name)


def beside(left: DataFrame, right: DataFrame, on: list[str], rows: int, how: str = "inner") -> DataFrame:
    """left joined to right, which has so many rows of a few numbers: FEW go to every task, and more are matched."""
    return left.join(F.broadcast(right), on, how) if rows <= FEW else matched(left, right, on, how)


def gathered(df: DataFrame, rows: int, a_task: int = A_TASK) -> DataFrame:
    """df, a checkpoint of so many rows, read by as many tasks as these are worth, and eight at least, whatever its files are.

    Where small tables are gone through again and again, it is tasks that cost time, and disk for what they log and write.
    """
    return df.coalesce(max(8, -(-rows // a_task)))


def slices(batches, rows: int = 500):
    """Batches of a column function in smaller parts, which it may give back one by one: what it makes of a part is gone before the next."""
    for texts in batches:
        for k in range(0, len(texts), rows):
            yield texts.iloc[k : k + rows]
    give_back()


def give_back() -> None:
    """For the end of a task: what its Python worker freed goes to the system, as idle workers of one stage stand beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        pass


def stars(members: DataFrame, key: str, node: str) -> DataFrame:
    """Edges (u, v), u > v, from every member of a key to the key's smallest: as linked as all pairs, in a row a member."""
    few = members.groupBy(key).agg(F.min(node).alias("_least"), F.max(node).alias("_most")).where("_least < _most")
    return matched(members, few.select(key, "_least"), [key]).where(F.col(node) > F.col("_least")).select(F.col(node).alias("u"), F.col("_least").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges (u, v: long); component is the smallest node reachable.

    Alternating large-star and small-star steps: each round is two aggregations and two joins over
    the edges, and rounds grow with the logarithm of the diameter. While edges are few, the least
    ends go to every task instead of a join. Null ends and loops are left out.
    """
    flat = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    state = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    pair = lambda a, b: F.struct(F.col(a).alias("u"), F.col(b).alias("v"))
    now, last = cut(flat.distinct()), None
    own = state(now)
    while own != last and own[0]:
        last, now = own, gathered(now, own[0])
        both = now.select(F.inline(F.array(pair("u", "v"), pair("v", "u"))))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = beside(both, least, ["u"], 2 * own[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large if 2 * own[0] <= FEW else large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        now = cut(beside(large, least, ["u"], 2 * own[0]).select(F.inline(F.array(pair("v", "m"), pair("u", "m")))).where("u > v").distinct())
        own = state(gathered(now, own[0]))
    now = gathered(now, own[0])
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
