"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A document's fingerprint has 64 bits, eight bytes by position. Fingerprints that differ in at most two
bits differ in at most two bytes, so they share at least six positional bytes. The index posts every
distinct fingerprint under each pair of two-byte blocks (six postings): of four blocks at most two can
be touched, hence two whole blocks meet in some posting list. Within a list, shared positional bytes
are tallied for each pair, pairs with fewer than six are left out, and the rest are verified by bits.
A posting list of more than ``SMALL_BUCKET`` fingerprints lists no pairs: there every fingerprint is
posted under itself and under each single-bit change of its own outside the shared blocks. Two
fingerprints within two bits share such a neighbour, and all that share one are within two bits, so
links to its smallest holder connect the same fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SMALL_BUCKET, components, cut, matched, stars, table

SHINGLE, SEED, MAX_BITS = 3, 42, 2
#: Bit k of a byte, most significant first.
_BITS = (np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The fingerprint of a text, as a signed 64-bit number; 0 for null and texts without words."""
    from xxhash import xxh64_digest

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    hashes = np.frombuffer(b"".join(map(xxh64_digest, grams, repeat(SEED))), np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(hashes[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return docs.select("doc_id", fp("text").alias("fp"))


def links(distinct: DataFrame) -> DataFrame:
    """Edges (u, v) between the nodes of (node, fp), one row a distinct fp: they connect just what links of <= 2 bits connect."""
    blocks = [0xFFFF << (48 - 16 * i) for i in range(4)]
    masks = [(a | b) - (1 << 64 if (a | b) >> 63 else 0) for a, b in combinations(blocks, 2)]
    posts = F.explode(F.array(*[F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)])).alias("p")
    posted = distinct.select("node", "fp", posts).select("p.list", "p.part", "node", "fp")
    sizes = cut(posted.groupBy("list", "part").agg(F.count("*").alias("n")).where("n > 1"))
    live = cut(matched(posted, sizes, ["list", "part"]))
    a, b = (live.where(F.col("n") <= SMALL_BUCKET).select("list", "part", F.col("node").alias(x), F.col("fp").alias(f"fp_{x}")) for x in "uv")
    differ = F.col("fp_u").bitwiseXOR(F.col("fp_v"))
    shared = sum((F.shiftrightunsigned(differ, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int") for i in range(8))
    pairs = a.join(b, ["list", "part"]).where("u > v").where(shared >= 8 - MAX_BITS).where(F.bit_count(differ) <= MAX_BITS).select("u", "v")
    outside = [[i for i in range(64) if not m >> i & 1] for m in masks]
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in bits]) for bits in outside])
    hot = live.where(F.col("n") > SMALL_BUCKET)
    near = hot.select("node", F.explode(F.transform(flips[F.col("list")], lambda x: F.col("fp").bitwiseXOR(x))).alias("ball"))
    return pairs.unionByName(stars(near, "ball", "node"))


def simhash_groups(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of docs (doc_id, text; other columns are left out).

    Null and empty texts have fingerprint zero and link like any other. Rows that share a doc_id are one
    node. A null doc_id takes part but never names a component; a group of nothing else has a null one.
    """
    own = cut(fingerprints(docs, width))
    node = own.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node"))
    # an id with two fingerprints links them
    twice = own.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("doc_id")
    node = cut(node)
    same = matched(matched(own, twice, ["doc_id"]), node, ["fp"]).select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    named = cut(components(links(node).unionByName(same)))
    top = node.join(named, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return matched(own, top, ["fp"], "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
