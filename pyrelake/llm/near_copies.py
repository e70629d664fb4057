"""Near copies beyond SimHash's bits: pairs of texts whose five-word shingles have a Jaccard of 0.8 or more, all of them.

The shingles of a text stand in one order for all texts. Two sets that are similar enough share one of their first
n // 5 + 1 shingles (n: a set's size), so texts are posted under those alone. A pair's shared postings are tallied;
sizes, places in the order and the tally leave out pairs that cannot reach the similarity, and the rest are verified
on the whole sets. The order has the shingles last that a sample of the documents shows to be common, the most
common at the very end; it decides what is compared, never what is found.
Groups of copies are connected before pairs are listed: in each of a few rounds the members of a long posting list
are compared with a few of them, its pivots, which most of the lists of a group agree on. With several, groups are connected
too of whose members only some are near each other. A round costs a few rows a posting and verifies a few pairs a text. Long lists that hold several groups even so are of shingles that many texts share
and the sample missed: these are put last in the order too, which gives new prefixes to the texts of such lists and
to no others. Then pairs are tallied, exactly, between texts that are not connected yet: within short
lists all of them, and in long ones texts outside a list's largest connected group with the rest of the list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SMALL_BUCKET, beside, components, cut, gathered, matched, slices

WIDTH = 5
#: Documents that the common shingles are read off, about, and how many of these are put last in the order.
SAMPLE, COMMON = 4_000, 50_000
#: Rounds of pivots, how many a list has in a round, the shortest posting lists that have any, and the share of a text's prefix that it
#: must have in common with a pivot to be compared. They decide how much is connected early, not what is found.
ROUNDS, PIVOTS, PIVOTED, SHARE = 3, 8, 8, 0.2
#: Shingles of long lists of several groups that are put last, about; the longest lists first.
LATE = 200_000
#: Sets of shingles that a task reads from a checkpoint, about.
SETS = 500
_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct five-word shingles, in ascending order; a text of fewer words is one shingle, one without words has none."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()  # as SimHash has them
    if not words:
        return np.zeros(0, np.int64)
    w = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    width = min(WIDTH, len(w))
    grams = np.full(len(w) - width + 1, width, np.uint64)
    for i in range(width):
        x = w[i : len(w) - width + 1 + i] * _ODD[i]
        grams = (grams ^ (x ^ x >> np.uint64(29))) * _ODD[-1 - i]
    return np.unique((grams ^ grams >> np.uint64(32)).view(np.int64))


def _whole(grams: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(grams.tobytes())).view(np.int64))


def _sets():
    """A column function: text -> (whole, grams), whole a hash that names the set."""

    @F.pandas_udf("struct<whole:long,grams:array<long>>")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in slices(batches):
            made = [shingles(t) for t in texts]
            yield pd.DataFrame({"whole": pd.Series([_whole(g) for g in made], dtype="int64"), "grams": pd.Series(made, dtype=object)})

    return sets.asNondeterministic()  # or filters on what it gives would run it again, below the joins that leave few rows


def _prefixes(last: np.ndarray):
    """A column function: text -> (whole, n, prefix), prefix the first n // 5 + 1 shingles of the order that has last at its end, as it stands."""
    place = np.argsort(last, kind="stable")
    sorted_last = last[place]

    def prefix(grams: np.ndarray) -> np.ndarray:
        if not len(grams) or not len(last):
            return grams[: len(grams) // 5 + 1]
        at = np.minimum(np.searchsorted(sorted_last, grams), len(last) - 1)
        late = sorted_last[at] == grams
        return np.concatenate([grams[~late], grams[late][np.argsort(place[at[late]])]])[: len(grams) // 5 + 1]

    @F.pandas_udf("struct<whole:long,n:int,prefix:array<long>>")
    def prefixes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in slices(batches):
            made = [shingles(t) for t in texts]
            yield pd.DataFrame({"whole": pd.Series([_whole(g) for g in made], dtype="int64"), "n": pd.Series([len(g) for g in made], dtype="int32"), "prefix": pd.Series([prefix(g) for g in made], dtype=object)})

    return prefixes.asNondeterministic()


def _common(docs: DataFrame) -> np.ndarray:
    """The shingles that most documents of a sample share, the most common last."""
    some = docs.sample(min(1.0, SAMPLE / max(1, docs.count())), 7).select(_sets()("text").alias("s")).select("s.whole", "s.grams").dropDuplicates(["whole"])
    rows = some.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("k")).where("k > 2").orderBy(F.desc("k"), "g").limit(COMMON).collect()
    return np.array([r.g for r in reversed(rows)], np.int64)


def _alike() -> Column:
    """Whether sets of these sizes can reach the similarity."""
    return 5 * F.least("n_u", "n_v") >= 4 * F.greatest("n_u", "n_v")


def _fits() -> Column:
    """Whether two sets that share a shingle at these places can reach the similarity, if it is the first they share."""
    most = F.least(F.col("n_u") - F.col("pos_u"), F.col("n_v") - F.col("pos_v"))
    return 9 * most >= 4 * (F.col("n_u") + F.col("n_v"))


def _enough(tally: Column) -> Column:
    """Whether two sets can reach the similarity of whose prefixes so many shingles are shared.

    What they share besides lies after the end of one prefix: at most n - (n // 5 + 1) shingles.
    """
    after = F.greatest(*[F.col(f"n_{x}") - F.floor(F.col(f"n_{x}") / 5) - 1 for x in "uv"])
    return 9 * (tally + after) >= 4 * (F.col("n_u") + F.col("n_v"))


def _side(of: DataFrame, x: str, keys: list[str], more: list[str]) -> DataFrame:
    return of.select(*keys, F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "pos", *more)])


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (u, v) of ids that have texts with a Jaccard of 0.8 or more."""
    pairs = cut(pairs.distinct())
    many = pairs.count()
    if not many:
        return pairs
    pairs = gathered(pairs, many)
    ids = cut(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct())
    n = gathered(ids, many).count()
    some = beside(docs, gathered(ids, n), ["doc_id"], n, "left_semi")
    grams = cut(some.select("doc_id", _sets()("text").alias("s")).select("doc_id", "s.whole", "s.grams").dropDuplicates(["doc_id", "whole"]).select("doc_id", "grams"))
    grams = gathered(grams, n, SETS)
    both = matched(pairs, grams.select(F.col("doc_id").alias("u"), F.col("grams").alias("a")), ["u"])
    both = matched(both, grams.select(F.col("doc_id").alias("v"), F.col("grams").alias("b")), ["v"])
    return cut(both.where(9 * F.size(F.array_intersect("a", "b")) >= 4 * (F.size("a") + F.size("b"))).select("u", "v").distinct())


def _grouped(live: DataFrame, named: DataFrame) -> DataFrame:
    """live with the component that named (node, component) puts each node in."""
    return beside(live.drop("component"), named, ["node"], named.count(), "left").withColumn("component", F.coalesce("component", "node"))


def _pivots(live: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Links (u, v) between texts and the pivots of the long lists that they are in, and the components (node, component) of these.

    live has (g, node, n, pos, size); without links there are no components.
    """
    links, named = docs.sparkSession.range(0).select(F.col("id").alias("u"), F.col("id").alias("v")), None  # rows given from Python would start workers of another kind
    base = cut(live.where(F.col("size") >= PIVOTED).select("g", "node", "n"))
    postings = base.count()
    if not postings:
        return links, named
    base = gathered(base, postings)
    many = base.withColumn("component", F.col("node"))
    for k in range(ROUNDS):
        least = [F.min(F.struct(F.xxhash64("node", F.lit(k * PIVOTS + j)).alias("h"), "node", "n", "component")) for j in range(PIVOTS)]
        pivots = many.groupBy("g").agg(F.array(*least).alias("ps"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        pivots = pivots.select("g", F.inline(F.array_distinct(F.transform("ps", lambda p: F.struct(p["node"].alias("pivot"), p["n"].alias("n_v"), p["component"].alias("own"))))))
        met = matched(many.withColumnRenamed("n", "n_u"), pivots, ["g"]).where("component != own").where(_alike())
        met = met.groupBy("node", "pivot", "n_u", "n_v").agg(F.count("*").alias("tally")).where(F.col("tally") >= SHARE * (F.floor(F.col("n_u") / 5) + 1))
        new = _verified(met.select(F.greatest("node", "pivot").alias("u"), F.least("node", "pivot").alias("v")), docs)
        if new.isEmpty():
            break
        links = links.unionByName(new)  # checkpoints each
        # what is connected already goes in as stars
        named = components(new if named is None else new.unionByName(named.select(F.col("node").alias("u"), F.col("component").alias("v"))))
        named = cut(named.select("node", "component").distinct())
        named = gathered(named, named.count())
        many = _grouped(base, named)  # kept once, and named again each round
    return links, named


def _tallied(live: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes that are not connected and may reach the similarity, by all lists that they share: live has component too."""
    on, keys = ["g"], ["u", "v", "n_u", "n_v"]
    small, hot = live.where(F.col("size") <= SMALL_BUCKET), live.where(F.col("size") > SMALL_BUCKET)
    a, b = (_side(small, x, on, ["component"]) for x in "uv")
    met = a.join(b, "g").where("u > v AND component_u != component_v")
    if not hot.isEmpty():
        top = hot.groupBy("g", "component").agg(F.count("*").alias("k")).groupBy("g").agg(F.max_by("component", F.struct("k", "component")).alias("top"), F.count("*").alias("groups")).where("groups > 1")
        some = cut(matched(hot, top.select("g", "top"), on))  # lists that are one group already are done
        rest = some.where("component != top")
        # of two that are both outside the largest group the greater id is u; one inside it is v
        far = matched(_side(rest, "u", on, ["component"]), _side(some, "v", on, ["component", "top"]), on).where("component_u != component_v").where("component_v = top_v OR u > v").drop("top_v")
        met = met.unionByName(far.select(*met.columns))
    # the two ends of a pair may have come either way round
    turned = met.where(_alike()).select(*[F.when(F.col("u") > F.col("v"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (("u", "v"), ("v", "u"), ("n_u", "n_v"), ("n_v", "n_u"))], _fits().alias("fits"))
    return turned.groupBy(*keys).agg(F.count("*").alias("tally"), F.max("fits").alias("fits")).where("fits").where(_enough(F.col("tally"))).select("u", "v").distinct()


def near_links(docs: DataFrame) -> DataFrame:
    """Edges (u, v) between doc_ids of docs (doc_id, text): they connect just what pairs of near copies connect.

    Rows without an id take no part, rows that share one are a node, and texts without words are copies of nothing.
    """
    docs, common = docs.select("doc_id", "text").where("doc_id IS NOT NULL"), _common(docs)
    own = cut(docs.select("doc_id", _prefixes(common)("text").alias("s")).select("doc_id", "s.*").where("n > 0"))
    distinct = cut(own.groupBy("whole").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("prefix").alias("prefix")))
    same = cut(matched(own.select("whole", F.col("doc_id").alias("u")), distinct.select("whole", F.col("node").alias("v")), ["whole"]).where("u != v").select("u", "v").distinct())
    live = _live(distinct)
    links, named = _pivots(live, docs)
    live = _named(live, named)
    late = _late(live)
    if len(late):
        live = _named(_live(_prefixed_again(distinct, live, docs, common, late)), named)
    return same.unionByName(links).unionByName(_verified(_tallied(live), docs))


def _live(distinct: DataFrame) -> DataFrame:
    """(g, node, n, pos, size) of the postings that more than one set has."""
    posted = distinct.select("node", "n", F.posexplode("prefix").alias("pos", "g"))
    sizes = cut(posted.groupBy("g").agg(F.count("*").alias("size")).where("size > 1"))
    return matched(posted, sizes, ["g"])


def _named(live: DataFrame, named: DataFrame | None) -> DataFrame:
    """live with components, kept: postings are many, and checkpoints stay."""
    return cut(live.withColumn("component", F.col("node")) if named is None else _grouped(live, named))


def _late(live: DataFrame) -> np.ndarray:
    """The shingles of long lists that hold texts of several groups, the longest lists last."""
    groups = live.where(F.col("size") > SMALL_BUCKET).groupBy("g", "component").agg(F.count("*").alias("k"))
    mixed = groups.groupBy("g").agg((F.sum("k") - F.max("k")).alias("rest")).where("rest > 0")
    return np.array([r.g for r in reversed(mixed.orderBy(F.desc("rest"), "g").limit(LATE).collect())], np.int64)


def _prefixed_again(distinct: DataFrame, live: DataFrame, docs: DataFrame, common: np.ndarray, late: np.ndarray) -> DataFrame:
    """distinct, with late shingles last too, before the common ones: prefixes that have none of these are the same in the new order."""
    spark = docs.sparkSession
    moved = F.broadcast(spark.createDataFrame(pa.table({"g": late})))  # at most LATE numbers
    touched = cut(live.join(moved, "g", "left_semi").select("node").distinct())
    ids = touched.select(F.col("node").alias("doc_id"))
    some = beside(docs, ids, ["doc_id"], touched.count(), "left_semi")
    fresh = some.select(F.col("doc_id").alias("node"), _prefixes(np.concatenate([late[~np.isin(late, common)], common]))("text").alias("s")).select("node", "s.*").dropDuplicates(["node", "whole"])
    fresh = matched(fresh, distinct.select("node", "whole"), ["node", "whole"], "left_semi")
    return cut(matched(distinct, touched, ["node"], "left_anti").unionByName(fresh.select(*distinct.columns)))
