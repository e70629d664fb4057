"""Line deduplication by a segment-partition edit join, in DataFrame functions alone.

Lines are compared after collapsing white space and case; blank ones stay. Equal lines, and lines of
``MIN_CHARS`` or more within one edit of each other, form classes (connected groups); of each class the first
occurrence by (doc_id, the text's hash, line number) stays.

The join: a line is split into threshold + 1 = 2 segments. An edit touches one of them, so the other is
found whole: at the same place in a line of the same length, or shifted by at most one in a line one longer.
The length-aware index holds each line's two segments under its length; probes look up a line's own
segments, and those that a line one shorter would have. What shares an entry is verified: common halves are
stripped from both sides, and the rest goes to an edit distance whose band of three diagonals is the bits
of one number. An entry of more than ``SMALL_BUCKET`` lines lists no pairs: its lines are keyed by what
is before and after each place of the segment they do not share. Lines of one length agree on such a key
just when they differ there alone, and a line with that place left out agrees with the shorter line cut there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SMALL_BUCKET, components, cut, matched, stars, table, unused

#: Edits allowed between two lines. The way around large entries is exact for one edit.
THRESHOLD = 1
#: Lines with fewer characters (after collapsing) are repeats only of equal lines: an edit in so few says another thing.
MIN_CHARS = 20
#: Common halves stripped before the edit distance; each strip halves what is left.
STRIPS = 6
#: Lines to fetch the texts of, up to which their documents' ids (eight bytes each) are broadcast.
FEW = 500_000
#: Characters of the blocks that lines of large entries are hashed by.
BLOCK = 128
_KEYS = ["len", "whole", "left", "right", "cut_left", "cut_right"]
#: A line's place. Rows that share an id are told apart by their texts' hashes.
_DOC = ["doc_id", "body"]
_PLACE = [*_DOC, "line_no"]


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _collapsed(text: Column) -> Column:
    """A text in lower case, with any run of white space within its lines as one space."""
    uneven = text.contains("  ")
    for c in "\t\x0b\f\r":
        uneven = uneven | text.contains(c)
    return F.lower(F.when(uneven, F.regexp_replace(text, r"[ \t\x0B\f\r]+", " ")).otherwise(text))


def _hash(*parts) -> Column:
    return F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _bodies(docs: DataFrame) -> DataFrame:
    """(doc_id, body, text) of the rows with an id."""
    return docs.select("doc_id", "text").where("doc_id IS NOT NULL").select("doc_id", _hash("body", F.col("text")).alias("body"), "text")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, body, line_no, s) of every line that is not blank."""
    lines = F.transform(_split(_collapsed(F.col("text"))), lambda x: F.trim(x))  # once a text, before lines are rows
    return docs.select(*_DOC, F.posexplode(lines).alias("line_no", "s")).where(F.length("s") > 0)


def _keyed(lines: DataFrame) -> DataFrame:
    """The lines' places with what identifies them (length, and hashes of the whole and of both segments) and their probes one shorter."""
    s, n = F.col("s"), F.length("s")
    half, shorter = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    return lines.select(
        *_PLACE, n.alias("len"), _hash("line", s).alias("whole"),
        _hash("left", n, F.substring(s, F.lit(1), half)).alias("left"), _hash("right", n, F.substring(s, half + 1, n)).alias("right"),
        _hash("left", n - 1, F.substring(s, F.lit(1), shorter)).alias("cut_left"), _hash("right", n - 1, F.substring(s, shorter + 2, n)).alias("cut_right"),
    )


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two short strings are within one edit: a banded bit-parallel automaton over a's characters.

    Bit d of a number stands for diagonal d - 1 of the band: the characters of a and b read so far differ in
    count by d - 1. r0 has the diagonals reached without an edit, r1 those with one at most.
    """
    none = F.array().cast("array<string>")
    pa, pb = (F.when(F.length(x) == 0, none).otherwise(F.split(x, "")) for x in (a, b))
    # a's characters beside those of b on the three diagonals, laid out once a pair
    band = F.slice(F.arrays_zip(pa, F.concat(F.array(F.lit("")), pb), pb, F.when(F.size(pb) < 2, none).otherwise(F.slice(pb, 2, F.greatest(F.size(pb), F.lit(2))))), 1, F.size(pa))
    start = F.struct(F.lit(2).alias("r0"), F.lit(6).alias("r1"))

    def step(state: Column, c: Column) -> Column:
        r0, r1 = state["r0"], state["r1"]
        same = sum(F.when(c[str(d + 1)] == c["0"], 1 << d).otherwise(0) for d in range(3))
        new0 = r0.bitwiseAND(same)
        # one edit more: a's character replaced (same diagonal), left out (diagonal below), or one of b's put in (diagonal above)
        new1 = r1.bitwiseAND(same).bitwiseOR(r0).bitwiseOR(F.shiftright(r0, 1)).bitwiseOR(F.shiftleft(new0, 1)).bitwiseAND(F.lit(7))
        return F.struct(new0.alias("r0"), new1.alias("r1"))

    last = F.aggregate(band, start, step)
    end = F.size(pb) - F.size(pa) + 1
    return end.between(0, 2) & (last["r1"].bitwiseOR(last["r0"]).bitwiseAND(F.when(end == 0, 1).when(end == 1, 2).otherwise(4)) != 0)


def _stripped(pairs: DataFrame) -> DataFrame:
    """Takes equal halves off the fronts and ends of a and b; pairs that have neither are more than one edit apart."""

    def strip(state: Column, _: Column) -> Column:
        a, b, near = state["a"], state["b"], state["near"]
        k = F.floor(F.least(F.length(a), F.length(b)) / 2).cast("int")
        front = F.substring(a, F.lit(1), k) == F.substring(b, F.lit(1), k)
        back = F.substring(a, F.length(a) - k + 1, k) == F.substring(b, F.length(b) - k + 1, k)
        rest = [F.when(k == 0, x).when(front, F.substring(x, k + 1, F.length(x))).otherwise(F.substring(x, F.lit(1), F.length(x) - k)).alias(n) for n, x in (("a", a), ("b", b))]
        return F.when(near, F.struct(*rest, (front | back | (k == 0)).alias("near"))).otherwise(state)

    start = F.struct("a", "b", F.lit(True).alias("near"))
    left = F.aggregate(F.sequence(F.lit(1), F.lit(STRIPS)), start, strip)
    return pairs.select("u", "v", left.alias("left")).where("left.near").select("u", "v", "left.a", "left.b")


def _chained(blocks: Column) -> Column:
    """Hashes of the first 0, 1, 2 ... blocks."""
    return F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda done, b: F.concat(done, F.array(F.xxhash64(F.element_at(done, -1), b))))


def _hot_links(hot: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges between lines of large entries: hot has (node, side, role), role 1 for probes one shorter.

    What is before a place is hashed by whole blocks from the front, what is after it by whole blocks from the end, and
    the rest of a block: a place costs a block's length, however long the line.
    """
    s, n, size = F.col("s"), F.length("s"), BLOCK
    last = F.floor((n - 1) / size).cast("int")
    front = F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(s, k * size + 1, F.lit(size)))
    back = F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(s, F.greatest(n - (k + 1) * size, F.lit(0)) + 1, F.least(F.lit(size), n - k * size)))
    full = hot.distinct().join(texts, "node").select("node", "side", "role", n.alias("n"), front.alias("front"), back.alias("back"))
    full = full.withColumns({"fronts": _chained(F.col("front")), "backs": _chained(F.col("back"))})
    n, role = F.col("n"), F.col("role")

    def before(p: Column) -> Column:
        k, rest = F.floor(p / size).cast("int"), F.pmod(p, F.lit(size))
        return F.xxhash64(F.get("fronts", k), F.substring(F.coalesce(F.get("front", k), F.lit("")), F.lit(1), rest))

    def after(p: Column) -> Column:
        """The hash of what follows from place p on."""
        k, rest = F.floor((n - p) / size).cast("int"), F.pmod(n - p, F.lit(size))
        block = F.coalesce(F.get("back", k), F.lit(""))
        return F.xxhash64(F.get("backs", k), F.substring(block, F.length(block) - rest + 1, rest))

    half = F.floor((n - role) / 2).cast("int")  # of the shorter line, for probes
    low, high = F.when(F.col("side") == 0, half).otherwise(0), F.when(F.col("side") == 0, n).otherwise(half + role)

    def keys(p: Column) -> Column:
        return F.array(
            F.when((role == 0) & (p < n), F.struct(F.lit(0).alias("kind"), _hash("swap", n, p, before(p), after(p + 1)).alias("h"))),
            F.when(role == 0, F.struct(F.lit(1).alias("kind"), _hash("cut", n, p, before(p), after(p)).alias("h"))),
            F.when((role == 1) & (p < n), F.struct(F.lit(2).alias("kind"), _hash("cut", n - 1, p, before(p), after(p + 1)).alias("h"))),
        )

    made = full.select("node", F.explode(F.flatten(F.transform(F.sequence(low, high), keys))).alias("k")).where("k IS NOT NULL").select("node", "k.kind", "k.h")
    swaps = stars(made.where("kind = 0"), "h", "node")
    whole = made.where("kind = 1").groupBy("h").agg(F.min("node").alias("v"))
    return swaps.unionByName(matched(made.where("kind = 2"), whole, ["h"]).select(F.col("node").alias("u"), "v"))


def _links(distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """Edges (u, v) between nodes of distinct lines that are connected by single edits."""
    entries = [("left", 0, 0), ("right", 1, 0), ("cut_left", 0, 1), ("cut_right", 1, 1)]
    posted = distinct.select("node", F.explode(F.array(*[F.struct(F.col(c).alias("key"), F.lit(side).alias("side"), F.lit(role).alias("role")) for c, side, role in entries])).alias("p")).select("p.*", "node")
    sizes = cut(posted.groupBy("key").agg(F.count("*").alias("n"), F.sum("role").alias("probes")).where("n > 1 AND n > probes").select("key", "n"))
    live = cut(matched(posted, sizes, ["key"]))
    a, b = (live.where(F.col("n") <= SMALL_BUCKET).select("key", F.col("node").alias(x), F.col("role").alias(f"role_{x}")) for x in "uv")
    pairs = cut(a.join(b, "key").where("u > v AND role_u + role_v < 2").select("u", "v").distinct())
    hot = live.where(F.col("n") > SMALL_BUCKET).select("node", "side", "role")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).unionByName(hot.select("node")).distinct()
    wanted = cut(distinct.join(nodes, "node", "left_semi").select("node", *_PLACE, "whole"))
    places = wanted.select("doc_id").distinct()
    # a few ids go to the texts; where they are many, the texts are dealt out to the ids
    places = F.broadcast(places) if wanted.count() <= FEW else places
    some = docs.join(places, "doc_id", "left_semi")
    texts = cut(_lines(some).withColumn("whole", _hash("line", F.col("s"))).join(wanted, [*_PLACE, "whole"]).groupBy("node").agg(F.min("s").alias("s")))
    # what large entries' keys connect is held against the texts like any other pair: keys are hashes
    pairs = pairs.unionByName(_hot_links(hot, texts)).distinct()
    both = pairs.join(texts.select(F.col("node").alias("u"), F.col("s").alias("a")), "u").join(texts.select(F.col("node").alias("v"), F.col("s").alias("b")), "v")
    return _stripped(both).where(within_one_edit(F.col("a"), F.col("b"))).select("u", "v")


def duplicate_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, body, line_no) of the lines that repeat an earlier one: equal, or within one edit if of min_chars or more.

    body is the hash of a row's text, line numbers start at 0. Documents without an id have no place in the order:
    their lines are neither compared nor removed. Rows that share an id and a text are one document, and lose the
    same lines; rows that share only an id are documents of their own.
    """
    docs = _bodies(docs)
    placed = _keyed(_lines(docs))
    place = F.struct(*_PLACE)
    distinct = cut(placed.groupBy(*_KEYS).agg(F.min(place).alias("first"), F.max(place).alias("last")).select(*_KEYS, "first.*", (F.col("first") < F.col("last")).alias("again")).withColumn("node", F.monotonically_increasing_id()))
    named = cut(components(_links(distinct.where(F.col("len") >= min_chars), docs)))
    classed = distinct.join(named, "node").select("node", "component", place.alias("at"))
    tops = classed.groupBy("component").agg(F.min("at").alias("top"))
    tops = cut(matched(classed.select("node", "component"), tops, ["component"]).select("node", "top"))
    of = ["len", "whole", "left"]  # two hashes of 64 bits and the length tell lines apart
    chosen = cut(distinct.join(tops, "node", "left").where("again OR top IS NOT NULL").select(*of, F.coalesce("top", place).alias("top")))
    return matched(placed.select(*_PLACE, *of), chosen, of).where(place != F.col("top")).select(*_PLACE).distinct()


def _per_document(removed: DataFrame) -> DataFrame:
    return removed.groupBy(*_DOC).agg(F.array_sort(F.collect_list("line_no")).alias("removed"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with the repeated lines taken out of text; null texts stay null, and all columns and rows stay.

    Columns of any name pass through; a null id, a repeated row and rows that share an id are as in duplicate_lines().
    """
    body, removed = unused("body", docs), unused("removed", docs)
    found = _per_document(duplicate_lines(docs, min_chars)).select("doc_id", F.col("body").alias(body), F.col("removed").alias(removed))
    gone = matched(docs.withColumn(body, _hash("body", F.col("text"))), found, ["doc_id", body], "left")
    lines = _split(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed))
    text = F.when(F.col(removed).isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    return gone.withColumn("text", text).select(*docs.columns)


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row of docs: doc_id, n_lines (0 for null texts), n_removed and the numbers of the removed lines."""
    n_lines = F.coalesce(F.greatest(F.size(_split(F.col("text"))), F.lit(0)), F.lit(0)).cast("long")
    counts = docs.select("doc_id", _hash("body", F.col("text")).alias("body"), n_lines.alias("n_lines"))
    out = matched(counts, _per_document(duplicate_lines(docs, min_chars)), _DOC, "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), F.concat_ws(",", removed.cast("array<string>")).alias("removed_lines"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
WITH RECURSIVE cut AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
raw AS (SELECT doc_id, unnest(range(0, len(ls))) AS line_no, unnest(ls) AS line FROM cut),
lines AS (SELECT doc_id, line_no, lower(trim(regexp_replace(line, '\\s+', ' ', 'g'))) AS s FROM raw),
uniq AS (SELECT s, length(s) AS n, row_number() OVER (ORDER BY s) AS node FROM lines WHERE s <> '' GROUP BY s),
lengthy AS (SELECT * FROM uniq WHERE n >= {MIN_CHARS}),
keyed AS (
  SELECT node, s, n, 0 AS side, substr(s, 1, CAST(floor(n / 2) AS BIGINT)) AS k, 0 AS role FROM lengthy
  UNION ALL SELECT node, s, n, 1, substr(s, CAST(floor(n / 2) AS BIGINT) + 1), 0 FROM lengthy
  UNION ALL SELECT node, s, n - 1, 0, substr(s, 1, CAST(floor((n - 1) / 2) AS BIGINT)), 1 FROM lengthy
  UNION ALL SELECT node, s, n - 1, 1, substr(s, CAST(floor((n - 1) / 2) AS BIGINT) + 2), 1 FROM lengthy),
edges AS (SELECT DISTINCT a.node AS u, b.node AS v FROM keyed a JOIN keyed b USING (n, side, k)
  WHERE a.node <> b.node AND a.role + b.role < 2 AND levenshtein(a.s, b.s) <= 1),
reach(node, other) AS (SELECT u, v FROM edges UNION SELECT r.node, e.v FROM reach r JOIN edges e ON r.other = e.u),
comp AS (SELECT node, least(node, min(other)) AS c FROM reach GROUP BY node),
classed AS (SELECT l.doc_id, l.line_no, coalesce(c.c, u.node) AS c FROM lines l JOIN uniq u USING (s) LEFT JOIN comp c ON c.node = u.node),
ranked AS (SELECT doc_id, line_no, row_number() OVER (PARTITION BY c ORDER BY doc_id, line_no) AS rn FROM classed),
gone AS (SELECT doc_id, count(*) AS n, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS removed FROM ranked WHERE rn > 1 GROUP BY doc_id)
SELECT d.doc_id, CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS n_lines, coalesce(g.n, 0) AS n_removed, coalesce(g.removed, '') AS removed_lines
FROM documents d LEFT JOIN gone g USING (doc_id)
"""
