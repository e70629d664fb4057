"""Spelling variants of a corpus' words, by bands of letter-parity masks.

A word's mask has a bit a letter: whether the letter stands in it an odd number of times. One inserted, deleted or
replaced letter flips two bits at most, so of three bands of the mask one stays as it was: words are posted under
each band with their length, and beside it with the length one more, and meet where band and length are equal.
What meets is held against the whole masks (two bits at most) and then compared by edit distance; a pair counts
where its first equal band finds it. Letters are dealt to the bands by how common they are in European languages, so
that each band tells about as much; that decides what is compared, never what is found.

A band's list of more than ``LARGE`` words lists no pairs: its words are posted, within the list, with each of
their letters left out. Words of one length that agree with the same place left out differ there alone, and a word with
a letter left out that is another word is one deletion from it. Pairs that meet there are near, so none is for nothing.

Nulls and odd rows: null texts have no words; a null id is written as nothing before the colon. Repeated rows count
each time. Other columns are left out, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, matched, table

WORD = "[A-Za-zÀ-ÿ]+"
#: The shortest words, and the fewest occurrences, that are grouped.
MIN_LENGTH, MIN_COUNT = 5, 3
#: A form is at least so many times as frequent as the variant.
TIMES = 2
BANDS, WIDTH = 3, 21
#: Words of a band and length that are compared one by one; each costs some hundredths of a microsecond.
LARGE = 1_024
#: Letters from common to rare; those that are not named follow by their code points.
COMMON = "enirtsaoduhlcgmpébväüfêèzwkßyç"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bits() -> dict[str, int]:
    """The bit of every letter. Letters share a bit where there are more than bits: an edit still flips two at most."""
    letters = dict.fromkeys(COMMON + _LOWER + "".join(map(chr, range(0xC0, 0x100))))
    return {c: k % BANDS * WIDTH + k // BANDS % WIDTH for k, c in enumerate(letters)}


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of every distinct word of docs (doc_id, text) and how often it is there: runs of letters, as they are noised.

    A run whose crc32 with its document's id is divisible by 97 loses the letter that the crc32 points at.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(WORD), F.lit(0))).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    noised = runs.withColumn("h", h).select(F.when(F.col("h") % 97 == 0, short).otherwise(F.col("run")).alias("word"))
    return noised.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))


def mask(word: Column) -> Column:
    """The word's letter parities as one number: each letter adds its bit, and twice is none."""
    bit = F.create_map(*[x for c, b in bits().items() for x in (F.lit(c), F.lit(1 << b))])
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda m, c: m.bitwiseXOR(F.coalesce(bit[c], F.lit(0).cast("long"))))


def _band(k: Column | int) -> Column:
    """A mask's band k."""
    return F.expr(f"shiftrightunsigned(mask, {k * WIDTH})").bitwiseAND((1 << WIDTH) - 1)


def _first_equal() -> Column:
    """The first band in which two masks are equal."""
    apart = F.col("mask_u").bitwiseXOR(F.col("mask_v"))
    equal = [apart.bitwiseAND(((1 << WIDTH) - 1) << (k * WIDTH)) == 0 for k in range(BANDS)]
    return F.when(equal[0], 0).when(equal[1], 1).when(equal[2], 2)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(u, v, n_u, n_v): every pair of words (word, n) that differ by one inserted, deleted or replaced letter, once.

    Keys are hashes, so that rows stay short: what meets is held against the words themselves, and found twice counts once.
    """
    known = vocabulary.select("word", "n", F.length("word").alias("size"), mask(F.col("word")).alias("mask"))
    # role 1: a word under the length one shorter, where the words that it has a letter more than are
    entries = F.array(*[F.struct(F.xxhash64(F.lit(k), _band(k), F.col("size") - role).alias("key"), F.lit(2 * k + role).cast("byte").alias("tag")) for k in range(BANDS) for role in (0, 1)])
    posted = known.select("word", "n", "mask", F.explode(entries).alias("e")).select("e.*", "word", "n", "mask")
    sizes = cut(posted.groupBy("key").agg(F.count("*").alias("listed"), F.sum(F.col("tag") % 2).alias("probes")).where("listed > 1 AND listed > probes").select("key", "listed"))
    live = cut(matched(posted, sizes, ["key"]))
    small, large = live.where(F.col("listed") <= LARGE).drop("listed"), live.where(F.col("listed") > LARGE).drop("listed")
    # of two equally long words one comes first; of two others the shorter one is u
    met = matched(_side(small, "u"), _side(small, "v"), ["key"]).where("tag_u % 2 = 0 AND (tag_v % 2 = 1 OR word_u < word_v)")
    return _verified(met).unionByName(_verified(_large(large))).distinct()


def _side(of: DataFrame, x: str) -> DataFrame:
    return of.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("word", "n", "mask", "tag")])


def _verified(met: DataFrame) -> DataFrame:
    """The pairs that are near, under the first band in which they are equal."""
    met = met.where(F.bit_count(F.col("mask_u").bitwiseXOR(F.col("mask_v"))) <= 2).where((_first_equal() == F.floor(F.col("tag_u") / 2)) & (F.floor(F.col("tag_u") / 2) == F.floor(F.col("tag_v") / 2)))
    return met.where(F.levenshtein("word_u", "word_v", 1) == 1).select(F.col("word_u").alias("u"), F.col("word_v").alias("v"), "n_u", "n_v")


def _large(live: DataFrame) -> DataFrame:
    """The words of large lists that agree with a letter left out, or with another word that has a letter less."""
    word, size = F.col("word"), F.length("word")
    without = lambda p: F.concat(F.substring(word, F.lit(1), p - 1), F.substring(word, p + 1, size))
    places = F.sequence(F.lit(1), size)
    keyed = lambda of, keys: of.select(F.explode(keys).alias("key"), "word", "n", "mask", "tag")
    same, more = live.where("tag % 2 = 0"), live.where("tag % 2 = 1")
    swaps = keyed(same, F.transform(places, lambda p: F.xxhash64("key", p, without(p))))
    swapped = matched(_side(swaps, "u"), _side(swaps, "v"), ["key"]).where("word_u < word_v")
    whole = same.select(F.xxhash64("key", F.lit(0), word).alias("key"), "word", "n", "mask", "tag")
    # of letters that stand twice in a row either may be left out
    longer = keyed(more, F.array_distinct(F.transform(places, lambda p: F.xxhash64("key", F.lit(0), without(p)))))
    return swapped.unionByName(matched(_side(whole, "u"), _side(longer, "v"), ["key"]).select(*swapped.columns))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: forms (word, form) is followed to its last word, twice as far each round.

    A form is at least twice as frequent as its variant, so that ways end, after a few dozen steps at most.
    """
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(matched(now, onward, ["root"], "left"))
        if moved.where("next IS NOT NULL").isEmpty():
            return now
        now = moved.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Per word of docs (doc_id, text): word, form, root, n, n_near and form_n.

    form is the word's most frequent near word (of equals the smallest), if it is at least TIMES as frequent; root is
    where forms lead. All texts are read whole; empty tables give no rows.
    """
    known = cut(words(docs.select("doc_id", "text")).where(F.col("n") >= MIN_COUNT))
    pairs = cut(near_pairs(known))
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), F.col("n_v").alias("n_u"), F.col("n_u").alias("n_v")))
    best = both.groupBy("u", "n_u").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_v")).alias("less"), F.col("v").alias("form"))).alias("b"))
    formed = F.when(-F.col("b.less") >= TIMES * F.col("n_u"), F.col("b.form"))
    best = cut(best.select(F.col("u").alias("word"), "n_near", formed.alias("form"), F.when(formed.isNotNull(), -F.col("b.less")).alias("form_n")))
    ends = roots(best.where("form IS NOT NULL"))
    out = known.join(best, "word", "left").join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


#: The checksum by its definition: a table of 256 remainders, and a step a byte of UTF-8.
_BYTES = "flatten(list_transform(string_split({s}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [192 + (CAST(ord(c) AS BIGINT) >> 6), 128 + (CAST(ord(c) AS BIGINT) & 63)] END))"
_CRC = f"xor(list_reduce([4294967295] || {_BYTES}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
ORACLE_SQL = f"""
WITH RECURSIVE tbl AS (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce([n] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS n))),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{WORD}')) AS run FROM documents WHERE text IS NOT NULL),
uniq AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s, run, count(*) AS k FROM runs GROUP BY 1, 2),
hashed AS (SELECT run, k, {_CRC.format(s="s")} AS h FROM uniq, tbl),
words AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
vocab AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM words WHERE length(word) >= {MIN_LENGTH} GROUP BY 1 HAVING sum(k) >= {MIN_COUNT}),
cuts AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM vocab)),
near AS (
  SELECT a.word AS u, b.word AS v, b.n AS n FROM cuts a JOIN cuts b ON a.p = b.p AND a.rest = b.rest WHERE a.word <> b.word
  UNION SELECT c.word, v.word, v.n FROM cuts c JOIN vocab v ON c.rest = v.word
  UNION SELECT v.word, c.word, c.n FROM cuts c JOIN vocab v ON c.rest = v.word),
ranked AS (SELECT u, v, n, count(*) OVER (PARTITION BY u) AS n_near, row_number() OVER (PARTITION BY u ORDER BY n DESC, v) AS k FROM near),
formed AS (SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= {TIMES} * v.n THEN r.v END AS form, CASE WHEN r.n >= {TIMES} * v.n THEN r.n END AS form_n FROM vocab v LEFT JOIN ranked r ON r.u = v.word AND r.k = 1),
ways(word, tip) AS (SELECT word, word FROM formed UNION ALL SELECT w.word, f.form FROM ways w JOIN formed f ON f.word = w.tip WHERE f.form IS NOT NULL),
ends AS (SELECT w.word, w.tip AS root FROM ways w JOIN formed f ON f.word = w.tip WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e ON e.word = f.word
"""
