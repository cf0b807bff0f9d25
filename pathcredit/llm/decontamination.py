"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed hashes the words of a window that a fixed mask keeps; the other positions
may differ.  The masks of an item follow from its number of words, so that every
way to change 20 of 100 words of an overlap leaves one seed whole: none is lost.
The seeds of all documents are joined with those of the benchmark items; a hit
names a document, an item and a diagonal (difference of positions).  Every
diagonal is then compared word by word: an overlap is a stretch of the item in
which twenty neighbouring words (all words of a shorter item) agree in at least
80 of 100 positions.

The benchmark's seeds are written once, so Spark knows their size: under its
broadcast threshold they are broadcast, beyond it the join shuffles both sides
on the seed and splits hot ones.

Cases: words are those between white space, lower-cased; null or empty texts
and items have none; an item under five words is found where all its words
stand; null ids are left out; equal rows report once; empty tables give no row;
further columns are ignored.  ``OP3_SQL`` uses no seeds: it counts the equal words
of all diagonals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import documents, table

#: (least words of an item, its masks): word positions of a window that count.  Each
#: group hits every pattern of 20 % changed words in an item, or in twenty words of it.
FAMILIES = (
    (12, ((0, 1, 3, 4, 5), (0, 1, 2, 3, 4))),
    (7, ((0, 1, 2, 4), (0, 1, 2, 3))),
    (5, ((0, 1, 2), (0, 1, 3))),
    (4, ((0, 1, 2, 3),)),
    (3, ((0, 1, 2),)),
    (2, ((0, 1),)),
    (1, ((0,),)),
)
MASKS = tuple(dict.fromkeys(m for _, masks in FAMILIES for m in masks))
OVERLAP_WORDS = 20
PERCENT = 80


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _codes(text: str) -> Column:
    """A 64-bit code for every word."""
    return F.transform(_words(text), lambda w: F.xxhash64(w))


def _family(size: Column) -> Column:
    """The group of masks, by its least words, of an item; null without words."""
    return F.coalesce(*[F.when(size >= least, F.lit(least)) for least, _ in FAMILIES])


Mask = tuple[int, ...]


def _seeds(codes: str, spots: str, masks: list[Mask]) -> Column:
    """The seeds of all windows, mask by mask.  A window past the end hashes fewer
    words: a pair more to compare, never one less."""

    def of(mask: Mask) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.col(spots) - 1),
            lambda i: F.xxhash64(F.lit(str(mask)), *[F.get(F.col(codes), i + o) for o in mask]),
        )

    return F.concat(*[of(m) for m in masks])


def seeded(coded: DataFrame, key: str, masks: list[Mask]) -> DataFrame:
    """(key, seed, at) of every window and mask."""
    counted = coded.withColumn("spots", F.size("codes") - min(m[-1] for m in masks))
    some = F.when(F.col("spots") > 0, _seeds("codes", "spots", masks))  # a filter would compute the words twice
    found = counted.select(key, "spots", F.posexplode(some).alias("place", "seed"))
    return found.select(key, "seed", F.pmod("place", "spots").alias("at"))


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_words, n_equal): one row for
    every document, item and diagonal with an overlap."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null")
    coded = table(asked.select("item_id", _codes("text").alias("codes")).withColumn("family", _family(F.size("codes"))), "items")
    present = {r["family"] for r in coded.select("family").distinct().collect()}
    families = [(least, masks) for least, masks in FAMILIES if least in present] or [FAMILIES[0]]
    seeds = reduce(DataFrame.unionByName, [seeded(coded.filter(F.col("family") == least), "item_id", list(masks)) for least, masks in families])
    seeds = table(seeds.select("seed", "item_id", F.col("at").alias("item_at")), "item-seeds")
    masks = list(dict.fromkeys(m for _, group in families for m in group))
    hits = seeded(own.select("doc_id", _codes("text").alias("codes")), "doc_id", masks).join(seeds, "seed").select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    hits = table(hits.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "shift")).alias("hits")), "hits")

    doc = own.join(hits, "doc_id").select("doc_id", _codes("text").alias("codes"), "hits")
    met = doc.select("doc_id", "codes", F.size("codes").alias("size"), F.explode("hits").alias("hit"))
    lined = met.select("doc_id", "hit.item_id", "hit.shift", F.greatest("hit.shift", F.lit(0)).alias("doc_from"), F.greatest(-F.col("hit.shift"), F.lit(0)).alias("item_from"), "codes", "size")
    item = coded.select("item_id", F.col("codes").alias("item_codes"), F.size("codes").alias("item_size"))
    both = lined.join(item, "item_id").withColumn("length", F.least(F.col("item_size") - F.col("item_from"), F.col("size") - F.col("doc_from")))
    same = F.zip_with(
        F.slice("codes", F.col("doc_from") + 1, F.col("length")),
        F.slice("item_codes", F.col("item_from") + 1, F.col("length")),
        lambda a, b: F.when(a == b, 1).otherwise(0),
    )
    windowed = both.select("doc_id", "item_id", "doc_from", "item_from", "length", F.least(F.lit(OVERLAP_WORDS), "item_size").alias("window"), same.alias("same")).filter("length >= window")

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    good = F.filter(
        F.sequence(F.lit(0), F.col("length") - F.col("window")),
        lambda i: total(F.slice("same", i + 1, F.col("window"))) * 100 >= F.col("window") * PERCENT,
    )
    judged = windowed.withColumn("good", good).filter(F.size("good") > 0)
    first, n = F.element_at("good", 1), F.element_at("good", -1) + F.col("window") - F.element_at("good", 1)
    return judged.select(
        "doc_id",
        "item_id",
        (F.col("doc_from") + first).cast("long").alias("doc_start"),
        (F.col("item_from") + first).cast("long").alias("item_start"),
        n.cast("long").alias("n_words"),
        total(F.slice("same", first + 1, n)).cast("long").alias("n_equal"),
    ).distinct()


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without an overlap, as they are."""
    hit = overlaps(docs, items).select(F.col("doc_id").alias("hit_doc")).distinct()
    return docs.join(hit, docs.doc_id.cast("long") == hit.hit_doc, "left_anti")


def op3_decontamination(spark, sf_dir):
    return overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP3_SQL = f"""
WITH rows AS (
  SELECT doc_id AS id, 'd' AS kind, text FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT item_id, 'b', text FROM benchmark WHERE item_id IS NOT NULL
), tokens AS (
  SELECT id, kind, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM rows
), spots AS (
  SELECT id, kind, len(w) AS size, unnest(range(0, len(w))) AS i, unnest(w) AS word FROM tokens
), hits AS (
  SELECT d.id AS doc_id, b.id AS item_id, d.i - b.i AS shift
  FROM spots d JOIN spots b ON d.word = b.word AND d.kind = 'd' AND b.kind = 'b'
  GROUP BY d.id, b.id, b.size, d.i - b.i HAVING count(*) * 100 >= least({OVERLAP_WORDS}, b.size) * {PERCENT}
), lined AS (
  SELECT doc_id, item_id, greatest(shift, 0) AS df, greatest(-shift, 0) AS bf, d.w AS dw, b.w AS bw,
         least(len(b.w) - greatest(-shift, 0), len(d.w) - greatest(shift, 0)) AS n, least({OVERLAP_WORDS}, len(b.w)) AS win
  FROM hits JOIN tokens d ON d.kind = 'd' AND d.id = doc_id JOIN tokens b ON b.kind = 'b' AND b.id = item_id
), same AS (
  SELECT *, list_transform(range(0, n), lambda j: CASE WHEN dw[df + j + 1] = bw[bf + j + 1] THEN 1 ELSE 0 END) AS eq FROM lined WHERE n >= win
), good AS (
  SELECT *, list_filter(range(0, n - win + 1), lambda i: list_sum(eq[i + 1 : i + win]) * 100 >= win * {PERCENT}) AS g FROM same
)
SELECT DISTINCT doc_id, item_id, CAST(df + g[1] AS BIGINT) AS doc_start, CAST(bf + g[1] AS BIGINT) AS item_start,
       CAST(g[len(g)] + win - g[1] AS BIGINT) AS n_words, CAST(list_sum(eq[g[1] + 1 : g[len(g)] + win]) AS BIGINT) AS n_equal
FROM good WHERE len(g) > 0
"""
