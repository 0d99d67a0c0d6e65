"""Benchmark decontamination by template canonicalisation, in DataFrame and SQL functions only.

A text becomes a row of words and numbers; numbers, names and units become typed placeholders. Windows
of five such tokens are the template windows. Benchmark windows meet document windows in a hash join;
documents that meet an item are then compared with it in full: an alignment counts if the placeholders
are filled consistently, that is, if each value of the item always stands for one value of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, cut, read, without

WORDS, SHARE = 5, 0.75
#: Words that are units wherever they stand (fixed values).
UNITS = (
    "mm cm km kg mg ml mph kmh percent meter meters metre metres kilometer kilometers kilometre kilometres mile miles "
    "gram grams kilogram kilograms liter liters litre litres second seconds minute minutes hour hours day days week "
    "weeks month months year years dollar dollars euro euros cent cents pound pounds degree degrees"
).split()
#: Rows up to which the benchmark's windows are broadcast (16 bytes each).
BROADCAST_ROWS = 1_000_000


def tokens(text: Column) -> Column:
    """Runs of letters, and numbers with their inner signs; everything else parts tokens."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"\p{L}+|[0-9][0-9.,:/]*"), F.lit(0))


def template(token: Column) -> Column:
    """#n for numbers, #u for units, #p for capitalised words (names), else the word in lower case."""
    low = F.lower(token)
    return (
        F.when(token.between("0", "9~"), "#n")
        .when(low.isin(UNITS), "#u")
        .when((token == low) | (F.length(token) == 1) | (token == F.upper(token)), low)
        .otherwise("#p")
    )


def _windows(token: Column, literal: bool = False) -> Column:
    """array<struct<pos, w>>: each window's position and hash; with literal also its number of literal words. A text of
    fewer than five tokens is one window, a text without tokens has none.

    The one-element transform binds the template tokens once for all windows.
    """

    def of(t: Column) -> Column:
        def window(i: Column) -> Column:
            own = [F.get(t, i + k) for k in range(WORDS)]
            more = [sum(F.when(F.substring(x, 1, 1) != "#", 1).otherwise(0) for x in own).alias("literal")] if literal else []
            return F.struct(i.alias("pos"), F.xxhash64(*own).alias("w"), *more)

        # Fewer tokens are one window of all of them; what is missing is null, which the hash passes over.
        return F.when(F.size(t) > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - WORDS, F.lit(0))), window))

    # A short text of placeholders alone would be like any other of their kinds, so there the tokens stand for themselves.
    bare = (F.size(token) < WORDS) & F.forall(token, lambda x: F.substring(template(x), 1, 1) == "#")
    return F.get(F.transform(F.array(F.when(bare, token).otherwise(F.transform(token, template))), of), F.lit(0))


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, n_slots, n_changed): pairs where a document holds `share`
    of an item's windows or more, in consistent alignments; n_changed of its n_slots slots have another
    value than the benchmark's.

    Rows with a null id and null or empty texts match nothing. An item of fewer than five tokens is one window, held by the
    documents that consist of it alone, as templates, or to the letter where it has nothing but placeholders. Before any alignment is made, the item's positions whose window a document
    has anywhere are counted, and only pairs that reach the share go on.
    Rows that repeat a doc_id count as one document, rows that repeat an item as one item; where the texts of
    one item_id differ, a document may hold any of their windows at a position. Of alignments that match
    equally many windows, the one with most slots, then most changed ones, gives n_slots and n_changed. A very
    long text is one row of windows, exploded as it is read. Other columns are left out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), tokens(F.col("text")).alias("tok")).where("item_id is not null")
    items = items.dropDuplicates()
    own = cut(items.select("item_id", "tok", F.explode(_windows(F.col("tok"), literal=True)).alias("x")).select("item_id", "tok", "x.*"))
    head = own.groupBy("item_id").agg(F.countDistinct("pos").alias("n_windows"))
    # A document that holds the share lacks at most `spare` positions of the item, so it holds one of any
    # spare + 1. Those with the most literal words are asked for, as they are the rarest.
    spare = F.col("n_windows") - F.ceil(F.lit(share) * F.col("n_windows") - 1e-9)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("literal"), "pos"))
    lead = own.groupBy("item_id", "pos").agg(F.min("literal").alias("literal")).withColumn("rank", rank)
    lead = lead.join(head, "item_id").where(F.col("rank") <= spare + 1).select("item_id", "pos")
    keys = cut(own.join(lead, ["item_id", "pos"]).select("w", "item_id").distinct())
    small = keys.count() <= BROADCAST_ROWS
    seen = (
        docs.select("doc_id", F.explode(_windows(tokens(F.col("text")))).alias("x"))
        .select("doc_id", "x.w")
        .join(F.broadcast(keys) if small else keys, "w")
        .select("doc_id", "item_id")
        .distinct()
    )
    seen = cut(seen)
    near = docs.join(bounded(seen.select("doc_id").distinct()), "doc_id", "left_semi")
    near = cut(near.select("doc_id", tokens(F.col("text")).alias("dtok")))
    spots = near.select("doc_id", "dtok", F.explode(_windows(F.col("dtok"))).alias("x")).select(
        "doc_id", F.col("x.pos").alias("dpos"), F.col("x.w").alias("w"), F.slice("dtok", F.col("x.pos") + 1, WORDS).alias("dvals")
    )
    there = spots.select("doc_id", "w").distinct()
    pairs = own.select("item_id", "w", "pos").distinct().join(bounded(seen), "item_id").join(there, ["doc_id", "w"])
    enough = pairs.groupBy("doc_id", "item_id").agg(F.countDistinct("pos").alias("n")).join(bounded(head), "item_id").where(F.col("n") >= share * F.col("n_windows"))
    seen = cut(enough.select("doc_id", "item_id"))
    spots = spots.join(bounded(seen.select("doc_id").distinct()), "doc_id", "left_semi")
    asked = own.select("item_id", "w", F.col("pos").alias("ipos"), F.slice("tok", F.col("pos") + 1, WORDS).alias("ivals"))
    asked = asked.join(bounded(seen), "item_id").distinct()
    hits = spots.join(asked, ["doc_id", "w"]).select("doc_id", "item_id", "ipos", (F.col("dpos") - F.col("ipos")).alias("shift"), "ivals", "dvals")
    slots = (
        hits.select("doc_id", "item_id", "shift", "ipos", F.posexplode(F.arrays_zip("ivals", "dvals")).alias("k", "v"))
        .where(F.substring(template(F.col("v.ivals")), 1, 1) == "#")
        .groupBy("doc_id", "item_id", "shift", F.col("v.ivals").alias("value"))
        .agg(
            F.min("v.dvals").alias("lo"),
            F.max("v.dvals").alias("hi"),
            F.countDistinct(F.col("ipos") + F.col("k")).alias("n_slots"),
        )
        .groupBy("doc_id", "item_id", "shift")
        .agg(
            F.max(F.col("lo") != F.col("hi")).alias("torn"),
            F.sum("n_slots").alias("n_slots"),
            F.sum(F.when(F.col("lo") != F.col("value"), F.col("n_slots")).otherwise(0)).alias("n_changed"),
        )
    )
    fair = hits.select("doc_id", "item_id", "shift", "ipos").distinct().join(slots, ["doc_id", "item_id", "shift"], "left").where("not coalesce(torn, false)")
    matched = fair.groupBy("doc_id", "item_id").agg(F.countDistinct("ipos").alias("n_matched"))
    best = (
        fair.groupBy("doc_id", "item_id", "shift")
        .agg(F.count("*").alias("n"), F.first("n_slots").alias("n_slots"), F.first("n_changed").alias("n_changed"))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("n", "n_slots", "n_changed")).alias("b"))
    )
    return (
        matched.join(best, ["doc_id", "item_id"])
        .join(head, "item_id")
        .where(F.col("n_matched") >= share * F.col("n_windows"))
        .select(
            "doc_id", "item_id", "n_windows", "n_matched",
            F.coalesce("b.n_slots", F.lit(0)).alias("n_slots"), F.coalesce("b.n_changed", F.lit(0)).alias("n_changed"),
        )
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a benchmark item; every column and every other row stays."""
    return without(docs, find_leaks(docs, benchmark))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
