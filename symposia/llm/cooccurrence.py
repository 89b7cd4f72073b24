"""Items that appear together (problem 4), by basket collapsing.

Rows become deduplicated baskets (record -> sorted item array); identical arrays collapse into one basket with a
weight, and pairs are enumerated once per distinct basket and summed by weight. Before that, items that cannot be in
any qualifying pair are taken out of the baskets, which is exact: a pair's count is at most the count of its rarer
item, so an item in fewer than ``min_count`` records cannot reach it, and lift is at most ``n / n_a``, so an item in
more than ``n / min_lift`` records cannot exceed chance enough. The few general concepts that occur in a third of
all records therefore never meet the pair stage. Wide records are laid out in blocks of items before anything is gathered,
and pairs are enumerated a pair of blocks at a time.

Defined results: null or blank uris and rows that name no record are left out; an item counts once per record; a
record with one item counts towards ``n`` only; ties cannot occur (counts are exact); empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.runtime import cut, lookup, read

MIN_COUNT = 5
MIN_LIFT = 3
BLOCK = 256


def record_key(metadata: Column) -> Column:
    """``section|id`` in lower case without padding, from ``origin_key`` or else ``section`` and ``discourse_id``."""
    strip = lambda c: F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    origin = F.regexp_replace(strip(metadata["origin_key"]), r"\s*\|\s*", "|")
    parts = F.concat(strip(metadata["section"]), F.lit("|"), strip(metadata["discourse_id"]))
    whole = lambda c: F.when(c.rlike(r"^[^|]+\|.+$"), c)
    return F.coalesce(whole(origin), whole(parts))


def pair_scores(baskets: DataFrame, min_count: int = MIN_COUNT, min_lift: int = MIN_LIFT, block: int = BLOCK) -> DataFrame:
    """(item_a, item_b, n_ab, n_a, n_b, n, lift, conviction) of (record, item) rows, item_a < item_b."""
    seen = cut(baskets.where("record is not null and item is not null").select("record", "item").distinct())
    n = seen.select("record").distinct().count()
    counts = seen.groupBy("item").agg(F.count(F.lit(1)).alias("n_item"))
    able = counts.where((F.col("n_item") >= min_count) & (F.col("n_item") * min_lift <= n))
    items = cut(able.select("item", "n_item", F.monotonically_increasing_id().alias("id")))
    kept = lookup(seen, items.select("item", "id"), ["item"], "inner")
    # the items of a record are laid out in blocks of their id's hash, so that no row holds more than a block; a record
    # whose items fill one block is a basket as it is, a wider one is a basket per pair of its blocks
    wide = cut(kept.groupBy("record").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > block).select("record", F.ceil(F.col("k") / block * 2).cast("int").alias("parts")))
    lone = kept.join(wide, "record", "left_anti").groupBy("record").agg(F.array_sort(F.collect_list("id")).alias("left")).where(F.size("left") > 1)
    cells = lone.groupBy("left").agg(F.count(F.lit(1)).alias("weight")).select("weight", "left", F.col("left").alias("right"))
    if wide.limit(1).count():
        placed = kept.join(wide, "record").select("record", "parts", "id", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("i"))
        blocks = cut(placed.groupBy("record", "parts", "i").agg(F.array_sort(F.collect_list("id")).alias("ids")))
        left = blocks.select("record", "i", F.col("ids").alias("left"), F.explode(F.sequence("i", F.col("parts") - 1)).alias("j"))
        met = left.join(blocks.select("record", F.col("i").alias("j"), F.col("ids").alias("right")), ["record", "j"])
        # within a block every item meets the later ones; across two, all do, once per distinct pair of blocks
        cells = cells.unionByName(met.groupBy("left", "right").agg(F.count(F.lit(1)).alias("weight")))
    pairs = (
        cells.select("weight", "left", F.explode("left").alias("a"), "right")
        .select("weight", F.col("a").alias("x"), F.explode(F.when(F.col("left") == F.col("right"), F.filter("right", lambda b: b > F.col("a"))).otherwise(F.col("right"))).alias("y"))
        .select("weight", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .groupBy("a", "b")
        .agg(F.sum("weight").alias("n_ab"))
        .where(F.col("n_ab") >= min_count)
    )
    name = lambda s: items.select(F.col("id").alias(s), F.col("item").alias(f"item_{s}"), F.col("n_item").alias(f"n_{s}"))
    scored = lookup(lookup(pairs, name("a"), ["a"], "inner"), name("b"), ["b"], "inner")
    scored = scored.where(F.col("n_ab").cast("decimal(38,0)") * F.lit(n).cast("decimal(19,0)") >= F.col("n_a").cast("decimal(38,0)") * F.col("n_b").cast("decimal(19,0)") * F.lit(min_lift))
    swap = F.col("item_a") > F.col("item_b")
    first = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    out = scored.select(
        first("item_a", "item_b").alias("item_a"),
        first("item_b", "item_a").alias("item_b"),
        "n_ab",
        first("n_a", "n_b").alias("n_a"),
        first("n_b", "n_a").alias("n_b"),
        F.lit(n).cast("bigint").alias("n"),
    )
    confidence = F.col("n_ab") / F.col("n_a")
    return out.withColumns(
        {
            "lift": F.round(F.col("n_ab") * F.col("n") / (F.col("n_a") * F.col("n_b")), 6),
            # conviction of a -> b; null where a never occurs without b (it is unbounded there)
            "conviction": F.when(F.col("n_ab") < F.col("n_a"), F.round((1 - F.col("n_b") / F.col("n")) / (1 - confidence), 6)),
        }
    )


def entity_baskets(spark: SparkSession, base: str) -> DataFrame:
    rows = read(spark, base, "entities").select(record_key(F.col("metadata")).alias("record"), F.col("uri").alias("item"))
    return rows.where("trim(item) <> ''")


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return pair_scores(entity_baskets(spark, base)).select(F.col("item_a").alias("uri_a"), F.col("item_b").alias("uri_b"))


def p4_scores(spark: SparkSession, base: str) -> DataFrame:
    """Every pair seen together more than once, at or below chance as well, with its counts, lift and conviction."""
    return pair_scores(entity_baskets(spark, base), min_count=2, min_lift=0).select(
        F.col("item_a").alias("uri_a"), F.col("item_b").alias("uri_b"), "n_ab", "n_a", "n_b", "n", "lift", "conviction"
    )


_PAIRS = """
with raw as (select uri, regexp_replace(lower(regexp_replace(map_extract_value(metadata, 'origin_key'), '^\\s+|\\s+$', '', 'g')), '\\s*\\|\\s*', '|', 'g') o,
    lower(regexp_replace(map_extract_value(metadata, 'section'), '^\\s+|\\s+$', '', 'g')) || '|' || lower(regexp_replace(map_extract_value(metadata, 'discourse_id'), '^\\s+|\\s+$', '', 'g')) p from entities where trim(uri) <> ''),
seen as (select distinct coalesce(case when regexp_matches(o, '^[^|]+\\|.+$') then o end, case when regexp_matches(p, '^[^|]+\\|.+$') then p end) record, uri from raw),
base as (select * from seen where record is not null),
total as (select count(distinct record) n from base),
c as (select uri, count(*) k from base group by 1),
ab as (select a.uri uri_a, b.uri uri_b, count(*) n_ab from base a join base b on a.record = b.record and a.uri < b.uri group by 1, 2 having count(*) >= 5),
s as (select uri_a, uri_b, n_ab, x.k n_a, y.k n_b, n from ab join c x on x.uri = uri_a join c y on y.uri = uri_b, total where n_ab * n >= 3 * x.k * y.k)
"""
_EVERY = _PAIRS.replace("having count(*) >= 5", "having count(*) >= 2").replace(" where n_ab * n >= 3 * x.k * y.k", "")
ORACLE = {
    "p4_found": _PAIRS + "select uri_a, uri_b from s",
    "p4_scores": _EVERY + "select uri_a, uri_b, n_ab, n_a, n_b, n, round(n_ab * n / (n_a * n_b), 6) as lift, case when n_ab < n_a then round((1 - n_b / n) / (1 - n_ab / n_a), 6) end as conviction from s",
}
