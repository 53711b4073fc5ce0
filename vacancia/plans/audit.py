"""Filter funnel, facet counts and the audit of names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vacancia.functions.text import col
from vacancia.operators.dedup import top_per_group

STAGE_ONE_WORDS = ("tulsa", "locations")  # fixed values


def funnel(df: DataFrame, stage_one: Column, stage_two: Column, reason: Column) -> DataFrame:
    """(stage, accepted, reason, n) over a coarse filter and the check behind it."""
    marked = df.select(stage_one.alias("s1"), stage_two.alias("s2"), reason.alias("reason"))
    counted = marked.groupBy("s1", "s2", "reason").agg(F.count(F.lit(1)).alias("n"))
    one = counted.groupBy(F.lit(1).alias("stage"), F.col("s1").alias("accepted"), "reason").agg(F.sum("n").alias("n"))
    two = counted.where("s1").groupBy(F.lit(2).alias("stage"), F.col("s2").alias("accepted"), "reason").agg(
        F.sum("n").alias("n"))
    return one.unionByName(two)


def funnel_summary(df: DataFrame, stage_one: Column, stage_two: Column) -> DataFrame:
    """Total, passed, confirmed, and the success rate of the coarse filter in percent."""
    s1, s2 = stage_one, stage_one & stage_two
    out = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(s1).alias("accepted"), F.count_if(s2).alias("confirmed")
    )
    rate = F.when(F.col("accepted") > 0, F.col("confirmed") * 100 / F.col("accepted"))
    return (
        out.withColumn("rejected", F.col("total") - F.col("accepted"))
        .withColumn("dropped", F.col("accepted") - F.col("confirmed"))
        .withColumn("success_rate", F.round(rate, 1))
    )


def location_mentions(text: Column | str, words: Sequence[str]) -> Column:
    low = F.lower(F.coalesce(col(text), F.lit("")))
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w.lower())
    return out


def facet_counts(df: DataFrame, facet: str) -> DataFrame:
    """Postings per facet value, by name."""
    return df.groupBy(facet).agg(F.count(F.lit(1)).alias("n")).orderBy(facet)


def with_facet(df: DataFrame, facet: str, allowed: DataFrame, allowed_col: str) -> DataFrame:
    return df.join(allowed.select(F.col(allowed_col).alias(facet)), facet, "left_semi")


def in_scope(df: DataFrame, facet: Column, wanted: Column, text: Column) -> DataFrame:
    """Rows of a source by facet id or, where the source has none, by search term."""
    hit = F.when(wanted["mode"] == "facet", facet == wanted["value"]).when(
        wanted["mode"] == "search", F.contains(F.lower(text), F.lower(wanted["value"])))
    return df.where(F.coalesce(hit, F.lit(False)))


def name_audit(used: DataFrame, dimension: DataFrame, shown: int = 3) -> DataFrame:
    """Names that rules use against the names that exist.

    ``used`` has (table_name, name, place), ``dimension`` (table_name, name). OK, MISMATCH
    for a name that does not exist, unused for one that no rule has. The first places are
    listed, the others counted.
    """
    places = used.select("table_name", "name", "place").distinct()
    counted = places.groupBy("table_name", "name").agg(F.count(F.lit(1)).alias("places"))
    some = top_per_group(places, ["table_name", "name"], [F.col("place")], shown)
    listed = some.groupBy("table_name", "name").agg(
        F.array_join(F.sort_array(F.collect_list("place")), ", ").alias("shown"))
    mine = counted.join(listed, ["table_name", "name"]).withColumn("_used", F.lit(True))
    real = dimension.select("table_name", "name").distinct().withColumn("_real", F.lit(True))
    out = mine.join(real, ["table_name", "name"], "full_outer")
    marker = (
        F.when(F.col("_used").isNull(), "unused").when(F.col("_real").isNull(), "MISMATCH").otherwise("OK")
    )
    more = F.when(F.col("places") > shown, F.concat(F.lit(", +"), (F.col("places") - shown).cast("string"), F.lit(" more")))
    return out.select(
        "table_name", "name", marker.alias("marker"),
        F.coalesce("places", F.lit(0).cast("bigint")).alias("places"),
        F.concat(F.col("shown"), F.coalesce(more, F.lit(""))).alias("shown"),
    )


def mismatch_totals(audit: DataFrame) -> DataFrame:
    return audit.groupBy("table_name").agg(
        F.count_if(F.col("marker") != "unused").alias("names"),
        F.count_if(F.col("marker") == "MISMATCH").alias("mismatches"),
        F.count_if(F.col("marker") == "unused").alias("unused"),
    )


def never_used(dimension: DataFrame, used: DataFrame) -> DataFrame:
    return dimension.select("table_name", "name").subtract(used.select("table_name", "name"))


def not_existing(used: DataFrame, dimension: DataFrame) -> DataFrame:
    return used.select("table_name", "name").distinct().join(dimension, ["table_name", "name"], "left_anti")


def served_and_known(served: DataFrame, cities: DataFrame) -> DataFrame:
    """City names that are served and that the city table has."""
    return served.select("city_name").intersect(cities.select("city_name"))
