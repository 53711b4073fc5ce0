"""Get-or-create and updates of the company and site dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from vacancia.functions.dates import moment
from vacancia.functions.text import blank_to_null, slug, strip
from vacancia.operators.dedup import first_of_key
from vacancia.operators.numbering import number_rows, with_new_ids
from vacancia.session import materialise

_CHUNK = 10_000  # candidate suffixes made per row


def unique_slugs(new: DataFrame, stored: DataFrame, name: str = "common_name") -> DataFrame:
    """Free slug for each distinct new name: ``base``, then ``base-1``, ``base-2``, ...

    The k-th new name of a base gets the k-th free suffix: suffixes that stored slugs or
    other new base slugs use are passed over.
    """
    names = materialise(new.select(name).distinct().withColumn("base", slug(name)), "names")
    suffixed = r"^(.*)-([1-9][0-9]*)$"

    def split_off(df: DataFrame, c: str) -> DataFrame:
        return df.where(F.col(c).rlike(suffixed)).select(
            F.regexp_extract(c, suffixed, 1).alias("base"),
            F.regexp_extract(c, suffixed, 2).try_cast("bigint").alias("suffix"),
        ).dropna()

    bases = names.groupBy("base").agg(F.count(F.lit(1)).alias("n_new"))
    taken = (
        stored.select(F.col("slug").alias("base"), F.lit(0).cast("bigint").alias("suffix"))
        .unionByName(split_off(stored, "slug"))
        .unionByName(split_off(bases, "base"))
        .distinct()
        .join(bases, "base", "left_semi")
    )
    sizes = bases.join(taken.groupBy("base").agg(F.count(F.lit(1)).alias("n_taken")), "base", "left")
    last = F.col("n_new") + F.coalesce("n_taken", F.lit(0)) - 1
    chunks = sizes.select("base", last.alias("last")).select(
        "base", "last", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("last") / _CHUNK).cast("bigint"))).alias("c")
    )
    # the chunks of one base are spread out before they are filled
    candidates = chunks.repartition("base", "c").select(
        "base",
        F.explode(F.sequence(F.col("c") * _CHUNK, F.least("last", (F.col("c") + 1) * _CHUNK - 1))).alias("suffix"),
    )
    free = candidates.join(taken, ["base", "suffix"], "left_anti")
    # the candidates are cheaper to make twice than to write
    free = number_rows(free, ["suffix"], ["base"], bucket=(F.col("suffix") / _CHUNK).cast("bigint"), save=False)
    numbered = number_rows(names, [name], ["base"], save=False)
    out = numbered.join(free, ["base", "rn"])
    suffix = F.when(F.col("suffix") > 0, F.concat(F.lit("-"), F.col("suffix").cast("string")))
    return out.select(name, F.concat("base", F.coalesce(suffix, F.lit(""))).alias("slug"))


def checked_companies(stored: DataFrame, wanted: DataFrame, types: DataFrame, default_type: str = "Private Company",
                      order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(companies to make, rejected) of the wanted rows whose name is not stored; one row per name.

    Of several wanted rows with one name the first in ``order`` counts, with all its fields;
    without an order it is the least row. An unknown company type is an error of that row.
    """
    typed = wanted.withColumn("company_type_name", F.coalesce("company_type_name", F.lit(default_type)))
    fields = ["common_name", "website", "jobboard", "company_type_name"]
    missing = typed.select(*fields, *order).join(stored.select("common_name"), "common_name", "left_anti")
    side = types.select(F.col("name").alias("company_type_name"), F.col("id").alias("company_type"))
    checked = first_of_key(missing, ["common_name"], order).join(first_of_key(side, ["company_type_name"]), "company_type_name", "left")
    unknown = F.col("company_type").isNull()
    return checked.where(~unknown), checked.where(unknown).withColumn("reason", F.lit("unknown_company_type"))


def get_or_create_companies(stored: DataFrame, wanted: DataFrame, types: DataFrame, as_of,
                            default_type: str = "Private Company", order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(new companies, rejected) for the wanted (common_name, website, jobboard, company_type_name).

    See ``checked_companies``. Known names are left alone. New companies are approved and
    marked as made by a feed.
    """
    good, rejected = checked_companies(stored, wanted, types, default_type, order)
    good = materialise(good, "new-companies")
    named = good.join(unique_slugs(good, stored), "common_name")
    created = with_new_ids(named, ["common_name"], stored).select(
        "id", "slug", "common_name", "website", "jobboard",
        F.lit(True).alias("approved"), F.lit(True).alias("is_scraped"), "company_type",
        moment(as_of).alias("created_at"),
    )
    return created, rejected


def get_or_create_sites(stored: DataFrame, wanted: DataFrame, by: str = "site_name") -> DataFrame:
    """New sites for (company_id, site_name, address1, city_id) keyed by name or by address.

    Names and addresses compare without letter case; blank keys make no site; stored
    sites are never changed. Of wanted rows with one key the first in name order stays.
    """
    keyed = wanted.where(blank_to_null(by).isNotNull()).withColumn("_key", F.lower(strip(by)))
    have = stored.where(blank_to_null(by).isNotNull()).select("company_id", F.lower(strip(by)).alias("_key"))
    missing = keyed.join(have, ["company_id", "_key"], "left_anti")
    one = missing.groupBy("company_id", "_key").agg(
        F.min(F.struct(strip("site_name").alias("site_name"), "address1", "city_id")).alias("_s")
    ).select("company_id", "_key", "_s.*")
    created = with_new_ids(one, ["company_id", "_key"], stored)
    return created.select("id", "company_id", "site_name", "address1", "city_id", F.lit(True).alias("is_active"))


def update_company(companies: DataFrame, patch: DataFrame, column: str, as_of, order: Sequence[str] = ()) -> DataFrame:
    """New website or job board by id; ``changed`` tells which rows were updated.

    Of several patches of one id the first in ``order`` counts.
    """
    side = first_of_key(patch.select("id", column, *order), ["id"], order).select("id", F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    joined = companies.join(side, "id", "left")
    hit = F.coalesce("_hit", F.lit(False))
    return (
        joined.withColumn(column, F.when(hit, F.col("_new")).otherwise(F.col(column)))
        .withColumn("updated_at", F.when(hit, moment(as_of)).otherwise(F.col("updated_at")))
        .withColumn("changed", hit).drop("_new", "_hit")
    )


def stamp_completion(companies: DataFrame, finished: DataFrame, as_of) -> DataFrame:
    """Companies with the completion time set for those whose cycle is finished."""
    side = finished.select("company_id").distinct().select(F.col("company_id").alias("id"), F.lit(True).alias("_done"))
    joined = companies.join(side, "id", "left")
    stamp = F.when(F.col("_done"), moment(as_of))
    return joined.withColumn(
        "last_full_scrape_completed", F.coalesce(stamp, "last_full_scrape_completed")
    ).drop("_done")
