"""Lookups as joins.

Dimensions are joined without a broadcast hint: Spark broadcasts a side that is under
``spark.sql.autoBroadcastJoinThreshold`` by its own size estimate or, with adaptive
execution, by its measured size, and splits hot partitions of a shuffle join otherwise.
Every lookup side has one row per key, so a join never multiplies the postings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vacancia.functions.text import blank_to_null, strip
from vacancia.operators.dedup import first_of_key, keep_first

GRAM = 4  # letters of an entry that are joined before the whole entry is looked for


def one_per_key(dim: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    return dim.groupBy(*key).agg(F.min(value).alias(value))


def lookup_id(df: DataFrame, dim: DataFrame, name: str, out: str, dim_name: str = "name",
              dim_id: str = "id") -> DataFrame:
    """Id of a canonical name; NULL where the dimension has none."""
    side = one_per_key(dim.select(F.col(dim_name).alias(name), F.col(dim_id).alias(out)), [name], out)
    return df.join(side, name, "left")


def city_ids(cities: DataFrame, states: DataFrame, state: str) -> DataFrame:
    """(city_name, city_id) of the cities of one state."""
    of_state = states.where(F.col("name") == state).select(F.col("id").alias("state_id"))
    side = cities.join(of_state, "state_id", "left_semi")
    return one_per_key(side.select("city_name", F.col("id").alias("city_id")), ["city_name"], "city_id")


def listing_ids(listings: DataFrame, functions: DataFrame, job_types: DataFrame,
                office_locations: DataFrame, cities: DataFrame) -> DataFrame:
    """Ids of the canonical names of adapted postings; ``cities`` is what ``city_ids`` gives.

    A name that its dimension lacks gives NULL. Every dimension is small next to the
    postings, and none of the four joins needs the postings laid out anew when Spark can
    send the dimension to them.
    """
    out = lookup_id(listings, functions, "function", "function_id")
    out = lookup_id(out, job_types, "job_type", "job_type_id")
    out = lookup_id(out, office_locations, "office_location", "office_location_id")
    return out.join(cities, "city_name", "left")


def _urls(listings: DataFrame) -> DataFrame:
    return listings.where(F.coalesce("posting_url", F.lit("")) != "")


def match_by_url(incoming: DataFrame, listings: DataFrame, active_only: bool = False) -> DataFrame:
    """``existing_id`` of each posting by its URL; any status, or the active ones of its company."""
    stored = _urls(listings)
    keys = ["posting_url"]
    if active_only:
        stored, keys = stored.where(F.col("job_status") == "active"), ["company_id", "posting_url"]
    side = stored.groupBy(*keys).agg(F.max("id").alias("existing_id"))
    return incoming.join(side, keys, "left")


def match_by_hash(incoming: DataFrame, listings: DataFrame, hash_col: str = "scraping_hash") -> DataFrame:
    stored = listings.where(F.col(hash_col).isNotNull())
    side = stored.groupBy(hash_col).agg(F.min("id").alias("existing_id"))
    return incoming.join(side, hash_col, "left")


def match_either(incoming: DataFrame, stored: DataFrame, first: Sequence[str], second: Sequence[str],
                 stored_id: str = "id", out: str = "existing_id") -> DataFrame:
    """Match on one key or another: lowest stored id over both, as two equi joins."""
    one = stored.dropna(subset=list(first)).groupBy(*first).agg(F.min(stored_id).alias("_by_first"))
    two = stored.dropna(subset=list(second)).groupBy(*second).agg(F.min(stored_id).alias("_by_second"))
    joined = incoming.join(one, list(first), "left").join(two, list(second), "left")
    return joined.withColumn(out, F.least("_by_first", "_by_second")).drop("_by_first", "_by_second")


def new_postings(incoming: DataFrame, listings: DataFrame) -> DataFrame:
    """Postings without a stored URL. Run before any page is parsed."""
    return incoming.join(_urls(listings).select("posting_url"), "posting_url", "left_anti")


def not_seen(listings: DataFrame, incoming: DataFrame, key: str = "posting_url") -> DataFrame:
    """Stored open rows that the snapshot does not have."""
    open_rows = listings.where(F.col("job_status") != "closed")
    return open_rows.join(incoming.select(key), key, "left_anti")


def _grams(low: Column, sizes: Sequence[int]) -> Column:
    """The distinct pieces of a text that have one of the sizes."""

    def of_length(n: int) -> Column:
        starts = F.when(F.length(low) >= n, F.sequence(F.lit(1), F.length(low) - n + 1))
        cut = F.transform(starts, lambda i: F.substring(low, i, F.lit(n)))
        return F.coalesce(cut, F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(*[of_length(n) for n in sizes])))


SPACE_RUN = r"(?U)\s+"  # what separates the words of a text, and the parts of an entry


def _by_rarest(side: DataFrame) -> DataFrame:
    """The entries with a piece of each (``_gram``) and the part of it (``_part``) that holds the piece.

    A part has no white space in it, so a text that has the entry has the part inside one of its
    words. It is the longest part, and the piece of it that fewest entries share; a part below
    ``GRAM`` letters is its own piece, and an entry of white space alone has the empty one.
    """
    parts = F.split("_low", SPACE_RUN)
    longest = F.array_max(F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    own = F.when(F.length("_part") < GRAM, F.array("_part")).otherwise(_grams(F.col("_part"), [GRAM]))
    keyed = side.select("_low", longest.alias("_part"))
    cut = keyed.select("_low", "_part", F.explode(own).alias("_gram"))
    shared = cut.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    return cut.join(shared, "_gram").groupBy("_low", "_part").agg(F.min(F.struct("_n", "_gram"))["_gram"].alias("_gram"))


def _likely(df: DataFrame, text: str, side: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, _low): the entries of which a text has the rarest part inside some word, each once.

    A text makes a row per distinct word, and only words, each once for all texts, are cut into
    pieces. Words that hold no part of any entry end there.
    """
    spread = F.array_distinct(F.concat(F.split(F.lower(F.col(text)), SPACE_RUN), F.array(F.lit(""))))
    words = df.select(*key, F.explode(spread).alias("_word"))
    pieces = F.concat(_grams(F.col("_word"), range(1, GRAM + 1)), F.when(F.col("_word") == "", F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))
    vocabulary = words.select("_word").distinct().select("_word", F.explode(pieces).alias("_gram"))
    held = vocabulary.join(_by_rarest(side), "_gram").where(F.col("_word").contains(F.col("_part"))).select("_word", "_low")
    return words.join(held, "_word").select(*key, "_low").distinct()


def _best(df: DataFrame, text: str, side: DataFrame, key: Sequence[str], rank: Column, out: str) -> DataFrame:
    """``df`` with the ``value`` of the least ``rank`` (a struct that ends with it) of the entries inside the text.

    The likely entries of a text come to it, so a text moves once.
    """
    likely = _likely(df, text, side, key).join(side, "_low")
    entries = likely.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "_low"))).alias("_entries"))
    inside = F.filter("_entries", lambda e: F.col("_text").contains(e["_low"]))
    joined = df.join(entries, list(key), "left").withColumn("_text", F.lower(F.col(text)))
    return joined.withColumn(out, F.get(inside, 0)["rank"]["value"]).drop("_entries", "_text")


def match_dictionary(df: DataFrame, text: str, names: DataFrame, key: Sequence[str], out: str,
                     name: str = "name") -> DataFrame:
    """Longest dictionary name inside a text, case-insensitive; ties by name order.

    ``key`` tells the rows of ``df`` apart. One plan for a dictionary of any size.
    """
    words = names.select(F.col(name).alias("_name")).dropna().distinct().withColumn("_low", F.lower("_name"))
    side = words.where(F.col("_low") != "").groupBy("_low").agg(F.min("_name").alias("_name"))
    return _best(df, text, side, key, F.struct((-F.length("_low")).alias("l"), F.col("_name").alias("value")), out)


def match_rules(df: DataFrame, text: str, rules: DataFrame, dimension: DataFrame, key: Sequence[str],
                out: str) -> DataFrame:
    """First category, by priority, with a keyword in the text, as joins.

    For rule tables too long for one expression. ``rules`` has (priority, category,
    keyword); categories that the dimension lacks cannot win.
    """
    live = rules.join(dimension.select(F.col("name").alias("category")), "category", "left_semi")
    live = live.withColumn("_low", F.lower("keyword")).where(F.col("_low") != "")
    side = live.groupBy("_low").agg(F.min(F.struct("priority", F.col("category").alias("value"))).alias("_rule"))
    return _best(df, text, side, key, F.col("_rule"), out)


def _folded(c: str) -> Column:
    return F.lower(strip(c))


def match_site(postings: DataFrame, sites: DataFrame, posting_col: str, site_col: str,
               out: str = "company_site_id") -> DataFrame:
    """Site of the same company with the same name or address, letter case aside."""
    side = sites.where(blank_to_null(site_col).isNotNull()).select(
        "company_id", _folded(site_col).alias("_site"), F.col("id").alias(out)
    )
    side = one_per_key(side, ["company_id", "_site"], out)
    return postings.withColumn("_site", _folded(posting_col)).join(side, ["company_id", "_site"], "left").drop("_site")


def city_from_site(postings: DataFrame, sites: DataFrame) -> DataFrame:
    """City of the posting, else city of its site."""
    side = sites.select(F.col("id").alias("company_site_id"), F.col("city_id").alias("_site_city"))
    joined = postings.join(side, "company_site_id", "left")
    return joined.withColumn("city_id", F.coalesce("city_id", "_site_city")).drop("_site_city")


def join_metadata(listing: DataFrame, metadata: DataFrame, key: str = "external_job_id", order: Sequence[str] = ()) -> DataFrame:
    """Listing rows with the metadata feed of the same employer; the first entry per id, in ``order``, counts."""
    return listing.join(first_of_key(metadata, [key], order), key, "left")


def company_with_type(companies: DataFrame, types: DataFrame) -> DataFrame:
    """Companies with their type name; a company without a known type is not configured."""
    side = types.select(F.col("id").alias("company_type"), F.col("name").alias("company_type_name"))
    return companies.join(side, "company_type")


def first_labels_of(df: DataFrame, key: Sequence[str], label: str, value: str, order: str) -> DataFrame:
    """First non-empty value per label, for pairs held as rows."""
    return keep_first(df.where(blank_to_null(value).isNotNull()), [*key, label], [order])


def split_required(df: DataFrame, column: str = "job_title") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) by a required field; a rejected row says why."""
    ok = F.coalesce(F.col(column) != "", F.lit(False))
    return df.where(ok), df.where(~ok).withColumn("reason", F.lit(f"missing_{column}"))
