"""Landed feeds: JSON documents, HTML pages, parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vacancia import schema as S
from vacancia.functions.text import blank_to_null, col, file_kind
from vacancia.operators.dedup import first_of_key


def read_documents(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """JSON documents with an explicit schema; no inference pass over the files."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def parse_documents(df: DataFrame, text: str, schema: str) -> DataFrame:
    """The same documents held as a text column of a table; other columns stay."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.from_json(F.col(text), schema).alias("_doc")).select(*rest, "_doc.*")


def landed_texts(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """(file, text) of landed JSON: a document per line, or per file."""
    return spark.read.text(path, wholetext=multi_line).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def split_documents(df: DataFrame, text: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(documents, quarantine): parsed documents, and the texts that are not such documents, with a reason.

    A page that was cut off, is empty, or has a value of another type than the schema's is in
    the quarantine as a whole, with all other columns of its row, and not a document of NULLs.
    """
    rest = [c for c in df.columns if c != text]
    whole = T.DataType.fromDDL(schema)
    blank = blank_to_null(text).isNull()
    if isinstance(whole, T.StructType):
        kind = T.StructType([*whole.fields, T.StructField("_corrupt", T.StringType())])
        marked = df.withColumn("_doc", F.from_json(F.col(text), kind, {"columnNameOfCorruptRecord": "_corrupt"}))
        broken, fields = blank | F.col("_doc").isNull() | F.col("_doc._corrupt").isNotNull(), [f"_doc.`{f.name}`" for f in whole.fields]
    else:
        marked = df.withColumn("_doc", F.from_json(F.col(text), whole))
        broken, fields = blank | F.col("_doc").isNull(), [F.col("_doc").alias("documents")]
    marked = marked.withColumn("_broken", broken)
    reason = F.when(blank, "empty").otherwise("malformed").alias("reason")
    return marked.where(~F.col("_broken")).select(*rest, *fields), marked.where("_broken").select(*rest, text, reason)


def variant_level(nodes: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(keep, path, value) of everything directly inside objects and arrays of any shape."""
    inside = nodes.sparkSession.tvf.variant_explode(F.col("value").outer()).toDF("_at", "_name", "_inner")
    return nodes.lateralJoin(inside).select(
        *keep, F.concat("path", F.array(F.struct(F.col("_at").alias("pos"), F.col("_name").alias("key")))).alias("path"), F.col("_inner").alias("value"))


def postings_of_any_shape(df: DataFrame, text: str, key: Sequence[str], fields: dict[str, Sequence[str]], title: str = "title", depth: int = 4) -> DataFrame:
    """Postings of JSON documents whose shape nobody declared: (key, pos, fields).

    A posting is an object of a list, at most ``depth`` containers deep, that has one of the names
    of its ``title``; ``fields`` has the names by which sources call each field, tried in order.
    Of the lists of a document the first that is least deep counts. ``key`` tells documents
    apart. A text that is no JSON has no postings.
    """
    nodes = df.select(*key, F.array().cast("array<struct<pos:int,key:string>>").alias("path"), F.try_parse_json(F.col(text)).alias("value"))
    found = []
    for level in range(1, depth + 1):
        nodes = variant_level(nodes, key)
        listed = nodes.where(F.element_at("path", -1)["key"].isNull() & F.schema_of_variant("value").startswith("OBJECT"))
        values = {f: F.coalesce(*[F.try_variant_get("value", f"$['{n}']", "string") for n in names]) for f, names in fields.items()}
        rows = listed.select(*key, F.lit(level).alias("_level"), F.transform(F.slice("path", 1, level - 1), lambda p: p["pos"]).alias("_list"), F.element_at("path", -1)["pos"].alias("pos"), *[v.alias(f) for f, v in values.items()])
        found.append(rows.where(F.col(title).isNotNull()))
    every = reduce(DataFrame.unionByName, found)
    first = every.groupBy(*key).agg(F.min(F.struct("_level", "_list")).alias("_first"))
    chosen = every.join(first, list(key)).where(F.struct("_level", "_list") == F.col("_first"))
    return chosen.select(*key, "pos", *fields)


def filters_of_any_shape(df: DataFrame, text: str, key: Sequence[str]) -> DataFrame:
    """(key, name, value, kind) of stored search filters with any names: a list gives a row per entry."""
    root = df.select(*key, F.array().cast("array<struct<pos:int,key:string>>").alias("path"), F.try_parse_json(F.col(text)).alias("value"))
    named = variant_level(root, key).where(F.element_at("path", -1)["key"].isNotNull())
    lists = F.schema_of_variant("value").startswith("ARRAY")
    single = named.where(~lists).select(*key, "path", "value")
    entries = variant_level(named.where(lists), key)
    rows = single.unionByName(entries).where(F.col("value").isNotNull() & (F.schema_of_variant("value") != "VOID"))
    return rows.select(*key, F.get("path", 0)["key"].alias("name"), F.try_variant_get("value", "$", "string").alias("value"), F.lower(F.schema_of_variant("value")).alias("kind"))


def postings_of(documents: DataFrame, container: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per posting of a document, with its position in the container."""
    spread = documents.select(*keep, F.posexplode(F.col(container)).alias("pos", "_p"))
    return spread.select(*keep, "pos", "_p.*")


def read_workday(documents: DataFrame) -> DataFrame:
    return postings_of(documents, "jobPostings", tuple(c for c in documents.columns if c != "jobPostings"))


def read_fountain(documents: DataFrame) -> DataFrame:
    """Openings of all listing pages that landed."""
    return postings_of(documents, "openings", tuple(c for c in documents.columns if c not in ("openings", "pagination")))


def read_adp(documents: DataFrame) -> DataFrame:
    keep = tuple(c for c in documents.columns if c != "jobRequisitions")
    return postings_of(documents, "jobRequisitions", keep)


def read_assa(documents: DataFrame) -> DataFrame:
    return postings_of(documents, "items", tuple(c for c in documents.columns if c != "items"))


def read_facets(documents: DataFrame, parameter: str = "locations") -> DataFrame:
    """(id, descriptor, count) of the values of one facet, as the source announces them."""
    groups = documents.select(F.explode("facets").alias("g")).where(F.col("g.facetParameter") == parameter)
    return groups.select(F.explode("g.facets").alias("f")).select("f.*")


def first_container(*candidates: Column | str) -> Column:
    """First candidate array that is there and not empty."""
    picks = [F.when(F.size(col(c)) > 0, col(c)) for c in candidates]
    return F.coalesce(*picks)


def read_binary_kinds(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Landed attachments with the kind their first bytes tell."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", file_kind("content").alias("kind"))


def saved_filters(df: DataFrame, text: str = "filters") -> DataFrame:
    """Stored search filters as columns."""
    return parse_documents(df, text, S.SAVED_FILTERS)


def with_source_config(feed: DataFrame, config: DataFrame, source: str = "source", order: Sequence[str] = ()) -> DataFrame:
    """Configuration of each posting's source, the first one in ``order``; a source without one is an error row."""
    out = feed.join(first_of_key(config, [source], order), source, "left")
    return out.withColumn("config_error", F.when(F.col("jobboard").isNull(), F.lit("unknown_source")))
