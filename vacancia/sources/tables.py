"""Table reads and writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vacancia import schema as S

# Fields that a dry-run report lists first.
REPORT_FIELDS = (
    "job_title", "posting_url", "posting_id", "company_id", "source_job_board", "city_id",
    "date_posted", "date_closed", "job_type", "office_location", "function",
    "minimum_salary", "maximum_salary", "scraping_hash",
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_database_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
                        bounds: tuple[int, int] | None = None, partitions: int = 1,
                        **options: str) -> DataFrame:
    """A table over JDBC, read in parallel ranges of a numeric key when one is given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions),
        )
    return reader.load()


def with_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Empty texts become NULL, then column defaults fill what is NULL or absent."""
    defaults = S.LISTING_DEFAULTS if defaults is None else defaults
    out = []
    for name, kind in df.dtypes:
        c = F.nullif(F.col(name), F.lit("")) if kind == "string" else F.col(name)
        if name in defaults:
            c = F.coalesce(c, F.lit(defaults[name]).cast(kind))
        out.append(c.alias(name))
    out += [F.lit(v).alias(k) for k, v in defaults.items() if k not in df.columns]
    return df.select(*out)


def to_canonical(df: DataFrame, schema: str = S.LISTINGS) -> DataFrame:
    """Any subset of columns to the canonical listing columns and types."""
    have = set(df.columns)
    cols = []
    for f in T.StructType.fromDDL(schema).fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        is_amount = f.dataType.typeName() == "decimal"
        cols.append((c.try_cast(f.dataType) if is_amount else c.cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """All employers' adapted feeds in one frame, whatever columns each of them has."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out


def current_version(spark: SparkSession, root: str) -> int:
    """The last version that was committed, 0 before the first."""
    try:
        commits = spark.read.schema("version bigint").parquet(f"{root}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return commits.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def commit_tables(spark: SparkSession, root: str, whole: dict[str, DataFrame], appended: dict[str, DataFrame] | None = None) -> int:
    """Write a new version of the tables under ``root`` and then make it the current one.

    ``whole`` tables are replaced, ``appended`` ones grow by these rows. Plans may read the
    current version while the next one is written, as no file of it is touched. The version
    counts from the one row that is written last: a run that dies before leaves the tables
    as they were, and the next run writes over what it left. One writer at a time.
    """
    version = current_version(spark, root) + 1
    for name, df in {**whole, **(appended or {})}.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/version={version}")
    spark.range(version, version + 1).select(F.col("id").alias("version")).coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return version


def read_whole(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A replaced table, as of the current version."""
    return spark.read.parquet(f"{root}/{name}/version={current_version(spark, root)}")


def read_appended(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A growing table: the rows of all versions up to the current one."""
    return spark.read.parquet(f"{root}/{name}").where(F.col("version") <= current_version(spark, root)).drop("version")


def read_listings(spark: SparkSession, root: str, company_id: int | None = None) -> DataFrame:
    """The listings, or those of one company: only files whose range of companies holds it are read."""
    out = read_whole(spark, root, "listings")
    return out if company_id is None else out.where(F.col("company_id") == company_id)


def write_listings(df: DataFrame, root: str, company_id: int | None = None) -> int:
    """Make ``df`` the listings, or the listings of one company, as a new version.

    Rows are laid out in ranges of company and id: a company is in few files, and one that
    owns most rows is spread over many.
    """
    if company_id is not None:
        others = read_listings(df.sparkSession, root).where(~F.col("company_id").eqNullSafe(F.lit(company_id)))
        df = others.unionByName(df.where(F.col("company_id") == company_id))
    laid_out = df.repartitionByRange("company_id", "id").sortWithinPartitions("company_id", "id")
    return commit_tables(df.sparkSession, root, {"listings": laid_out})


def save_bucketed(df: DataFrame, table: str, buckets: int = 512, key: str = "id") -> None:
    """Keep a table bucketed by the merge key: later merges do not shuffle the stored side."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def append_run_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def names_of(table: DataFrame, column: str = "name", most: int = 10_000) -> list[str]:
    """The names of a small table (served cities, functions), for the adapters that take them.

    They become part of an expression; a table of more than ``most`` rows belongs in a join
    (``resolve.match_dictionary``) and is an error here.
    """
    rows = table.select(column).dropna().distinct().orderBy(column).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} names: join them instead")
    return [r[0] for r in rows]


def rules_of(table: DataFrame, most: int = 10_000) -> list[tuple[str, list[str]]]:
    """The ordered keyword rules of a table (priority, category, keyword)."""
    rows = table.select("priority", "category", "keyword").orderBy("priority", "category", "keyword").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} keywords: join them with resolve.match_rules")
    out: dict[tuple, list[str]] = {}
    for r in rows:
        out.setdefault((r.priority, r.category), []).append(r.keyword.lower())
    return [(category, words) for (_, category), words in out.items()]


def dry_run_rows(staged: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows a run would write, known fields first, other fields after them.

    Every posting counts as new. ``limit`` ends the run early, as the report option does.
    """
    first = [c for c in REPORT_FIELDS if c in staged.columns]
    rest = [c for c in staged.columns if c not in first and c != "job_description"]
    last = ["job_description"] if "job_description" in staged.columns else []
    out = staged.select(*first, *rest, *last)
    return out if limit is None else out.limit(limit)


def write_dry_run(staged: DataFrame, path: str, limit: int | None = None) -> None:
    dry_run_rows(staged, limit).write.mode("overwrite").json(path)
