"""The state table in place: parts by company, buckets by URL, and parts written one by one.

A company's rows lie in one part, so a cycle of few companies changes few parts; a part's rows
lie in buckets of their URL, so a company of any size is spread, and a join by URL moves no
stored row. A part is never overwritten: its next copy is written beside it under a label of
its own, and counts from the row that commits the whole cycle. A run that dies leaves the table
as it was, and readers keep the copy that they began with.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacancia.sources.tables import commit_tables, current_version, read_appended

PARTS, BUCKETS = 64, 32


@dataclass(frozen=True)
class Layout:
    """A name in the session's catalog, and how the rows are dealt out; fixed when the table is made."""

    table: str
    parts: int = PARTS
    buckets: int = BUCKETS


def part_of(layout: Layout) -> Column:
    return F.pmod(F.xxhash64("company_id"), F.lit(layout.parts)).cast("int")


def _attached(spark: SparkSession, root: str, layout: Layout, columns: str) -> None:
    """Make the files under ``root`` known to this session as a bucketed table."""
    if not spark.catalog.tableExists(layout.table):
        spark.sql(
            f"CREATE TABLE {layout.table} ({columns}, part INT, copy STRING) USING parquet PARTITIONED BY (part, copy) "
            f"CLUSTERED BY (posting_url) SORTED BY (posting_url) INTO {layout.buckets} BUCKETS LOCATION '{root}/state_parts'")


def _copies(spark: SparkSession, root: str) -> dict[str, list[int]]:
    """The copy that counts of every part: label -> parts. One row for each part is read."""
    try:
        known = read_appended(spark, root, "state_copies")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    out: dict[str, list[int]] = {}
    for r in known.groupBy("part").agg(F.max_by("copy", "number").alias("copy")).collect():
        out.setdefault(r["copy"], []).append(r["part"])
    return out


def read_state(spark: SparkSession, root: str, layout: Layout, columns: str) -> DataFrame:
    """The rows that count, with the ``part`` each lies in; ``columns`` is the schema of the state as DDL."""
    _attached(spark, root, layout, columns)
    copies = _copies(spark, root)
    if copies:
        spark.catalog.recoverPartitions(layout.table)  # other sessions may have written parts since
    wanted = [(F.col("copy") == copy) & F.col("part").isin(parts) for copy, parts in copies.items()]
    return spark.table(layout.table).where(reduce(lambda a, b: a | b, wanted) if wanted else F.lit(False)).drop("copy")


def commit_parts(spark: SparkSession, root: str, layout: Layout, changed: DataFrame, whole: dict[str, DataFrame] | None = None,
                 appended: dict[str, DataFrame] | None = None) -> int:
    """Write the parts that ``changed`` touches, with its rows in place of those of their ids, and commit.

    ``changed`` has the columns of the state and is read twice: it should be saved. The other
    tables go with the same commit (``sources.tables.commit_tables``).
    """
    columns = [c for c in changed.columns if c != "part"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changed.schema.fields if f.name != "part")
    rows = changed.select(*columns, part_of(layout).alias("part"))
    parts = sorted(r[0] for r in rows.select("part").distinct().collect())  # as many as the layout has at most
    stored = read_state(spark, root, layout, ddl).where(F.col("part").isin(parts))
    copy = uuid.uuid4().hex
    ids = rows.select(F.col("part").alias("_part"), F.col("id").alias("_id"))
    kept = stored.join(ids, (stored["part"] == ids["_part"]) & (stored["id"] == ids["_id"]), "left_anti")
    following = kept.select(*columns, "part").unionByName(rows).withColumn("copy", F.lit(copy))
    if parts:
        # one task holds one bucket of every part, which is how the files are dealt out
        dealt = following.repartition(layout.buckets, "posting_url").sortWithinPartitions("part", "posting_url")
        dealt.select(*spark.table(layout.table).columns).write.insertInto(layout.table)
    names = spark.createDataFrame([(part, copy) for part in parts], "part int, copy string")
    number = F.lit(current_version(spark, root) + 1).cast("bigint")
    return commit_tables(spark, root, whole or {}, {"state_copies": names.withColumn("number", number).coalesce(1), **(appended or {})})

