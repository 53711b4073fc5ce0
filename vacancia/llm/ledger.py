"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds the
pairs (blob, rule version) that were scanned, and the findings of each. A scan reads only the
pairs the ledger lacks, each blob once however many paths and versions hold it, and findings
are joined back to all paths by blob. Only native expressions run: a rule's matches and the
pieces between them give its spans as running sums of lengths, one short row per match.

Defined cases: a null text is the empty blob, which has no findings; repeated rows each give
a row; positions are code points, the end exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import saved

RULE_VERSION = 3  # not 2, which the tests take for a version no ledger holds
INCREMENTS = 2  # in which the query's documents arrive

# Fixed patterns: the base kinds, then kinds this scan adds. Each is (kind, cheap test, pattern,
# captured group to measure, least length of it). Runs shorter than the least length need
# not be matched to be dropped where a pattern is a single greedy run.
# A private key runs to its END line. Where another marker or the text's end comes first, it is
# the header's fields and the lines of base64 behind it, the last of them short.
_BREAK, _BASE64 = "(?:[\\s>\"',]|\\\\+[nrt])", "[A-Za-z0-9+/=]"
_KEY_HEAD = "-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
_KEY_ENDED = "[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
_KEY_CUT = (
    f"(?:{_BREAK}++[A-Z][A-Za-z-]*+:\\x20[^\\r\\n\\\\]*+)*+"
    f"(?:(?:{_BREAK}++{_BASE64}{{20,}}+)++(?:{_BREAK}++{_BASE64}++(?=[\\r\\n\"']|\\\\+[nr]|\\z)){{0,2}}+|{_BREAK}++{_BASE64}++(?={_BREAK}*+(?:\\z|-----)))?+"
)
_ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
RULES = [
    ("assign", "(?i)password|passwd|secret|token|api_?key", _ASSIGN, 1, 6),
    ("access", "AKIA", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24}", "[0-9a-f]{24,}", 0, 24),
    ("private_key", "-----BEGIN", f"{_KEY_HEAD}(?:{_KEY_ENDED}|{_KEY_CUT})", 0, 1),
    ("web_token", "eyJ", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("hosted_token", "gh[pousr]_", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
]
BASE = ["assign", "access", "hex"]

MASK = "[SECRET]"


def blob_name(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def distinct_blobs(versions: DataFrame) -> DataFrame:
    """Each content once. Copies meet in the partial aggregate before anything moves."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return versions.select(blob_name(text).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))


def matches(text: Column, pattern: str, group: int) -> tuple[Column, Column, Column]:
    """A pattern's whole matches, the group measured in each, and the pieces between matches."""
    return (F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
            F.split(text, pattern, -1))


def may_hold(text: Column) -> Column:
    """Whether any rule's cheap test hits: texts that fail all of them have no findings and need not move."""
    return F.coalesce(reduce(lambda a, b: a | b, [text.rlike(test) for _, test, *_ in RULES]), F.lit(False))


def scan_blobs(blobs: DataFrame, rule_version: int = RULE_VERSION) -> DataFrame:
    """Findings of every blob, by every rule; ``blobs`` has blob and text."""
    per_rule = []
    for rank, (kind, test, pattern, group, least) in enumerate(RULES):
        whole, measured, pieces = matches(F.col("text"), pattern, group)
        likely = F.col("text").rlike(test) & F.col("text").rlike(pattern)
        spans = F.transform(
            F.arrays_zip(whole.alias("whole"), measured.alias("measured"), pieces.alias("piece")),
            lambda x, i: F.struct(
                F.lit(rank).alias("rank"), i.alias("i"), F.length(x["piece"]).alias("before"), F.length(x["whole"]).alias("n"),
                (F.length(x["measured"]) >= least).alias("counts"),
            ),
        )
        per_rule.append(F.when(likely, F.filter(spans, lambda x: x["n"].isNotNull())))
    found = F.concat(*[F.coalesce(x, F.array().cast("array<struct<rank:int,i:int,before:int,n:int,counts:boolean>>")) for x in per_rule])
    rows = blobs.select("blob", F.explode(found).alias("m")).select("blob", "m.*")
    upto = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("before") + F.col("n")).over(upto)
    kinds = F.element_at(F.array(*[F.lit(r[0]) for r in RULES]), F.col("rank") + 1)
    return (
        rows.withColumn("stop", stop).where("counts")
        .select("blob", F.lit(rule_version).alias("rule_version"), kinds.alias("kind"), "rank", (F.col("stop") - F.col("n")).alias("start"), "stop")
    )


def unseen(versions: DataFrame, ledger: DataFrame | None, rule_version: int = RULE_VERSION) -> DataFrame:
    """Blobs of these versions that the ledger lacks for this version of the rules."""
    if ledger is None:
        return distinct_blobs(versions)
    seen = ledger.where(F.col("rule_version") == rule_version).select("blob").distinct()
    new = versions.select(blob_name(F.col("text")).alias("blob"), "text").join(seen, "blob", "left_anti")
    return distinct_blobs(new)


def scan_increment(versions: DataFrame, ledger: DataFrame | None = None, rule_version: int = RULE_VERSION) -> tuple[DataFrame, DataFrame]:
    """One run: rows to append to the ledger, and to the findings.

    Every content is named where it lies. Only texts that may hold a finding are moved to
    meet their copies, so that each is scanned once.
    """
    new = unseen(versions.where(may_hold(F.col("text"))), ledger, rule_version)
    entries = versions.select(blob_name(F.col("text")).alias("blob"), F.lit(rule_version).alias("rule_version")).distinct()
    if ledger is not None:
        entries = entries.join(ledger.select("blob", "rule_version").distinct(), ["blob", "rule_version"], "left_anti")
    return entries, scan_blobs(new, rule_version)


def per_blob(findings: DataFrame, rule_version: int = RULE_VERSION) -> DataFrame:
    """One row per blob that has findings: its spans in order, at most as many as its text holds."""
    spans = F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "stop")))
    return findings.where(F.col("rule_version") == rule_version).groupBy("blob").agg(spans.alias("found"))


def findings_by_path(versions: DataFrame, findings: DataFrame, rule_version: int = RULE_VERSION) -> DataFrame:
    """Every row of ``versions`` (without its text) with the spans found in its content."""
    paths = versions.select(*[c for c in versions.columns if c not in ("text", "blob", "found")], blob_name(F.col("text")).alias("blob"))
    return paths.join(saved(per_blob(findings, rule_version), "findings_by_blob"), "blob", "left")


def span_list(found: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    one = F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string")))
    return F.coalesce(F.array_join(one, ","), F.lit(""))


def _of(kind: str):
    return lambda x: x["kind"] == kind


def scanned(versions: DataFrame, increments: int = INCREMENTS, rule_version: int = RULE_VERSION) -> tuple[DataFrame, DataFrame]:
    """The ledger and the findings after all versions arrived, in increments by the hash of their ids.

    Each increment is scanned against the ledger that the ones before have written, so a content
    that was seen is not scanned again, wherever it stands.
    """
    place = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(increments))
    ledger, findings = None, None
    for k in range(increments):
        entries, found = scan_increment(versions.where(place == k), ledger, rule_version)
        # findings first: a run that dies in between scans the increment again and leaves none out
        found = saved(found, "findings")
        entries = saved(entries, "ledger")
        ledger = entries if ledger is None else ledger.unionByName(entries)
        findings = found if findings is None else findings.unionByName(found)
    return ledger, findings


def secret_digest(docs: DataFrame) -> DataFrame:
    """One row per document: spans counted by base kind, and listed."""
    versions = docs.select("doc_id", "text")
    df = findings_by_path(versions, scanned(versions)[1])
    base = F.filter("found", lambda x: x["kind"].isin(*BASE))
    counts = [F.coalesce(F.size(F.filter("found", _of(kind))), F.lit(0)) for kind in BASE]
    counts = [F.greatest(n, F.lit(0)).cast("bigint").alias(f"n_{kind}") for n, kind in zip(counts, BASE)]
    return df.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("found")).alias("spans"))


def masked(docs: DataFrame, mask: str = MASK, rule_version: int = RULE_VERSION) -> DataFrame:
    """The documents, all columns, with a mask in place of every secret; ``n_chars``, if there, counts anew.

    Spans that overlap are one. Only texts with findings are rebuilt, from the pieces between.
    """
    findings = scan_increment(docs.select("text"), rule_version=rule_version)[1]
    before = Window.partitionBy("blob").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    spans = findings.withColumn("covered", F.coalesce(F.max("stop").over(before), F.lit(0))).where(F.col("stop") > F.col("covered"))
    fresh = (F.col("start") > F.col("covered")) | (F.col("covered") == 0)
    cuts = spans.select("blob", F.greatest("start", "covered").alias("start"), "stop", "covered", fresh.alias("fresh"))
    cuts = cuts.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "covered", "fresh"))).alias("cuts"))
    cuts = saved(cuts, "cuts")
    plain = docs.where(~may_hold(docs["text"]))
    some = docs.where(may_hold(docs["text"]))
    joined = some.join(cuts, blob_name(some["text"]) == cuts["blob"], "left")
    text, found = some["text"], cuts["cuts"]
    between = F.transform(
        found,
        lambda x: F.concat(
            F.substring(text, (x["covered"] + 1).cast("int"), (x["start"] - x["covered"]).cast("int")), F.when(x["fresh"], F.lit(mask)).otherwise(F.lit(""))
        ),
    )
    last = F.element_at(found, -1)["stop"]
    rebuilt = F.concat(F.array_join(between, ""), F.substring(text, (last + 1).cast("int"), F.length(text)))
    new = {"text": F.when(found.isNull(), text).otherwise(rebuilt)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(found.isNull(), some["n_chars"]).otherwise(F.length(rebuilt))
    rebuilt_rows = joined.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else some[c] for c in docs.columns])
    return plain.unionByName(rebuilt_rows)
