"""The queries of this package, next to the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from vacancia.llm import chat, decontaminate, forest, interpolation, language, ledger, merkle, pieces, prefix_trie, quality, resync, substring, suffixes
from vacancia.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.interpolated_scores(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.joined_classes(table(spark, sf_dir, "documents"))


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_predictions(table(spark, sf_dir, "documents"))


def op4_substring_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_digest(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip_digest(table(spark, sf_dir, "documents"))


def op6_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op7_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.suffix_digest(table(spark, sf_dir, "documents"))


def op8_benchmark_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("matches")  # the longest matches and their locations stay with the operator


def op9_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    control = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.window_digest(chat.chat_windows(turns.unionByName(control)))


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.secret_digest(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digest(table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resync.token_counts(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    by_name = {
        f.__name__: f
        for f in (
            op1_deleted_interpolation, op2_ngram_jaccard_join, op3_language_mixture, op4_substring_doubling, op5_sentencepiece,
            op6_adaptive_quality, op7_suffix_arrays, op8_benchmark_suffixes, op9_chat_windows, op10_secret_ledger,
            op11_prefix_trie, op12_merkle_manifest, op13_token_counts,
        )
    }
    return {**by_name, "pipeline": corpus_pipeline.run}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# exact links by an inverted index of shingles; classes are what is reached over links
_JACCARD = f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
    sets AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(0, greatest(len(ws) - 4, least(len(ws), 1))),
                    lambda i: md5(array_to_string(ws[i + 1 : i + 5], ' '))))) AS g FROM w),
    s AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM sets),
    near AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
             GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= CAST(0.8 AS DOUBLE) * (a.n + b.n - count(*))),
    reach AS (SELECT x, y FROM near UNION SELECT r.x, n.y FROM reach r JOIN near n ON r.y = n.x),
    class AS (SELECT x, min(y) AS least_id FROM reach GROUP BY 1), links AS (SELECT x, count(*) AS n FROM near GROUP BY 1)
    SELECT doc_id, least(doc_id, coalesce(least_id, doc_id)) AS class_id, coalesce(links.n, 0) AS n_links,
           CASE WHEN len(g) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY g) END AS copy_of
    FROM sets LEFT JOIN class ON class.x = doc_id LEFT JOIN links ON links.x = doc_id
"""

_SUBSTRING = f"""
    WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
    pos AS (SELECT doc_id, unnest(range(0, greatest(len(ws) - 19, 0))) AS i,
                   unnest(list_transform(range(0, greatest(len(ws) - 19, 0)), lambda i: md5(array_to_string(ws[i + 1 : i + 20], ' ')))) AS h FROM w),
    firsts AS (SELECT h, min({{'d': doc_id, 'i': i}}) AS f FROM pos GROUP BY 1 HAVING count(*) > 1),
    hit AS (SELECT doc_id, i FROM pos JOIN firsts USING (h) WHERE {{'d': doc_id, 'i': i}} > f),
    gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(range(i, i + 20)) AS k FROM hit) GROUP BY 1)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
           sha256(array_to_string(CASE WHEN ks IS NULL THEN ws ELSE list_filter(ws, lambda x, k: NOT list_contains(ks, k - 1)) END, ' ')) AS kept_sha256
    FROM w LEFT JOIN gone USING (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_HITS = f"""
    WITH w AS (SELECT doc_id, {_ALNUM} AS ws FROM documents), b AS (SELECT item_id, {_ALNUM} AS ws FROM benchmark),
    items AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(len(ws), 10) AS n,
                     unnest(list_transform(range(0, len(ws) - least(len(ws), 10) + 1), lambda i: md5(array_to_string(ws[i + 1 : i + least(len(ws), 10)], ' ')))) AS h
              FROM b WHERE len(ws) > 0),
    sizes AS (SELECT DISTINCT n FROM items),
    pos AS (SELECT doc_id, n, unnest(range(0, greatest(len(ws) - n + 1, 0))) AS i,
                   unnest(list_transform(range(0, greatest(len(ws) - n + 1, 0)), lambda i: md5(array_to_string(ws[i + 1 : i + n], ' ')))) AS h FROM w, sizes),
    hit AS (SELECT doc_id, pos.n, i, item_id FROM pos JOIN items ON pos.h = items.h AND pos.n = items.n),
    words AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY 1),
    found AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS ids FROM hit GROUP BY 1)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
           sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, words.n IS NOT NULL AS contaminated
    FROM w LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


# the unsigned crc32 of a decimal number, bit by bit
_CRC32 = """xor(CAST(4294967295 AS UBIGINT), list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS UBIGINT))),
    lambda crc, ch: list_reduce(list_prepend(xor(crc, ch), list_transform(range(8), lambda k: CAST(k AS UBIGINT))), lambda c, k: xor(c >> 1, (c & 1) * CAST(3988292384 AS UBIGINT)))))"""

# every node is the list of its turns, named by a digest of them; what lies below a node is found over its first member
_TRIE = f"""
    WITH turns AS (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
    h AS (SELECT c, own, CAST({_CRC32.format("c")} % 4 AS BIGINT) AS h FROM turns),
    convs AS (SELECT h.c, list_concat(coalesce(b.own[1 : h], []), h.own[h + 1 :]) AS ts FROM h LEFT JOIN turns b ON b.c = h.c - h.c % 20),
    spread AS (SELECT c, len(ts) AS n, unnest(range(0, len(ts) + 1)) AS d, ts FROM convs),
    named AS (SELECT c, d, d = n AS ends, md5(CAST(to_json(ts[1 : d]) AS VARCHAR)) AS p, CASE WHEN d > 0 THEN md5(CAST(to_json(ts[1 : d - 1]) AS VARCHAR)) END AS up,
                     CASE WHEN d > 0 THEN len(regexp_extract_all(ts[d].t, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS words FROM spread),
    node AS (SELECT d, p, up, min(c) AS c, count(*) AS n, max(words) AS words, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM named GROUP BY 1, 2, 3),
    kids AS (SELECT d - 1 AS d, up AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
    every AS (SELECT node.*, coalesce(kids.n, 0) AS kids FROM node LEFT JOIN kids USING (d, p)),
    sums AS (SELECT a.d, a.p, count(*) FILTER (x.kids = 0) AS leaves, sum((x.n - 1) * x.words) AS spared FROM every x JOIN named a ON a.c = x.c AND a.d <= x.d GROUP BY 1, 2)
    SELECT e.c AS conv_id, e.d AS depth, up.c AS parent_conv_id, e.n AS n_convs, e.kids AS n_children, s.leaves AS n_leaves, CAST(s.spared AS BIGINT) AS saved_tokens, e.ends_sha256
    FROM every e JOIN sums s ON s.d = e.d AND s.p = e.p LEFT JOIN node up ON up.d = e.d - 1 AND up.p = e.up
"""


def _manifest_sql(heights: int = 6) -> str:
    """Sixteen to the power of ``heights`` rows per source, and sources."""

    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    changed = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [f"""leaves AS (SELECT doc_id, source, {leaf("text")} AS leaf, coalesce({_CRC32.format("doc_id")} % 5 = 0, false) AS hit, CASE WHEN hit THEN {leaf(changed)} ELSE leaf END AS changed FROM documents),
    s0 AS (SELECT *, source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS size, leaf AS digest FROM leaves)"""]

    def up(name: str, k: int) -> str:
        run = f"PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN"
        return f"""{name}{k}x AS (SELECT g, i, size, digest, CASE WHEN size > 1 THEN coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
            CASE WHEN size > 1 THEN coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r FROM {name}{k}),
        {name}{k + 1} AS (SELECT g, i // 16 AS i, CAST(ceil(max(size) / 16) AS BIGINT) AS size, CASE WHEN max(size) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest FROM {name}{k} GROUP BY 1, i // 16)"""

    def joined(name: str, first: str) -> str:
        return "\n".join(f"JOIN {name}{k}x AS {name}{k}y ON {name}{k}y.g IS NOT DISTINCT FROM {first}.g AND {name}{k}y.i = {first}.i // {16**k}" for k in range(heights))

    steps += [up("s", k) for k in range(heights)]
    steps += [f"t0 AS (SELECT 0 AS g, g AS source, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS i, count(*) OVER () AS size, digest FROM s{heights})"]
    steps += [up("t", k) for k in range(heights)]
    sides = [f"s{k}y" for k in range(heights)] + [f"t{k}y" for k in range(heights)]
    # a run of one node is hashed by itself, a group of one node is not
    proof = " || ".join(f"{x}.l || {x}.r" for x in sides)
    steps += [f"""paths AS (SELECT s0.doc_id, s0.leaf, t0.digest AS subroot, (SELECT digest FROM t{heights}) AS root, {proof} AS proof, {", ".join(f"{x}.l AS {x}l, {x}.r AS {x}r, {x}.size AS {x}n" for x in sides)}, s0.changed AS f0
        FROM s0 {joined("s", "s0")} JOIN t0 ON t0.source IS NOT DISTINCT FROM s0.source {joined("t", "t0")})"""]
    for k, x in enumerate(sides):
        steps.append(f"f{k + 1}s AS (SELECT *, CASE WHEN {x}n > 1 THEN sha256({x}l || f{k} || {x}r) ELSE f{k} END AS f{k + 1} FROM {'paths' if not k else f'f{k}s'})")
    last = len(sides)
    return f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f{last} AS folded_root, f{last} = root AS verified FROM f{last}s"


def oracles() -> dict[str, str]:
    """SQL where it can give the same rows; the other queries are tested against plain versions."""
    return {"op2_ngram_jaccard_join": _JACCARD, "op4_substring_doubling": _SUBSTRING, "op8_benchmark_suffixes": _HITS, "op11_prefix_trie": _TRIE, "op12_merkle_manifest": _manifest_sql()}
