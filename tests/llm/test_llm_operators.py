"""Each operator against its plain version, on odd inputs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from vacancia.llm import chat, common, decontaminate, forest, interpolation, language, ledger, pieces, quality, substring, suffixes
from vacancia.llm.flat import arrow_bytes

ROWS = brute.documents()
PAIRS = [(r[0], r[1]) for r in ROWS]
ITEMS = [(1, brute.sentences(99, 80)), (2, "one"), (3, None), (4, ""), (5, brute.sentences(5, 12)), (5, "nothing here"), (None, "12 34"), (10, brute.sentences(7, 40).upper())]


@pytest.fixture(scope="module")
def docs(spark):
    return common.saved(brute.frame(spark, ROWS, extra=True), "docs")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_deleted_interpolation(docs):
    rows = {r.doc_id: r for r in interpolation.interpolated_scores(docs).collect()}
    size, expected = brute.unigram_scores(PAIRS)
    for doc_id, (held_out, n, known, base) in expected.items():
        r = rows[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n, known, size)
        assert r.base_score == pytest.approx(base)
        assert r.score < 0
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_estimates_are_distributions(docs):
    # the weights of every bucket sum to one, and nothing is left to a context never seen
    rows = [type("R", (), {"bucket": b, "bins": [1024 + 8 * k, 1024 + 16 * k], "events": 3})() for b in (1, 2, 5) for k in range(4)]
    share = interpolation.weights(rows, 2)
    assert np.allclose(share.sum(1), 1) and (share >= 0).all() and share[0, 2] == 0


def test_the_query_counts_trigrams(spark):
    # with two alternating successors only the token before last tells what comes
    def text(i):
        words = brute.sentences(i % 5, 30).split()
        return " ".join(w for k in range(len(words) - 1) for w in (words[k], "and", words[k + 1]))

    df = brute.frame(spark, [(i, text(i), "en", "a", None) for i in range(200)])
    asked, pairs = (by_id(interpolation.interpolated_scores(df, *order).where("held_out"), "score") for order in ((), (2,)))
    assert sum(x[0] for x in asked.values()) > sum(x[0] for x in pairs.values()) + 10


def test_no_weight_on_contexts_never_seen():
    rows = [type("R", (), {"bucket": b, "bins": [1024 + 8 * k, 1024 + 16 * k, 1024 + 24 * k], "events": 3})() for b in (0, 1, 63) for k in range(4)]
    share = interpolation.weights(rows, 3)
    assert np.allclose(share.sum(1), 1) and (share >= 0).all()
    assert (share[0, 2:] == 0).all() and share[63, 3] == 0 and share[63, 2] > 0


@pytest.mark.parametrize("block", [256, 2])
def test_jaccard_join(docs, monkeypatch, block):
    monkeypatch.setattr(forest.block_pairs, "__defaults__", (block,))
    found = by_id(forest.joined_classes(docs), "class_id", "n_links")
    assert found == brute.links(PAIRS)


def test_one_of_each(docs):
    kept = forest.one_of_each(docs)
    assert kept.columns == docs.columns
    classes = brute.links(PAIRS)
    assert {r.doc_id for r in kept.collect()} == {d for d, (least, _) in classes.items() if d == least}


def test_one_of_each_keeps_a_repeated_row_once(spark):
    other = [(d, (t or "") + " another", *more) for d, t, *more in ROWS[1:3]]  # the id of another text
    unique = [r for r in ROWS[:20]] + other + [(None, brute.sentences(500, 40), "en", None, 3)]
    once = forest.one_of_each(brute.frame(spark, unique)).collect()
    again = forest.one_of_each(brute.frame(spark, unique + unique[:8] * 2 + unique[-1:])).collect()
    assert sorted(map(str, again)) == sorted(map(str, once)) and len(once) > 10


def test_language_mixture(docs):
    found = by_id(language.language_predictions(docs), "held_out", "lang_pred", "score")
    for doc_id, text, lang, *_ in ROWS:
        held_out, pred, score = found[doc_id]
        assert held_out == (brute.fold(doc_id, 3) == 1)
        if not any(map(str.isalpha, text or "")):
            assert (pred, score) == ("und", 0)
        else:
            assert pred in ("en", "fr") and 0 <= score <= 1
        if doc_id < 60 and lang and doc_id % 4 and doc_id % 5:  # no passage of the other language
            assert pred == lang


def test_mixture_of_two_languages(spark):
    langs = ["en", "fr"]
    plain, french = brute.sentences(1, 300), brute.sentences(2, 300, "être où déjà forêt naïf çà élève très après".split())
    train = spark.createDataFrame([(0, plain, "en"), (1, french, "fr")], "doc_id long, text string, lang string")
    names, logs = language.trained(train)
    assert names == langs
    mixed = " ".join(plain.split()[:100] + french.split()[:50])
    row = language.detected(spark.createDataFrame([(0, mixed)], "doc_id long, text string"), names, logs).first()
    assert row.lang_pred == "en" and row.score == pytest.approx(2 / 3, abs=0.05)


def test_substring_doubling(docs):
    assert by_id(substring.substring_digest(docs), "n_words", "n_removed", "kept_sha256") == brute.word_windows(PAIRS)


@pytest.mark.parametrize("many", [256, 2])
def test_suffix_arrays(docs, monkeypatch, many):
    monkeypatch.setattr(suffixes.repeated_spans, "__defaults__", (suffixes.LENGTH, suffixes.GRAM, many))
    assert by_id(suffixes.suffix_digest(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.byte_strings(PAIRS)


@pytest.mark.parametrize("length,shallow", [(16, 4), (24, 1), (40, 2), (8, 4)])
def test_deep_shallow_sort(length, shallow):
    rng = np.random.default_rng(length)
    buf = rng.integers(97, 99, 3000).astype(np.uint8)
    buf[500:1500] = buf[2000:3000]
    places = np.arange(buf.size - length + 1)
    found = suffixes.repeated_suffixes(buf, places, length, shallow)
    counts = {}
    for i in places.tolist():
        counts.setdefault(buf[i : i + length].tobytes(), []).append(i)
    assert found.tolist() == sorted(i for same in counts.values() if len(same) > 1 for i in same)


def test_benchmark_suffixes(docs, items):
    df = decontaminate.benchmark_matches(docs, items)
    expected = brute.benchmark_hits(PAIRS, ITEMS)
    assert by_id(df, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == expected
    kept = decontaminate.decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, x in expected.items() if not x[4]}


def test_benchmark_in_blocks(docs, items, monkeypatch):
    whole = by_id(decontaminate.benchmark_matches(docs, items), "n_hit", "items_sha256")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    assert by_id(decontaminate.benchmark_matches(docs, items), "n_hit", "items_sha256") == whole


def test_longest_matches(docs, items):
    texts = dict(PAIRS)
    for r in decontaminate.benchmark_matches(docs, items).where("contaminated").collect():
        words = brute.ALNUM.findall(brute.lower(texts[r.doc_id]))
        for m in r.matches:
            options = [brute.ALNUM.findall(brute.lower(t)) for i, t in ITEMS if ("" if i is None else str(i)) == m.item_id]
            assert any(w[m.item_word : m.item_word + m.words] == words[m.doc_word : m.doc_word + m.words] for w in options)


TEXTS = [t or "" for _, t in PAIRS] + ["  a  ▁b ▁▁c", "\n\n\t", " " * 300, "a" * 700, "the" * 200, "😀😀 ́ ﬁ", "<s>x</s><0x41>", "##  ## #"]


def test_pieces_are_the_library_s():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    known = pieces.model(pieces.default_path())
    for texts in (TEXTS, [t for t in TEXTS if "▁" not in t], ["", ""], []):
        ids, counts = known.encode(*arrow_bytes(pa.array(texts, pa.string())))
        ends = np.cumsum(counts)
        decoded, listed = known.decode_all(ids, counts), known.listed(ids, counts)
        assert counts.size == len(texts)
        for k, text in enumerate(texts):
            own = ids[ends[k] - counts[k] : ends[k]]
            assert own.tolist() == library.encode(text)
            assert known.decode(own) == library.decode(own.tolist()) == decoded[k].decode()
            assert listed[k].decode() == ",".join(map(str, own.tolist()))
    rng = np.random.default_rng(3)
    for _ in range(300):  # any ids decode as in the library
        ids = rng.integers(0, 400, rng.integers(1, 20))
        assert known.decode(ids) == library.decode(ids.tolist())


def test_long_words_merge_alike():
    known = pieces.model(pieces.default_path())
    for word in ("▁" + "theinter" * 20, "▁" * 40 + "x", "▁" + "aab" * 50):
        codes = np.array([ord(c) for c in word])
        flat = known.merged(codes, np.array([codes.size]))
        one = known.merged_long(codes)
        assert flat[0].tolist() == one[0].tolist() and flat[1].tolist() == one[1].tolist()


def test_piece_digest_and_round_trip(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    found = by_id(pieces.round_trip_digest(docs), "n_tokens", "ids_sha256", "decoded_sha256")
    rows = docs.select("doc_id", "text", "lang")
    ids = by_id(pieces.encoded(rows), "ids")
    back = by_id(pieces.decoded(pieces.encoded(rows)), "text")
    for doc_id, text in PAIRS:
        want = library.encode(text or "")
        assert found[doc_id] == (len(want), brute.sha(",".join(map(str, want))), brute.sha(library.decode(want)))
        assert ids[doc_id][0] == want and back[doc_id][0] == library.decode(want)


def test_quality(docs):
    found = by_id(quality.judged(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert found == {d: brute.quality(t) for d, t in PAIRS}
    kept = by_id(quality.judged(docs), "base_failed", "kept")
    assert not any(failed and stays for failed, stays in kept.values())


def test_quality_thresholds_adapt(spark):
    # one source writes symbols everywhere: they are no outliers there, but are elsewhere
    rows = [(i, brute.sentences(i, 60) + (" #" * 20 if i % 2 else ""), "en", "marked" if i % 2 else "plain", None) for i in range(500)]
    rows += [(1000, brute.sentences(1, 60) + " #" * 20, "en", "plain", None)]
    kept = by_id(quality.judged(brute.frame(spark, rows)), "kept")
    assert kept[1000] == (False,) and all(kept[i] == (True,) for i in range(500))


@pytest.mark.parametrize("fence", ["mean_word", "symbol_share", "dup_line_share", "repeat_share"])
def test_every_fence_adapts(spark, fence):
    # what all texts of one source have is kept there, and goes where next to no text has it
    def odd(i):
        words = brute.sentences(i, 100).split()
        if fence == "mean_word":
            return " ".join(w + "0" * (i % 3 + 1) for w in words)
        if fence == "symbol_share":
            return " ".join(words) + " #" * 5
        if fence == "dup_line_share":
            return "\n".join([" ".join(words[k : k + 9]) for k in range(0, 99, 9)] + ["the end"] * (3 + i % 3))
        return " ".join(words + words[: 9 + i % 3])

    plain = [(i, brute.sentences(5000, 100), "en", "plain", None) for i in range(400)]
    rows = plain + [(1000 + i, odd(i), "en", "marked", None) for i in range(400)] + [(9999, odd(1), "en", "plain", None)]
    found = by_id(quality.judged(brute.frame(spark, rows)), "kept", "base_failed")
    assert found[9999] == (False, False)
    assert all(found[i] == (True, False) for i in [*range(400), *range(1000, 1400)])


def test_secret_ledger(docs):
    found = by_id(ledger.secret_digest(docs), "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    for doc_id, text in PAIRS:
        want = brute.secrets(text)
        *counts, digest, spans = found[doc_id]
        assert counts == [want.count(f"{k}:") for k in ("assign", "access", "hex")] and digest == brute.sha(want)
        assert ",".join(s for s in spans.split(",") if s.split(":")[0] in ledger.BASE) == want


def test_ledger_scans_only_the_unseen(docs):
    entries, findings = ledger.scan_increment(docs)
    seen = common.saved(entries, "ledger")
    assert ledger.unseen(docs, seen).count() == 0
    assert ledger.scan_increment(docs, seen)[1].count() == 0
    assert ledger.unseen(docs, seen, rule_version=2).count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    half = seen.where(F.crc32("blob") % 2 == 0)
    both = ledger.scan_increment(docs, half)
    assert both[0].unionByName(half).distinct().count() == seen.count()
    assert findings.count() > both[1].count()


def test_masked(docs):
    out = ledger.masked(docs)
    assert out.columns == docs.columns and out.schema["n_chars"] == docs.schema["n_chars"]
    rows = by_id(out, "text", "n_chars")
    for doc_id, text in PAIRS:
        if not brute.secrets(text) and "ghp_" not in (text or ""):
            assert rows[doc_id][0] == text
        else:
            assert ledger.MASK in rows[doc_id][0] and not brute.secrets(rows[doc_id][0]) and rows[doc_id][1] == len(rows[doc_id][0])


LINES = ["MIIEowIBAAKCAQEA7bq" + f"{k:02d}/+" * 11 + "Q" for k in range(5)]
KEYS = [
    "-----BEGIN RSA PRIVATE KEY-----\n{}\nq83vEjRWeJA=\n-----END RSA PRIVATE KEY-----",
    "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,A1B2C3\n\n{}\n-----END RSA PRIVATE KEY-----",
    "-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: GnuPG v2\nComment: a -- b\n\n{}\n=x5Q7\n-----END PGP PRIVATE KEY BLOCK-----",
    "-----BEGIN PRIVATE KEY-----\\n{}\\nq83v==\\n-----END PRIVATE KEY-----",
    "-----BEGIN EC PRIVATE KEY-----\r\n{}\r\nq83vEjRWeJA=",  # the end is missing
    "-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: GnuPG v2\n\n{}\nq83vEjRWeJA=\n=x5Q7",
    "-----BEGIN PRIVATE KEY-----\n{}\nq83vEjRWeJA=",
]


@pytest.mark.parametrize("behind", [" and so on", "\n\nThen comes prose with words of 7 letters.\n-----BEGIN CERTIFICATE-----\nMIIB\n-----END CERTIFICATE-----\n", ""])
def test_whole_private_keys_are_masked(spark, behind):
    ended = [k for k in KEYS if "END" in k]
    some = ended if behind == " and so on" else KEYS
    sep = lambda k: "\\n" if "\\n" in k else "\r\n" if "\r" in k else "\n"
    texts = [f"before {k.format(sep(k).join(LINES))}{behind}" for k in some] + ["two " + ended[0].format("\n".join(LINES)) + "\nand " + ended[2].format("\n".join(LINES)) + behind]
    texts.append("é" * 3 + " -----BEGIN PRIVATE KEY-----\n" + "\n".join(LINES * 4000) + "\n-----END PRIVATE KEY-----" + behind)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = by_id(ledger.masked(df), "text")
    for k in range(len(some)):
        assert out[k] == (f"before {ledger.MASK}{behind}",)
    assert out[len(some)] == (f"two {ledger.MASK}\nand {ledger.MASK}{behind}",) and out[len(some) + 1] == ("é" * 3 + f" {ledger.MASK}{behind}",)
    spans = by_id(ledger.secret_digest(df), "spans")
    assert all(f"private_key:7:{len(texts[k]) - len(behind)}" in spans[k][0].split(",") for k in range(len(some)))


CHATS = [
    *[(1, i, "user" if i % 2 == 0 else "assistant", brute.sentences(i, 30 + i)) for i in range(40)],
    (2, 0, "system", "be brief ### </turn>"), *[(2, i, "assistant" if i % 2 == 0 else "user", brute.sentences(i, 90)) for i in range(1, 30)],
    (3, 0, "assistant", "\\s \\h \\ # < : </turn>\n### user: x"), (3, 0, "assistant", None), (3, 1, None, "no role"), (3, 2, "a:b", ""),
    (4, 5, "assistant", brute.sentences(3, 5000)), (4, 7, "assistant", "after a very long turn"), (None, None, "user", "x"), (None, 1, "assistant", "y"),
    (5, 0, "assistant", "twice"), (5, 0, "assistant", "twice"),
]


def test_chat_windows(spark):
    df = spark.createDataFrame(CHATS, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    windows = common.saved(chat.chat_windows(df.withColumn("window", F.lit("other"))), "windows")
    found = {r.conv_id: r for r in chat.window_digest(windows).collect()}
    talks = {}
    for conv, turn, role, text in sorted(CHATS, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        talks.setdefault(conv, []).append((role or "", text or ""))
    assert set(found) == set(talks)
    for conv, turns in talks.items():
        r, learned = found[conv], "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), brute.sha("".join(f"{role}\n{t}\n" for role, t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), brute.sha(learned))
        assert r.formatted_chars == sum(len(w.text) for w in windows.where(F.col("conv_id").eqNullSafe(conv)).collect())
    second = windows.where("conv_id = 2").orderBy("window").collect()
    assert len(second) > 3 and all("### system: be brief" in w.text for w in second)
    assert all(w.tokens <= chat.BUDGET for w in second) and second[1].repeated >= 2


EMPTY = [
    lambda d, i: interpolation.interpolated_scores(d), lambda d, i: forest.joined_classes(d), lambda d, i: forest.one_of_each(d),
    lambda d, i: language.language_predictions(d), lambda d, i: substring.substring_digest(d), lambda d, i: pieces.round_trip_digest(d),
    lambda d, i: quality.judged(d), lambda d, i: suffixes.suffix_digest(d), lambda d, i: decontaminate.benchmark_matches(d, i),
    lambda d, i: ledger.secret_digest(d), lambda d, i: ledger.masked(d), lambda d, i: decontaminate.decontaminated(d, i),
]


@pytest.mark.parametrize("k", range(len(EMPTY)))
def test_empty_tables(spark, items, k):
    assert EMPTY[k](brute.frame(spark, []), items.limit(0)).count() == 0


@pytest.mark.parametrize("k", range(len(EMPTY)))
def test_rows_without_identity(spark, items, k):
    """Null ids, ids with several texts and repeated rows: a row for every row, copies alike."""
    text = brute.sentences(1, 200)
    rows = [(None, text, None, None, None), (None, None, None, None, None), (1, text, "en", "a", 1), (1, text, "en", "a", 1), (1, text + " more", "en", "a", 1), (2, None, "en", None, None), (2, None, "en", None, None)]
    out = EMPTY[k](brute.frame(spark, rows), items).collect()
    if "class_id" in (out[0].__fields__ if out else []) or "n_words" in out[0].__fields__ or "n_tokens" in out[0].__fields__:
        assert len(out) == len(rows)
    assert len(out) >= 2


def test_empty_conversations(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.window_digest(chat.chat_windows(df)).count() == 0
