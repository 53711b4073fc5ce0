"""The query scans its documents in increments: a content that was seen is not scanned again."""

import pytest
from pyspark.sql import functions as F

import brute
from vacancia.llm import common, ledger


def rows():
    secret = "password = abcdef123456 and AKIA" + "A" * 20
    return [(k, secret if k % 3 else f"{secret} {k // 12}", "en", "s", None) for k in range(60)] + [(None, "token: zzzzzz99", "en", "s", None), (100, None, "en", "s", None)]


@pytest.mark.parametrize("increments", [1, 2, 5])
def test_contents_are_scanned_once_over_all_increments(spark, monkeypatch, increments):
    docs = brute.frame(spark, rows())
    scanned = []

    def counted(blobs, rule_version, scan=ledger.scan_blobs):
        blobs = common.saved(blobs, "scanned")
        scanned.append(sorted(r.blob for r in blobs.select("blob").collect()))
        return scan(blobs, rule_version)

    monkeypatch.setattr(ledger, "scan_blobs", counted)
    entries, findings = ledger.scanned(docs, increments)
    texts = {r[1] or "" for r in rows()}
    held = [b for run in scanned for b in run]
    assert len(scanned) == increments and len(held) == len(set(held)) == len({brute.sha(t) for t in texts if t})
    assert sorted(r.blob for r in entries.collect()) == sorted(brute.sha(t) for t in texts)
    one = ledger.scan_increment(docs)[1]
    assert sorted(map(tuple, findings.collect())) == sorted(map(tuple, one.collect()))


def test_the_query_is_the_same_for_any_increments(spark, monkeypatch):
    docs = brute.frame(spark, rows(), extra=True)
    found = []
    for n in (1, 3):
        monkeypatch.setattr(ledger.scanned, "__defaults__", (n, ledger.RULE_VERSION))
        found.append(sorted(map(tuple, ledger.secret_digest(docs).collect()), key=repr))
    assert found[0] == found[1] and len(found[0]) == 62
