import hashlib
import re

import pytest
from support import documents, odd_rows

from tillmark.llm import secrets
from tillmark.staging import staging_path

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


HOSTILE = [
    (20, "PassWord='abcdefgh' é token:short secret = " + "Z" * 9), (21, "token=token=abcdefgh"), (22, "AKIA" + "B2" * 8 + " AKIAX"),
    (23, "🙂 " + "0af" * 20 + " " + "a" * 31), (24, "paſſword=abcdefghij toKen=abcdefghij"), (25, "API_KEY" + '"' + "   :   'xx/yy+zz=" + "1" * 40),
    (26, "-----BEGIN RSA PRIVATE KEY-----\nMIIabc\n-----END RSA PRIVATE KEY-----"), (27, "x" * 300_000 + " secret=" + "q" * 20),
]


def scan(spark, df):
    ledger = staging_path(spark, "ledger")
    secrets.update_ledger(spark, df, ledger)
    return secrets.digests(secrets.findings(df, secrets.read_ledger(spark, ledger))).collect()


def test_spans_equal_a_plain_scan(spark):
    rows = odd_rows() + HOSTILE
    got = scan(spark, documents(spark, rows, clashes=True))
    assert len(got) == len(rows)
    want = sorted(((i, hashlib.sha256(brute(t).encode()).hexdigest()) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.base_sha256) for r in got), key=repr) == want
    pem = next(r for r in got if r.doc_id == 26)
    assert pem.spans.startswith("pem:0:")


def test_only_unseen_blobs_and_rule_versions_are_scanned(spark):
    ledger = staging_path(spark, "ledger")
    first = documents(spark, [(1, "token=abcdefghij"), (2, "token=abcdefghij"), (3, "plain")])
    assert secrets.update_ledger(spark, first, ledger) == 2 * len(secrets.RULES)
    again = first.union(documents(spark, [(4, "plain"), (5, "secret=abcdefghij")]))
    assert secrets.update_ledger(spark, again, ledger) == len(secrets.RULES)
    raised = dict(secrets.VERSIONS) | {"hex": 2}
    assert secrets.update_ledger(spark, again, ledger, rules=raised) == 3
    found = {r.doc_id: len(r.secrets) for r in secrets.findings(again, secrets.read_ledger(spark, ledger)).collect()}
    assert found == {1: 1, 2: 1, 3: 0, 4: 0, 5: 1}


def test_masked_texts_hold_no_secret(spark):
    rows = odd_rows() + HOSTILE
    df = documents(spark, rows, clashes=True)
    got = secrets.redact(spark, df, staging_path(spark, "ledger"))
    assert got.columns == df.columns
    kept = got.collect()
    assert len(kept) == len(rows)
    assert not any(len(m[2]) >= 8 for r in kept for m in ASSIGN.finditer(r.text or ""))
    assert [r.text for r in kept if r.doc_id == 9] == [dict(rows)[9]]
    assert all(r.n_chars == len(r.text) for r in kept if r.text is not None)


@pytest.mark.parametrize("rows", [[]])
def test_empty_table(spark, rows):
    assert scan(spark, documents(spark, rows)) == []
    assert secrets.redact(spark, documents(spark, rows), staging_path(spark, "ledger")).collect() == []
