import hashlib
import random
import re

from propensity.llm import secrets
from propensity.session import shared_path

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    spans = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))
    return (*[sum(f[2] == k for f in found) for k in ("assign", "access", "hex")], hashlib.sha256(spans.encode()).hexdigest(), spans)


def check(df):
    got = sorted((tuple(r) for r in secrets.digest_columns(secrets.scan_secrets(df)).collect()), key=repr)
    want = sorted(((r.doc_id, *brute(r.text)) for r in df.select("doc_id", "text").collect()), key=repr)
    assert got == want
    return got


def test_documents_and_edges(documents, odd_documents, no_documents):
    check(documents)
    got = check(odd_documents)
    assert [g[1:4] for g in got if g[0] == 11] == [(1, 1, 1)]
    assert check(no_documents) == []


def test_random_texts(spark):
    rng = random.Random(2)
    bits = ["password", "PassWd", "ſecret", "toKen", "api_key", "APIKEY", "api__key", "=", ": ", " ", "'", '"', "AKIA", "ABCDEFGHIJKLMNOPQRST", "0123456789abcdef", "deadbeefcafe", "é", "中", "x", "Ab/+=_.-", "\n", "tok"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(400)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_ledger_scans_only_unseen_pairs(spark, documents):
    path = shared_path(spark, "ledger-test")
    half = documents.where("doc_id < 100")
    secrets.update_ledger(half, path)
    n = secrets.read_ledger(spark, path).count()
    blobs = half.select("text").distinct().count()
    assert n == 3 * blobs
    secrets.update_ledger(half, path)
    assert secrets.read_ledger(spark, path).count() == n
    # one rule changes its version: one pair per blob is new
    changed = (*secrets.RULES[:2], secrets.Rule("hex", "[0-9a-f]+", 0, 32))
    secrets.update_ledger(half, path, changed)
    assert secrets.read_ledger(spark, path).count() == n + blobs
    found = secrets.digest_columns(secrets.scan_secrets(documents, path))
    assert sorted(map(tuple, found.collect())) == sorted((r.doc_id, *brute(r.text)) for r in documents.collect())
    assert secrets.read_ledger(spark, path).count() == 3 * documents.select("text").distinct().count() + blobs
