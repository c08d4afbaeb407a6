import hashlib
import random
import re

import pytest

from propensity.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(window, len(w))
        for i in range(len(w) - n + 1):
            wins.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if (own := wins.get(tuple(w[i:i + n]))):
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def check(spark, docs, items, **options):
    a = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, n_words string, spans int")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = d.contamination(a, b, **options).drop("spans", "items").collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(docs, items, options.get("window", 10))


@pytest.mark.parametrize("block", [3, 200_000])
def test_random_texts(spark, block):
    rng = random.Random(4)
    vocabulary = ["a", "b", "C", "é", "9", "z中"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", " - "]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 6, 9]))) for i in range(12)] + [(3, text(5)), (None, text(2)), (40, None), (41, ""), (42, "?!")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)] + [(1, None), (None, text(20)), (2, ""), (2, "")]
    check(spark, docs, items, window=4, block_windows=block)


def test_window_edges(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, "x " + item), (2, " ".join(item.split()[:10])), (3, " ".join(item.split()[:9])), (4, item.upper().replace(" ", " ;; ")),
            (5, " ".join(item.split()[2:]) + " y " + " ".join(item.split()[:10])), (6, "short item"), (7, "a short item here")]
    check(spark, docs, [(1, item), (2, "Short item!")])
    check(spark, docs, [])
    check(spark, [], [(1, item)])


def test_drop_keeps_columns(odd_documents, spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    kept = d.drop_contaminated(odd_documents, bench)
    assert kept.columns == odd_documents.columns
    assert kept.count() == odd_documents.count() - 4
    assert d.drop_contaminated(odd_documents.limit(0), bench).count() == 0
