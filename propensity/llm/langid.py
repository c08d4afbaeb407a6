"""Language identification by hierarchical discrimination.

The family of a document's language is predicted first (linear support vector machines, one against the rest);
inside the family, one-versus-one linear machines vote among its closely related languages, margins break ties.
Features are character n-grams of the letters of each word, hashed and averaged over the document, so every
machine's margin is a sum over words and one pass over the text evaluates all of them; see ``subword``.

The machines are trained in numpy on at most ``per_lang`` documents of each learned language (chosen by a hash of
the id; a documented bound). Languages of one family are known for the common codes below; any other language is
a family of its own.

Edge cases: a text that is null or has no letter is ``und`` with score 0; rows with null language teach nothing;
null ids are predicted but never learned from; with a single learned language every text with letters gets it,
with none every text is ``und``; repeated rows are predicted alike; other columns are not read.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.functions.sizing import broadcast_if_bounded
from propensity.llm.subword import Features, TokenScores, token_slices
from propensity.session import materialize

# Families of common language codes.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
BUCKETS, N_MIN, N_MAX = 1 << 15, 1, 3
PER_LANG, EPOCHS, LAMBDA, SEED = 400, 10, 1e-4, 11
FOLDS, HELD_OUT = 3, 1
MAX_BROADCAST_ROWS = 100_000  # languages whose shares are sent to every executor; more are joined by shuffle
UND = "und"
_MARKS = re.compile("\x03+")


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def letters(token: str) -> str:
    """Lower-case letters of a token, other characters as one boundary mark each run; "" without letters."""
    token = token.lower()
    return token if token.isalpha() else _MARKS.sub("\x03", "".join([c if c.isalpha() else "\x03" for c in token])).strip("\x03")


def train_machine(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """A linear machine on unit feature rows: hinge loss, averaged stochastic subgradient steps.

    Classes weigh alike. Rows are averages, so they are scaled by a common factor, not each to unit length."""
    rng = np.random.default_rng(seed)
    w, b, total, total_b = np.zeros(BUCKETS), 0.0, np.zeros(BUCKETS), 0.0
    balance = {s: 0.5 * len(signs) / max(1, (signs == s).sum()) for s in (-1.0, 1.0)}
    n, shrink = 0, 1.0
    last = np.zeros(BUCKETS, np.int64)  # lazy averaging: steps already added per weight
    steps = EPOCHS * len(rows)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            ids, x = rows[k]
            n += 1
            rate = 1.0 / (1.0 + 10.0 * n / steps)
            if signs[k] * (w[ids] @ x + b) < 1:
                total[ids] += (n - last[ids]) * w[ids]
                last[ids] = n
                w[ids] += rate * balance[signs[k]] * signs[k] * x
                b += 0.01 * rate * balance[signs[k]] * signs[k]
            total_b += b
    total += (n + 1 - last) * w
    return total / max(n, 1) * shrink, total_b / max(n, 1)


class Model:
    """``langs`` learned; columns of ``weights``: one per family, then one per pair of languages of a family."""

    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray):
        self.langs, self.weights, self.bias = langs, weights, bias
        self.families: dict[str, list[str]] = {}
        for lang in langs:
            self.families.setdefault(family_of(lang), []).append(lang)
        self.pairs = [(f, a, b) for f, members in self.families.items() for a, b in combinations(members, 2)]

    def predict(self, margins: np.ndarray) -> tuple[str, float]:
        names = list(self.families)
        first = margins[:len(names)]
        family = names[int(np.argmax(first))]
        score = 1 / (1 + np.exp(-2 * np.clip(first.max(), -50, 50))) if len(names) > 1 else 1.0
        members = self.families[family]
        if len(members) == 1:
            return members[0], float(score)
        votes, sums, least = Counter(), Counter(), {}
        for (f, a, b), m in zip(self.pairs, margins[len(names):]):
            if f == family:
                for lang, value in ((a, m), (b, -m)):
                    votes[lang] += value > 0
                    sums[lang] += value
                    least[lang] = min(least.get(lang, np.inf), value)
        best = max(sorted(members), key=lambda x: (votes[x], sums[x]))
        return best, float(score / (1 + np.exp(-2 * np.clip(least[best], -50, 50))))


def sample(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """lang and text of about ``per_lang`` documents of every lang outside the held-out fold (all if there are fewer)."""
    rows = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    scale = 1 << 30
    limits = rows.groupBy("lang").count().select("lang", F.expr(f"least({scale}L, ({scale * per_lang - 1}L + count) div count)").alias("_limit"))
    limits = broadcast_if_bounded(materialize(limits), MAX_BROADCAST_ROWS)
    return rows.join(limits, "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(scale)) < F.col("_limit")).select("lang", "text")


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> Model | None:
    """Learn from text and non-null lang of the documents outside the held-out fold."""
    chosen = sample(docs, per_lang)
    features = Features(BUCKETS, N_MIN, N_MAX, words=False)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for text in batch.column("text"):
                bag = Counter()
                for part in token_slices(text.as_py()):
                    bag.update(map(letters, part))
                i, c = features.counts(bag)
                ids.append(i.astype("<u4").tobytes())
                counts.append(c.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], names=["lang", "ids", "counts"])

    found = chosen.mapInArrow(count, "lang string, ids binary, counts binary").collect()
    found = sorted(((r["lang"], bytes(r["ids"]), bytes(r["counts"])) for r in found if r["ids"]))
    langs = sorted({f[0] for f in found})
    if not langs:
        return None
    data = []
    for _, ids, counts in found:
        c = np.frombuffer(counts, "<f4").astype(np.float64)
        data.append((np.frombuffer(ids, "<u4").astype(np.int64), c / c.sum() * SCALE))
    shell = Model(langs, np.empty((0, 0)), np.empty(0))
    own = np.array([f[0] for f in found])
    own_family = np.array([family_of(x) for x in own])
    weights, bias = [], []
    for k, family in enumerate(shell.families):
        w, b = train_machine(data, np.where(own_family == family, 1.0, -1.0), SEED + k)
        weights.append(w)
        bias.append(b)
    for k, (_, a, b_) in enumerate(shell.pairs):
        at = np.flatnonzero((own == a) | (own == b_))
        w, b = train_machine([data[i] for i in at], np.where(own[at] == a, 1.0, -1.0), SEED + 1000 + k)
        weights.append(w)
        bias.append(b)
    return Model(langs, (np.array(weights).T * SCALE).astype(np.float32), np.array(bias))


#: Averages of hashed n-grams are small; machines see them times this.
SCALE = 20.0


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = None if model is None else TokenScores(Features(BUCKETS, N_MIN, N_MAX, words=False), model.weights, letters)
        for batch in batches:
            if scores is None:
                out = [(UND, 0.0)] * batch.num_rows
            else:
                out = [(model.predict(sums / n + model.bias) if n else (UND, 0.0))
                       for sums, n, _ in scores.documents(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
