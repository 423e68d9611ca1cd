"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only the document is labelled. Each sentence has a score
``p = sigmoid(bias + sum of its distinct words' scores)``, and the document's is their
noisy-or, ``1 - prod(1 - p)``: one toxic sentence makes the document toxic. The weights are
fitted to document labels through the noisy-or, so the sentence scores, never labelled
themselves, then locate the offending sentences.

A word's score is the sum of the weights of its hashed character n-grams (with word ends)
and of the word itself, so unseen forms of a known stem score too, and a word is scored
once and kept in a bounded cache. Letter runs of any length count whole (scripts without spaces
make long ones); those above ``LONG_BYTES`` go by pieces and are not cached. Only features whose document counts tell the classes apart
(log-likelihood ratio of at least ``EVIDENCE``) get a weight, which keeps the chance
n-grams of long texts out of the sums.

Fitting uses a bounded sample of labelled documents (``TRAIN_DOCS`` a class, the first by a
hash of the id, and at most ``TRAIN_WORDS`` words), in one task. Scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hamper.llm.common import stage, trim

BUCKETS = 1 << 24
EVIDENCE = 25.0             # least log-likelihood ratio of a feature
TRAIN_DOCS = 2_500          # labelled documents of each class used for fitting
TRAIN_WORDS = 4_000_000     # their words together (distinct words of each sentence)
ROUNDS = 1_000
PENALTY = 1e-5
THRESHOLD = 0.3
SENTENCE_WORDS = 48         # longer runs without a sentence end are cut there
CACHE_WORDS = 250_000
LONG_BYTES = 96             # longer words (letter runs of scripts without spaces) are taken a piece at a time
PIECE_BYTES = 1 << 16       # and their features are not kept
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> set[int]:
    """Buckets of a lower-cased word: itself and its n-grams of 3 to 6 bytes."""
    w = b"<%b>" % word.encode()
    grams = {w, *(w[i:i + n] for n in range(3, 7) for i in range(len(w) - n + 1))}
    return {zlib.crc32(g) & (BUCKETS - 1) for g in grams}


def is_long(word: str) -> bool:
    return len(word) > LONG_BYTES // 4 and len(word.encode()) > LONG_BYTES


def long_word_features(word: str) -> Iterator[set[int]]:
    """The same buckets of the whole word, by pieces of ``PIECE_BYTES`` (one may come again in a later piece)."""
    w = b"<%b>" % word.encode()
    yield {zlib.crc32(w) & (BUCKETS - 1)}
    for at in range(0, len(w), PIECE_BYTES):
        part = w[at:at + PIECE_BYTES + 5]   # n-grams that begin in the piece end at most 5 bytes behind it
        yield {zlib.crc32(part[i:i + n]) & (BUCKETS - 1) for n in range(3, 7) for i in range(len(part) - n + 1)}


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, distinct words) of each sentence that has words."""
    for m in SENTENCE.finditer(text):
        words = WORD.findall(m[0].lower())
        if len(words) <= SENTENCE_WORDS:
            if words:
                yield m.start(), m.end(), set(words)
            continue
        # a very long sentence: windows of words, with their own places
        places = list(WORD.finditer(m[0]))
        for i in range(0, len(places), SENTENCE_WORDS):
            part = places[i:i + SENTENCE_WORDS]
            yield m.start() + part[0].start(), m.start() + part[-1].end(), {p[0].lower() for p in part}


def telling_features(toxic: np.ndarray, clean: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Features more frequent in toxic documents, by the log-likelihood ratio of their counts
    (``toxic`` and ``clean``: documents with the feature, by bucket; n1 and n0 documents)."""
    feats = np.flatnonzero(toxic)
    a, b = toxic[feats].astype(float), clean[feats].astype(float)
    feats, a, b = (x[a * n0 > b * n1] for x in (feats, a, b))
    rate = (a + b) / (n1 + n0)

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)
    g = 2 * (part(a, n1 * rate) + part(b, n0 * rate) + part(n1 - a, n1 * (1 - rate)) + part(n0 - b, n0 * (1 - rate)))
    return feats[g >= EVIDENCE]


def fit(texts: Iterable[str], labels: Iterable[int], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) by full-batch AdaGrad on the noisy-or's log loss."""
    types: dict[str, int] = {}
    flat, ends = array("i"), array("q", [0])                    # features of each word, one after the other
    token_type, token_sentence, sentence_doc, y = array("i"), array("i"), array("i"), array("i")
    seen_in = {0: np.zeros(BUCKETS, np.int16), 1: np.zeros(BUCKETS, np.int16)}   # documents with a feature
    copies: set[tuple[int, int]] = set()
    for text, label in zip(texts, labels):
        if len(token_type) >= TRAIN_WORDS:
            break
        if (hash(text), label) in copies:   # a copy is no further evidence
            continue
        copies.add((hash(text), label))
        seen: set[int] = set()
        long_words: set[str] = set()
        for _, _, words in sentences(text):
            for w in sorted(words):
                t = types.setdefault(w, len(types))
                if t == len(ends) - 1:
                    if not is_long(w):
                        flat.extend(sorted(word_features(w)))
                    ends.append(len(flat))
                token_type.append(t)
                token_sentence.append(len(sentence_doc))
                seen.add(t)
                if is_long(w):
                    long_words.add(w)
            sentence_doc.append(len(y))
        if seen:
            parts = [flat[ends[t]:ends[t + 1]] for t in seen]
            parts.extend(np.fromiter(f, np.int32, len(f)) for w in long_words for f in long_word_features(w))
            seen_in[label][np.unique(np.concatenate(parts))] += 1
        y.append(label)
    target = np.array(y, float)
    none = np.zeros(0, np.int32), np.zeros(0)
    if not len(sentence_doc) or target.min() == target.max():
        return *none, -4.0 if not target.any() else 4.0
    chosen = telling_features(seen_in[1], seen_in[0], int(target.sum()), int(len(target) - target.sum()))
    del seen_in
    n_types = len(types)
    place = np.full(BUCKETS, -1, np.int32)     # of a feature among the chosen
    place[chosen] = np.arange(len(chosen))
    at = place[np.frombuffer(flat, np.int32) if flat else none[0]]
    owner = np.repeat(np.arange(n_types, dtype=np.int32), np.diff(np.frombuffer(ends, np.int64)))[at >= 0]
    at = at[at >= 0]
    for w, t in types.items():   # long words: only their chosen features are held
        if is_long(w):
            own = {b for f in long_word_features(w) for b in place[np.fromiter(f, np.int32, len(f))].tolist() if b >= 0}
            at = np.concatenate([at, np.array(sorted(own), np.int32)])
            owner = np.concatenate([owner, np.full(len(own), t, np.int32)])
    del place, flat
    kind, sent, doc = (np.frombuffer(x, np.int32) for x in (token_type, token_sentence, sentence_doc))
    telling = np.zeros(n_types, bool)
    telling[owner] = True
    kind, sent = kind[telling[kind]], sent[telling[kind]]   # other words score 0
    share = np.full(len(target), 1.0 / len(target))
    weights, bias, sq_w, sq_b = np.zeros(len(chosen)), -4.0, np.full(len(chosen), 1e-10), 1e-10
    for _ in range(rounds):
        word_score = np.bincount(owner, weights[at], n_types)
        z = bias + np.bincount(sent, word_score[kind], len(doc))
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        log_clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(target))  # log prod(1 - p)
        noisy = np.clip(-np.expm1(log_clean), 1e-12, 1 - 1e-12)
        # d loss / d z of a sentence: p for clean documents, -p * (1 - P) / P for toxic ones
        grad_z = share[doc] * p * np.where(target[doc] > 0, -(1 - noisy[doc]) / noisy[doc], 1.0)
        grad_kind = np.bincount(kind, grad_z[sent], n_types)
        grad = np.bincount(at, grad_kind[owner], len(chosen)) + PENALTY * weights
        grad_b = grad_z.sum()
        sq_w += grad * grad
        sq_b += grad_b * grad_b
        weights -= 0.5 * grad / np.sqrt(sq_w)
        bias -= 0.5 * grad_b / np.sqrt(sq_b)
    return chosen.astype(np.int32), weights, float(bias)


class Scorer:
    """Sentence and document scores under fitted weights, with a bounded cache of word scores."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.cache = dict(zip(features.tolist(), weights.tolist())), bias, {}

    def word(self, w: str) -> float:
        if is_long(w):   # scored whole, not cached
            return math.fsum(self.weights[f] for f in {f for part in long_word_features(w) for f in part if f in self.weights})
        s = self.cache.get(w)
        if s is None:
            weights = self.weights
            s = math.fsum(weights[f] for f in word_features(w) if f in weights)  # in whatever order
            if len(self.cache) < CACHE_WORDS:
                self.cache[w] = s
        return s

    def sentence_scores(self, text: str) -> list[tuple[int, int, float]]:
        found, z = [], []
        for a, b, words in sentences(text):
            found.append((a, b))
            z.append(self.bias + math.fsum(map(self.word, words)))
        p = 1.0 / (1.0 + np.exp(-np.clip(np.array(z, float), -30, 30)))
        return [(a, b, s) for (a, b), s in zip(found, p.tolist())]

    def __call__(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        parts = self.sentence_scores(text)
        clean = np.log1p(-np.minimum([s for *_, s in parts], 1 - 1e-12)).sum() if parts else 0.0
        return float(np.clip(-np.expm1(clean), 0.0, 1.0)), parts


def held_out(id_col: str = "doc_id"):
    """True for rows whose crc32(id as text) mod 4 is 2; a null id is the empty text (remainder 0)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on labelled documents outside the held-out rows.

    ``labels``: doc_id, toxic. Rows with a null id or label are ignored; of several labels of
    one document the largest counts. The sample is bounded (module parameters) and stored by a
    scan in as many tasks as the documents have; fitting is one task over the sample alone, and
    the model that comes back holds the sample's telling features only.
    """
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out())
             .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("y"))
             .withColumn("turn", F.xxhash64(F.lit(5), "doc_id")))
    # the first TRAIN_DOCS of each class in hash order: two bounded top-n selections
    sample = known.where("y = 1").orderBy("turn", "doc_id").limit(TRAIN_DOCS).unionByName(
        known.where("y = 0").orderBy("turn", "doc_id").limit(TRAIN_DOCS))
    # stored, so that all tasks of the documents' scan look for the sample and only it reaches the fit
    rows = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                 .join(F.broadcast(sample), "doc_id").select("turn", "doc_id", "text", "y"), "toxicity-sample")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = list(batches)
        if got:
            # an id whose row repeats in the table counts once
            pdf = pd.concat(got).sort_values(["turn", "doc_id", "text"]).drop_duplicates("doc_id")
            features, weights, bias = fit(pdf["text"].fillna(""), pdf["y"])
        else:
            features, weights, bias = fit([], [])
        got.clear()
        trim()
        yield pd.DataFrame({"features": [features.astype("<i4").tobytes()], "weights": [weights.astype("<f8").tobytes()],
                            "bias": [bias]})
    model = rows.coalesce(1).mapInPandas(run, "features binary, weights binary, bias double").first()
    if model is None:   # nothing labelled: an empty plan has no partition to fit in
        return fit([], [])
    return np.frombuffer(model["features"], "<i4"), np.frombuffer(model["weights"], "<f8"), model["bias"]


def score_documents(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], id_col: str = "doc_id",
                    text_col: str = "text", locate: float = 0.5) -> DataFrame:
    """doc_id, score, offending (start, end, score of sentences scoring at least ``locate``).

    Defined cases: a null or empty text has no sentences and scores 0; very long texts are
    scored sentence by sentence; repeated rows score alike; a null id is kept; other columns take
    no part, whatever their names; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's features
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            scores, spans = [], []
            for t in batch.column(1):
                s, parts = scorer(t.as_py() if t.is_valid else "")
                scores.append(s)
                spans.append([dict(start=a, end=b, score=p) for a, b, p in parts if p >= locate])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, span)],
                                             names=["doc_id", "score", "offending"])
    return rows.mapInArrow(run, f"doc_id {id_type}, score double, "
                                "offending array<struct<start:int,end:int,score:double>>")


def score_column(model: tuple[np.ndarray, np.ndarray, float], spark):
    """The document score as a column function of a text, for filtering whole rows."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(*shared.value)
        for texts in batches:
            yield pd.Series([scorer(t or "")[0] for t in texts], dtype="float64")
        scorer.cache.clear()
        trim()
    return score
