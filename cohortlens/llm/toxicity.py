"""Toxicity by averaged subword embeddings and a linear softmax.

A word is the mean of the embeddings of its character n-grams (3 to 5 bytes
with border marks, hashed to ``BUCKETS``), so unseen misspellings and endings
share vectors with known words. A window of ``WINDOW`` words is the mean of its
words, goes through a linear softmax over the two labels, and a text scores as
its most toxic window: a word in a very long text weighs as in a short one.

Embeddings and softmax are trained jointly in numpy, by Adam on the sample of
labelled texts: first on averages over whole texts, then on each text's most
toxic window. The sample holds up to ``max_docs`` texts, half of them toxic at
most; weights keep the labels' shares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.text import buffers, by_bytes, hash_spans, spans
from cohortlens.sources.sizing import broadcast_if_small
from cohortlens.sources.stage_tables import materialize

BUCKETS = 1 << 17
DIM = 8
WINDOW = 4
MAX_DOCS = 5000
#: Characters of text that the fit holds, and so the driver.
MAX_CHARS = 1 << 26
_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[0x30:0x3A] = np.arange(0x30, 0x3A)
_LETTER[0x61:0x7B] = _LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


class Words:
    """The words of a batch of texts: per token the number of its distinct word,
    per distinct word its n-gram buckets."""

    def __init__(self, column: pa.Array) -> None:
        offsets, raw = buffers(column)
        raw = _LETTER[raw]
        starts, ends, self.first = spans(offsets, raw)
        hashes = hash_spans(raw, starts, ends)
        _, where, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self._grams(raw, starts[where], ends[where])

    def _grams(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        size = ends - starts + 2
        at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        inner = np.arange(at[-1]) - np.repeat(at[:-1], size)
        marked = np.repeat(starts, size) + inner - 1
        text = raw[np.clip(marked, 0, max(len(raw) - 1, 0))] if len(raw) else np.zeros(0, np.uint8)
        text[at[:-1]], text[at[1:] - 1] = 0x3C, 0x3E
        left = np.repeat(at[1:], size) - np.arange(at[-1])
        code = np.zeros(len(text), dtype=np.uint64)
        grams, owner = [], []
        word = np.repeat(np.arange(len(size)), size)
        for n in range(1, 6):
            ok = left >= n
            code[ok] = code[ok] * np.uint64(257) + text[np.flatnonzero(ok) + n - 1]
            if n >= 3:
                grams.append(((code[ok] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) >> np.uint64(40)) % np.uint64(BUCKETS))
                owner.append(word[ok])
        own = np.concatenate(owner)
        order = np.argsort(own, kind="stable")
        self.grams = np.concatenate(grams)[order].astype(np.int64)
        self.count = np.bincount(own, minlength=len(size))

    def logits(self, z: np.ndarray) -> np.ndarray:
        """Per token the mean of its n-grams' values; a word has one n-gram at least."""
        if not len(self.count):
            return np.zeros(0)
        per = np.add.reduceat(z[self.grams], np.concatenate([[0], np.cumsum(self.count)[:-1]]))
        return (per / self.count)[self.word]


def windows(values: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(largest window mean, its first token, its width) per text; of texts without words 0 and no width."""
    n = np.diff(first)
    width = np.minimum(n, width)
    total = np.concatenate([[0.0], np.cumsum(values)])
    begin = np.repeat(first[:-1], np.maximum(n - width + 1, 0) * (n > 0))
    count = (n - width + 1) * (n > 0)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begin
    w = np.repeat(width, count)
    mean = (total[at + w] - total[at]) / np.maximum(w, 1)
    best, place = np.zeros(len(n)), np.zeros(len(n), dtype=np.int64)
    has = count > 0
    if has.any():
        cuts = (np.cumsum(count) - count)[has]
        best[has] = np.maximum.reduceat(mean, cuts)
        hit = np.flatnonzero(mean == np.repeat(best, count))
        owner = np.repeat(np.arange(len(n)), count)[hit]
        _, k = np.unique(owner, return_index=True)
        place[owner[k]] = at[hit[k]]
    return best, place, width


def train(texts: pa.Array, labels: np.ndarray, weight: np.ndarray, epochs: int = 40, seed: int = 0) -> tuple[np.ndarray, float]:
    """(value of each bucket, bias): the trained embeddings through the softmax's difference of the two labels."""
    words = Words(texts)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.log(np.maximum([weight[labels == 0].sum(), weight[labels == 1].sum()], 1e-3))
    params = [table, out, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    n = np.maximum(np.diff(words.first), 1)
    doc = np.repeat(np.arange(len(n)), np.diff(words.first))
    share = weight / weight.sum()
    for epoch in range(1, epochs + 1):
        z = params[0] @ (params[1][:, 1] - params[1][:, 0])
        values = words.logits(z)
        if epoch <= epochs // 4:
            score, start, width = np.bincount(doc, values, len(n)) / n, words.first[:-1], np.diff(words.first)
            score = score * np.minimum(n, 50)  # the sum of short texts, lest the signal fade
            gain = np.minimum(n, 50)
        else:
            score, start, width = windows(values, words.first, WINDOW)
            gain = np.ones(len(n))
        logit = score + params[2][1] - params[2][0]
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        g = share * (p - labels)
        per = g * gain / np.maximum(width, 1)
        if epoch <= epochs // 4:
            token = per[doc]
            by_word = np.bincount(words.word, token, len(words.count))
        else:
            at = np.repeat(start, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            by_word = np.bincount(words.word[at], np.repeat(per, width), len(words.count))
        s = np.bincount(words.grams, np.repeat(by_word / np.maximum(words.count, 1), words.count), BUCKETS).astype(np.float32)
        d = params[1][:, 1] - params[1][:, 0]
        dw = params[0].T @ s
        grads = [np.outer(s, d), np.stack([-dw, dw], axis=1), np.array([-g.sum(), g.sum()])]
        for i, (x, (m, v)) in enumerate(zip(grads, moments, strict=True)):
            m *= 0.9
            m += 0.1 * x
            v *= 0.99
            v += 0.01 * x * x
            params[i] = (params[i] - (0.05 if i else 0.1) * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-9)).astype(params[i].dtype)
    z = params[0] @ (params[1][:, 1] - params[1][:, 0])
    best, _, _ = windows(words.logits(z), words.first, WINDOW)
    scale, shift = _calibrated(best, labels, share)
    return (scale * z).astype(np.float32), shift


def _calibrated(best: np.ndarray, labels: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """Scale and bias of the softmax refitted on the finished embeddings' window means, by Newton steps."""
    x = np.stack([best, np.ones(len(best))], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (share * (p - labels)) + 1e-4 * b * [1, 0]
        curve = (x * (share * (p * (1 - p) + 1e-6))[:, None]).T @ x + np.diag([1e-4, 0])
        step = np.linalg.solve(curve, grad)
        b = b - step * min(1.0, 2 / (np.abs(step).max() + 1e-12))
    return max(float(b[0]), 1e-3), float(b[1])


def _score(z: np.ndarray, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 1 << 22):
            words = Words(batch.column("text"))
            best, _, _ = windows(words.logits(z), words.first, WINDOW)
            p = 1 / (1 + np.exp(-np.clip(best + bias, -30, 30)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return run


def remainder(of: int) -> Column:
    """crc32(doc_id as text) mod ``of``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def training_sample(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(text, y, weight), by hash: labelled texts outside the held-out fold, at most about
    max_docs: by hash of doc_id, half of the bound for each label. A doc_id
    labelled more than once is toxic if any row says so. The chosen ids, whose number
    bounds them, are sent to the texts; beyond the threshold of broadcasts they are joined."""
    fit = labels.where(F.col("toxic").isNotNull() & (remainder(5) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    each = {r["y"]: r["count"] for r in fit.groupBy("y").count().collect()}
    rate = F.lit(0.0)
    for y, n in each.items():
        rate = F.when(F.col("y") == y, F.lit(min(1.0, max_docs / 2 / n))).otherwise(rate)
    fit = fit.withColumn("rate", rate).where((F.xxhash64("doc_id") % 1000003 + 1000003) % 1000003 < F.col("rate") * 1000003)
    chosen = materialize(fit.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"), "rate"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = texts.join(broadcast_if_small(chosen, 40 * chosen.count()), "doc_id")
    sample = joined.select("text", "y", F.try_divide(F.lit(1.0), F.col("rate")).alias("weight"), "doc_id")
    return sample.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).drop("doc_id")


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> tuple[np.ndarray, float]:
    """The trained model, fitted on the driver. The sample comes in the order of a hash,
    so that neither files nor tasks decide what the model sees first, and ends at
    2 * max_docs rows or max_chars of text, one partition at a time."""
    texts, y, weight, size = [], [], [], 0
    for r in training_sample(docs, labels, max_docs).toLocalIterator():
        size += len(r["text"] or "")
        if texts and (size > max_chars or len(texts) == 2 * max_docs):
            break
        texts.append(r["text"])
        y.append(r["y"])
        weight.append(r["weight"])
    if not y or min(y) == max(y):  # one label only: its share, whatever the text
        return np.zeros(BUCKETS, dtype=np.float32), 0.0 if not y else (5.0 if y[0] else -5.0)
    return train(pa.array(texts, pa.string()), (np.array(y) == 1).astype(float), np.array(weight))


def score(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of docs.

    docs needs doc_id and text, labels doc_id and toxic; other columns are no
    inputs. Null and empty texts score as a text without words, by the labels'
    shares. A null doc_id is not held out. Repeated rows are scored each.
    """
    z, bias = fit(docs, labels, max_docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(z.astype(np.float32), bias), "doc_id long, score double, predicted int")
    return rows.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
