"""Language by the nearest of several TF-IDF n-gram centroids per language.

Texts are lowered, non-letters of ASCII become spaces, and runs of one, two
and three bytes are counted into hashed bins; 1 + log(count) times idf,
normalised, is the text's vector. Spherical k-means clusters each language's
labelled vectors; a text takes the language of the centroid with the largest
cosine. It is rejected when all but about one in a thousand of the language's own
texts with as many different n-grams are nearer, or when it has no letter.

The centroids are fitted on a bounded sample (``max_docs``) of labelled texts.
Document frequencies and the limits of rejection come from all of them: each
text, and cuts of it, which stand for short texts, is measured against centroids
of the half of the sample that it is not in, and counts for its language if none
of another language is nearer.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.text import buffers, by_bytes

BINS = (256, 2048, 4096)
WIDTH = sum(BINS)
MAX_DOCS = 2000
#: Characters of text that the fit holds, and so the driver.
MAX_CHARS = 1 << 26
CENTROIDS = 4
#: Share of a language's own texts beyond its limit.
BEYOND = 0.001
#: Steps of the cosine in a histogram, and of the number of different n-grams (half octaves).
STEPS, KINDS = 256, 2 * WIDTH.bit_length()
#: Texts of a histogram at least (else it takes in those of fewer n-grams), and cuts of a text.
POOL, MOST_CUTS = 1000, 8
#: Texts whose vectors are held at once.
PART = 128
_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def counts(column: pa.Array) -> np.ndarray:
    """(texts x WIDTH) n-gram counts; null and empty texts are zero."""
    offsets, raw = buffers(pc.utf8_lower(column.cast(pa.large_string())))
    raw = _LETTER[raw].astype(np.int64)
    out = np.zeros((len(offsets) - 1, WIDTH), dtype=np.float32)
    two = (raw[:-1] * 251 + raw[1:] * 7) % BINS[1] + BINS[0]
    three = (raw[:-2] * 63001 + raw[1:-1] * 251 + raw[2:] * 13) % BINS[2] + BINS[0] + BINS[1]
    for i, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
        if b > a:
            out[i] = np.bincount(raw[a:b], minlength=WIDTH)
            out[i] += np.bincount(two[a : b - 1], minlength=WIDTH)
            out[i] += np.bincount(three[a : max(a, b - 2)], minlength=WIDTH)
    return out


def vectors(column: pa.Array, idf: np.ndarray) -> np.ndarray:
    return _weighed(counts(column), idf)


def _weighed(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.where(c > 0, 1 + np.log(np.maximum(c, 1)), 0) * idf
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def has_letter(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]  # of each centroid
    least: np.ndarray  # (centroids x KINDS) cosine up to which a text is rejected

    def nearest(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centroid, cosine, step of the number of different n-grams) per text."""
        c = counts(column)
        cos = np.clip(_weighed(c, self.idf) @ self.centroids.T, 0, 1).astype(float)
        best = cos.argmax(axis=1)
        kinds = (2 * np.log2(np.maximum((c > 0).sum(axis=1), 1))).astype(np.int64)
        return best, cos[np.arange(len(best)), best], kinds

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine, rejected) per text."""
        letter = has_letter(column)
        if not self.langs:
            return ["und"] * len(column), np.zeros(len(column)), np.ones(len(column), dtype=bool)
        best, top, kinds = self.nearest(column)
        lang = [self.langs[b] if ok else "und" for b, ok in zip(best, letter, strict=True)]
        return lang, np.where(letter, top, 0.0), ~letter | (top <= self.least[best, kinds])


def clusters(x: np.ndarray, k: int, seed: int = 0, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, cluster of each row) of spherical k-means."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        for j in range(k):
            if (near == j).any():
                m = x[near == j].mean(axis=0)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c, (x @ c.T).argmax(axis=1)


def cut(column: pa.Array, cuts: int) -> list[list[str]]:
    """Of each text, cuts of 8 to 2048 bytes at places that follow from the text."""
    out = []
    for x in column:
        raw = (x.as_py() or "").encode()
        rng, own = zlib.crc32(raw), []
        for _ in range(cuts):
            rng = (rng * 6364136223846793005 + 1442695040888963407) % (1 << 64)
            n = 8 << (rng >> 33) % 9
            if len(raw) > n:
                at = (rng >> 20) % (len(raw) - n)
                own.append(raw[at : at + n].decode(errors="ignore"))
        out.append(own)
    return out


def tally(halves: tuple[Model, Model], column: pa.Array, langs: list[str], half: np.ndarray, cuts: int) -> Counter:
    """Texts and cuts by (language, step of n-grams, step of the cosine), those that are nearest
    to a centroid of their language. ``half`` is the half of the sample that a text would be in."""
    found: Counter = Counter()
    more = cut(column, cuts)
    rows = [(t.as_py(), lang, h) for t, lang, h in zip(column, langs, half, strict=True)]
    rows += [(t, lang, h) for own, lang, h in zip(more, langs, half, strict=True) for t in own]
    for h, model in enumerate(reversed(halves)):
        of = [(t, lang) for t, lang, x in rows if x == h]
        for i in range(0, len(of) if model.langs else 0, PART):
            texts = pa.array([t for t, _ in of[i : i + PART]], pa.large_string())
            best, top, kinds = model.nearest(texts)
            steps = np.minimum((top * STEPS).astype(np.int64), STEPS - 1)
            for (_, lang), b, k, s, ok in zip(of[i : i + PART], best.tolist(), kinds.tolist(), steps.tolist(), has_letter(texts), strict=True):
                if ok and model.langs[b] == lang:
                    found[lang, k, s] += 1
    return found


def limits(seen: np.ndarray) -> np.ndarray:
    """The cosine that all but ``BEYOND`` of a language's texts exceed, by step of n-grams, of a
    (KINDS x STEPS) histogram. Where it has too few texts for that, the tail below the
    tenth is carried on as an exponential one, and a language of fewer than ``POOL`` texts
    gets a limit lower in proportion. No texts give 0."""
    out = np.zeros(KINDS)
    for k in range(KINDS):
        h, lo, hi = seen[k].astype(float), k, k
        while h.sum() < POOL and (lo > 0 or hi < KINDS - 1):
            lo, hi = (lo - 1, hi) if lo > 0 else (lo, hi + 1)
            h = h + seen[lo if hi == k else hi]
        n = h.sum()
        if n:
            below = h.cumsum()
            at = float(np.searchsorted(below, BEYOND * n))
            if BEYOND * n < 10:
                tenth = int(np.searchsorted(below, 0.1 * n))
                mean = (h[: tenth + 1] * (tenth + 1 - np.arange(tenth + 1))).sum() / below[tenth]
                at = min(at, tenth - log(0.1 / BEYOND) * mean)
            out[k] = max(0.0, at / STEPS) * min(1.0, n / POOL)
    return out


def _centroids(x: np.ndarray, langs: np.ndarray, idf: np.ndarray, k: int) -> Model:
    cents, names = [np.zeros((0, WIDTH), dtype=np.float32)], []
    for lang in sorted(set(langs)):
        c, _ = clusters(x[langs == lang], k)
        cents.append(c)
        names += [lang] * len(c)
    return Model(idf, np.concatenate(cents), names, np.zeros((len(names), KINDS)))


def _fitted(texts: pa.Array, langs: np.ndarray, half: np.ndarray, idf: np.ndarray, k: int) -> tuple[Model, tuple[Model, Model]]:
    """The model without limits, and those of the two halves."""
    x = np.empty((len(texts), WIDTH), dtype=np.float32)
    for i in range(0, len(texts), PART):
        p = texts[i : i + PART]
        x[i : i + len(p)] = vectors(p, idf)
    first, second = (_centroids(x[half == h], langs[half == h], idf, k) for h in (0, 1))
    return _centroids(x, langs, idf, k), (first, second)


def _limited(model: Model, found: dict[tuple[str, int, int], int]) -> Model:
    names = {lang: i for i, lang in enumerate(dict.fromkeys(model.langs))}
    seen = np.zeros((len(names), KINDS, STEPS), dtype=np.int64)
    for (lang, kinds, step), n in found.items():
        if lang in names:
            seen[names[lang], kinds, step] += n
    least = np.array([limits(h) for h in seen])
    return Model(model.idf, model.centroids, model.langs, least[[names[x] for x in model.langs]])


def _frequency(column: pa.Array) -> np.ndarray:
    seen = np.zeros(WIDTH, dtype=np.int64)
    for i in range(0, len(column), PART):
        seen += (counts(column[i : i + PART]) > 0).sum(axis=0)
    return seen


def _idf(texts: int, seen: np.ndarray) -> np.ndarray:
    return (np.log((1 + texts) / (1 + seen)) + 1).astype(np.float32)


def _none() -> Model:
    return Model(np.ones(WIDTH), np.zeros((0, WIDTH)), [], np.zeros((0, KINDS)))


def fit_model(texts: pa.Array, langs: np.ndarray, k: int = CENTROIDS) -> Model:
    """Fitted on these texts alone."""
    if len(texts) == 0:
        return _none()
    half = np.arange(len(texts)) % 2
    model, halves = _fitted(texts, langs, half, _idf(len(texts), _frequency(texts)), k)
    return _limited(model, tally(halves, texts, list(langs), half, MOST_CUTS))


def remainder(of: int) -> Column:
    """crc32(doc_id as text) mod ``of``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def _count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bin, texts that have it); bin -1 has all texts."""
    seen, texts = np.zeros(WIDTH, dtype=np.int64), 0
    for batch in by_bytes(batches, "text", 1 << 20):
        seen += _frequency(batch.column("text"))
        texts += batch.num_rows
    yield pa.record_batch([pa.array(np.arange(-1, WIDTH)), pa.array(np.concatenate([[texts], seen]))], names=["bin", "n"])


def _tallies(halves: tuple[Model, Model], cuts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in by_bytes(batches, "text", 1 << 20):
            for i in range(0, batch.num_rows, PART):
                part = batch.slice(i, PART)
                found += tally(halves, part.column("text"), part.column("lang").to_pylist(), part.column("half").to_numpy(zero_copy_only=False), cuts)
        keys = list(found)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.int32()), pa.array(list(found.values()), pa.int64())]
        yield pa.record_batch(columns, names=["lang", "kinds", "step", "n"])

    return run


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> Model:
    """Centroids from about max_docs texts outside the held-out fold, shared evenly by
    the languages, chosen by hash of doc_id (the first of each language at least) and
    at most of max_chars characters; document frequencies and limits from all texts
    outside the fold. The sample comes in the order of the hash, so that neither files
    nor tasks decide where the clusters start."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(4) != 2))
    place = ((F.xxhash64("doc_id", "lang") % 1000003 + 1000003) % 1000003).cast("double") / 1000003
    rows = rows.select("text", "lang", place.alias("place"), F.pmod(F.xxhash64(F.lit("half"), "doc_id", "lang"), F.lit(2)).cast("int").alias("half"))
    most = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("first")).orderBy(F.desc("n"), "lang").limit(max_docs).collect()
    if not most:
        return _none()
    sizes = {r["lang"]: r["n"] for r in most}
    rate = F.lit(-1.0)
    for r in most:
        share = min(1.0, max(1, max_docs / len(sizes)) / r["n"])
        rate = F.when(F.col("lang") == r["lang"], F.lit(max(share, r["first"]))).otherwise(rate)
    texts, langs, half, size = [], [], [], 0
    chosen = rows.where(F.col("place") <= rate).orderBy("place", "lang", F.xxhash64("text"))
    for r in chosen.toLocalIterator():  # a partition at a time
        size += len(r["text"])
        if texts and (size > max_chars or len(texts) == 2 * max_docs):
            break
        texts.append(r["text"])
        langs.append(r["lang"])
        half.append(r["half"])
    seen = {r["bin"]: r["n"] for r in rows.select("text").mapInArrow(_count_texts, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    idf = _idf(seen[-1], np.array([seen[i] for i in range(WIDTH)]))
    model, halves = _fitted(pa.array(texts, pa.string()), np.array(langs, dtype=object), np.array(half), idf, CENTROIDS)
    found = rows.select("text", "lang", "half").mapInArrow(_tallies(halves, MOST_CUTS), "lang string, kinds int, step int, n long")
    found = found.groupBy("lang", "kinds", "step").agg(F.sum("n").alias("n")).collect()
    return _limited(model, {(r["lang"], r["kinds"], r["step"]): r["n"] for r in found})


def _predict(model: Model, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 1 << 20):
            for i in range(0, batch.num_rows, PART):
                part = batch.slice(i, PART)
                lang, score, rejected = model.predict(part.column("text"))
                if keep:
                    yield part.filter(pa.array(~rejected))
                else:
                    yield pa.record_batch([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) per row of docs.

    Needs doc_id, text and lang; lang is only read to learn, from rows that are not
    held out. Null texts and texts without a letter get ``und``, score 0 and are
    rejected; so is every text if nothing can be learned. A null doc_id is neither
    held out nor learned from. Whole texts count, repeated rows each.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_predict(fit(docs, max_docs), False), "doc_id long, lang_pred string, score double, rejected boolean")
    return rows.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """The rows of docs that are not rejected, unchanged."""
    return docs.mapInArrow(_predict(fit(docs, max_docs), True), docs.schema)
