"""Stupid-backoff bigram scores of documents against all other documents.

A word w after v scores ln(o(v w) / c(v)) where o counts the bigram in the
other documents and c the word in all of them, or, if o is 0,
ln(ALPHA * c(w) / N). A text's first word follows a start mark, whose count is
the number of texts with words. A document's score is the mean over its words.

1. Word counts over the whole corpus: combined per block, then summed (a table).
   Words above a share ``FREQUENT`` of all words, of which there can be only
   1 / FREQUENT, are known to every task.
2. Bigrams of very frequent words are counted likewise; those above a share
   ``HOT`` of all words, at most 1 / HOT, are scored where they are read, so no
   common pair gathers its documents in one place.
3. All other bigrams go, one row per document and bigram packed in blocks of a
   hash partition, to the partition of their second word (of the pair, if
   that word is frequent). There the bigram's and the word's counts meet the
   documents' rows. Sums per document leave, packed in a block for each hash
   partition of documents, and first words whose count is not there, in a block
   for each hash partition of words.
4. The words asked for meet the word table, partition by partition, and all sums
   are added up per partition of documents. A document has a sum from every
   partition that holds a bigram of it, so the sums grow with the bigrams; in
   blocks, a partition sends one row to each other, however many documents it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.text import by_bytes, mix, stream, word_hashes
from cohortlens.sources.stage_tables import materialize

ALPHA = 0.4
FREQUENT = 1e-6
HOT = 1e-4
#: Bigram rows of a hash partition.
PART_ROWS = 2_000_000
_BLOCK = 1 << 23
_START = stream(1, 77)[0]
_G = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Frequent:
    """Sorted hashes of the frequent words, their counts, hot pairs' hashes and counts, and the corpus's words."""

    words: np.ndarray
    counts: np.ndarray
    pairs: np.ndarray
    pair_counts: np.ndarray
    total: int

    @staticmethod
    def find(table: np.ndarray, counts: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The counts of x, 0 where it isn't in the table."""
        if not len(table):
            return np.zeros(len(x), dtype=np.int64)
        at = np.searchsorted(table, x)
        at[at == len(table)] = 0
        return np.where(table[at] == x, counts[at], 0)


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _G + second)


def _bigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, second word, index of the text) of all bigrams, start marks included."""
    second, first_of = word_hashes(column)
    first = np.empty_like(second)
    first[1:] = second[:-1]
    first[first_of[:-1][np.diff(first_of) > 0]] = _START
    return first, second, np.repeat(np.arange(len(first_of) - 1), np.diff(first_of))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "text", _BLOCK):
        hashes, first = word_hashes(batch.column("text"))
        words, counts = np.unique(hashes, return_counts=True)
        words = np.append(words, _START)
        counts = np.append(counts, np.count_nonzero(np.diff(first)))
        yield pa.record_batch([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "c"])


def _count_pairs(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.ones(len(table), dtype=np.int64)
        for batch in by_bytes(batches, "text", _BLOCK):
            first, second, _ = _bigrams(batch.column("text"))
            both = (Frequent.find(table, every, first) > 0) & (Frequent.find(table, every, second) > 0)
            pairs, counts = np.unique(_pair(first[both], second[both]), return_counts=True)
            yield pa.record_batch([pa.array(pairs.view(np.int64)), pa.array(counts)], names=["pair", "c"])

    return run


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        out.append(np.frombuffer(raw, dtype=k, count=n, offset=at))
        at += n * np.dtype(k).itemsize
    return out


_ROWS = ("u8", "u8", "u4", "u4")  # second word, first word, number of the document among the block's, times
_SUMS = ("i8", "f8", "i8", "i8")  # document, sum, backed off, words


def _deal(f: Frequent, parts: int):
    """(part, rows, docs, sums): the bigram rows of a block for each part; sums of hot pairs go along with one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", _BLOCK):
            first, second, doc = _bigrams(batch.column("text"))
            if not len(first):
                continue
            pair = _pair(first, second)
            order = np.lexsort((pair, doc))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (np.diff(doc[order]) != 0) | (np.diff(pair[order]) != 0)
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(order)))
            row = order[at]
            first, second, doc, pair = first[row], second[row], doc[row], pair[row]
            rid = batch.column("rid").to_numpy()[doc]
            hot = f.find(f.pairs, f.pair_counts, pair)
            is_hot = hot > 0
            sums = b""
            if is_hot.any():
                c1, c2 = (f.find(f.words, f.counts, x[is_hot]) for x in (first, second))
                sums = _pack(*_sums(rid[is_hot], *_values(hot[is_hot], times[is_hot], c1, c2, f.total), times[is_hot]))
            first, second, rid, times, pair = (x[~is_hot] for x in (first, second, rid, times, pair))
            key = np.where(f.find(f.words, f.counts, second) > 0, pair, mix(second))
            part = (key % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((first, second, part))
            first, second, rid, times, part = (x[order] for x in (first, second, rid, times, part))
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            edges = np.append(cuts, len(part))
            blobs, names = [], []
            for a, b in zip(edges, edges[1:], strict=False):
                docs, at = np.unique(rid[a:b], return_inverse=True)
                blobs.append(_pack(second[a:b], first[a:b], at.astype(np.uint32), times[a:b].astype(np.uint32)))
                names.append(docs.tobytes())
            numbers = part[cuts].tolist()
            if sums:
                numbers.append(int(rid[0] if len(rid) else batch.column("rid")[0].as_py()) % parts)
                blobs.append(b"")
                names.append(b"")
            extra = [b""] * (len(blobs) - 1) + [sums] if sums else [b""] * len(blobs)
            yield pa.record_batch([pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary()), pa.array(names, pa.binary()), pa.array(extra, pa.binary())], names=["part", "rows", "docs", "sums"])

    return run


def _values(c12: np.ndarray, own: np.ndarray, c1: np.ndarray, c2: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(sum over the row's times, times backed off); a c1 of 0 adds nothing for the first word."""
    others = c12 - own
    hit = others > 0
    value = np.where(hit, np.log(np.maximum(others, 1)) - np.log(np.maximum(c1, 1)), np.log(ALPHA) + np.log(np.maximum(c2, 1)) - np.log(max(total, 1)))
    return value * own, np.where(hit, 0, own)


def _sums(rid: np.ndarray, value: np.ndarray, missed: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    docs, at = np.unique(rid, return_inverse=True)
    add = lambda x: np.bincount(at, x, len(docs))
    return docs, add(value), add(missed).astype(np.int64), add(times).astype(np.int64)


_OUT = "kind int, part long, block binary"
_ASKED = ("u8", "i8", "i4")  # first word, document, times


def _blocks(kind: int, key: np.ndarray, parts: int, *arrays: np.ndarray) -> pa.Table:
    """Arrays in a block for each part of their key."""
    part = key % parts  # not negative, also for negative keys
    order = np.argsort(part, kind="stable")
    part, arrays = part[order], [a[order] for a in arrays]
    edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    blocks = [_pack(*[x[a:b] for x in arrays]) for a, b in zip(edges, edges[1:], strict=False)]
    return pa.table([pa.array([kind] * len(blocks), pa.int32()), pa.array(part[edges[:-1]], pa.int64()), pa.array(blocks, pa.binary())], names=["kind", "part", "block"])


def _meet(f: Frequent, parts: int):
    """A part's rows to sums per document (kind 0), and (word, document, times) for first words whose count is elsewhere (1)."""

    def run(table: pa.Table) -> pa.Table:
        rows, names, known = [], [], 0
        for x, own in zip(table.column("rows"), table.column("docs"), strict=True):
            if len(x.as_py()):
                second, first, at, times = _unpack(x.as_py(), *_ROWS)
                names.append(np.frombuffer(own.as_py(), dtype=np.int64))
                rows.append((second, first, at + np.uint32(known), times))
                known += len(names[-1])
        done = [_unpack(x.as_py(), *_SUMS) for x in table.column("sums") if len(x.as_py())]
        out = [_blocks(0, np.zeros(0, np.int64), parts, *[np.zeros(0, k) for k in _SUMS])]
        if rows:
            second, first, doc, times = (np.concatenate(x) for x in zip(*rows, strict=True))
            docs = np.concatenate(names)
            del rows, names
            order = np.lexsort((first, second))
            second, first = second[order], first[order]
            doc, times = doc[order], times[order].astype(np.int64)
            del order
            word_new = np.append(True, second[1:] != second[:-1])
            pair_new = word_new | np.append(True, first[1:] != first[:-1])

            def totals(new: np.ndarray) -> np.ndarray:
                at = np.flatnonzero(new)
                return np.repeat(np.add.reduceat(times, at), np.diff(np.append(at, len(times))))

            c12 = totals(pair_new)
            c2 = f.find(f.words, f.counts, second)
            c2 = np.where(c2 > 0, c2, totals(word_new))
            c1 = f.find(f.words, f.counts, first)
            value, missed = _values(c12, times, c1, c2, f.total)
            done.append([docs, *[np.bincount(doc, x, len(docs)) for x in (value, missed, times)]])
            ask = (c1 == 0) & (c12 > times)
            if ask.any():
                out.append(_blocks(1, first[ask].view(np.int64), parts, first[ask], docs[doc[ask]], times[ask].astype(np.int32)))
        if done:
            docs, *sums = (np.concatenate(x) for x in zip(*done, strict=True))
            out.append(_total_blocks(docs, sums, parts))
        return pa.concat_tables(out)

    return run


def _merged(docs: np.ndarray, sums: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(documents, sum, backed off, words), one entry per document."""
    own, at = np.unique(docs, return_inverse=True)
    s, missed, n = (np.bincount(at, x, len(own)) for x in sums)
    return own, s, missed.astype(np.int64), n.astype(np.int64)


def _total_blocks(docs: np.ndarray, sums: list[np.ndarray], parts: int) -> pa.Table:
    docs, *sums = _merged(docs, sums)
    return _blocks(0, docs, parts, docs, *sums)


def _answer(parts: int):
    """Sums per document of the first words asked for, from their part of the word table."""

    def run(asked: pa.Table, words: pa.Table) -> pa.Table:
        empty = _blocks(0, np.zeros(0, np.int64), parts, *[np.zeros(0, k) for k in _SUMS])
        if not asked.num_rows:
            return empty
        word, doc, times = (np.concatenate(x) for x in zip(*[_unpack(b.as_py(), *_ASKED) for b in asked.column("block")], strict=True))
        known = words.column("word").to_numpy().view(np.uint64)
        order = np.argsort(known)
        c = Frequent.find(known[order], words.column("c").to_numpy()[order], word)
        none = np.zeros(len(doc), np.int64)
        return pa.concat_tables([empty, _total_blocks(doc, [-times * np.log(c), none, none], parts)])

    return run


def _add_up(table: pa.Table) -> pa.Table:
    docs, *sums = (np.concatenate(x) for x in zip(*[_unpack(b.as_py(), *_SUMS) for b in table.column("block")], strict=True))
    return pa.table(list(map(pa.array, _merged(docs, sums))), names=["rid", "s", "missed", "n"])


def frequent(docs: DataFrame, words: DataFrame, share: float = FREQUENT, hot: float = HOT) -> Frequent:
    """The bounded tables of frequent words and hot pairs (at most 1 / share and 1 / hot rows)."""
    start = int(np.array([_START]).view(np.int64)[0])
    total = words.where(F.col("word") != start).agg(F.sum("c")).first()[0] or 0
    top = words.where(F.col("c") >= F.lit(share * total)).toArrow().sort_by("word")
    table, counts = top.column("word").to_numpy().view(np.uint64), top.column("c").to_numpy()
    order = np.argsort(table)
    table, counts = table[order], counts[order]
    very = table[counts >= hot * total]
    pairs = docs.select("text").mapInArrow(_count_pairs(very), "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c"))
    got = pairs.where(F.col("c") >= F.lit(hot * total)).toArrow()
    keys = got.column("pair").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Frequent(table, counts, keys[order], got.column("c").to_numpy()[order], int(total))


def _count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "text", _BLOCK):
        n = np.diff(word_hashes(batch.column("text"))[1])
        yield pa.record_batch([batch.column("doc_id"), batch.column("rid"), pa.array(n)], names=["doc_id", "rid", "n_words"])


def score(docs: DataFrame, share: float = FREQUENT, hot: float = HOT, part_rows: int = PART_ROWS) -> DataFrame:
    """(doc_id, n_words, n_backoff, score) per row of docs.

    Needs doc_id and text; words are lowered in A-Z. Null and empty texts, and
    texts without words, have 0 words and a null score. Repeated rows are
    documents each: one row of result for each, all alike, and each sees the
    others' bigrams. Null doc_ids are kept.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("rid"))
    words = materialize(rows.select("text").mapInArrow(_count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")))
    f = frequent(rows, words, share, hot)
    parts = max(1, ceil(f.total / part_rows))
    dealt = rows.select("rid", "text").mapInArrow(_deal(f, parts), "part long, rows binary, docs binary, sums binary")
    met = materialize(dealt.groupBy("part").applyInArrow(_meet(f, parts), _OUT))
    asked = met.where("kind = 1").select("part", "block").groupBy("part")
    counts = words.select(F.pmod("word", F.lit(parts)).alias("at"), "word", "c").groupBy("at")
    late = asked.cogroup(counts).applyInArrow(_answer(parts), _OUT)
    blocks = met.where("kind = 0").unionAll(late).select("part", "block")
    sums = blocks.groupBy("part").applyInArrow(_add_up, "rid long, s double, missed long, n long")
    base = rows.mapInArrow(_count_texts, "doc_id long, rid long, n_words long")
    out = base.join(sums, "rid", "left")
    # Rows alike share a rid: n is n_words times their number.
    missed = F.coalesce(F.expr("missed * n_words div n"), F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", missed.alias("n_backoff"), (F.col("s") / F.col("n")).alias("score"))
