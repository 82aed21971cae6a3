"""Packing by concatenating all documents and cutting the stream into windows.

The tokens of all documents, each closed by an end token, form one stream that
is never held anywhere. Two passes of prefix sums place a document in it: while
tokenising, each partition counts the tokens before a document inside the
partition; the partitions' totals, summed in order, give each partition's place
in the stream. The sum of both is the document's global offset, and windows of
a fixed length cut it by arithmetic alone. A window that two partitions share
is met by pieces of both: ``sequences`` joins these boundary records, at most
two per run of documents, and passes all other windows on as they are.

The rest after the last full window is cut into windows of falling powers of
two, so that no sequence needs padding.

Token ids are written once, as a table in the shared folder, since the second
pass must meet the very rows that the first has counted.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.text import by_bytes
from cohortlens.sources.sizing import broadcast_if_small
from cohortlens.sources.stage_tables import materialize

LENGTH = 1024
END = 0
VOCABULARY = "byte_bpe_50k.json"
#: Bytes of ids that one output batch holds, or one piece.
MOST = 1 << 23


#: The pattern that byte-level vocabularies of this kind cut a text by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks of a vocabulary's byte strings, if it is a plain byte-level one whose ids
    follow its merges; None for any other."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and model.get("type") == "BPE"
    if not plain or spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges") or any(not t["special"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        return None
    # the visible characters that stand for bytes: printable ones for themselves, the others from 256 on
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    special = {t["content"] for t in spec["added_tokens"]}
    vocab = {w: i for w, i in model["vocab"].items() if w not in special}
    if [vocab.get(w) for w in merged] != list(range(256, 256 + len(merged))) or len(vocab) != 256 + len(merged):
        return None
    return {bytes(byte[c] for c in w): i for w, i in vocab.items()}


class Tokens:
    """Ids of whole texts as little-endian bytes, two a token where the vocabulary allows.

    A plain byte-level vocabulary is read by ``tiktoken``, which gives the ids of
    ``tokenizers`` four times as fast (the tests hold both equal); other
    vocabularies, and texts on which its pattern gives up, by ``tokenizers``.
    """

    def __init__(self, vocabulary: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(vocabulary)
        self.dtype = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        spec = json.loads(vocabulary)
        ranks = _ranks(spec)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.fast = ranks and tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> bytes:
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype(self.dtype).tobytes()
            except ValueError:  # endless blanks, for example
                pass
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype).tobytes()


@lru_cache(maxsize=1)
def _tokens(vocabulary: str) -> Tokens:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Tokens(vocabulary)


def _tokenise(vocabulary, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, before = _tokens(vocabulary.value), TaskContext.get().partitionId(), 0
        last = np.array([end], tokens.dtype).tobytes()
        for batch in by_bytes(batches, "text", 1 << 21):
            ids = [tokens(t or "") + last for t in batch.column("text").to_pylist()]
            size = np.array([len(b) // tokens.dtype.itemsize for b in ids], np.int64)
            starts = before + np.cumsum(size) - size
            before += int(size.sum())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(np.full(len(size), part, np.int64)), pa.array(starts), pa.array(size), pa.array(ids, pa.binary())],
                names=["doc_id", "part", "before", "doc_tokens", "ids"],
            )

    return run


class Windows:
    """The windows of a stream: full ones, then falling powers of two."""

    def __init__(self, total: int, length: int) -> None:
        self.length, self.full = length, total // length
        rest, sizes = total % length, []
        while rest:
            sizes.append(1 << (rest.bit_length() - 1))
            rest -= sizes[-1]
        self.sizes = np.array(sizes, np.int64)
        self.starts = self.full * length + np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def of(self, place: np.ndarray) -> np.ndarray:
        """The window of each place in the stream."""
        tail = self.full + np.searchsorted(self.starts, place, side="right") - 1
        return np.where(place < self.full * self.length, place // self.length, tail)

    def start(self, window: np.ndarray) -> np.ndarray:
        return np.where(window < self.full, window * self.length, self.starts[np.clip(window - self.full, 0, len(self.starts) - 1)])

    def size(self, window: int) -> int:
        return self.length if window < self.full else int(self.sizes[window - self.full])


def _cut(windows: Windows, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at").to_numpy()
            size = batch.column("doc_tokens").to_numpy()
            first, last = windows.of(at), windows.of(at + size - 1)
            lo = 0
            heavy = np.cumsum(size) * 4 // MOST  # rows of one output batch
            while lo < len(at):
                hi = max(lo + 1, int(np.searchsorted(heavy, heavy[lo], side="right")))
                row = np.repeat(np.arange(lo, hi), (last - first + 1)[lo:hi])
                nth = np.arange(len(row)) - np.searchsorted(row, row)
                window = first[row] + nth
                begin = np.maximum(at[row], windows.start(window))
                end = np.minimum((at + size)[row], windows.start(window + 1))
                start, length = begin - at[row], end - begin
                ids = []
                for r in range(lo, hi):
                    raw = np.frombuffer(batch.column("ids")[r].as_buffer(), f"<u{width}").astype("<u4").tobytes()
                    own = slice(int(np.searchsorted(row, r)), int(np.searchsorted(row, r, side="right")))
                    ids += [raw[4 * s : 4 * (s + n)] for s, n in zip(start[own].tolist(), length[own].tolist(), strict=True)]
                yield pa.record_batch(
                    [
                        batch.column("doc_id").take(pa.array(row)),
                        *[pa.array(x.astype(np.int64)) for x in (start, length, size[row], window, begin - windows.start(window))],
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )
                lo = hi

    return run


PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _pieces(docs: DataFrame, length: int, end: int, vocabulary: str | None) -> tuple[DataFrame, Windows]:
    spark = docs.sparkSession
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    with open(vocabulary, encoding="utf-8") as f:
        model = f.read()  # bounded by the vocabulary; executors need no file
    width = Tokens(model).dtype.itemsize
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = materialize(rows.mapInArrow(_tokenise(spark.sparkContext.broadcast(model), end), "doc_id long, part long, before long, doc_tokens long, ids binary"))
    totals = sorted((r["part"], r["n"]) for r in table.groupBy("part").agg(F.sum("doc_tokens").alias("n")).collect())  # a row for each partition
    sizes = np.array([n for _, n in totals], np.int64)
    bases = spark.createDataFrame([(p, b) for (p, _), b in zip(totals, (np.cumsum(sizes) - sizes).tolist(), strict=True)], "part long, base long")
    placed = table.join(broadcast_if_small(bases, 32 * len(totals)), "part")
    windows = Windows(int(sizes.sum()), length)
    cut = placed.select("doc_id", (F.col("base") + F.col("before")).alias("at"), "doc_tokens", "ids").mapInArrow(_cut(windows, width), PIECES)
    return cut, windows


def pieces(docs: DataFrame, length: int = LENGTH, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids) per piece of a document in a sequence.

    docs needs doc_id and text; other columns, whatever their names, are left
    alone. ``ids`` are the piece's tokens, little-endian unsigned 32-bit numbers.
    Every row is a document of its own, also with a null or repeated doc_id;
    a null or empty text is its end token alone, and an empty table gives no
    rows. A very long text is tokenised whole, and its pieces leave in batches
    of bounded bytes. Equal inputs in equal partitions give equal pieces.
    ``vocabulary`` is the path of a tokenizer file on the driver.
    """
    return _pieces(docs, length, end, vocabulary)[0]


def _join(windows: Windows):
    """Whole sequences from pieces that follow each other; others, as far as they go, as boundary records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, offset, held, n, out = -1, 0, [], 0, []

        def record():
            return (window, offset, n == windows.size(window), b"".join(held))

        def batch_of(rows):
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            columns = zip(*rows, strict=True) if rows else ([], [], [], [])
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["sequence_id", "offset", "whole", "ids"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("sequence_id", "offset", "length", "ids")]
            for s, o, length, ids in zip(*columns, strict=True):
                if s != window or o != offset + n:
                    if held:
                        out.append(record())
                    window, offset, held, n = s, o, [], 0
                held.append(ids)
                n += length
            yield batch_of(out)
            out = []
        if held:
            yield batch_of([record()])

    return run


def sequences(docs: DataFrame, length: int = LENGTH, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """(sequence_id, tokens, ids) per sequence: its ids in order, as in ``pieces``, whose rules hold."""
    cut, windows = _pieces(docs, length, end, vocabulary)
    records = materialize(cut.mapInArrow(_join(windows), "sequence_id long, offset long, whole boolean, ids binary"))
    shared = records.where(~F.col("whole")).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))  # of one window
    joined = F.aggregate("p", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    every = records.where("whole").select("sequence_id", "ids").unionAll(shared.select("sequence_id", joined.alias("ids")))
    return every.select("sequence_id", (F.octet_length("ids") / 4).cast("long").alias("tokens"), "ids")

