"""Concatenate and cut, against tokenising and concatenating everything in one place."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlens.llm import concat_cut
from cohortlens.llm.queries import op13_concat_cut


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path(concat_cut.VOCABULARY), encoding="utf-8") as f:
        return f.read()


def whole(model, texts):
    t = Tokenizer.from_str(model)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 0] for x in texts]


def check(rows, want, length=1024):
    """Pieces by document and by sequence: every id once, gapless, no padding."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length == len(r.ids) // 4 > 0
    got = Counter()
    for (doc, n), parts in by_doc.items():
        copies = sum(s == 0 for s, _ in parts)
        assert sum(len(i) for _, i in parts) == n * copies
        if copies == 1:
            parts.sort()
            assert [s for s, _ in parts] == [sum(len(i) for _, i in parts[:k]) for k in range(len(parts))]
            got[doc, tuple(x for _, i in parts for x in i)] += 1
        else:
            got[doc, tuple(next(w for d, w in want if d == doc))] += copies
    assert got == Counter((d, tuple(w)) for d, w in want)
    sizes = []
    for s in sorted(by_seq):
        at = 0
        for offset, n in sorted(by_seq[s]):
            assert offset == at
            at += n
        sizes.append(at)
    total = sum(len(w) for _, w in want)
    assert sorted(by_seq) == list(range(len(sizes)))
    assert sizes[: total // length] == [length] * (total // length)
    tail = sizes[total // length :]
    assert sum(tail) == total % length and all(x & (x - 1) == 0 for x in tail) and sorted(set(tail), reverse=True) == tail


def test_pieces_of_odd_documents(llm, odd, model):
    docs = odd.collect()
    want = list(zip([d.doc_id for d in docs], whole(model, [d.text for d in docs]), strict=True))
    check(concat_cut.pieces(odd).collect(), want)
    check(concat_cut.pieces(odd.repartition(1), length=64).collect(), want, 64)


def test_query_over_the_corpus(llm, corpus, model):
    rows = op13_concat_cut(llm, "/root/testdata/sf0.001").collect()
    docs = {d.doc_id: d.text for d in corpus.collect()}
    ids = dict(zip(docs, whole(model, docs.values()), strict=True))
    stream = {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        stream.setdefault(r.sequence_id, []).append((r.offset, part))
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    padded = sum(len([x for _, p in s for x in p]) for s in stream.values())
    assert padded == sum(map(len, ids.values())) and len(stream) <= padded // 1024 + 10


def test_sequences_join_the_boundaries_of_partitions(llm, corpus):
    """The documents of a partition end in the middle of a window; small ones lie inside one."""
    docs = corpus.unionAll(corpus.limit(3).select(F.lit(-1).cast("long").alias("doc_id"), F.lit("a").alias("text"), *corpus.columns[2:]).repartition(3)).repartition(40)
    parts = concat_cut.pieces(docs, length=256)
    seqs = {r.sequence_id: r for r in concat_cut.sequences(docs, length=256).collect()}
    total = parts.agg(F.sum("length")).first()[0]
    assert sum(r.tokens for r in seqs.values()) == total and sorted(seqs) == list(range(len(seqs)))
    assert all(len(r.ids) == 4 * r.tokens for r in seqs.values())
    assert Counter(r.tokens for r in seqs.values())[256] >= total // 256
    ends = sum(np.frombuffer(r.ids, "<u4").tolist().count(0) for r in seqs.values())
    assert ends >= docs.count()


def test_empty_table(llm, empty):
    assert concat_cut.pieces(empty).collect() == [] and concat_cut.sequences(empty).collect() == []


def test_ids_are_those_of_the_tokenizer(model):
    rng = random.Random(5)
    alphabet = ["a", "Zb", "9", " ", "  ", "\n", " \n", "\t", "'s", " 're", "é", "漢", "\xa0", "\u2028", "\x1c", "\x85", "!", "...", "<|endoftext|>", "\U0001f600", "x" * 90]
    texts = ["", " ", "\n ", *["".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(3000)]]
    texts += ["".join(map(chr, rng.choices([*range(0xD800), *range(0xE000, 0x110000)], k=50))) for _ in range(2000)]
    texts += [" " * 300000, "\n" * 300000 + "a", "x" * 100000, "漢" * 50000]
    tokens = concat_cut.Tokens(model)
    assert tokens.fast
    assert [np.frombuffer(tokens(t), "<u2").tolist() for t in texts] == [w[:-1] for w in whole(model, texts)]


def test_other_vocabularies(llm, model):
    """One with words, lower case and no blanks, of which no byte ranks can be taken."""
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        other = f.read()
    texts = ["Some  Words", None, "ÄÖ! 12"]
    assert concat_cut.Tokens(other).fast is None
    df = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(concat_cut.pieces(df, vocabulary=path, length=4).collect(), list(enumerate(whole(other, texts))), 4)


def test_long_text_leaves_in_bounded_batches(llm, model, monkeypatch):
    monkeypatch.setattr(concat_cut, "MOST", 1 << 14)
    docs = [(1, "lorem ipsum " * 40000), (2, "short"), (3, "y" * 30000)]
    df = llm.createDataFrame(docs, "doc_id long, text string")
    check(concat_cut.pieces(df).collect(), list(zip([1, 2, 3], whole(model, [t for _, t in docs]), strict=True)))


def test_windows_of_a_stream():
    for total in (0, 1, 1023, 1024, 1025, 5000):
        w = concat_cut.Windows(total, 1024)
        place = np.arange(total)
        of = w.of(place)
        sizes = Counter(of.tolist())
        assert all(w.size(s) == n for s, n in sizes.items()) and sorted(sizes) == list(range(len(sizes)))
        assert all(w.start(np.array([s]))[0] == place[of == s][0] for s in sizes)
