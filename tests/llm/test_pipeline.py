"""What each stage of the corpus pipeline does, against plain Python over its own input, and odd rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlens.llm import language_id, mixing, packing, secret_scan

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(llm, corpus, odd, tmp_path_factory):
    """Each stage's input and output, over the corpus and odd rows with the same columns."""
    root = tmp_path_factory.mktemp("stages")
    known = set(corpus.columns)
    more = odd.select(*[F.col(c) if c in odd.columns else F.lit(None).cast(corpus.schema[c].dataType).alias(c) for c in corpus.columns])
    docs = corpus.unionByName(more.withColumn("doc_id", F.col("doc_id") + 10**6).select(*corpus.columns))
    docs.write.parquet(f"{root}/in")
    docs, found = llm.read.parquet(f"{root}/in"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(llm, docs, SF).write.parquet(f"{root}/{name}")
        out = llm.read.parquet(f"{root}/{name}")
        assert name == "packing" or set(out.columns) == known
        found[name] = (docs, out)
        docs = out
    return found


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def shingles(text):
    words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def test_language_keeps_rows_as_they_are(stages):
    before, after = stages["language_id"]
    rejected = Counter(r.doc_id for r in language_id.identify(before).where("rejected").collect())
    want = Counter({r: n for r, n in rows(before).items()})
    assert rows(after) <= want
    assert Counter(r[0] for r in (want - rows(after)).elements()) == rejected
    assert all(re.search(r"[^\W\d_]", r[before.columns.index("text")] or "") for r in rows(after))


def test_one_of_each_near_duplicate_group_stays(stages):
    before, after = stages["near_dedup"]
    docs = before.collect()
    sets = [shingles(d.text) for d in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                group[root(i)] = root(j)
    members = {}
    for i, d in enumerate(docs):
        members.setdefault(root(i) if sets[i] else ("none", i), []).append(d)
    least = [min(m, key=lambda d: (d.doc_id is None, d.doc_id or 0)) for m in members.values()]
    kept = after.collect()
    assert Counter(d.doc_id for d in kept) == Counter(d.doc_id for d in least)
    assert Counter(map(tuple, kept)) <= rows(before) and len(kept) < len(docs)


def test_secrets_are_blanked_and_nothing_else(stages):
    before, after = stages["secrets"]
    spans = {(r.doc_id): r for r in secret_scan.scan(before).collect()}
    out = {d.doc_id: d for d in after.collect()}
    changed = 0
    for d in before.collect():
        got = out[d.doc_id]
        cuts = [tuple(map(int, s.split(":")[1:])) for s in spans[d.doc_id].spans.split(",") if s]
        assert tuple(x for c, x in zip(before.columns, d, strict=True) if c not in ("text", "n_chars")) == tuple(x for c, x in zip(before.columns, got, strict=True) if c not in ("text", "n_chars"))
        if not cuts:
            assert got.text == d.text
            continue
        changed += 1
        # what lies outside the spans is still there, in order
        at, kept = 0, []
        for a, b in sorted(cuts):
            kept.append(d.text[at : max(a, at)])
            at = max(at, b)
            if b - a >= 12:
                assert d.text[a:b] not in got.text
        place = 0
        for part in [*kept, d.text[at:]]:
            place = got.text.index(part, place) + len(part)
    assert changed > 0


def test_sources_come_near_their_targets(stages):
    before, after = stages["mixing"]
    plan = mixing.mixture(before).collect()
    times = Counter()
    for r in plan:
        times[r.doc_id] += r.passes
    assert Counter(d.doc_id for d in after.collect()) == +times
    target, taken, longest = {}, Counter(), Counter()
    by_id = {d.doc_id: d for d in before.collect()}
    for r in plan:
        source = by_id[r.doc_id].source
        target[source] = r.target
        taken[source] += r.taken
        longest[source] = max(longest[source], r.size)
        assert r.taken <= 2 * r.size
    for source, want in target.items():
        assert abs(taken[source] - want) <= 1
        whole = sum(len(WORD.findall(d.text or "")) for d in after.where(F.col("source").eqNullSafe(F.lit(source))).collect())
        assert want - 1 <= whole <= want + longest[source]


def test_pieces_fill_bins_without_conflicts(stages):
    before, after = stages["packing"]
    docs = before.collect()
    words = Counter()
    for d in docs:
        words[d.doc_id] += len(WORD.findall(d.text or ""))
    got, bins = Counter(), {}
    for r in after.collect():
        got[r.doc_id] += r.words
        if r.bin is not None:
            bins.setdefault((r.block, r.bin), []).append(r)
    assert +got == +words and set(got) == set(words)
    source = {d.doc_id: d.source for d in docs}
    for pieces in bins.values():
        assert sum(p.words for p in pieces) == pieces[0].fill <= packing.CAPACITY
        named = [source[p.doc_id] for p in pieces if source[p.doc_id] is not None]
        assert len(named) == len(set(named))


def test_run_goes_through_all_stages(llm, stages):
    out = corpus_pipeline.run(llm, SF)
    assert out.columns == stages["packing"][1].columns and out.count() > 0
