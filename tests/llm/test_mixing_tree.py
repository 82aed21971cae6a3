"""The splitting tree of the mixture: what shards get, also with many sources and one large one."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cohortlens.llm import mixing


def test_shards_get_even_draws_and_every_source_in_proportion(llm, monkeypatch):
    """The tree deals draws of blocks."""
    docs = llm.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 11).cast("string")).alias("source"), F.lit("a b c").alias("text"))
    sized = docs.select("doc_id", "source", mixing.word_count().alias("size"), mixing.order_key(0).alias("h"))
    for group in (4096, 3):  # one group of sources, and several
        monkeypatch.setattr(mixing, "GROUP", group)
        _, blocks = mixing.plan(sized, shards=8, block_docs=2)
        draws = Counter((d.shard, r.si) for r in blocks.collect() for d in r.draws)
        per_shard, by_source = Counter(), Counter()
        for (shard, source), n in draws.items():
            per_shard[shard] += n
            by_source[source] += n
        assert set(per_shard) == set(range(8)) and max(per_shard.values()) - min(per_shard.values()) <= 3
        for (_, source), n in draws.items():
            share = by_source[source] / 8
            assert abs(n - share) < 6 * np.sqrt(share) + 1  # hypergeometric, so narrower than Poisson
        got = mixing.mixture(docs, shards=8, block_docs=2).collect()
        assert all(len(r.shards) == r.passes for r in got) and {s for r in got for s in r.shards} == set(range(8))


def test_many_sources_and_one_large_one(llm):
    n = 30000
    source = F.when(F.col("id") % 10 != 0, F.lit("large")).otherwise(F.concat(F.lit("s"), F.lpad((F.col("id") / 10 % 10000).cast("long").cast("string"), 5, "0")))
    docs = llm.range(n * 4).select(F.col("id").alias("doc_id"), source.alias("source"), F.lit("one two three four five").alias("text"))
    got = mixing.mixture(docs, shards=16, block_docs=64)
    facts = got.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    rows = facts.collect()
    assert len(rows) == 10001 and all(abs(r.taken - r.target) <= 0.5 for r in rows)
    assert sum(r.target for r in rows) <= 1.5 * n * 4 * 5 + 1
    shards = got.select(F.explode("shards").alias("shard")).groupBy("shard").count().collect()
    assert len(shards) == 16


def test_quotas_add_up_group_by_group():
    import pandas as pd

    rng = np.random.default_rng(4)
    sources = pd.DataFrame({"si": np.arange(1, 41), "draws": rng.integers(0, 90, 40)})
    sources["grp"] = (sources["si"] - 1) // 7
    groups = sources.groupby("grp", as_index=False)["draws"].sum()
    run = mixing._quota_rows(groups, 13, 5)
    rows = pd.concat([run(g) for _, g in sources.groupby("grp")])
    assert rows.groupby("si")["n"].sum().reindex(sources["si"], fill_value=0).tolist() == sources["draws"].tolist()
    total = int(sources["draws"].sum())
    assert rows.groupby("shard")["n"].sum().tolist() == np.diff(mixing.even(total, 13)).tolist()
    assert max(np.diff(mixing.even(total, 13))) - min(np.diff(mixing.even(total, 13))) <= 4
    for _, own in rows.sort_values("shard").groupby("si"):
        assert own["start"].tolist() == (own["n"].cumsum() - own["n"]).tolist()
