"""Near-duplicate documents by SuperMinHash signatures.

1. Each text becomes its set of word-shingle hashes. A SuperMinHash signature
   draws one random permutation of the slots per element: in step j an
   element offers rank j plus a fraction to the j-th slot of its
   permutation. Once every slot holds less than j + 1 no later step can
   change it, so texts stop early, after one or two steps mostly. All texts
   of a block of an Arrow batch take a step together.
2. Equal sets are collapsed to one (a combined minimum), so exact copies cost
   one row however many there are.
3. Bands of the signature are the buckets. A bucket's members are compared
   with its leader on their full sets, and the links are grouped (union-find
   as star contractions). Families of buckets that still hold several groups
   get an exact prefix-filtered join of their members' differences from the
   family's hub (``_links``). No pairs inside a group are listed, and no link
   between two members of a family is lost.
4. A document's component is the least doc_id reachable.

Bands have the most rows for which a pair at the threshold is missed in all
bands with probability under 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.components import components, merged
from cohortlens.llm.text import by_bytes, mix, release, shingle_hashes, stream, word_hashes
from cohortlens.sources.stage_tables import materialize

SLOTS = 128
WIDTH = 5
#: Pairs between groups, for each row of the prefixes, that are listed without meeting leaders first.
LISTED = 16
_SALT = stream(SLOTS, 101)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def band_rows(percent: int, slots: int = SLOTS, miss: float = 1e-6) -> int:
    """Most signature rows per band that keep the chance of a miss at the threshold low."""
    s = percent / 100
    return max([r for r in range(1, 17) if (1 - s**r) ** (slots // r) <= miss], default=1)


def superminhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """Signatures (sets x slots, uint64: rank in the high half, fraction in the low) of hash sets."""
    n = len(sets)
    sig = np.full((n, slots), _FULL, dtype=np.uint64)
    flat = sig.reshape(-1)
    h = np.concatenate(sets) if n else np.zeros(0, dtype=np.uint64)
    doc = np.repeat(np.arange(n), [len(s) for s in sets])
    perm = None
    for j in range(slots):
        if not len(h):
            break
        draw = mix(h + _SALT[j])
        k = j + ((draw >> np.uint64(32)) % np.uint64(slots - j)).astype(np.int64)
        if perm is None:
            slot = k
        else:
            rows = np.arange(len(h))
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, j]
        value = np.uint64(j << 32) | (draw & np.uint64(0xFFFFFFFF))
        np.minimum.at(flat, doc * slots + slot, value)
        going = sig.max(axis=1) >= np.uint64((j + 1) << 32)
        stay = going[doc]
        if perm is None:
            h, doc, k = h[stay], doc[stay], k[stay]
            perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(h), 1))
            perm[np.arange(len(h)), k] = 0
        elif not stay.all():
            h, doc, perm = h[stay], doc[stay], perm[stay]
    return sig


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """(sets x bands) bucket keys; the band's number is part of the key."""
    bands = sig.shape[1] // rows
    key = np.broadcast_to(stream(bands, 13), (len(sig), bands)).copy()
    for r in range(rows):
        key = mix(key ^ sig[:, r : bands * rows : rows])
    return key


def _sets(column: pa.Array, width: int) -> list[np.ndarray]:
    hashes, first = word_hashes(column)
    return [np.unique(shingle_hashes(hashes[a:b], width)) for a, b in zip(first, first[1:], strict=False)]


_SIGNED = "doc_id long, th long, n long, f1 long, f2 long, bands array<long>"
_BLOBS = "node long, n long, items binary"


def _signed(width: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 1 << 20):
            sets = _sets(batch.column("text"), width)
            keys = band_keys(superminhash(sets), rows).view(np.int64)
            sums = [(int(s.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(s)))) for s in sets]
            prints = np.array(sums, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            size = np.array([len(s) for s in sets], dtype=np.int64)
            flat = keys[size > 0].reshape(-1)
            offsets = np.concatenate([[0], np.cumsum(np.where(size > 0, keys.shape[1], 0))]).astype(np.int32)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("th"), pa.array(size), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "th", "n", "f1", "f2", "bands"],
            )

    return run


def _blobs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 1 << 20):
            sets = _sets(batch.column("text"), width)
            yield pa.record_batch([batch.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "n", "items"])

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            last, other = None, None
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                if last is None or y.as_buffer() != last:
                    last, other = y.as_buffer(), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                at = np.searchsorted(other, p)
                at[at == len(other)] = 0
                both = int(np.count_nonzero(other[at] == p))
                keep.append(100 * both >= percent * (len(p) + len(other) - both))
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release()

    return run


def _buckets(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, node) of the band buckets that hold several sets."""
    rows = nodes.select("node", F.explode("bands").alias("key"))
    many = rows.groupBy("key").agg(F.count("*").alias("g"), F.min("node").alias("lead")).where("g > 1")
    return rows.join(many, "key")


def _verify(pairs: DataFrame, blobs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    x = blobs.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("items").alias("x"))
    y = blobs.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("items").alias("y"))
    size = blobs.select("node", "n")
    near = (
        pairs.join(size.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
        .join(size.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        .select("a", "b")
    )
    return near.join(x.drop("na"), "a").join(y.drop("nb"), "b").mapInArrow(_linked(percent), "a long, b long")


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(family, node, root, n, nh, d, item) for each item of the symmetric difference with the family's hub."""
    for batch in batches:
        parts = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            parts.append(np.setxor1d(np.frombuffer(x.as_buffer(), dtype=np.int64), np.frombuffer(y.as_buffer(), dtype=np.int64), assume_unique=True))
        size = np.array([len(p) for p in parts], dtype=np.int64)
        at = np.repeat(np.arange(len(parts)), size)
        for i in range(0, len(at), 200_000):
            rows = batch.select(["family", "node", "root", "n", "nh"]).take(pa.array(at[i : i + 200_000]))
            items = np.concatenate(parts)[i : i + 200_000]
            yield pa.record_batch([*rows.columns, pa.array(size[at[i : i + 200_000]]), pa.array(items)], names=[*rows.schema.names, "d", "item"])


_SIDE = ("node", "root", "n", "d", "i")


def _near(percent: int) -> Column:
    """Whether two rows of the prefixes that share an item, the second's columns as b_, may be a link between
    two groups: at a pair's first shared item, what follows in both must hold the rest of the overlap
    that a link needs."""
    c = (100 - percent) / (100 + percent)
    needs = (F.col("d") + F.col("b_d") - c * (F.col("n") + F.col("b_n"))) / 2 - 1e-6
    follows = F.least(F.col("d") - F.col("i"), F.col("b_d") - F.col("b_i")) + 1
    return (F.col("root") != F.col("b_root")) & (F.least("n", "b_n") * 100 >= F.greatest("n", "b_n") * percent) & (follows >= needs)


def _crossing(prefix: DataFrame) -> tuple[int, int]:
    """(pairs of rows that share an item but no group, rows)."""
    own = prefix.groupBy("family", "item", "root").agg(F.count("*").alias("g"))
    every = own.groupBy("family", "item").agg(F.sum("g").alias("g"), F.sum(F.col("g") * F.col("g")).alias("same"))
    r = every.agg(F.sum((F.col("g") * F.col("g") - F.col("same")) / 2).alias("cross"), F.sum("g").alias("rows")).first()
    return int(r["cross"] or 0), r["rows"] or 0


def _led(prefix: DataFrame, percent: int, turn: int) -> DataFrame:
    """(a, b): of the rows that share an item, each with one of them, another one in each turn."""
    lead = prefix.groupBy("family", "item").agg(F.min(F.struct(F.xxhash64("item", "node", F.lit(turn)).alias("h"), *_SIDE)).alias("b"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    lead = lead.where("lo <> hi").select("family", "item", *[F.col(f"b.{x}").alias(f"b_{x}") for x in _SIDE])
    return prefix.join(lead, ["family", "item"]).where(_near(percent)).select(F.greatest("node", "b_node").alias("a"), F.least("node", "b_node").alias("b")).distinct()


def _links(buckets: DataFrame, blobs: DataFrame, percent: int) -> DataFrame:
    """(node, root) of all sets linked with another.

    Every member meets its bucket's leader; buckets that share members form a
    family, whose members meet the family's hub h too. Let D(x) be the
    symmetric difference of x and h, and c = (100 - percent) / (100 + percent).
    A pair is linked if |D(x) ^ D(y)| <= c (|x| + |y|), since that is the
    difference of x and y. Of a linked pair that is not yet in one group, one
    is not linked with h, so its E = |D| - c (|x| + |h|) is positive; this
    bounds the overlap of D(x) and D(y) from below, for x outside h's group by
    E / (1 + c) and inside by more than (|D(x)| + c (|h| - |x|)) / 2. So the
    rarest |D| - bound + 1 items of the two share one (a prefix filter), and at
    the first they share enough items must follow (a positional filter). For
    copies with edits of their own these are mostly items of no other copy. All
    other pairs are settled without being listed. Where many copies share an item
    that the hub lacks, each first meets one of them, in rounds, until few groups
    are left or no fewer; only pairs between groups that remain are listed.
    """
    met = materialize(buckets.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct())
    families = components(met).select("node", F.col("root").alias("hub"))
    groups = components(_verify(met, blobs, percent))
    state = families.join(groups, "node", "left").select("node", "hub", F.coalesce("root", "node").alias("root"))
    hub_root = groups.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    state = state.join(hub_root, "hub", "left").withColumn("hub_root", F.coalesce("hub_root", "hub"))
    open_ = state.groupBy("hub").agg(F.count("*").alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.first("hub_root").alias("hr")).where("size > 1 and (lo <> hi or lo <> hr)")
    pairs = state.join(open_.select("hub"), "hub").select("node", "hub")
    hub_links = materialize(_verify(pairs.select(F.col("node").alias("a"), F.col("hub").alias("b")).join(met, ["a", "b"], "left_anti"), blobs, percent))
    groups = merged(groups, hub_links)
    x = blobs.select("node", "n", F.col("items").alias("x"))
    y = blobs.select(F.col("node").alias("hub"), F.col("n").alias("nh"), F.col("items").alias("y"))
    member = pairs.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sides = member.join(x, "node").join(y, "hub").select(F.col("hub").alias("family"), "node", "root", "n", "nh", "x", "y")
    items = materialize(sides.mapInArrow(_differences, "family long, node long, root long, n long, nh long, d long, item long"))
    c = (100 - percent) / (100 + percent)
    in_hub = groups.select(F.col("node").alias("family"), F.col("root").alias("fr"))
    items = items.join(in_hub, "family", "left").withColumn("inside", F.col("root") == F.coalesce("fr", "family"))
    outside = F.ceil((F.col("d") - c * (F.col("n") + F.col("nh"))) / (1 + c) - 1e-6)
    inside = F.floor((F.col("d") + c * (F.col("nh") - F.col("n"))) / 2 - 1e-6) + 1
    overlap = F.greatest(F.lit(1), F.when(F.col("inside"), inside).otherwise(outside))
    often = items.groupBy("family", "item").agg(F.count("*").alias("often")).where("often > 1")
    ranked = items.join(often, ["family", "item"], "left").withColumn("i", F.row_number().over(Window.partitionBy("node").orderBy(F.coalesce("often", F.lit(1)), "item")))
    prefix = materialize(ranked.where((F.col("i") <= F.col("d") - overlap + 1) & F.col("often").isNotNull()).select("family", "item", "node", "root", "n", "nh", "d", "i"))
    before, turn = None, 0
    while True:
        cross, rows = _crossing(prefix)
        if cross <= LISTED * rows or (before is not None and 2 * cross > before):
            break
        before, turn = cross, turn + 1
        groups = merged(groups, _verify(_led(prefix, percent, turn), blobs, percent))
        moved = prefix.drop("root").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
        moved = moved.join(groups.select(F.col("node").alias("family"), F.col("root").alias("fr")), "family", "left")
        # in the hub's group by now: the shorter prefix of those holds as well
        prefix = materialize(moved.where((F.col("root") != F.coalesce("fr", "family")) | (F.col("i") <= F.col("d") - inside + 1)).select(*prefix.columns))
    other = prefix.select("family", "item", *[F.col(x).alias(f"b_{x}") for x in _SIDE])
    rest = prefix.join(other, ["family", "item"]).where((F.col("node") > F.col("b_node")) & _near(percent)).select(F.col("node").alias("a"), F.col("b_node").alias("b")).distinct()
    return merged(groups, _verify(rest, blobs, percent))


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = WIDTH, slots: int = SLOTS) -> DataFrame:
    """(doc_id, th, n_shingles, component, component_id) for every row of docs.

    ``docs`` needs doc_id (integer) and text; other columns are ignored. Two
    documents are linked if 100 * intersection >= percent * union of their
    shingle sets. ``component`` numbers the group; ``component_id`` is its
    least doc_id. Texts null, empty or without words have no shingles and are
    linked with nothing: component null, component_id their own doc_id. Rows
    repeated are returned as often, very long texts are taken whole, and an empty
    table gives no rows; a null doc_id counts as larger than all
    others, and component_id is null only if the whole group has none. ``th``
    is the text's xxhash64, to tell rows with the same doc_id apart.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    signed = materialize(rows.mapInArrow(_signed(width, band_rows(percent, slots)), _SIGNED))
    # a set is known by its size and two fingerprints, 128 bits beside the size; its number is its place in the table
    known = ["f1", "f2", "n"]  # a fingerprint first, which sorts apart what the size would not
    each = signed.where("n > 0").groupBy(*known).agg(F.min("doc_id").alias("least_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("first"), F.first("bands").alias("bands"))
    sets = materialize(each.withColumn("node", F.monotonically_increasing_id()))
    buckets = materialize(_buckets(sets, sets))
    wanted = buckets.select("node").distinct().join(sets, "node").select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.th").alias("th"))
    texts = rows.join(wanted, rows.doc_id.eqNullSafe(wanted.doc_id) & (rows.th == wanted.th)).select("node", "text")
    blobs = materialize(texts.mapInArrow(_blobs(width), _BLOBS).dropDuplicates(["node"]))
    groups = _links(buckets, blobs, percent)
    named = sets.select("node", *known, "least_id").join(groups, "node", "left").select(*known, "least_id", F.coalesce("root", "node").alias("component"))
    named = materialize(named)
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.select(*known, "component").join(least, "component")
    out = signed.select("doc_id", "th", *known).join(named, known, "left").withColumnRenamed("n", "n_shingles")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "th", "n_shingles", "component", own.alias("component_id"))


def deduplicate(docs: DataFrame, percent: int = 80, width: int = WIDTH) -> DataFrame:
    """The rows of docs, one of each near-duplicate group (the one with the least
    doc_id; of rows equal in doc_id and text, one). Texts without words stay."""
    found = near_duplicates(docs, percent, width)
    none = found.where("component is null")
    first = found.where("component is not null").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")).alias("f"))
    keep = first.select(F.col("f.doc_id").alias("keep_id"), F.col("f.th").alias("keep_th"), F.lit(True).alias("one"))
    keep = materialize(keep.unionAll(none.select("doc_id", "th", F.lit(False)).distinct()))
    rows = docs.withColumn("keep_th", F.xxhash64("text"))
    kept = rows.join(keep, rows.doc_id.cast("long").eqNullSafe(keep.keep_id) & (rows.keep_th == keep.keep_th))
    whole = kept.select(*[docs[c] for c in docs.columns], keep.keep_id, keep.keep_th, keep.one)
    return whole.where("one").dropDuplicates(["keep_id", "keep_th"]).unionAll(whole.where("not one")).drop("keep_id", "keep_th", "one")
