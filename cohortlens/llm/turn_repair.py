"""Repair of damaged conversations by target alignment.

A conversation is well formed if its roles' initials are nothing, or an
optional ``s`` and then ``ua`` once or more. Wagner and Fischer's table aligns a
conversation's turns with the alternating string of every feasible length:
strings of all lengths end alike, so one table over (turns left, letters left)
holds them all, and a second one the strings that begin with ``s``. A greedy
repair gives the incumbent cost; Ukkonen's band leaves out the cells that no
alignment as cheap as that can visit. Each length of least cost is traced back
to its audit, the edits' initials in order, and the ASCII-least audit wins.

Above ``BANDED`` turns the table's columns are folded to their period (next
letter ``u`` or ``a``), which gives the same costs and audits in linear time.

Texts stay out of the alignment. Turns travel as one letter each (initial and
fault), so a conversation is held as a byte a turn; equal conversations are
aligned once a task. The repaired text is hashed as its sorted turns stream by,
in one task for each conversation, since a hash of its whole text is asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.text import by_bytes

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Turns of the longest conversation that is aligned in the banded table.
BANDED = 4096
#: Letters of an audit that travel in one row.
CHUNK = 1 << 16
FAR = 1 << 40
_BLANKS = r"\x20\x09-\x0D"

# -- damage and faults, row by row ---------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): the rows after damage by crc32 of
    ``conv_id:turn`` modulo 20. Nulls in the key, the role and the text are one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    hurt = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        hurt.alias("text"),
        (kind == 0).alias("dropped"),
        F.explode(times).alias("copy"),
    ).drop("copy")


def _digest() -> Column:
    """The order of rows that share a turn and a role, and the identity of texts."""
    return F.unhex(F.sha2(F.col("text"), 256))


def coded(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, initial, code) per row after damage, without its text.

    code: 'x' dropped, 'b' blank, 'd' duplicate, 't' truncated, 'f' without fault.
    """
    text = F.col("text")
    facts = rows.select(
        "conv_id", "turn", "role", "dropped", _digest().alias("digest"),
        (~F.regexp_like(text, F.lit(f"[^{_BLANKS}]"))).alias("blank"),
        (~F.regexp_like(text, F.lit(rf"[.!?][{_BLANKS}]*\z"))).alias("truncated"),
    )
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "digest", "dropped").orderBy(F.asc_nulls_first("turn"))) > 1
    code = F.when(F.col("dropped"), "x").when(F.col("blank"), "b").when(again, "d").when(F.col("truncated"), "t").otherwise("f")
    return facts.select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), code.alias("code"))


# -- alignment -------------------------------------------------------------------


def incumbent(initials: str, codes: str) -> int:
    """Cost of a repair from left to right: a system turn may come first, and what is missing is inserted."""
    cost, want, made, system = 0, "u", 0, False
    for r, c in zip(initials, codes, strict=True):
        if c in "bd":
            cost += DELETE
            continue
        cost += TRUNCATED * (c == "t")
        if r == "s" and not made and not system:
            system = True
            continue
        if r in "ua" and r != want:
            cost += INSERT
        else:
            cost += REROLE * (r not in "ua")
            want = "a" if want == "u" else "u"
        made += 1
    if want == "a":
        return cost + INSERT
    return cost + 2 * INSERT * (system and not made)


class Banded:
    """Least costs to go. ``tail[i][k]``: turns from i on against the last a + k letters
    of ``...uaua``, where a is the number of those turns that may stay; ``head`` the
    same with an ``s`` in front of them, which counts as a letter."""

    def __init__(self, initials: str, codes: str) -> None:
        self.initials, self.codes, n = initials, codes, len(codes)
        loose = np.array([c not in "bd" for c in codes], dtype=bool)
        cut = sum(c == "t" for c in codes)
        slack = incumbent(initials, codes) - DELETE * int((~loose).sum()) - TRUNCATED * cut
        self.more = slack // INSERT
        # a truncated turn costs 3 if it stays, so that its deletion adds 1 only
        self.less = slack if slack <= cut else cut + (slack - cut) // DELETE
        k = np.arange(-self.less, self.more + 1)
        self.alive = np.concatenate([np.cumsum(loose[::-1])[::-1], [0]]).astype(np.int64)
        self.tail = np.full((n + 1, len(k)), FAR, np.int64)
        self.head = np.full((n + 1, len(k)), FAR, np.int64)
        self.tail[n] = np.where(k >= 0, INSERT * k, FAR)
        for i in range(n - 1, -1, -1):
            letters = self.alive[i] + k
            if loose[i]:
                rest = np.append(self.tail[i + 1][1:], FAR)
                fit = np.where(letters % 2 == 0, initials[i] == "u", initials[i] == "a")
                stay = np.where(letters >= 1, self.tail[i + 1] + np.where(fit, KEEP, REROLE) + TRUNCATED * (codes[i] == "t"), FAR)
                row = np.minimum(rest + DELETE, stay)
                first = np.append(self.head[i + 1][1:], FAR) + DELETE
                if initials[i] == "s":
                    opens = (letters >= 3) & (letters % 2 == 1)
                    first = np.minimum(first, np.where(opens, self.tail[i + 1] + TRUNCATED * (codes[i] == "t"), FAR))
                self.head[i] = first
            else:
                row = self.tail[i + 1] + DELETE
                self.head[i] = self.head[i + 1] + DELETE
            row = np.where(letters >= 0, row, FAR)
            self.tail[i] = np.minimum(np.minimum.accumulate(row - INSERT * k) + INSERT * k, FAR)
        np.minimum(self.head, FAR, out=self.head)

    def at(self, table: np.ndarray, i: int, letters: int) -> int:
        k = letters - int(self.alive[i]) + self.less
        return int(table[i][k]) if 0 <= k < table.shape[1] else FAR

    def trace(self, letters: int, system: bool) -> str:
        """The ASCII-least audit of least cost for one target length: D before I, K and R."""
        out, i = [], 0
        while system:
            loose = self.codes[i] not in "bd"
            if self.at(self.head, i, letters) == DELETE + self.at(self.head, i + 1, letters):
                out.append("D")
            else:
                assert loose and self.initials[i] == "s"
                out.append("K")
                letters, system = letters - 1, False
            i += 1
        while i < len(self.codes) or letters:
            here = self.at(self.tail, i, letters)
            if i < len(self.codes) and here == DELETE + self.at(self.tail, i + 1, letters):
                out.append("D")
                i += 1
                continue
            if letters and here == INSERT + self.at(self.tail, i, letters - 1):
                out.append("I")
            else:
                out.append("K" if self.initials[i] == ("u" if letters % 2 == 0 else "a") else "R")
                i += 1
            letters -= 1
        return "".join(out)

    def best(self) -> tuple[int, str]:
        a = int(self.alive[0])
        lengths = range(max(0, a - self.less), a + self.more + 1)
        costs = {n: self.at(self.tail if n % 2 == 0 else self.head, 0, n) for n in lengths}
        least = min(costs.values())
        return least, min(self.trace(n, n % 2 == 1) for n, c in costs.items() if c == least)


def folded(initials: str, codes: str) -> tuple[int, str]:
    """The same for any number of turns, in linear time: columns one period apart differ
    by insertions only, so the next letter stands for all of them.

    States: 0 the rest is nothing or begins with u, 1 begins with a, 2 begins with u
    and is not nothing, 3 an s comes first."""
    n = len(codes)
    go = [[0, INSERT, 2 * INSERT, FAR]] + [[]] * n
    for i in range(n - 1, -1, -1):
        after, c, r = go[n - 1 - i], codes[i], initials[i]
        u, a, v, s = (DELETE + x for x in after)
        if c not in "bd":
            more = TRUNCATED * (c == "t")
            u = min(u, more + (KEEP if r == "u" else REROLE) + after[1])
            v = min(v, more + (KEEP if r == "u" else REROLE) + after[1])
            a = min(a, more + (KEEP if r == "a" else REROLE) + after[0])
            s = min(s, more + after[2]) if r == "s" else s
        u, a = min(u, INSERT + a), min(a, INSERT + u)
        v = min(v, INSERT + a)
        go[n - i] = [u, a, v, s]
    cost = min(go[n][0], go[n][3])
    found = [_follow(initials, codes, go, state) for state in (0, 3) if go[n][state] == cost]
    return cost, min(found)


def _follow(initials: str, codes: str, go: list[list[int]], state: int) -> str:
    out, i, n = [], 0, len(codes)
    while i < n or state != 0:
        here = go[n - i][state]
        if i < n and here == DELETE + go[n - i - 1][state]:
            out.append("D")
            i += 1
            continue
        if state == 3:
            out.append("K")
            state, i = 2, i + 1
            continue
        nxt = 0 if state == 1 else 1
        if here == INSERT + go[n - i][nxt]:
            out.append("I")
        else:
            out.append("K" if initials[i] == ("a" if state == 1 else "u") else "R")
            i += 1
        state = nxt
    return "".join(out)


@lru_cache(maxsize=1 << 14)
def _short(initials: str, codes: str) -> tuple[int, str]:
    return Banded(initials, codes).best()


def align(initials: str, codes: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of turns given by initials and codes, a letter each."""
    if len(codes) <= 64:
        return _short(initials, codes)
    return Banded(initials, codes).best() if len(codes) <= BANDED else folded(initials, codes)


# -- streams over sorted turns -----------------------------------------------------

FACTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Shape:
    """What is kept of a conversation while its turns go by: a letter or two for each."""

    def __init__(self, conv) -> None:
        self.conv, self.initials, self.codes = conv, [], []
        self.least = self.last = None
        self.turns = 0

    def add(self, turn, initial: str, code: str) -> None:
        if code == "x":
            return
        if turn is not None and turn != self.last:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.last = turn
        # roles whose initial is none of the grammar's letters are all alike
        self.initials.append(initial if initial in ("s", "u", "a") else "-")
        self.codes.append(code)

    def rows(self) -> Iterator[tuple]:
        initials, codes = "".join(self.initials), "".join(self.codes)
        cost, audit = align(initials, codes)
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.turns
        legal = sum(initials.count(p) for p in ("su", "ua", "au"))
        counts = (gaps, *(codes.count(c) for c in "bdt"), max(len(codes) - 1, 0) - legal, cost)
        for i in range(0, max(len(audit), 1), CHUNK):
            yield (self.conv, i // CHUNK, *(counts if i == 0 else (None,) * 6), audit[i : i + CHUNK])


_SOLVED = "conv_id long, chunk int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape, out = None, []
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.string()]
    names = ["conv_id", "chunk", *_COUNTS, "audit"]

    def batch_of(rows):
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for conv, turn, initial, code in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "code")], strict=True):
            if shape is None or conv != shape.conv:
                if shape is not None:
                    out += shape.rows()
                shape = _Shape(conv)
            shape.add(turn, initial, code)
        yield batch_of(out)
        out = []
    if shape is not None:
        yield batch_of(shape.rows())


class _Repair:
    """Applies a conversation's audit to its turns as they go by, and hashes what comes out."""

    def __init__(self, conv) -> None:
        self.conv, self.counts, self.audit = conv, None, []
        self.place = self.made = 0
        self.sha = hashlib.sha256()

    def edits(self, counts: tuple, audit: str) -> None:
        self.counts = self.counts or counts
        self.audit.append(audit)

    def begin(self) -> None:
        self.audit = ["".join(self.audit)]
        self.odd = (len(self.audit[0]) - self.audit[0].count("D")) % 2

    def write(self, text: str) -> None:
        self.sha.update(("\n" if self.made else "").encode() + text.encode())
        self.made += 1

    def next_role(self) -> str:
        return "user" if (self.made - self.odd) % 2 == 0 else "assistant"

    def inserts(self) -> None:
        while self.place < len(self.audit[0]) and self.audit[0][self.place] == "I":
            self.write(f"{self.next_role()}:")
            self.place += 1

    def turn(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[0][self.place]
        self.place += 1
        if edit != "D":
            self.write(f"{role if edit == 'K' else self.next_role()}:{text}")

    def row(self) -> tuple:
        self.inserts()
        assert self.place == len(self.audit[0]), "a conversation's turns and audit differ"
        return (self.conv, *self.counts, self.audit[0], self.sha.hexdigest())


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, began, out = None, False, []
    kinds = [pa.int64(), *[pa.int64()] * 6, pa.string(), pa.string()]
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]

    def close():
        if not began:
            now.begin()
        out.append(now.row())

    def batch_of(rows):
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in by_bytes(batches, "text"):
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "chunk", "role", "text", "audit")]
        counts = list(zip(*[batch.column(c).to_pylist() for c in _COUNTS], strict=True))
        for i, (conv, chunk, role, text, audit) in enumerate(zip(*columns, strict=True)):
            if now is None or conv != now.conv:
                if now is not None:
                    close()
                now, began = _Repair(conv), False
            if chunk is not None:
                now.edits(counts[i], audit)
                continue
            if not began:
                now.begin()
                began = True
            now.turn(role, text)
        yield batch_of(out)
        out = []
    if now is not None:
        close()
        yield batch_of(out)


def audits(conversations: DataFrame) -> DataFrame:
    """(conv_id, chunk, gaps, blank, duplicate, truncated, illegal, cost, audit): a row per
    conversation, or more where an audit is over ``CHUNK`` letters (counts in the first)."""
    rows = coded(damage(conversations)).select("conv_id", "turn", "role", "digest", "initial", "code")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest", F.col("code") == "d").mapInArrow(_solve, _SOLVED)


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conv_id.

    conversations needs conv_id, turn, role and text; other columns, whatever
    their names, are left alone. A null conv_id is a conversation of its own;
    null turns come first; null roles and texts are one space. Rows of one turn
    come by role and then by digest of their text, after damage; repeated rows
    stay repeated, and count as duplicates. A conversation of which damage
    leaves nothing has zeros, no audit and the hash of no text. An empty table
    gives no rows. Very long texts and conversations pass by in batches; a byte
    or two for each turn is all that is held of a conversation.
    """
    texts = damage(conversations).where(~F.col("dropped")).select(
        "conv_id", F.lit(None).cast("int").alias("chunk"), "turn", "role", _digest().alias("digest"), "text",
        *[F.lit(None).cast("long").alias(c) for c in _COUNTS], F.lit(None).cast("string").alias("audit"),
    )
    solved = audits(conversations).select(
        "conv_id", "chunk", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"),
        *_COUNTS, "audit",
    )
    both = solved.unionAll(texts).repartition("conv_id")
    ordered = both.sortWithinPartitions("conv_id", F.asc_nulls_last("chunk"), F.asc_nulls_first("turn"), "role", "digest")
    return ordered.mapInArrow(_apply, FACTS + ", repaired_sha256 string")
