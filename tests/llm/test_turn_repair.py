"""Conversation repair against enumerating every edit script, and on odd rows."""

import hashlib
import random
import re
import zlib

import pytest

from cohortlens.llm import turn_repair
from cohortlens.llm.turn_repair import Banded, folded, incumbent

SCHEMA = "conv_id long, turn long, role string, text string, code string, audit string, copy int"


def every_script(initials, codes):
    """The least (cost, audit) of all edit scripts within the incumbent's cost."""
    most, found = incumbent(initials, codes), []

    def go(i, out, cost, audit):
        if cost > most:
            return
        if i == len(codes):
            if re.fullmatch("(s?(ua)+)?", out):
                found.append((cost, audit))
        else:
            go(i + 1, out, cost + 4, audit + "D")
            if codes[i] not in "bd":
                cut = 3 * (codes[i] == "t")
                go(i + 1, out + initials[i], cost + cut, audit + "K")
                for r in "ua":
                    go(i + 1, out + r, cost + cut + 3, audit + "R")
        for r in "ua":
            go(i, out + r, cost + 3, audit + "I")

    go(0, "", 0, "")
    return min(found)


def test_least_cost_and_least_audit_of_all_scripts():
    rng = random.Random(3)
    for _ in range(250):
        n = rng.randrange(0, 6)
        initials, codes = "".join(rng.choices("uas-", [4, 4, 2, 1], k=n)), "".join(rng.choices("fftbd", k=n))
        want = every_script(initials, codes)
        assert Banded(initials, codes).best() == want == folded(initials, codes), (initials, codes)


def test_folded_columns_give_the_banded_tables_audits():
    rng = random.Random(4)
    for n in [*range(6, 120), 700]:
        initials, codes = "".join(rng.choices("uas-", [8, 8, 1, 1], k=n)), "".join(rng.choices("ffffffftbd", k=n))
        assert Banded(initials, codes).best() == folded(initials, codes)


def test_band_leaves_out_most_cells():
    n = 2000
    initials = "".join("ua"[i % 2] if i % 97 else "s" for i in range(n))
    table = Banded(initials, "f" * n)
    assert table.tail.shape[1] < n / 20 and table.best() == folded(initials, "f" * n)


def repaired(rows):
    """The contract, in plain Python over the rows of one conversation."""
    sp = lambda v: " " if v is None else str(v)
    kept = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = ("user" if kind == 4 else sp(role)), sp(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, codes = set(), ""
    for _, role, text in kept:
        bare = text.strip(" \t\n\x0b\x0c\r")
        codes += "b" if not bare else "d" if (role, text) in seen else "f" if bare[-1] in ".!?" else "t"
        seen.add((role, text))
    turns = [t for t, _, _ in kept if t is not None]
    first = [r[:1] for _, r, _ in kept]
    initials = "".join(r if r in ("u", "a", "s") else "-" for r in first)
    cost, audit = folded(initials, codes)
    lines, i = [], 0
    odd = sum(e != "D" for e in audit) % 2
    for e in audit:
        role = "user" if (len(lines) - odd) % 2 == 0 else "assistant"
        if e == "I":
            lines.append(f"{role}:")
            continue
        if e != "D":
            lines.append(f"{kept[i][1] if e == 'K' else role}:{kept[i][2]}")
        i += 1
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(codes.count(c) for c in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def odd_rows():
    rng = random.Random(9)
    text = ["Well.", "Well.", "no end", "", " \t", None, "Ü? \n", "x" * 100000 + "!", "a.b.c", ". "]
    rows = [(c, rng.choice([*range(9), None]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(text)) for c in range(60) for _ in range(rng.randrange(1, 9))]
    rows += [(None, t, "user", "hello.") for t in (1, 1, None)] + [(70, None, None, None)] * 3
    rows += [(80, t, "assistant" if t % 3 else "user", f"turn {t}" + "." * (t % 5 > 0)) for t in range(0, 900, 2)]
    rows += [(90, 5, "user", "hi!")] * 4
    rows += [(c, 0, "user", "Only one.") for c in range(100, 140)]  # some are dropped whole
    return rows


@pytest.mark.parametrize("banded,chunk", [(4096, 1 << 16), (50, 7)])
def test_odd_rows(llm, monkeypatch, banded, chunk):
    monkeypatch.setattr(turn_repair, "BANDED", banded)
    monkeypatch.setattr(turn_repair, "CHUNK", chunk)
    rows = odd_rows()
    df = llm.createDataFrame([(*r, "x", "x", 1) for r in rows], SCHEMA).repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(df).collect()}
    want = {c: repaired([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want
    assert any(a == "" and s == hashlib.sha256(b"").hexdigest() for *_, a, s in got.values())


def test_empty_table_and_a_conversation_beyond_the_table(llm):
    assert turn_repair.repair(llm.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, t, "user" if t % 3 else "assistant", f"So {t}.") for t in range(6000)]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    assert [tuple(r) for r in turn_repair.repair(df).collect()] == [(1, *repaired(rows))]
