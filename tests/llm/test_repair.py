"""Conversation repair: the audit DP against enumeration and a plain DP over whole strings."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from linfold.llm import op12_repair as op

WHITE_CHARS = " \t\n\x0b\x0c\r"
SF001 = "/root/testdata/sf0.001"

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def plain(rows):
    """Cheapest (cost, audit, repaired) by a DP over states with whole strings."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def insert(states):
        for _ in range(3):
            for s, (c, a, out) in list(states.items()):
                t = turn[s]
                new = (c + 2, a + "I", (*out, name[t] + ":"))
                if t not in states or new[:2] < states[t][:2]:
                    states[t] = new
        return states

    states = insert({"": (0, "", ())})
    for role, text, fault in rows:
        after: dict = {}

        def offer(s, item, after=after):
            if s not in after or item[:2] < after[s][:2]:
                after[s] = item

        for s, (c, a, out) in states.items():
            offer(s, (c + 3, a + "D", out))
            if fault in "bd":
                continue
            cut = fault == "t"
            if (s, role[:1]) in step:
                offer(step[s, role[:1]], (c + cut, a + "K", (*out, f"{role}:{text}")))
            offer(turn[s], (c + 2 + cut, a + "R", (*out, f"{name[turn[s]]}:{text}")))
        states = insert(after)
    return min(states[s] for s in ("", "a") if s in states)


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        shown = text.rstrip(WHITE_CHARS)
        if not shown:
            out.append("b")
        elif (role, text) in seen:
            out.append("d")
        elif shown[-1] not in ".!?":
            out.append("t")
        else:
            out.append(".")
        seen.add((role, text))
    return out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        case = zlib.crc32(key.encode()) % 20
        if case == 0:
            continue
        if case == 1:
            text = ""
        elif case == 2:
            text = re.sub("[.!?]", "", text)
        elif case == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if case == 3 else 1)
    return out


def expected(rows):
    out = {}
    after = damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest()))
        pairs = [(r[2], r[3]) for r in mine]
        marks = faults(pairs)
        cost, audit, text = plain([(*p, f) for p, f in zip(pairs, marks, strict=True)])
        turns = [r[1] for r in mine if r[1] is not None]
        initials = [p[0][:1] for p in pairs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit,
                     hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_dp_against_all_audits(n):
    """Every audit of up to 3 rows with up to 4 insertions, by enumeration."""
    letters = {"K": 0, "R": 2, "D": 3}
    for kinds in itertools.product(itertools.product("sua?", ".bt"), repeat=n):
        best = None
        for choice in itertools.product("DKR", repeat=n):
            for gaps in itertools.product(range(4), repeat=n + 1):
                if sum(gaps) > 4:
                    continue
                cost, initials, audit = 2 * sum(gaps), [], ""
                for i in range(n + 1):
                    audit += "I" * gaps[i]
                    initials += ["*"] * gaps[i]
                    if i == n:
                        break
                    role, fault = kinds[i]
                    if fault == "b" and choice[i] != "D":
                        break
                    audit += choice[i]
                    cost += letters[choice[i]] + (fault == "t" and choice[i] != "D")
                    if choice[i] != "D":
                        initials.append(role if choice[i] == "K" else "*")
                else:
                    continue
                if len(audit) < n + sum(gaps) or (best and (cost, audit) >= best):
                    continue
                if any(GRAMMAR.fullmatch("".join(filled))
                       for filled in itertools.product(*[("ua" if x == "*" else x) for x in initials])):
                    best = (cost, audit)
        table = op._block("".join(k[0] for k in kinds), "".join(k[1] for k in kinds), (0,))
        got = min(table[0, e] for e in (0, 3) if (0, e) in table)
        assert got == best, kinds


def test_dp_and_composition_against_plain_strings():
    rng = random.Random(7)
    for _ in range(400):
        n = rng.randrange(0, 40)
        rows = [(rng.choice(["system", "user", "assistant", "tool", "user"]), "x", rng.choice(".....tbd")) for _ in range(n)]
        initials = "".join(op._initial(r[0]) for r in rows)
        marks = "".join(r[2] for r in rows)
        want = plain(rows)[:2]
        table = op._block(initials, marks, (0,))
        assert min(table[0, e] for e in (0, 3) if (0, e) in table) == want
        cut = rng.randrange(0, n + 1)
        whole = op.composed(op._block(initials[:cut], marks[:cut], (0, 1, 2, 3)),
                            op._block(initials[cut:], marks[cut:], (0, 1, 2, 3)))
        assert min(whole[0, e] for e in (0, 3) if (0, e) in whole) == want


def test_collisions_are_verified(monkeypatch):
    """With a hash of one bit every search goes astray; the letters still decide."""
    monkeypatch.setattr(op, "MODULUS", 2)
    test_dp_and_composition_against_plain_strings()


def _random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(rng.randrange(0, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "", None, "tool"])
            text = rng.choice(["Hi.", "hello there", "", " \t", None, "Ja!", "é\x85", f"text {rng.random()}.", "so?  "])
            turn = rng.choice([turn, turn, turn, turn + 2, None])
            rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("block_rows", [3, op.BLOCK_ROWS])
def test_repaired_equals_brute_force(spark, block_rows):
    rows = _random_rows(3, 60, 14) + [(1000, t, ["user", "assistant"][t % 2], f"t {t % 50}.") for t in range(400)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = found(op.repaired(frame, op.damaged(frame), block_rows))
    assert got == expected(rows)


def test_conversation_over_many_partitions_and_long_texts(spark):
    """One conversation holds nearly all rows and crosses every range; one text has 4 MB."""
    rows = [(5, t, "user" if t % 3 else "assistant", "x" * (4_000_000 if t == 17 else 3) + ".!"[t % 2]) for t in range(3000)]
    rows += [(6, 0, "system", "s."), (7, 1, "user", "Hm?"), (7, 2, "assistant", "Yes.")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(op.repaired(frame, op.damaged(frame), 100)) == expected(rows)


def test_empty_table_extra_columns_and_whole_table(spark):
    assert op.repaired(spark.createDataFrame([], SCHEMA), op.damaged(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = _random_rows(5, 10, 6)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", _r int, digest string")
    assert found(op.repaired(frame, op.damaged(frame))) == expected(rows)
    table = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    assert found(op.query(spark, SF001)) == expected(table)
