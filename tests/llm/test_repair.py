"""Repaired conversations against a search over (price, audit) of all ways."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import queries, repair

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMES = {"u": "user", "a": "assistant"}
WORD = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        said = WORD.findall(text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def inserted(ways):
    """Ways with Insert added wherever it is cheaper."""
    out = dict(ways)
    for _ in range(4):
        for state, (cost, audit, turns) in list(out.items()):
            for letter, to in NEXT[state].items():
                if letter in NAMES:
                    new = (cost + 5, audit + "I", turns + (f"{NAMES[letter]}:",))
                    out[to] = min(out.get(to, new), new)
    return out


def brute(rows):
    """price, audit and repaired turns: for every state the least way there, row by row."""
    ways = inserted({0: (0, "", ())})
    for (role, text), fault in zip(rows, faults(rows), strict=True):
        later = {}

        def offer(state, way):
            later[state] = min(later.get(state, way), way)

        for state, (cost, audit, turns) in ways.items():
            offer(state, (cost + 2, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1] in NEXT[state]:
                offer(NEXT[state][role[:1]], (cost + more, audit + "K", (*turns, f"{role}:{text}")))
            for letter, name in NAMES.items():
                if letter in NEXT[state]:
                    offer(NEXT[state][letter], (cost + more + 1, audit + "R", (*turns, f"{name}:{text}")))
        ways = inserted(later)
    return min(ways[state] for state in (0, 3) if state in ways)


def summary_of(key, rows):
    """The expected row of the query, from (turn, role, text) after damage."""
    rows = sorted(((t is not None, t or 0, r, x) for t, r, x in rows))
    said = [(r, x) for _, _, r, x in rows]
    turns = [t for given, t, _, _ in rows if given]
    found = faults(said)
    cost, audit, repaired = brute(said)
    initials = [r[:1] for r, _ in said]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
    return {
        "conv_id": key, "gaps": gaps, **{k: found.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": illegal, "cost": cost, "audit": audit, "repaired_sha256": digest,
    }


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def drawn(rng, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", "usher", "", "x", None]
    texts = ["Yes.", "no", "", " \n", "Well!", "Why?", "a. ", "b", None]
    rows = []
    for turn in range(n):
        role = ["user", "assistant"][turn % 2] if rng.random() < 0.5 else rng.choice(roles)
        text = rng.choice(texts) if rng.random() < 0.4 else f"{turn} {rng.choice(['said.', 'cut', 'so!'])}"
        rows.append((conv, rng.choice([turn, turn, turn, None, n]), role, text))
    return rows


def frame(spark, rows):
    own = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return own.withColumns({"id": F.lit("clash"), "at": F.lit(0), "code": F.lit(1)})


@pytest.mark.parametrize("block", [1, 2, 8, 1024])
def test_query_against_a_search_over_all_ways(spark, block):
    rng = random.Random(block)
    rows = [r for conv in range(90) for r in drawn(rng, conv if conv else None, rng.randrange(1, 14))]
    rows += drawn(rng, 1_000, 90)
    rows += [(2_000, k, "user", "again.") for k in range(60)]
    given = frame(spark, rows)
    found = queries.repair_digests(*repair.repairs(queries.damaged(given), every=given, block=block)).collect()
    left = damaged(rows)
    expected = {c: summary_of(c, [r[1:] for r in left if r[0] == c]) for c in {r[0] for r in rows}}
    assert {r.conv_id: r.asDict() for r in found} == expected and len(found) == len(expected)


def test_paths_of_blocks_entered_in_any_state():
    """Ways through blocks from all four states, by trying every way."""
    rng = random.Random(11)
    lengths = np.array([rng.randrange(0, 7) for _ in range(120)])
    codes = np.array([rng.randrange(16) for _ in range(lengths.sum())])
    after = np.array([[rng.choice([0, 3, 5, 9, repair._FAR]) for _ in range(3)] + [0] for _ in lengths])
    blocks = repair.Blocks(codes, lengths, after, np.zeros(len(lengths), bool))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for state, (sizes, letters, given, _, final) in enumerate(blocks.least(4)):
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for b in range(len(lengths)):
            own = codes[starts[b] : starts[b + 1]].tolist()
            price, audit, left = every_way(own, after[b].tolist(), state)
            assert blocks.prices[blocks.base[b], state] == price
            assert "".join("DIKR"[x] for x in letters[ends[b] : ends[b + 1]]) == audit and final[b] == left


def every_way(codes, after, state):
    """Least (price, audit, state behind): inserts stand before rows, and behind none but the last block's."""
    insert = [2, 2, 3, 2]
    if not codes:
        return after[state], "", state
    options = []

    def go(at, state, cost, audit, inserts):
        if at == len(codes):
            options.append((cost + after[state], audit, state))
            return
        if inserts < 2:
            go(at, insert[state], cost + 5, audit + "I", inserts + 1)
        kind, fault = divmod(codes[at], 4)
        go(at + 1, state, cost + 2, audit + "D", 0)
        if fault > 1:
            return
        more = 5 * (fault == 1)
        if (state, kind) in ((0, 1), (0, 2), (1, 2), (2, 3), (3, 2)):
            go(at + 1, kind, cost + more, audit + "K", 0)
        go(at + 1, insert[state], cost + more + 1, audit + "R", 0)

    go(0, state, 0, "", 0)
    return min(options)


def test_edits_give_the_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "Hm."), (1, 2, "system", " "), (1, 3, "user", "cut"), (2, 0, "user", "One.")]
    edits, summary = repair.repairs(frame(spark, rows))
    found = [tuple(r)[:1] + tuple(r)[3:] for r in edits.orderBy("conv_id", "id", "step").collect()]
    assert found == [
        (1, "R", "user", "Hi."), (1, "K", "assistant", "Hm."), (1, "D", None, None), (1, "D", None, None), (2, "D", None, None),
    ]
    assert {r.conv_id: (r.cost, r.audit) for r in summary.collect()} == {1: (5, "RKDD"), 2: (2, "D")}


def test_nothing_and_lost_conversations(spark):
    lost = next(c for c in range(1_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    given = frame(spark, [(lost, 0, "user", "Hi.")])
    row = queries.repair_digests(*repair.repairs(queries.damaged(given), every=given)).collect()
    assert [r.asDict() for r in row] == [
        dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0) | {"conv_id": lost, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    ]
    edits, summary = repair.repairs(given.limit(0))
    assert edits.count() == summary.count() == 0
    with pytest.raises(ValueError, match="power of two"):
        repair.repairs(given, block=3)


def test_a_very_long_conversation(spark):
    """Twenty thousand turns in one conversation, in blocks of 256: all rows of a hot key, none of them in one task."""
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    rows = spark.range(20_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("turn "), "id", F.lit(".")).alias("text"))
    edits, summary = repair.repairs(rows.where("turn <> 777"), block=256)
    row = summary.first()
    assert (row.gaps, row.illegal, row.cost) == (1, 1, 2) and row.audit == "K" * 776 + "D" + "K" * 19_222
    assert edits.where("edit <> 'D'").count() == 19_998
