"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest

from strataloom.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, cost string"
WHITE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for c, t, role, text, *_ in rows:
        show = lambda x: " " if x is None else str(x)
        role, text, d = show(role), show(text), zlib.crc32(f"{show(c)}:{show(t)}".encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        role = "user" if d == 4 else role
        out += [(c, t, role, text)] * (2 if d == 3 else 1)
    return out


def cheapest(rows):
    """Of all ways to each place, by cost and then letters, with what they leave."""
    go = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def put_in(best):
        for _ in range(3):
            for state, (cost, audit, kept) in list(best.items()):
                nxt = "a" if state == "u" else "u"
                new = (cost + 2, audit + "I", kept + (({"u": "user:", "a": "assistant:"})[nxt],))
                if nxt not in best or new[:2] < best[nxt][:2]:
                    best[nxt] = new
        return best

    for role, text, fault in rows:
        after = {}

        def offer(state, way):
            if state not in after or way[:2] < after[state][:2]:
                after[state] = way

        for state, (cost, audit, kept) in put_in(best).items():
            offer(state, (cost + 3, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            if role[:1] and role[:1] in go[state]:
                offer(role[:1], (cost + more, audit + "K", kept + (f"{role}:{text}",)))
            nxt = "a" if state == "u" else "u"
            offer(nxt, (cost + 2 + more, audit + "R", kept + (f"{'user' if nxt == 'u' else 'assistant'}:{text}",)))
        best = after
    best = put_in(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def full(rows):
    out = {}
    every = {r[0] for r in rows}
    after = sorted(damage(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3]))
    for c, conv in groupby(after, key=lambda r: r[0]):
        conv, seen, judged = list(conv), set(), []
        for _, _, role, text in conv:
            core = text.strip(WHITE)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = {t for _, t, _, _ in conv if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[:1] for r, _, _ in judged]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = cheapest(judged)
        n = lambda f: sum(x == f for _, _, x in judged)
        out[c] = (gaps, n("blank"), n("duplicate"), n("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return {c: out.get(c, (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())) for c in every}


def told(df):
    rows = [(r.conv_id, (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)) for r in df.collect()]
    assert len({c for c, _ in rows}) == len(rows)
    return dict(rows)


def table(seed, n=120):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", "  \n", "Well, so be it!  ", "No way. ", "ok ", None, "a.", "b.", "c", "d!"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "ursa"]
    rows = []
    for c in range(n):
        t = rng.randint(0, 3)
        for _ in range(rng.randint(1, 12)):
            rows.append((c * 5 - 100, t, rng.choice(roles[: rng.choice([2, 4, 5, 9])]), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}.", "x"))
            t += rng.choice([1, 1, 1, 1, 2, 5])
    for i in range(300):  # one long conversation, one without an id, turns null or stated twice
        rows.append((-7, i, roles[i % 2], rng.choice(texts), "x"))
        if i < 30:
            rows += [(None, rng.choice([None, i, 3]), rng.choice(roles), f"{i}.", "x")]
    rows += [(9999, None, "user", "q?", "x"), (9999, None, "user", "q?", "x"), (9999, None, "assistant", "r" * 300_000 + ".", "x")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seg", "fan"), [(10, 10), (0, 6), (2, 10)])
def test_equals_a_plain_search(spark, monkeypatch, seg, fan):
    monkeypatch.setattr(repair, "SEG_BITS", seg)
    monkeypatch.setattr(repair, "FAN_BITS", fan)
    rows = table(seg)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert told(repair.repair(repair.damaged(df), df.select("conv_id"))) == full(rows)


def test_distances_equal_those_of_all_ways():
    """Every short conversation of every code."""
    rng = random.Random(3)
    for _ in range(300):
        codes = [rng.randrange(12) for _ in range(rng.randint(1, 6))]
        dist = repair.distances(codes, repair.FINAL)
        for i in range(len(codes)):
            for s in range(4):
                assert dist[i][s] == min(cost + dist[i + step][after] for _, step, after, cost in repair.arcs(codes[i], s))


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair.repair(repair.damaged(df), df.select("conv_id")).count() == 0
    far = spark.createDataFrame([(1, -(1 << 63), "user", "a.", "x"), (1, (1 << 63) - 1, "assistant", "b.", "x")], SCHEMA)
    r = repair.repair(far).first()
    assert (r.gaps, r.cost, r.audit) == ((1 << 63) - 1, 0, "KK")


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(queries.op11_conversation_repair(spark, sf)) == full(rows)
