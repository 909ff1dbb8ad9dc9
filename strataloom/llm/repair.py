"""Conversation structure repair: cheapest edits by Dial's bucket queue, audited by a walk of tight arcs.

A repaired conversation has the role initials ``(s?(ua)+)?``. Rows are blank (no character other than ASCII white space),
duplicate (role and text seen earlier in the conversation), truncated (its last such character is none of ``.!?``) or fine; the first of these
counts. Keeping a row costs 0, a new role (user or assistant) 2, deleting 3, an empty turn put in 2, and a truncated row that stays 1 more;
blank and duplicate rows have to go. Nodes are (rows passed, state), states are start, s, u and a. Costs are small whole numbers, so
a circular queue of buckets gives all distances to the end (Dial 1969); the walk takes, at each node, the least letter (D, I, K, R) among
arcs that lose exactly their cost in distance, which makes the audit the least of all cheapest ones.

Rows are sorted by ranges of (conversation, turn) over all tasks, so one conversation may hold any share of all rows. It is cut into
segments of at most 2 ** ``SEG_BITS`` rows. A segment's distances depend on those at its end only, by a 4 x 4 matrix of least costs; matrices of consecutive
segments are multiplied level by level (``FAN`` at once), and so are the maps from the state in which a walk enters a segment to that in which it leaves.
Only repaired texts' digests and audits are read through in order by one task a conversation, in constant memory, as a digest of the whole needs.

Defined cases: null roles and texts count as one space; rows without a conv_id are one conversation; rows go by turn, null first, those of equal turn by
the beginnings of role (16 characters) and text (48), then by a hash of both; equal rows are rows of their own, the later ones duplicates; initials other than s, u and a are never
legal; gaps ignore null turns and stop at the largest long; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialize, scope

#: Rows of a segment (bits), and segments that are put together at once (bits).
SEG_BITS, FAN_BITS = 10, 10
START, S, U, A = range(4)
#: States reached from a state by a row or turn with an initial; the turn that can be put in; what it costs to end in a state.
NEXT = ({S: S, U: U}, {U: U}, {A: A}, {U: U})
PUT_IN = (U, U, A, U)
FINAL = (0, 4, 2, 0)
ROLE = {U: "user", A: "assistant"}
FINE, TRUNCATED, GONE = range(3)
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
_FAR = 1 << 60
_WHITE = " \t\n\x0b\x0c\r"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def arcs(code: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, rows passed, next state, cost) of the arcs from a state before a row of ``code``, by letter."""
    initial, fault = code & 3, code >> 2
    yield "D", 1, state, DELETE
    yield "I", 0, PUT_IN[state], INSERT
    if fault != GONE:
        if initial and initial in NEXT[state]:
            yield "K", 1, NEXT[state][initial], KEEP + fault
        yield "R", 1, PUT_IN[state], REROLE + fault


#: Arcs into (row passed or not, state), from a state, by code: what the queue relaxes backwards.
_BACK = [[[(1 - step, before, cost) for before in range(4) for _, step, after, cost in arcs(code, before) if after == state] for state in range(4)] for code in range(12)]


def distances(codes: list[int], end: tuple[int, ...]) -> list[list[int]]:
    """Least costs from each (row, state) to the end, where states cost ``end``; by buckets."""
    n = len(codes)
    out = [[_FAR] * 4 for _ in range(n + 1)]
    base = min(end)
    width = max((e - base for e in end if e < _FAR), default=0) + 4
    buckets: list[list[tuple[int, int]]] = [[] for _ in range(width)]
    left = 0
    for state, cost in enumerate(end):
        if cost < _FAR:
            out[n][state] = cost
            buckets[(cost - base) % width].append((n, state))
            left += 1
    now = base
    while left:
        bucket = buckets[(now - base) % width]
        while bucket:
            i, state = bucket.pop()
            left -= 1
            if out[i][state] != now:
                continue  # reached cheaper meanwhile
            for passed, at in ((0, i), (1, i - 1)):
                # an arc that passes a row comes from the row before; one that puts a turn in stays before its row
                if 0 <= at < n:
                    for stays, before, cost in _BACK[codes[at]][state]:
                        if stays != passed and now + cost < out[at][before]:
                            out[at][before] = now + cost
                            buckets[(now + cost - base) % width].append((at, before))
                            left += 1
        now += 1
    return out


def walk(codes: list[int], dist: list[list[int]], state: int, last: bool) -> tuple[str, list[tuple[int, int, int]], int]:
    """The audit, the turns that stay or come in as (row, place, new initial or -1 for the row's own role), and the state at the end."""
    audit, turns, i, n = [], [], 0, len(codes)
    place = 0
    while i < n:
        for letter, step, after, cost in arcs(codes[i], state):
            if cost + dist[i + step][after] == dist[i][state]:
                break
        audit.append(letter)
        if letter == "I":
            turns.append((i, place, after))
            place += 1
        else:
            if letter != "D":
                turns.append((i, 8, after if letter == "R" else -1))
            place = 0
        i, state = i + step, after
    while last and FINAL[state]:
        state = PUT_IN[state]
        audit.append("I")
        turns.append((max(n - 1, 0), 9 + state, state))
    return "".join(audit), turns, state


def _matrix(codes: list[int]) -> list[int]:
    """Least costs from each state before the segment to each state after it, row by row."""
    columns = [distances(codes, tuple(0 if q == s else _FAR for s in range(4)))[0] for q in range(4)]
    return [columns[q][p] for p in range(4) for q in range(4)]


def _times(m: list[int], end: list[int]) -> list[int]:
    return [min(_FAR, *(m[4 * p + q] + end[q] for q in range(4))) for p in range(4)]


def _product(a: list[int], b: list[int]) -> list[int]:
    return [min(_FAR, *(a[4 * p + r] + b[4 * r + q] for r in range(4))) for p in range(4) for q in range(4)]


def _rows(f: Callable, names: list[str], types: list[pa.DataType], every: int = 512) -> Callable:
    """``mapInArrow`` function of a generator over rows as dictionaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for at in range(0, len(batch), 256):
                    yield from batch.slice(at, 256).to_pylist()

        held = []
        for row in f(rows()):
            held.append(row)
            if len(held) == every:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    return run


_CONV = ["none", "conv"]
_LONGS = pa.list_(pa.int64())


def ordered(rows: DataFrame) -> DataFrame:
    """(none, conv, pos, turn, role, text) of ``rows`` (conv_id, turn, role, text), written; pos rises in order over all rows."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    r = rows.select(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    r = r.withColumns({"r16": F.left("role", F.lit(16)), "t48": F.left("text", F.lit(48)), "h": F.xxhash64("role", "text"), "salt": F.monotonically_increasing_id()})
    # equal rows may lie in several ranges: their order does not show
    key = [*_CONV, "turn", "r16", "t48", "h", "salt"]
    return materialize(r.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("pos", F.monotonically_increasing_id()).select(*_CONV, "pos", "turn", "role", "text"), "turns")


def judged(turns: DataFrame) -> DataFrame:
    """(none, conv, pos, turn, code, fault) of ordered turns, written; fault is blank, duplicate, truncated or null."""
    worded = F.rtrim("text", F.lit(_WHITE))
    same = F.sha2(F.concat_ws(":", F.when(F.col("none"), "-").otherwise(F.col("conv").cast("string")), F.length("role").cast("string"), F.concat("role", "text")), 256)
    t = turns.select(*_CONV, "pos", "turn", F.left("role", F.lit(1)).alias("initial"), (worded == "").alias("blank"), (~F.right(worded, F.lit(1)).isin(".", "!", "?")).alias("cut"), same.alias("same"))
    repeated = t.groupBy("same").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").select("same", "first")
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("cut"), "truncated")
    initial = F.when(F.col("initial") == "s", S).when(F.col("initial") == "u", U).when(F.col("initial") == "a", A).otherwise(0)
    j = t.join(repeated, "same", "left").withColumn("fault", fault)
    code = initial + 4 * F.when(F.col("fault") == "truncated", TRUNCATED).when(F.col("fault").isNotNull(), GONE).otherwise(FINE)
    return materialize(j.select(*_CONV, "pos", "turn", code.alias("code"), "fault"), "judged")


def _segments(rows: DataFrame) -> DataFrame:
    """(none, conv, seg, pos, codes), written."""
    seg = F.shiftright("pos", SEG_BITS)
    s = rows.groupBy(*_CONV, seg.alias("seg")).agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("x"))
    return materialize(s.select(*_CONV, "seg", F.col("x.pos").alias("pos"), F.col("x.code").alias("codes")), "segments")


def _of_seg(names: list[str], types: list[pa.DataType], f: Callable) -> Callable:
    return _rows(lambda rows: ((r["none"], r["conv"], r["seg"], *f(r)) for r in rows), [*_CONV, "seg", *names], [pa.bool_(), pa.int64(), pa.int64(), *types])


def _levels(leaves: DataFrame, value: str, combine: Callable, spread: Callable, top: list[int]) -> DataFrame:
    """(none, conv, seg, told) for each of ``leaves`` (none, conv, seg, ``value``: longs), written.

    Values are combined upwards, a group of consecutive segments at once, until a conversation is one value; ``spread(values, told)`` hands
    down what a group is told (``top`` at the root) to each of its members."""
    schema = "none boolean, conv long, seg long, v array<long>"
    up = [leaves.select(*_CONV, "seg", F.col(value).alias("v"))]
    grouped = []
    while True:
        level = up[-1]
        most = level.groupBy(*_CONV).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            break
        # whole conversations where all are short enough, or else neighbours
        parent = F.lit(0).cast("long") if most <= 1 << FAN_BITS else F.shiftright("seg", FAN_BITS)
        g = level.groupBy(*_CONV, parent.alias("parent")).agg(F.array_sort(F.collect_list(F.struct("seg", "v"))).alias("x"))
        g = materialize(g.select(*_CONV, F.col("parent").alias("seg"), F.col("x.seg").alias("members"), F.col("x.v").alias("values")), "level")
        grouped.append(g)
        up.append(g.select(*_CONV, "seg", F.col("values")).mapInArrow(_of_seg(["v"], [_LONGS], lambda r: (combine(r["values"]),)), schema))
    told = up[-1].select(*_CONV, "seg", F.array(*(F.lit(x).cast("long") for x in top)).alias("told"))
    for g in reversed(grouped):
        both = g.join(told, [*_CONV, "seg"])
        flat = _rows(lambda rows: ((r["none"], r["conv"], s, t) for r in rows for s, t in zip(r["members"], spread(r["values"], r["told"]))), [*_CONV, "seg", "told"], [pa.bool_(), pa.int64(), pa.int64(), _LONGS])
        told = both.mapInArrow(flat, "none boolean, conv long, seg long, told array<long>")
    return materialize(told, "told")


def _combined(values: list[list[int]]) -> list[int]:
    out = values[0]
    for v in values[1:]:
        out = _product(out, v)
    return out


def _ends(values: list[list[int]], end: list[int]) -> list[list[int]]:
    out = [end]
    for v in reversed(values[1:]):
        out.append(_times(v, out[-1]))
    return out[::-1]


def _entries(values: list[list[int]], entry: list[int]) -> list[list[int]]:
    out = [entry]
    for v in values[:-1]:
        out.append([v[out[-1][0]]])
    return out


def _composed(values: list[list[int]]) -> list[int]:
    out = list(range(4))
    for v in values:
        out = [v[s] for s in out]
    return out


def _long_plan(segments: DataFrame, many: DataFrame) -> DataFrame:
    """(none, conv, seg, entry, end, last), written, for conversations of several segments."""
    own = segments.join(many, _CONV)
    matrices = materialize(own.mapInArrow(_of_seg(["m"], [_LONGS], lambda r: (_matrix(r["codes"]),)), "none boolean, conv long, seg long, m array<long>"), "matrices")
    ends = _levels(matrices, "m", _combined, _ends, list(FINAL))
    leave = lambda r: ([walk(r["codes"], d, s, False)[2] if (d := distances(r["codes"], tuple(r["told"])))[0][s] < _FAR else s for s in range(4)],)
    maps = materialize(own.join(ends, [*_CONV, "seg"]).mapInArrow(_of_seg(["m"], [_LONGS], leave), "none boolean, conv long, seg long, m array<long>"), "maps")
    entries = _levels(maps, "m", _composed, _entries, [START])
    last = own.groupBy(*_CONV).agg(F.max("seg").alias("last"))
    both = ends.withColumnRenamed("told", "end").join(entries.withColumnRenamed("told", "entry"), [*_CONV, "seg"]).join(last, _CONV)
    return materialize(both.select(*_CONV, "seg", F.col("entry")[0].alias("entry"), "end", (F.col("seg") == F.col("last")).alias("last")), "plan")


_LEGAL = {(S, U), (U, A), (A, U)}


def _solve(r: dict) -> tuple:
    codes, entry, end = r["codes"], r["entry"] or START, r["end"] or FINAL
    last = r["last"] is not False
    dist = distances(codes, tuple(end))
    audit, turns, state = walk(codes, dist, entry, last)
    cost = dist[0][entry] - (0 if last else end[state])
    initials = [c & 3 for c in codes]
    illegal = sum(p not in _LEGAL for p in zip(initials, initials[1:]))
    told = [{"pos": r["pos"][i], "place": place, "role": ROLE.get(new)} for i, place, new in turns]
    return audit, cost, illegal, initials[0], initials[-1], told


_TOLD = pa.list_(pa.struct([("pos", pa.int64()), ("place", pa.int32()), ("role", pa.string())]))


def solved(segments: DataFrame) -> DataFrame:
    """Each segment's part of the audit and the repaired turns, written."""
    many = materialize(segments.groupBy(*_CONV).agg(F.count("*").alias("n")).filter("n > 1").select(*_CONV), "many")
    if many.isEmpty():
        plan = segments.select("*", F.lit(None).cast("long").alias("entry"), F.lit(None).cast("array<long>").alias("end"), F.lit(None).cast("boolean").alias("last"))
    else:
        plan = segments.join(_long_plan(segments, many), [*_CONV, "seg"], "left")
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), _TOLD]
    return materialize(plan.mapInArrow(_of_seg(["audit", "cost", "illegal", "first", "final", "turns"], types, _solve), "none boolean, conv long, seg long, audit string, cost long, illegal long, first int, final int, turns array<struct<pos:long,place:int,role:string>>"), "solved")


def _per_conversation(rows: Iterator[dict], start: Callable, add: Callable, end: Callable) -> Iterator[tuple]:
    """A state a conversation, over rows sorted by it."""
    key, state = None, None
    for r in rows:
        if (r["none"], r["conv"]) != key:
            if key is not None:
                yield (*key, *end(state))
            key, state = (r["none"], r["conv"]), start()
        add(state, r)
    if key is not None:
        yield (*key, *end(state))


def _audits(parts: DataFrame) -> DataFrame:
    """(none, conv, audit, cost, illegal) of solved segments, put together in order."""

    def add(state: dict, r: dict) -> None:
        state["audit"].append(r["audit"])
        state["cost"] += r["cost"]
        state["illegal"] += r["illegal"] + (state["final"] is not None and (state["final"], r["first"]) not in _LEGAL)
        state["final"] = r["final"]

    f = _rows(lambda rows: _per_conversation(rows, lambda: {"audit": [], "cost": 0, "illegal": 0, "final": None}, add, lambda s: ("".join(s["audit"]), s["cost"], s["illegal"])), [*_CONV, "audit", "cost", "illegal"], [pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int64()])
    dealt = parts.drop("turns").repartition(*_CONV).sortWithinPartitions(*_CONV, "seg")
    return dealt.mapInArrow(f, "none boolean, conv long, audit string, cost long, illegal long")


def repaired_turns(turns: DataFrame, parts: DataFrame) -> DataFrame:
    """(none, conv, pos, place, role, text) of the repaired conversations; (pos, place) is their order, empty turns put in have an empty text."""
    r = parts.select(*_CONV, F.explode("turns").alias("t")).select(*_CONV, "t.pos", "t.place", F.col("t.role").alias("new"))
    own = turns.select("pos", F.col("role").alias("own"), F.col("text").alias("said"))
    text = F.when(F.col("place") == 8, F.col("said")).otherwise("")
    return r.join(own, "pos").select(*_CONV, "pos", "place", F.coalesce("new", "own").alias("role"), text.alias("text"))


def _digests(repaired: DataFrame) -> DataFrame:
    """(none, conv, sha) of ``role:text``, joined by newlines; a conversation is streamed, not held."""

    def add(state: list, r: dict) -> None:
        if state[1]:
            state[0].update(b"\n")
        state[0].update(r["said"].encode())
        state[1] = True

    f = _rows(lambda rows: _per_conversation(rows, lambda: [hashlib.sha256(), False], add, lambda s: (s[0].hexdigest(),)), [*_CONV, "sha"], [pa.bool_(), pa.int64(), pa.string()])
    dealt = repaired.select(*_CONV, "pos", "place", F.concat("role", F.lit(":"), "text").alias("said")).repartition(*_CONV).sortWithinPartitions(*_CONV, "pos", "place")
    return dealt.mapInArrow(f, "none boolean, conv long, sha string")


def _gaps() -> Column:
    wide = lambda c: c.cast("decimal(20,0)")
    n = wide(F.max("turn")) - wide(F.min("turn")) + 1 - wide(F.countDistinct("turn"))
    most = (1 << 63) - 1
    return F.when(n > most, most).otherwise(F.coalesce(n.cast("long"), F.lit(0))).cast("long").alias("gaps")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """A row for each conversation of ``rows`` (conv_id, turn, role, text), and of ``conversations`` (conv_id) where given: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    with scope(rows.sparkSession) as results:
        turns = ordered(rows)
        codes = judged(turns)
        parts = solved(_segments(codes))
        faults = (F.count_if(F.col("fault") == name).cast("long").alias(name) for name in ("blank", "duplicate", "truncated"))
        counted = codes.groupBy(*_CONV).agg(_gaps(), *faults)
        every = (conversations if conversations is not None else rows).select(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv")).distinct()
        out = every.join(counted, _CONV, "left").join(_audits(parts), _CONV, "left").join(_digests(repaired_turns(turns, parts)), _CONV, "left")
        zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
        out = out.select(F.when(~F.col("none"), F.col("conv")).alias("conv_id"), *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))
        results.append(out)
    return out


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text; nulls count as one space) with a fault in a quarter of them, told by crc32(conv_id:turn) % 20: 0 dropped, 1 emptied, 2 without ``.!?``, 3 repeated, 4 of role user."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    r = rows.select("conv_id", "turn", own("role").alias("role"), own("text").alias("text"), (F.crc32(F.concat(own("conv_id"), F.lit(":"), own("turn"))) % 20).alias("d"))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    r = r.filter("d != 0").select("conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "d")
    return r.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("d") == 3, 2).otherwise(1)))).select("conv_id", "turn", "role", "text")


_CRC32 = "xor(list_reduce(flatten(list_transform(string_split(k, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, 4294967295::BIGINT), 4294967295)"

#: Forward over the rows, the best way into each state by (cost, audit); more than one turn put in before a row is never cheapest.
ORACLE = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC32} % 20 AS d
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations)
), damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy FROM keyed WHERE d <> 0
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS cid, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM damaged
), judged AS MATERIALIZED (
  SELECT *, left(role, 1) AS ini, CASE WHEN core = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM placed
), ways AS (
  SELECT DISTINCT cid, 0::BIGINT AS i, '' AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS kept FROM judged
  UNION ALL
  SELECT cid, i, state, cost, audit, kept FROM (
    SELECT * FROM (
      SELECT j.cid, j.i, unnest([{{'state': w.state, 'cost': w.cost + 3, 'audit': w.audit || 'D', 'kept': w.kept}},
        CASE WHEN coalesce(fault, '') NOT IN ('blank', 'duplicate') AND CASE w.state WHEN '' THEN ini IN ('s', 'u') WHEN 'u' THEN ini = 'a' ELSE ini = 'u' END
          THEN {{'state': ini, 'cost': w.cost + (fault IS NOT NULL)::INTEGER, 'audit': w.audit || 'K', 'kept': list_append(w.kept, role || ':' || text)}} END,
        CASE WHEN coalesce(fault, '') NOT IN ('blank', 'duplicate')
          THEN {{'state': CASE WHEN w.state = 'u' THEN 'a' ELSE 'u' END, 'cost': w.cost + 2 + (fault IS NOT NULL)::INTEGER, 'audit': w.audit || 'R', 'kept': list_append(w.kept, CASE WHEN w.state = 'u' THEN 'assistant:' ELSE 'user:' END || text)}} END], recursive := true)
      FROM (
        SELECT cid, i, state, cost, audit, kept FROM ways
        UNION ALL
        SELECT cid, i, CASE WHEN state = 'u' THEN 'a' ELSE 'u' END, cost + 2, audit || 'I', list_append(kept, CASE WHEN state = 'u' THEN 'assistant:' ELSE 'user:' END) FROM ways
      ) w JOIN judged j ON j.cid = w.cid AND j.i = w.i + 1
    ) WHERE state IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cid, state ORDER BY cost, audit) = 1)
), ended AS (
  SELECT cid, cost + CASE state WHEN 'u' THEN 2 WHEN 's' THEN 4 ELSE 0 END AS cost, audit || CASE state WHEN 'u' THEN 'I' WHEN 's' THEN 'II' ELSE '' END AS audit,
    kept || CASE state WHEN 'u' THEN ['assistant:'] WHEN 's' THEN ['user:', 'assistant:'] ELSE []::VARCHAR[] END AS kept
  FROM ways JOIN (SELECT cid, max(i) AS i FROM judged GROUP BY cid) USING (cid, i)
  QUALIFY row_number() OVER (PARTITION BY cid ORDER BY cost + CASE state WHEN 'u' THEN 2 WHEN 's' THEN 4 ELSE 0 END, audit || CASE state WHEN 'u' THEN 'I' WHEN 's' THEN 'II' ELSE '' END) = 1
), counted AS (
  SELECT any_value(conv_id) AS conv_id, cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, ini || lead(ini) OVER (PARTITION BY cid ORDER BY i) AS pair FROM judged) GROUP BY cid
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN ended USING (cid)
"""
