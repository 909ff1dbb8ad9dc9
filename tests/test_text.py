"""Text rules by example."""

from __future__ import annotations

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from strataloom.functions import text


def run(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.o for r in df.select("i", f(F.col("t")).alias("o")).orderBy("i").collect()]


def test_nfc(spark):
    s = "Việt Nam đất nước tuyệt vời"
    odd = [chr(c) for c in list(range(0x300, 0x345)) + [0x2126, 0x212B, 0x1F71, 0xF900, 0x0958, 0x2000, 0x37E]]
    values = [unicodedata.normalize("NFD", s), s, "plain", None, "", *odd, "가"]
    assert run(spark, text.nfc, values) == [None if v is None else unicodedata.normalize("NFC", v) for v in values]


def test_guard_of_composition(spark):
    """Texts that composition changes are all seen by the guard."""
    changed = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.normalize("NFC", chr(c)) != chr(c)]
    assert run(spark, text.nfc, changed) == [unicodedata.normalize("NFC", c) for c in changed]


def test_tones(spark):
    assert run(spark, text.modern_tones, ["hoà bình, thuỷ điện, khoẻ mạnh, quĩ đầu tư", "không đổi"]) == ["hòa bình, thủy điện, khỏe mạnh, quỹ đầu tư", "không đổi"]


def test_typography(spark):
    got = run(spark, text.typography, ["Xe,một thương hiệu ô tô  điện .“Xe rất tốt” – ông Nam chia sẻ .", "giá 260.000.000 và 60,13", "a\n\n\n\nb \n c", "x​y…"])
    assert got == ['Xe, một thương hiệu ô tô điện. "Xe rất tốt" - ông Nam chia sẻ.', "giá 260.000.000 và 60,13", "a\n\nb\nc", "xy..."]


def test_boilerplate(spark):
    got = run(spark, text.strip_boilerplate, ["Tin\nChia sẻ bài viết qua: x\n\n\n\n\nHết", "about: blank\n", "giá xe\nxem thêm: y", None])
    assert got == ["Tin\n\nHết", "", "giá xe", None]


@pytest.mark.parametrize(
    ("t", "n"),
    [("Tại TP.HCM. Ông Nam đến.", 2), ("Giá 260.000.000 VNĐ trong tháng 6. Khách hàng vui.", 2), ("# h\n- a.\n- b.", 3), ("Theo TS. Nam. Xe TP.HCM giá 1.500 đ. Tốt!", 3), ("", 0)],
)
def test_sentences(spark, t, n):
    assert len(run(spark, text.sentences, [t])[0]) == n


def python_sentences(p: str) -> list[str]:
    """A scanner written from the rules: at a run of stops that is followed by a
    blank, end the sentence unless an honorific stands before it or no capital after."""
    import re

    short = {"pgs.ts", "gs.ts", "pgs.", "gs.", "ts.", "ths.", "bs.", "cn.", "th.s", "mr.", "ms.", "mrs.", "dr.", "k/g.", "đ/c."}
    out, start = [], 0
    for m in re.finditer(r"[.!?…]+", p):
        if m.start() < start or not re.match(r"[ \t]", p[m.end():]):
            continue
        rest = p[m.end():].lstrip()
        if not rest or not re.match(r"[A-ZÀ-ỹ\"'(“‘0-9]", rest):
            continue
        word = re.search(r"([\w./]+)\Z", p[start:m.start()])
        if word and ((word[1] + m[0]).lower() in short or (word[1] + m[0]).lower().rstrip(".") in short):
            continue
        out.append(p[start:m.end()].strip())
        start = len(p) - len(rest)
    out.append(p[start:].strip())
    return [x for x in out if x]


def test_sentences_equal_a_scanner(spark):
    rng = random.Random(1)
    parts = ["TS", "Th.S", "PGS.TS", "Mr", "k/g", "xe", "Xe", "TP.HCM", "1.500", "3", ".", ".", "...", "!", "?!", "…", " ", " ", "  ", '"', "(", "é", "É", "a/b."]
    values = ["".join(rng.choices(parts, k=rng.randint(1, 14))).strip() for _ in range(3000)]
    values = [v for v in values if v and v[0] not in "#-*>|`"]
    got = run(spark, text.sentences, values)
    bad = [(v, g, python_sentences(v)) for v, g in zip(values, got) if g != python_sentences(v)]
    assert not bad, bad[:3]


def test_shingles_and_jaccard(spark):
    assert run(spark, text.shingles, ["a b c d", "a b", "", "a b c a b c"]) == [["a b c", "b c d"], ["a b"], [], ["a b c", "b c a", "c a b"]]
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])], "x array<string>, y array<string>")
    assert [round(r[0], 3) for r in df.select(text.jaccard(F.col("x"), F.col("y"))).collect()] == [0.333, 0.0]


def test_texts_come_to_python_a_few_at_a_time(spark, sf):
    """No Arrow batches of up to 10,000 whole texts, each of which a worker holds."""
    from strataloom.plans import queries

    plan = queries.queries()["gold_report"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_shares_tones_and_composition_equal_plain_code(spark):
    """Over characters of all the classes, by themselves and mixed."""

    from strataloom.functions import fixed

    rng = random.Random(8)
    olds = [old for old, _ in fixed.TONES]
    pool = [*fixed.DIACRITICS, *olds, *"abc ouqkmOUQKM19.,-", "é", "ố", "̀", "가", "豈", "Å", "\U0001d15e", "\U0001f600", "ß", "ж", "中", "\n"]
    texts = ["".join(rng.choices(pool if i % 2 else pool[-30:], k=rng.randint(0, 12))) for i in range(1500)] + pool + [""]

    def tones(t):
        for old, new in fixed.TONES:
            t = t.replace(old, new)
        return t

    def ratio(t):
        letters = sum(unicodedata.category(c).startswith("L") for c in t)
        return sum(c in fixed.DIACRITICS for c in t) / letters if letters else 0.0

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = sorted(df.select("i", text.modern_tones(F.col("t")).alias("m"), text.diacritic_ratio(F.col("t")).alias("r"), text.nfc(F.col("t")).alias("n")).collect())
    assert [(r.m, r.r, r.n) for r in got] == [(tones(t), ratio(t), unicodedata.normalize("NFC", t)) for t in texts]
