"""PDF files written here and read back."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from strataloom.functions import pdf, text


def body(d: str, data: bytes | None = None, flate: bool = True) -> bytes:
    if data is None:
        return d.encode("latin-1")
    packed = zlib.compress(data) if flate else data
    return f"<< {d} /Length {len(packed)} {'/Filter /FlateDecode' if flate else ''} >>\nstream\r\n".encode() + packed + b"\nendstream"


def classic(objects: dict[int, bytes], root: int = 1, shift: int = 0, extra: str = "") -> bytes:
    """With a cross-reference table; ``shift`` makes it wrong."""
    out, at = bytearray(b"%PDF-1.4\n%\xe2\xe3\n"), {}
    for k, o in objects.items():
        at[k] = len(out)
        out += b"%d 0 obj\n" % k + o + b"\nendobj\n"
    start = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (max(objects) + 1)
    for k in range(1, max(objects) + 1):
        out += b"%010d 00000 %s \n" % (at.get(k, 0) + shift, b"n" if k in at else b"f")
    return bytes(out + f"trailer\n<< /Size {max(objects) + 1} /Root {root} 0 R {extra} >>\nstartxref\n{start}\n%%EOF".encode())


def compact(objects: dict[int, bytes], streams: dict[int, bytes]) -> bytes:
    """With an object stream and a cross-reference stream of predicted rows."""
    out, at = bytearray(b"%PDF-1.5\n"), {}
    heads, texts, n = [], b"", 0
    for i, (k, o) in enumerate(objects.items()):
        heads.append(f"{k} {len(texts)}")
        texts += o + b" "
        n += 1
    head = " ".join(heads).encode() + b" "
    holder, table = max([*objects, *streams]) + 1, max([*objects, *streams]) + 2
    for k, o in {**streams, holder: body(f"/Type /ObjStm /N {n} /First {len(head)}", head + texts)}.items():
        at[k] = len(out)
        out += b"%d 0 obj\n" % k + o + b"\nendobj\n"
    start, rows = len(out), []
    for k in range(table):
        if k in objects:
            rows.append(b"\x02" + holder.to_bytes(3) + bytes([list(objects).index(k)]))
        else:
            rows.append(b"\x01" + at[k].to_bytes(3) + b"\x00" if k in at else b"\x00" * 5)
    above, lines = bytes(5), b""
    for r in rows:
        lines += b"\x02" + bytes((x - y) & 255 for x, y in zip(r, above))
        above = r
    packed = zlib.compress(lines)
    out += f"{table} 0 obj\n<< /Type /XRef /Size {table} /W [1 3 1] /Root 1 0 R /Filter /FlateDecode /DecodeParms << /Predictor 12 /Columns 5 >> /Length {len(packed)} >>\nstream\n".encode() + packed + f"\nendstream\nendobj\nstartxref\n{start}\n%%EOF".encode()
    return bytes(out)


def parts(pages: list[list[str]]) -> tuple[dict[int, bytes], dict[int, bytes]]:
    """Plain objects and streams of a file whose pages have these lines, two bytes a character through a ToUnicode map, pages below two nodes."""
    letters = sorted({c for p in pages for line in p for c in line})
    code = {c: i + 3 for i, c in enumerate(letters)}
    rows = "".join(f"<{code[c]:04X}> <{c.encode('utf-16-be').hex()}>\n" for c in letters)
    cmap = f"/CIDInit /ProcSet findresource begin begincmap 1 begincodespacerange <0000> <FFFF> endcodespacerange\n{len(letters)} beginbfchar\n{rows}endbfchar endcmap end"
    plain = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [6 0 R] /Count %d >>" % len(pages), 3: b"<< /Type /Font /Subtype /Type0 /BaseFont /F /Encoding /Identity-H /ToUnicode 4 0 R >>"}
    streams = {4: body("", cmap.encode())}
    plain[6] = f"<< /Type /Pages /Parent 2 0 R /Kids [{' '.join(f'{10 + 2 * i} 0 R' for i in range(len(pages)))}] /Resources << /Font << /F1 3 0 R >> >> >>".encode()
    for i, p in enumerate(pages):
        show = lambda line: "<" + "".join(f"{code[c]:04X}" for c in line) + "> Tj"
        content = "BT /F1 12 Tf 14 TL 50 700 Td " + " T* ".join(map(show, p)) + " ET"
        plain[10 + 2 * i] = f"<< /Type /Page /Parent 6 0 R /Contents {11 + 2 * i} 0 R >>".encode()
        streams[11 + 2 * i] = body("", content.encode())
    return plain, streams


PAGES = [["Chương I Quy định chung", "Điều 1. Phạm vi điều chỉnh", "Nội dung (có ngoặc) và \\ gạch"], ["Trang 2 / 2", "Lệ phí trước bạ ô tô điện 😀"]]
WANT = ["\n".join(p) for p in PAGES]


@pytest.mark.parametrize("form", ["classic", "compact", "wrong", "none"])
def test_pages_are_read_back(form):
    plain, streams = parts(PAGES)
    data = {"classic": lambda: classic(plain | streams), "compact": lambda: compact(plain, streams), "wrong": lambda: classic(plain | streams, shift=7), "none": lambda: classic(plain | streams).replace(b"startxref", b"startxxxx")}[form]()
    assert pdf.page_texts(data) == WANT


def test_operators_and_encodings():
    content = rb"""q 1 0 0 1 10 10 cm BT /A 10 Tf 1 0 0 1 0 500 Tm (Hello) Tj 60 0 Td (world\041) Tj 0 -20 TD [(V)80(at)-300(m)-20(ore)] TJ T* (caf\351 \(x\)) ' ET Q
    BT /B 10 Tf 0 400 Td <0102> Tj ET /X Do BI /W 1 /H 1 ID (BT (no) Tj EI BT /A 10 Tf 0 100 Td (end) Tj ET"""
    form = body("/Type /XObject /Subtype /Form /Resources << /Font << /A 5 0 R >> >>", b"BT /A 9 Tf 0 300 Td (in a form) Tj ET")
    objects = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [3 0 R 3 0 R 2 0 R] >>",
        3: b"<< /Type /Page /Contents [4 0 R] /Resources << /Font << /A 5 0 R /B 6 0 R >> /XObject << /X 7 0 R >> >> >>",
        4: body("", content, flate=False), 5: b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>",
        6: b"<< /Type /Font /Subtype /TrueType /Encoding << /Differences [1 /uni1EC7 /acircumflexacute] >> >>", 7: form,
    }
    assert pdf.page_texts(classic(objects)) == ["Hello world!\nVat more\ncafé (x)\nệấ\nin a form\nend"]


def test_broken_files_give_an_error_and_no_pages(spark):
    plain, streams = parts(PAGES)
    good = classic(plain | streams)
    rng = random.Random(1)
    bad = [b"", b"no", b"%PDF-1.4\n", good[:60], classic(plain | streams, extra="/Encrypt 9 0 R"), b"%PDF-1.4\n" + b"[" * 5000, good.replace(b"/Catalog", b"/Nothing").replace(b"/Pages 2", b"/Pagez 2")]
    odd = [bytes(rng.choices(range(256), k=3000)), *(bytes(b if rng.random() > 0.01 else rng.randrange(256) for b in good) for _ in range(40))]
    df = spark.createDataFrame([(0, good), (1, None), *((10 + i, b) for i, b in enumerate(bad)), *((100 + i, b) for i, b in enumerate(odd))], "i int, content binary").repartition(3)
    got = {r.i: r.p for r in df.select("i", pdf.pdf_pages(F.col("content")).alias("p")).collect()}
    assert got[0].pages == WANT and got[0].error is None
    assert all((got[k].pages is None) == (got[k].error is not None) for k in got)
    assert all(got[k].pages is None for k in (1, *range(10, 10 + len(bad))))
    md = df.filter("i = 0").select(text.printed_markdown(pdf.pdf_pages(F.col("content"))["pages"], F.lit("Luật")).alias("m")).first().m
    assert md.startswith("# Luật\n\n\n## Chương I Quy định chung\n\n\n### Điều 1. Phạm vi") and "Trang 2" not in md
