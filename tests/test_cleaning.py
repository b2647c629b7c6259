import random

import pytest

from inkmill.operators import cleaning as C
from inkmill.operators import prose

FURNITURE = ["NewPP limit report", "CPU time usage: 0.1", "←", "12", "2$00", "金 雲 翹 傳", "———", "TRANSCRIT POUR", "3' ÉDITION", "Prix 2$", "Illustrations de X", "zh:abc", "total 3"]
PROSE = ["Trăm năm trong cõi người ta,", "totalement faux", "Chữ tài chữ mệnh", "a - b", "revues", "金 là vàng"]


def test_furniture(ask):
    assert ask(C.drop_furniture_lines, "\n".join([*FURNITURE, *PROSE])) == ["\n".join(PROSE)]


@pytest.mark.parametrize(("line", "number"), [("12", True), ("- 13 -", True), ("Trang 14", True), ("page 3", True), ("12345", False), ("12 người", False)])
def test_page_numbers(ask, line, number):
    assert ask(C.is_page_number, line) == [number]


def test_running_heads(ask, spark):
    text = "\n".join(f"Truyện Kiều\nCâu {i} dài hơn thế." for i in range(5)) + "\n12"
    assert ask(C.drop_page_number_lines, text, text.replace("Truyện Kiều", "x", 1), "") == ["\n".join(f"Câu {i} dài hơn thế." for i in range(5)), text.replace("Truyện Kiều", "x", 1)[:-3], ""]
    found = C.running_heads(spark.createDataFrame([(1, text)], "doc_id int, text string"), "doc_id", "text").collect()
    assert [tuple(r) for r in found] == [(1, "Truyện Kiều", 5)]


def test_headings(ask):
    found = ask(C.parse_heading, "== Một ==", "=== Hai ===", "# Ba", "### Bốn ##", "văn", "== a =")
    assert [tuple(h) if h else None for h in found] == [(1, "Một"), (2, "Hai"), (1, "Ba"), (3, "Bốn ##"), None, None]
    assert ask(C.is_caps_heading, "CHƯƠNG MỘT", "../II", "AB", "Chương một", "ABC def") == [True, False, False, False, False]
    assert ask(C.is_non_chapter_title, "Mục lục", "1. Ghi chú.", "Ghi chú dài ra", "Lời nói đầu", "Chương 1") == [True, True, False, True, False]
    assert ask(C.looks_like_chapter_heading, "CHƯƠNG 3", "Phần II", "Bài viết", "== x ==", "") == [True, True, False, True, False]
    assert ask(C.is_chapter_heading_line, "Chương 1", "Chương 1 kể về những chuyến đi xa của cậu ấy đó") == [True, False]


def test_sanitize(ask):
    given = ["a<ref>x\ny</ref> b [t](u) **c** {{x}} TúyKiều", "![i](u)x [^1]y", "a\n| row |\nb", "khônngoan quá", "''x'' <b>y</b>\xa0z"]
    assert ask(C.sanitize_prose, *given) == ["a b t c Túy Kiều", "x y", "a\n\nb", "khôn ngoan quá", "x y z"]


def test_sanitize_twice_and_in_python(ask):
    r = random.Random(5)
    parts = ["a", "B", " ", "\n", "*", "_", "[", "]", "(", ")", "{{", "}}", "|", "<b>", "<ref>", "</ref>", "''", "12", "é", "\xa0", "=", "-", "TúyKiều", "total"]
    given = ["".join(r.choices(parts, k=r.randint(0, 25))) for _ in range(300)]
    assert ask(C.sanitize_prose, *given) == [prose.clean(g) for g in given]


def test_repairs(ask):
    assert ask(C.dehyphenate, "chuyến-\n  tàu", "thứ-\n2", "a-\nB") == ["chuyếntàu", "thứ-\n2", "a-\nB"]
    assert ask(C.split_internal_capitals, "TúyKiều KimTrọng", "Chương") == ["Túy Kiều Kim Trọng", "Chương"]
    book = "x\n*** START OF THE PROJECT GUTENBERG EBOOK A ***\n\nProduced by me\nLanguage: en\n\nBody\nmore\n*** END OF THIS PROJECT GUTENBERG EBOOK\nz"
    assert ask(C.drop_gutenberg, book, "plain\ntext") == ["Body\nmore", "plain\ntext"]
    assert ask(C.pdf_furniture, "a\n 12 \n\fb\nđèo trang 3\nc") == ["a\n\n\nb\nc"]
    assert ask(C.has_forbidden_markup, "a <b>x</b>", "plain", "**x**", "[a](b)") == [True, False, True, True]


def test_fences(spark):
    rows = C.chapter_fences(spark.createDataFrame([(1, "a\n```\nb\n```\nc")], "k int, t string"), "k", "t").orderBy("line_no").collect()
    assert [r.fenced for r in rows] == [False, True, True, True, False]
