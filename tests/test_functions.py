import pytest
import regex

from inkmill.functions import numbers as N
from inkmill.functions import text as T


def test_words_and_spaces(ask):
    assert ask(T.count_words, "một\xa0hai\u3000ba", "  ", "", None, "a\x1cb") == [3, 0, 0, 0, 2]
    assert ask(T.squeeze_spaces, "  x\t y \n\n\n z \n") == ["x y\n\nz"]
    assert ask(T.strip, "\u2003 a b\n") == ["a b"]
    assert ask(T.strip_control, "a\x07b\u200bc\td\n") == ["abc\td\n"]
    assert ask(T.strip_quotes, "“a”  \"b\" „c‟") == ["a b c"]


@pytest.mark.parametrize(
    ("text", "said"),
    [
        ("Một câu. Hai câu!", ["Một câu.", "Hai câu!"]),
        ("Một. 1. Hai", ["Một. 1.", "Hai"]),
        ("Chờ... “Vâng.” Rồi đi", ["Chờ...", "“Vâng.”", "Rồi đi"]),
        ("Không dấu", ["Không dấu"]),
        ("?! abc", ["?!", "abc"]),
        ("  ", []),
        ("", []),
    ],
)
def test_sentences(ask, text, said):
    assert ask(T.sentences, text) == [said]


def test_sentences_against_a_fold(ask, spark):
    import random

    r = random.Random(3)
    given = ["".join(r.choices("ab1 .!?…”)\"é", k=r.randint(0, 40))) for _ in range(300)]

    def fold(text):
        out = []
        for raw in regex.findall(T.SENTENCE, text):
            s = raw.strip()
            if s and out and (sum(c.isalnum() for c in s) < 3 or s[0] in ".!?…"):
                out[-1] += " " + s
            elif s:
                out.append(s)
        return out

    assert ask(T.sentences, *given) == [fold(g) for g in given]


def test_keys(ask):
    assert ask(T.slugify, "Truyện Kiều", "Đại Đồng", "!!!", "a--b", "e\u0301") == ["truyen-kieu", "dai-dong", "sach", "a-b", "e"]
    assert ask(T.title_key, "Lục  Vân-Tiên!") == ["luc van tien"]
    assert ask(T.compact_key, "Mục lục 1") == ["mucluc1"]
    assert sorted(["Chương 10", "Chương 2"], key=dict(zip(["Chương 10", "Chương 2"], ask(T.natural_key, "Chương 10", "Chương 2"))).get) == ["Chương 2", "Chương 10"]
    assert ask(T.title_from_url, "https://vi.x.org/wiki/Truy%E1%BB%87n_Ki%E1%BB%81u?a=1#b", "A+B_C#d", "/wiki/100%") == ["Truyện Kiều", "A+B C", "100%"]


NUMBERS = {
    0: "không", 10: "mười", 15: "mười lăm", 21: "hai mươi mốt", 24: "hai mươi bốn", 105: "một trăm lẻ năm", 110: "một trăm mười", 1000: "một nghìn",
    1005: "một nghìn không lẻ năm", 1865: "một nghìn tám trăm sáu mươi lăm", 1234567: "một triệu hai trăm ba mươi bốn nghìn năm trăm sáu mươi bảy",
    10**9: "một tỷ không triệu không nghìn không", -3: "-ba",
}


def test_numbers(ask):
    assert ask(N.int_to_viet, *NUMBERS, kind="long") == list(NUMBERS.values()) == [N.viet(n) for n in NUMBERS]
    some = [0, 7, 99, 1001, 54321, 999999, 20_000_001, 123_456_789, 10**12 - 1]
    assert ask(N.int_to_viet, *some, kind="long") == [N.viet(n) for n in some]
    assert ask(N.int_to_viet, 10**12, None, kind="long") == [None, None]


def test_romans(ask):
    given = ["IV", "xx", "MCMXCIV", "IIX", "ABC", ""]
    assert ask(N.roman_to_int, *given) == [4, 20, 1994, 8, 0, 0] == [N.roman_value(g) for g in given]
