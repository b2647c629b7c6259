import pytest

from inkmill.operators import gloss as G

CASES = [
    (G.arrows, "Mưa lớn -> đường ngập", "Mưa lớn, dẫn tới đường ngập"),
    (G.arrows, "Ngủ muộn → dẫn đến mệt mỏi", "Ngủ muộn, dẫn đến mệt mỏi"),
    (G.arrows, "⇒ Kết quả tốt", "Kết quả tốt"),
    (G.arrows, "Xong. => Nghỉ =>", "Xong. Nghỉ"),
    (G.slashes, "Đọc sách/tạp chí", "Đọc sách, tạp chí"),
    (G.slashes, "Chọn có/không, A/B", "Chọn có hoặc không, A hoặc B"),
    (G.slashes, "300 triệu/năm, 3 ngày/tuần, 1%/tháng", "300 triệu một năm, 3 ngày một tuần, 1% một tháng"),
    (G.slashes, "12/09/2026 24/7 và/hoặc http://a/b", "12/09/2026 24 7 và hoặc http://a/b"),
    (G.colons, "Nhớ một nguyên tắc: phục vụ.", "Nhớ một nguyên tắc. Phục vụ."),
    (G.colons, "10:30 https://a:b", "10:30 https://a:b"),
    (G.colons, "a:\nb", "a.\nb"),
    (G.ampersands, "A & B&C & D", "A và B và C và D"),
    (G.small_ranges, "4-6 tháng, 12-13/4", "4 đến 6 tháng, 12-13/4"),
    (G.heading_romans, "Chương I: Mở, Phần xiv. Bài viết, Chương XXI", "Chương một: Mở, Phần mười bốn. Bài viết, Chương XXI"),
    (G.grade_signs, "A- B+ xA- khách - mới", "A trừ B cộng xA- khách - mới"),
    (G.marketing_p, "4P và 12Ps, 4Px 4p", "bốn Pê và mười hai Pê, 4Px 4p"),
    (G.lone_p, "P P &P Px", "Pê Pê &P Px"),
    (G.standalone_numbers, "Có 3 người, 007, 1.5, 10:30, 5%, 1,250 và 1234567", "Có ba người, 007, 1.5, 10:30, 5%, 1,250 và 1234567"),
    (G.abbreviations, "TP.HCM, STP. và triệu; tr. 5 USD USDx", "Thành phố Hồ Chí Minh, STP. và triệu; trang 5 đô la Mỹ USDx"),
    (G.pronunciations, "một CEO và R&D ở đây, pr", "một xi i âu và a en đi ở đây, pr"),
    (G.pronunciations, "CEO AI PR", "CEO AI PR"),
    (G.list_markers, "- Ý\n1. Đọc\n4) Viết\na) Bản\n2. Thứ hai, x\n123. y", "Ý\nThứ nhất, Đọc\nThứ tư, Viết\nBản\nThứ hai, x\n123. y"),
    (G.section_number_lines, "4.1.2. Tên\n3.5 năm\n1. x", "Tên\n3.5 năm\n1. x"),
    (lambda c: G.section_number_lines(c, True), "1.6. Lập kế hoạch", "một chấm sáu. Lập kế hoạch"),
    (G.drop_script_page_numbers, "12\ntr. 3\nTrang 4\nvăn", "văn"),
]


@pytest.mark.parametrize(("fn", "given", "expected"), CASES)
def test_steps(ask, fn, given, expected):
    assert ask(fn, given, None) == [expected, None]


def test_script(ask):
    once = ask(G.normalize_script, "Chương I: “mở” đầu\n\n\n12\nTP.HCM có 3 CEO & 4P -> lỗ/lãi: tăng 4-6 tháng", "", None)
    assert once == ["Chương một. Mở đầu\n\nThành phố Hồ Chí Minh có ba xi i âu và bốn Pê, dẫn tới lỗ, lãi. Tăng bốn đến sáu tháng", "", ""]
    assert ask(G.normalize_script, once[0]) == [once[0]]
    assert ask(G.normalize_title, "# Chương IV: “x” 3 ", None) == ["Chương bốn: x 3", ""]
    assert len(G.STEPS) == 17 and len(G.glossary()["abbreviations"]) == 19 and len(G.glossary()["pronunciations"]) == 60
