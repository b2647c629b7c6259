from inkmill.operators import markup as M
from inkmill.operators import wikitext as W

PAGE = """{{đầu đề|tựa đề=[[../]]|tác giả=Nguyễn Du|phần={{nowrap|Chương 4}}|năm=1820}}
{{văn|
{{drop cap|B}}ắt đầu từ '''gà''' gáy<ref>x {{y}}</ref> [[A|b]] [http://x y] &amp; z.
<poem style="a">dòng một
dòng hai</poem>
{|class=x
| style="a" | q || r
|-
! h
|}
{{unknown|{{inner}}}}
}}
== Ghi chú ==
bỏ
=== Chương 5 ===
một hai ba bốn năm sáu
==== sâu ====
bảy tám
[[Thể loại:X]] {{open"""


def test_markup_goes(ask):
    assert W.strip_markup("a{{x|{{y}}}}b <!-- c --> [[Tập tin:a.jpg]]__TOC__ {{{p}}}") == "ab"
    assert W.strip_markup("[[A|b]] [[C]] [http://x d] '''e''' <b>f</b> &lt;") == "b C d e f <"
    assert W.strip_markup("{|\n| a || b\n|-\n! c !! d\n|}\nx") == "\na\nb\nc\nd\nx".lstrip("\n")
    assert W.strip_markup("{{" * 2000 + "x") == "{{" * 2000 + "x"
    assert W.strip_markup("{{a|" * 500 + "}}" * 500) == ""
    found = ask(lambda c: W.wikitext_sections(c, 3), PAGE, "plain words only", "", None)
    assert [(s.title, len(s.text.split())) for s in found[0]] == [("Chương 4", 16), ("Chương 5", 12)] and "sâu" in found[0][1].text
    assert [[s.title for s in f] for f in found[1:]] == [["Nội dung"], [], []]
    assert [tuple(a) for a in ask(W.page_authorship, PAGE, "x", None)] == [("Nguyễn Du", None, "1820"), (None, None, None), (None, None, None)]


def test_titles(ask):
    assert ask(W.is_front_matter, "Mục lục", "Lời tựa", "SAIGON 1911", "Chương 1", "Đề lại chung án") == [True, True, True, False, False]
    assert [tuple(t) for t in ask(W.printed_title, "\nKIM VÂN KIỀU\nbody", "abc\nd", "ONE LINE")] == [("KIM VÂN KIỀU", "body"), ("", "abc\nd"), ("", "ONE LINE")]
    assert W.same_title("1. Chương bốn", "chương bốn") and W.same_title("Chương bốn", "Chương bốm") and not W.same_title("a", "xyz")
    assert ask(W.is_stub, "<pages index=x/>" + "y" * 500, "z" * 500, "short", None) == [True, False, True, True]
    assert ask(W.is_placeholder_title, " Nội dung ", "", "x") == [True, True, False]


def test_html(ask, spark):
    html = '<html><body><nav>n</nav><div class="toc">t</div><article><h1>T&amp;x</h1><p>Một-đoạn<sup>1</sup> văn<p>Hai.<br>ba<ruby>字<rt>x</rt></ruby><table><tr><td>no</table></article>tail</body></html>'
    text = M.html_to_text(html)
    assert "== T&x ==" in text and "Một-đoạn" in text and not any(x in text for x in ("no", "tail", "nav", "rt"))
    found = ask(lambda c: M.html_sections(c, 1), html, "<h4>A</h4><p>b c</p><h5>D</h5><p>e f</p>", "", None)
    assert [[s.title for s in f] for f in found] == [["T&x"], ["A", "D"], [], []]
    assert M.html_to_text("<p>a<div class='prp-pages-output'><p>only</div>b") .strip() == "only"
    df = spark.createDataFrame([('<p class="a"><b class="a">',), (None,)], "html string")
    assert [tuple(r) for r in M.attribute_frequency(df, "html", top=1).collect()] == [("a", 2)]
    assert sorted(tuple(r) for r in M.tag_frequency(df, "html").collect()) == [("b", 1), ("p", 1)]


def test_references_without_semicolon():
    html = '<h1>a&amp</h1><p class="x&amp;y">b &lt c &am &#65; &#66 &amp;lt; &copy; &nosuch; &'
    assert M.html_to_text(html).split() == "== a& == b < c &am A B &lt; © &nosuch; &".split()
    assert M.html_to_text(html, ended=True).split() == "== a&amp == b &lt c &am A &#66 &lt; © &nosuch; &".split()
