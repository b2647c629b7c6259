"""XHTML to text with == headings, and to sections. The tree is built by the standard library's parser."""

from __future__ import annotations

from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions.text import col
from inkmill.operators.chapters import SECTIONS, as_rows, detect, join_wrapped_lines
from inkmill.operators.cleaning import drop_page_number_lines, sanitize_prose

# Fixed values.
DROP_TAGS = set(
    "script style img image svg figure figcaption picture table thead tbody tfoot tr td th caption nav aside form input button select "
    "iframe object embed video audio canvas hr".split()
)
FURNITURE_CLASSES = set(
    "ws-noexport ws-pagenum pagenum pagenum-inner prp-pages-nav noprint printfooter mw-editsection mw-editsection-bracket mw-jump-link "
    "navbox vertical-navbox catlinks sisterproject references reflist refbegin reference reference-text licenseContainer licensetpl "
    "headertemplate dynlayout-exempt ws-data toc toctitle shortdescription mw-jump thumb thumbinner gallery hatnote dablink".split()
)
ROOTS = [("div", "prp-pages-output"), ("div", "prp-page-body"), ("div", "poem"), ("div", "mw-parser-output"), ("article", None), ("body", None)]
BLOCKS = set("p div section article li blockquote dt dd pre figcaption".split())
INVISIBLE = regex.compile(r"[\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff\u00ad\u180e]")
NOTE_MARK = regex.compile(r"[\[(]?\d+[\])]?")
REFERENCE = regex.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag closes open elements of these kinds.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
CLOSES |= {t: {"p"} for t in "div section article blockquote pre ul ol dl table h1 h2 h3 h4 h5 h6 footer header nav aside form hr".split()}


class Node:
    __slots__ = ("children", "classes", "tag")

    def __init__(self, tag: str, classes: list[str]):
        self.tag, self.classes, self.children = tag, classes, []

    def said(self) -> str:
        return "".join(c if isinstance(c, str) else c.said() for c in self.children)

    def find(self, tag: str, name: str | None) -> Node | None:
        for c in self.children:
            if isinstance(c, Node):
                if c.tag == tag and (name is None or name in c.classes) and c.said().strip():
                    return c
                if found := c.find(tag, name):
                    return found
        return None


class Tree(HTMLParser):
    """Elements that are not narrated are never added."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", [])
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        classes = (dict(attrs).get("class") or "").split()
        closes = CLOSES.get(tag, ())
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in closes:
                del self.open[i:]
                break
            if self.open[i].tag in ("div", "section", "article", "table", "ul", "ol", "blockquote", "body"):
                break
        node = Node(tag, classes)
        if not (tag in DROP_TAGS or tag == "rt" or FURNITURE_CLASSES & set(classes)):
            self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def _is_note(node: Node) -> bool:
    return node.tag in ("sup", "sub") and ("note" in " ".join(node.classes).lower() or bool(NOTE_MARK.fullmatch(node.said().strip())))


def _walk(node: Node) -> list[str]:
    out: list[str] = []
    for c in node.children:
        if isinstance(c, str):
            if (s := INVISIBLE.sub("", c.replace("\xa0", " "))).strip():
                out.append(s)
        elif _is_note(c):
            continue
        elif c.tag == "br":
            out.append("\n")
        elif regex.fullmatch("h[1-6]", c.tag):
            if title := " ".join(" ".join(_walk(c)).split()):
                marks = "=" * min(int(c.tag[1]) + 1, 4)
                out.append(f"{marks} {title} {marks}")
        else:
            inner = _walk(c)
            if c.tag not in BLOCKS:
                out += inner
            elif any(s.strip() for s in inner):
                out += ["\n".join(inner), "\n"]
    return out


def _unended(m: regex.Match) -> str:
    return m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else "&amp;" + m[0][1:]


def html_to_text(markup: str, ended: bool = False) -> str:
    """HTML reads some references without their semicolon too (``&amp``); with ``ended`` only those that have it, as in
    XML, and all others stay as written."""
    tree = Tree()
    tree.feed(REFERENCE.sub(_unended, markup) if ended else markup)
    tree.close()
    root = next((found for tag, name in ROOTS if (found := tree.root.find(tag, name))), tree.root)
    return "\n".join(_walk(root))


def promote(text: str) -> str:
    """Where no heading is of the outermost level, all of them become it."""
    rows = text.split("\n")
    heads = [s for s in rows if regex.match(r"={2,6}\s*.*?\s*=+\s*$", s)]
    if heads and not any(regex.match(r"==\s*[^=]", s) for s in heads):
        rows = [f"== {m[2].strip()} ==" if (m := regex.match(r"^\s*(=+)\s*(.*?)\s*\1\s*$", s)) else s for s in rows]
    return "\n".join(rows)


def html_text(c: Column | str, ended: bool = False) -> Column:
    def over(s: pd.Series) -> pd.Series:
        return s.map(lambda t: html_to_text(t or "", ended))

    return F.pandas_udf(over, T.StringType())(col(c))


def html_sections(c: Column | str, min_words: int = 40, ended: bool = False) -> Column:
    """array of struct(title, text, level): flattened, wraps repaired, page numbers dropped, cleaned, detected."""

    def over(s: pd.Series) -> pd.Series:
        return s.map(lambda t: as_rows(detect(promote(t or ""), min_words)))

    clean = sanitize_prose(drop_page_number_lines(join_wrapped_lines(html_text(c, ended))))
    return F.pandas_udf(over, SECTIONS)(clean)


def attribute_frequency(df: DataFrame, html: str, name: str = "class", top: int | None = None) -> DataFrame:
    """(value, n): how often each value of an attribute occurs; ``top`` keeps the most frequent, ties by value."""
    found = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(rf'{name}="([^"]*)"'), F.lit(1))
    counts = df.select(F.explode(found).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return counts if top is None else counts.orderBy(F.desc("n"), "value").limit(top)


def tag_frequency(df: DataFrame, html: str) -> DataFrame:
    found = F.regexp_extract_all(F.lower(F.coalesce(F.col(html), F.lit(""))), F.lit(r"<([a-z][a-z0-9]*)"), F.lit(1))
    return df.select(F.explode(found).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
