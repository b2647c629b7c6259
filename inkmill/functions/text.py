"""Text functions as Column expressions: words, sentences, folding, keys, spaces. All of them stay in the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as white space, as a Java character class body. DuckDB's spelling is SPACE_RE2.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_RE2 = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same characters.
WHITE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: A code point that no text holds, between the parts of a string that is taken apart again.
CUT = "\uffff"

# Fixed values.
SENTENCE = r"""[^.!?…]+(?:[.!?…]+["'”’»)\]]*)?|[.!?…]+"""
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\u200b-\u200d\u2060\ufeff]"
QUOTES = '"“”„‟'
EMPTY_SLUG = "sach"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c: Column, fn) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it, and that lambdas inside may use."""
    return F.get(F.transform(F.array(c), fn), F.lit(0))


def words(c: Column | str) -> Column:
    """White-space tokens; none for null."""
    return F.filter(F.split(F.coalesce(col(c), F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def count_words(c: Column | str) -> Column:
    return F.size(words(c))


def strip(c: Column | str) -> Column:
    """Without white space at both ends."""
    return F.btrim(col(c), F.lit(WHITE))


def lines(c: Column | str) -> Column:
    return F.split(col(c), "\n", -1)


def per_line(c: Column | str, fn) -> Column:
    """``fn`` over each line."""
    return F.array_join(F.transform(lines(c), fn), "\n")


def keep_lines(c: Column | str, keep) -> Column:
    return F.array_join(F.filter(lines(c), keep), "\n")


def letters_and_digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}]", "")


def sentences(c: Column | str) -> Column:
    """Sentences of a paragraph with their punctuation; a fragment of fewer than three letters or digits, or one
    that starts with an end mark, joins the sentence before it. Null gives null, blank text none."""
    parts = F.filter(F.transform(F.regexp_extract_all(col(c), F.lit(SENTENCE), F.lit(0)), strip), lambda s: s != "")
    small = lambda s: s.rlike(r"^[.!?…]") | (F.length(letters_and_digits(s)) < 3)
    marked = F.transform(parts, lambda s, i: F.concat(F.when((i > 0) & small(s), " ").otherwise(CUT), s))
    return F.filter(F.split(F.array_join(marked, ""), CUT), lambda s: s != "")


def squeeze_spaces(c: Column | str) -> Column:
    """Runs of white space in a line as one space, one blank line between paragraphs, none at the ends."""
    tidy = per_line(c, lambda s: F.regexp_replace(strip(s), f"[{SPACE}]+", " "))
    return F.regexp_replace(F.regexp_replace(tidy, "\n{3,}", "\n\n"), r"\A\n+|\n+\z", "")


def strip_control(c: Column | str) -> Column:
    return F.regexp_replace(col(c), CONTROL, "")


def strip_quotes(c: Column | str) -> Column:
    return F.regexp_replace(F.translate(col(c), QUOTES, ""), r"[ \t]{2,}", " ")


@cache
def fold_table() -> tuple[str, str]:
    """(from, to) for translate: Latin letters to their base letters by Unicode decomposition, marks to nothing."""
    pairs = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        low = chr(code).lower()
        base = "".join(x for x in unicodedata.normalize("NFD", low) if unicodedata.category(x) != "Mn").replace("đ", "d")
        if len(base) == 1 and base != chr(code):
            pairs[chr(code)] = base
    marks = "".join(chr(m) for m in range(0x300, 0x370) if unicodedata.category(chr(m)) == "Mn")
    return "".join(pairs) + marks, "".join(pairs.values())


def fold(c: Column | str) -> Column:
    """Lower case without diacritics."""
    return F.translate(F.lower(col(c)), *fold_table())


def slugify(c: Column | str) -> Column:
    slug = F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(slug == "", EMPTY_SLUG).otherwise(slug)


def title_key(c: Column | str) -> Column:
    """For fuzzy comparison of titles: folded words, one space between."""
    return F.trim(F.regexp_replace(fold(c), "[^a-z0-9]+", " "))


def compact_key(c: Column | str) -> Column:
    """Folded letters and digits only."""
    return letters_and_digits(fold(c))


def natural_key(c: Column | str) -> Column:
    """A string that sorts digits by value: each run of them is padded to 20."""
    padded = F.regexp_replace(F.lower(col(c)), "([0-9]+)", "0" * 20 + "$1")
    return F.regexp_replace(padded, "[0-9]*([0-9]{20})", "$1")


def is_shouted(line: Column) -> Column:
    """At least three words, at least four fifths of the letters upper case."""
    upper, letters = F.length(F.regexp_replace(line, r"[^\p{Lu}]", "")), F.length(F.regexp_replace(line, r"[^\p{L}]", ""))
    return (F.size(words(line)) >= 3) & (letters > 0) & (upper * 5 >= letters * 4)


def title_from_url(c: Column | str) -> Column:
    """The page title in a wiki address: what follows /wiki/ in its path, decoded."""
    url = col(c)
    path = F.regexp_replace(F.when(url.contains("://"), F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)).otherwise(url), r"^.*?/wiki/", "")
    decoded = F.url_decode(F.regexp_replace(F.regexp_replace(path, r"%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B"))
    return F.trim(F.regexp_extract(F.trim(F.regexp_replace(decoded, "_", " ")), "^[^#]*", 0))
