"""Line predicates and text cleaning as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions.text import SPACE, col, count_words, is_shouted, keep_lines, let, lines, per_line, squeeze_spaces, strip, words
from inkmill.operators import patterns as P

__all__ = ["is_shouted", "squeeze_spaces"]


def parse_heading(line: Column | str) -> Column:
    """struct(level, title) of a wiki heading (level: equals signs less one) or a markdown heading; else null."""
    line = col(line)
    wiki, md = F.regexp_extract(line, P.WIKI_HEADING, 1), F.regexp_extract(line, P.MARKDOWN_HEADING, 1)
    as_heading = lambda level, pattern: F.struct(level.cast("int").alias("level"), strip(F.regexp_extract(line, pattern, 2)).alias("title"))
    return F.when(wiki != "", as_heading(F.length(wiki) - 1, P.WIKI_HEADING)).when(md != "", as_heading(F.length(md), P.MARKDOWN_HEADING))


def bare_start(c: Column) -> Column:
    """Without leading digits, marks and underscores."""
    return strip(F.regexp_replace(c, r"\A[^\p{L}]+", ""))


def is_non_chapter_title(title: Column | str) -> Column:
    """Whole-line titles of front and back matter, of at most 60 characters, with nothing after them but marks."""
    clean = bare_start(col(title))
    rest = F.regexp_replace(clean, rf"(?iu)\A(?:{P.NON_CHAPTER})", "")
    return (clean != "") & (F.length(clean) <= 60) & (F.length(rest) < F.length(clean)) & (F.regexp_replace(rest, r"[ .:\-–—]", "") == "")


def is_caps_heading(line: Column | str) -> Column:
    """1 to 8 words in 80 characters, four fifths of the letters upper case, no path or markup."""
    line = col(line)
    upper, letters = F.length(F.regexp_replace(line, r"[^\p{Lu}]", "")), F.length(F.regexp_replace(line, r"[^\p{L}]", ""))
    n = count_words(line)
    long_word = F.exists(words(line), lambda w: F.length(F.regexp_replace(w, r"[^\p{L}\p{N}_]", "")) >= 3)
    plain = ~line.contains("/") & ~line.rlike(rf"^[{SPACE}]*[.#|\[*]")
    return (n >= 1) & (n <= 8) & (F.length(line) <= 80) & plain & long_word & (letters >= 2) & (upper * 5 >= letters * 4)


def looks_like_chapter_heading(line: Column | str) -> Column:
    line = col(line)
    return (strip(line) != "") & (parse_heading(line).isNotNull() | ((F.length(line) <= 90) & line.rlike(P.CHAPTER)))


def is_chapter_heading_line(line: Column | str) -> Column:
    s = strip(line)
    return (s != "") & (F.length(s) <= 70) & s.rlike(P.CHAPTER) & (count_words(s) <= 8)


def is_furniture(line: Column) -> Column:
    return reduce(lambda a, b: a | b, [line.rlike(p) for p in P.FURNITURE])


def drop_furniture_lines(c: Column | str) -> Column:
    """Without lines that are a parser report, an arrow, a printed number, Han characters, a rule or a title page."""
    return keep_lines(c, lambda s: ~is_furniture(s))


def head_key(line: Column | str) -> Column:
    """What could be a running head: at most 80 characters and 8 words without an end mark; else null."""
    s = strip(line)
    short = (s != "") & (F.length(s) <= P.RUNNING_HEAD_CHARS)
    return F.when(short & ~s.rlike(P.RUNNING_HEAD_ENDS) & (count_words(s) <= P.RUNNING_HEAD_WORDS), s)


def is_page_number(line: Column) -> Column:
    return line.rlike(P.PAGE_NUMBER)


def drop_page_number_lines(c: Column | str, min_repeats: int = P.RUNNING_HEAD_REPEATS) -> Column:
    """Without page numbers, then without running heads: short lines that repeat at least ``min_repeats`` times.

    Counting is one sort of the candidate heads: a head that stands again min_repeats - 1 places on occurs often
    enough."""

    def noisy(heads: Column) -> Column:
        n = F.greatest(F.size(heads) - (min_repeats - 1), F.lit(0))
        pairs = F.zip_with(F.slice(heads, F.lit(1), n), F.slice(heads, F.lit(min_repeats), n), lambda a, b: F.when(a == b, a))
        return F.array_distinct(F.array_compact(pairs))

    def quiet(kept: Column) -> Column:
        found = noisy(F.array_sort(F.array_compact(F.transform(kept, head_key))))
        # the heads go along with each line, as a lambda's own argument is computed once
        left = F.zip_with(kept, F.array_repeat(found, F.size(kept)), lambda s, z: F.when(~F.coalesce(F.array_contains(z, head_key(s)), F.lit(False)), s))
        return F.when(F.size(found) == 0, kept).otherwise(F.array_compact(left))

    return F.array_join(let(F.filter(lines(c), lambda s: ~is_page_number(s)), quiet), "\n")


def running_heads(df: DataFrame, key: str, text: str, min_repeats: int = P.RUNNING_HEAD_REPEATS) -> DataFrame:
    """(key, head, n): running heads of each document, by a grouped count."""
    heads = df.select(key, F.explode(F.transform(lines(F.coalesce(F.col(text), F.lit(""))), head_key)).alias("head")).filter("head is not null")
    return heads.groupBy(key, "head").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_repeats)


@cache
def _case_classes() -> tuple[str, str]:
    letters = [chr(c) for c in range(0x41, 0x250)]
    return "".join(c for c in letters if c.islower()), "".join(c for c in letters if c.isupper())


def split_internal_capitals(c: Column | str) -> Column:
    """A space before a capital that follows a small letter, both up to U+024F."""
    low, up = r"[\p{IsLowercase}&&[A-\u024f]]", r"[\p{IsUppercase}&&[A-\u024f]]"
    return F.regexp_replace(col(c), f"(?<={low})(?={up})", " ")


def any_of(words: list[str], depth: int = 2) -> str:
    """A pattern of any of the words, of two that begin alike the longer first. Beginnings are spelled once, so at most
    places in a text one look tells that none of them is there."""
    if depth == 0 or len(words) < 2 or "" in words:
        return "|".join(sorted(words, key=len, reverse=True))
    heads: dict[str, list[str]] = {}
    for w in sorted(words, key=len, reverse=True):
        heads.setdefault(w[0], []).append(w[1:])
    return f"(?=[{''.join(heads)}])(?:" + "|".join(f"{h}(?:{any_of(rest, depth - 1)})" for h, rest in heads.items()) + ")"


def may_be_glued(s: Column) -> Column:
    """Whether a glued word can be in a text: it has a letter of the ranges that all but a few of them have, or a few."""
    plain = [k for k in P.GLUED if max(map(ord, k)) <= 0xFF]
    return reduce(lambda a, k: a | s.contains(k), plain, s.rlike("[\u0100-\u024f\u1e00-\u1eff]"))


def repair_glued_words(c: Column | str) -> Column:
    def repaired(out: Column) -> Column:
        for glued, fixed in P.GLUED.items():
            out = F.replace(out, F.lit(glued), F.lit(fixed))
        return out

    # one search spares most texts all the passes
    return let(col(c), lambda s: F.when(may_be_glued(s), repaired(s)).otherwise(s))


def _guarded(has_mark, passes: list[tuple[str, str]]):
    """A function of a column that runs the passes where the mark is."""

    def run(s: Column) -> Column:
        done = s
        for pattern, to in passes:
            done = F.regexp_replace(done, pattern, to)
        return F.when(has_mark(s), done).otherwise(s)

    return run


def sanitize_prose(c: Column | str) -> Column:
    """Prose without tags, references, images, link targets, tables, templates, emphasis, notes and furniture."""
    # each group of passes runs only over texts that hold its mark; looking for that costs next to nothing
    groups = [
        (lambda s: s.contains("<"), [(r"(?iu)<ref[^>]*?/>", ""), (r"(?isu)<ref[^>]*>.*?</ref>", ""), (r"<[^>]+>", "")]),
        (lambda s: s.contains("["), [(r"!\[[^\]]*\]\([^)]*\)", ""), (r"\[([^\]]*)\]\([^)]*\)", "$1"), (r"\[([^\]]*)\]\[[^\]]*\]", "$1")]),
        (lambda s: s.contains("|"), [(rf"(?md)^[{SPACE}]*\|.*$", "")]),
        (lambda s: s.contains("{{"), [(r"(?s)\{\{.*?\}\}", "")]),
        (lambda s: s.contains("*") | s.contains("_"), [(r"[*_]{2,}", "")]),
        (lambda s: s.contains("''"), [("'{3}", ""), ("'{2}", "")]),
        (lambda s: s.contains("[^"), [(r"\[\^[^\]]*\]", "")]),
        (lambda s: s.contains("  ") | s.contains("\t"), [(r"[ \t]+", " ")]),
        (lambda s: s.contains(" \n") | s.contains("\n "), [(r" ?\n ?", "\n")]),
    ]
    out = F.translate(col(c), "\u00a0", " ")
    for has_mark, passes in groups:
        out = let(out, _guarded(has_mark, passes))
    return repair_glued_words(split_internal_capitals(drop_furniture_lines(out)))


def unify_newlines(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "\r\n?", "\n")


def dehyphenate(c: Column | str) -> Column:
    """Joins a word that a hyphen splits over a line break, where the next line starts with a small letter."""
    return F.regexp_replace(col(c), r"([\p{L}\p{N}_])-\n[ \t]*(?=[a-zà-ỹ])", "$1")


def drop_gutenberg(c: Column | str) -> Column:
    """The text between the marks of a public-domain edition, without credits in front."""
    text = F.regexp_replace(col(c), rf"\A(?s:.*?){P.GUTENBERG_START}", "")
    text = F.regexp_replace(text, rf"{P.GUTENBERG_END}(?s:.*)\z", "")
    return strip(F.regexp_replace(text, rf"(?iu)\A(?:[ \t\x0b\f\r]*(?:(?:{P.CREDITS})[^\n]*)?\n)+", ""))


def pdf_layout(c: Column | str) -> Column:
    """Lines without trailing blanks, and without the gutters that a column layout leaves inside sentences."""
    trimmed = per_line(c, lambda s: F.regexp_replace(s, rf"[{SPACE}]+\z", ""))
    return F.regexp_replace(trimmed, rf"(?<=[^{SPACE}\d])[ \t]{{2,}}(?=[^{SPACE}])", " ")


def pdf_furniture(c: Column | str) -> Column:
    """A line of its own for each page break, no lines that are a page label."""
    text = F.regexp_replace(col(c), "\f", "\n\n")
    kept = F.filter(lines(text), lambda s: ~strip(s).rlike(P.PDF_JUNK))
    return F.array_join(F.transform(kept, lambda s: F.regexp_replace(s, rf"[{SPACE}]+\z", "")), "\n")


def chapter_fences(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line, fenced): lines and whether a code fence is open there, by a running count."""
    rows = df.select(key, F.posexplode(lines(F.coalesce(F.col(text), F.lit("")))).alias("line_no", "line"))
    fence = F.col("line").rlike(rf"^[{SPACE}]*```")
    over = Window.partitionBy(key).orderBy("line_no")
    return rows.withColumn("fenced", (F.sum(fence.cast("int")).over(over) % 2 == 1) | fence)


def has_forbidden_markup(c: Column | str) -> Column:
    return col(c).rlike(P.FORBIDDEN)


