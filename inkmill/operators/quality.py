"""Corpus checks: each returns the rows that break a rule, with the rule's name. Inputs: chapters(slug, index, title,
source_path, markdown, word_count) and books(slug, title, status, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions.text import count_words, lines, sentences, strip
from inkmill.operators import patterns as P
from inkmill.operators.chapters import ABSOLUTE_FLOOR, assembled
from inkmill.operators.cleaning import any_of, is_furniture, may_be_glued
from inkmill.operators.wikitext import is_front_matter

LAST_SHARE, DRIFT, BODY_LINES, TOTAL_WORDS = 0.25, 2, 3, 200
JUNK_TITLE = r"(?iu)\A(?:\P{L}*|(?:chương|phần)\s*|.*(?:://|\{\{|\[\[|<[a-z]).*)\z"
OUT = ["slug", "index", "rule", "detail"]


def body(markdown: str = "markdown") -> Column:
    return F.filter(lines(markdown), lambda s: (strip(s) != "") & ~s.startswith("#"))


def own_rules() -> dict[str, Column]:
    """What a chapter shows by itself: per rule the offending value, null where there is none."""
    first = lambda c: F.get(c, F.lit(0))
    text = F.col("markdown")
    heads = F.size(F.filter(lines(text), lambda s: s.rlike(r"\A# ")))
    found = F.regexp_extract(F.array_join(body(), "\n"), P.FORBIDDEN, 0)
    words = count_words(text)
    glued = F.when(may_be_glued(text), F.regexp_extract(text, any_of(list(P.GLUED)), 0))
    return {
        "one-heading": F.when((heads != 1) | text.rlike(r"(?m)^#{2,}"), heads.cast("string")),
        "blank-lines": F.when(text.rlike(r"\n\n\n|\A\n|[ \t]+(?:\n|\z)|\n\n\z|[^\n]\z"), ""),
        "forbidden-markup": F.when(found != "", found),
        "two-sentences": first(F.filter(body(), lambda s: F.size(sentences(s)) > 1)),
        "heading-is-title": F.when(F.element_at(lines(text), 1) != F.concat(F.lit("# "), F.col("title")), F.col("title")),
        "word-drift": F.when(F.abs(words - F.col("word_count")) > DRIFT, words.cast("string")),
        "furniture": first(F.filter(body(), is_furniture)),
        "body-lines": F.when(F.size(body()) < BODY_LINES, F.size(body()).cast("string")),
        "front-matter": F.when(is_front_matter("title"), F.col("title")),
        "junk-title": F.when(F.col("title").rlike(JUNK_TITLE), F.col("title")),
        "glued-words": F.when(glued != "", glued),
    }


def book_rules(min_words: int = ABSOLUTE_FLOOR, least: int = TOTAL_WORDS) -> dict[str, Column]:
    """What shows next to a book's other chapters, by windows over the book on slim columns."""
    book = Window.partitionBy("slug")
    ordered = book.orderBy("index")
    n, words = F.count(F.lit(1)).over(book), F.col("word_count")
    last = F.col("index") == F.max("index").over(book)
    part = F.nullif(F.regexp_extract("title", r"\APhần (\d+)", 1), F.lit("")).cast("int")
    before = F.last(part, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    twice = lambda c: F.row_number().over(Window.partitionBy("slug", c).orderBy("index")) == 2
    return {
        "contiguous": F.when(F.col("index") != F.row_number().over(ordered), F.row_number().over(ordered).cast("string")),
        "floor": F.when((n > 1) & (words < min_words), words.cast("string")),
        "unique-paths": F.when(twice("source_path"), F.col("source_path")),
        "duplicate-title": F.when(twice("title"), F.col("title")),
        "part-numbers": F.when(part <= before, part.cast("string")),
        "runt": F.when((n > 1) & last & (words < LAST_SHARE * F.median(words).over(book)), words.cast("string")),
        "total-words": F.when(last & (F.sum(words).over(book) <= least), F.sum(words).over(book).cast("string")),
    }


def _exploded(df: DataFrame, rules: list[str]) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(F.col(r).isNotNull(), F.struct(F.lit(r).alias("rule"), F.col(r).alias("detail"))) for r in rules]))
    return df.select("slug", F.col("index").cast("int").alias("index"), F.explode(found).alias("v")).select("slug", "index", "v.rule", "v.detail")


def violations(ch: DataFrame) -> DataFrame:
    """All broken chapter rules: slug, index, rule, detail. Chapters are read once: each shows its own faults, then
    only slim columns are dealt by book."""
    own, book = own_rules(), book_rules()
    rows = ch.select("slug", "index", "title", "source_path", "word_count", *[c.cast("string").alias(r) for r, c in own.items()])
    return _exploded(rows.withColumns(book), [*own, *book])


def broken(ch: DataFrame, rule: str) -> DataFrame:
    """The rows that break one rule."""
    own, book = own_rules(), book_rules()
    if rule in own:
        return _exploded(ch.withColumn(rule, own[rule].cast("string")), [rule])
    return _exploded(ch.withColumn(rule, book[rule]), [rule])


def _of_book(df: DataFrame, rule: str, bad: Column, detail: Column) -> DataFrame:
    return df.filter(bad).select("slug", F.lit(0).alias("index"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def chapter_stats(ch: DataFrame) -> DataFrame:
    """(slug, n, total, smallest, middle, last): words of each book's chapters."""
    return ch.groupBy("slug").agg(
        F.count(F.lit(1)).alias("n"), F.sum("word_count").alias("total"), F.min("word_count").alias("smallest"), F.median("word_count").alias("middle"), F.max_by("word_count", "index").alias("last")
    )


def chapter_count(books: DataFrame, ch: DataFrame) -> DataFrame:
    """Books whose declared number of chapters isn't the number there is."""
    have = ch.groupBy("slug").agg(F.count(F.lit(1)).alias("have"))
    rows = books.join(have, "slug", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    return _of_book(rows, "chapter-count", F.col("expect_chapters") != F.col("have"), F.col("have"))


def blocked_have_no_text(books: DataFrame, ch: DataFrame) -> DataFrame:
    rows = books.filter(F.col("status").startswith("blocked")).join(ch.select("slug").distinct(), "slug", "left_semi")
    return _of_book(rows, "blocked-text", F.lit(True), F.col("status"))


def provenance(books: DataFrame, catalog: DataFrame, fields: list[str]) -> DataFrame:
    """Fields of a book that differ from its catalog entry."""
    rows = books.alias("b").join(catalog.alias("c"), "slug")
    differs = F.array_compact(F.array(*[F.when(~F.col(f"b.{f}").eqNullSafe(F.col(f"c.{f}")), f) for f in fields]))
    rows = rows.select("slug", differs.alias("differs"))
    return _of_book(rows, "provenance", F.size("differs") > 0, F.array_join("differs", ","))


def machine_translated(books: DataFrame) -> DataFrame:
    return _of_book(books, "machine-translated", F.coalesce(F.col("translate_mode"), F.lit("off")).isin("command", "http"), F.col("translate_mode"))


def whole_is_parts(whole: DataFrame, ch: DataFrame) -> DataFrame:
    """Assembled texts that are not their chapters joined."""
    parts = assembled(ch, "slug", "index", "markdown").withColumnRenamed("text", "parts")
    return _of_book(whole.join(parts, "slug"), "whole-is-parts", F.col("text") != F.col("parts"), F.lit(""))
