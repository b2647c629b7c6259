"""Books: schemas, assembly from sections, manifests, provenance and the outcome of a build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions.text import count_words, strip
from inkmill.operators.chapters import chapter_slug, chapter_title, render_markdown
from inkmill.operators.rights import is_allowed, normalize_license

CHAPTER = "struct<index: int, slug: string, title: string, source_path: string, audio_path: string, duration_sec: double, word_count: int>"
_TEXT_FIELDS = "slug title author translator language source_language source_format source_path source_url license license_url rights_note summary narrator text_path".split()
BOOK_FIELDS = [*((k, "string") for k in _TEXT_FIELDS), ("chapters", f"array<{CHAPTER}>"), *((k, "string") for k in ("cover_path", "m4b_path", "status"))]
#: Further keys that writers add and plain readers ignore.
EXTRA_FIELDS = [
    *((k, "string") for k in "author_dates translator_dates license_basis wikisource_title wikisource_url notes source_page source_revision_timestamp".split()),
    *((k, "string") for k in "source_revision_user source_author source_translator rights_gate translate_mode".split()),
    ("author_death_year", "int"), ("expect_chapters", "int"), ("min_chapter_words", "int"), ("source_revision", "bigint"), ("source_pages", "array<string>"),
    ("verified", "struct<bytes: bigint, subpages: int, checked: string, note: string>"),
]


def ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"{k} {kind}" for k, kind in fields)


def nested(fields: list[tuple[str, str]]) -> str:
    return "struct<" + ", ".join(f"{k}: {kind}" for k, kind in fields) + ">"


BOOK, EXTRA = ddl(BOOK_FIELDS), ddl(EXTRA_FIELDS)
MANIFEST = ddl([("book", nested(BOOK_FIELDS)), ("stage", "string"), ("created_at", "string"), ("notes", "array<string>")])
CATALOG_FIELDS = [*((k, "string") for k in _TEXT_FIELDS), *EXTRA_FIELDS]
STATUSES = ["draft", "extracted", "translated", "narrated", "packaged"]
BLOCKED = "blocked-no-vi-source"
DEFAULTS = {"language": "vi", "source_language": "en", "source_format": "pdf", "status": "draft"}


def with_defaults(books: DataFrame) -> DataFrame:
    """Absent text fields as empty strings or their defaults, absent chapters as none."""
    kinds = dict(books.dtypes)
    filled = {k: F.coalesce(F.col(k), F.lit(DEFAULTS.get(k, ""))) for k in [*_TEXT_FIELDS, "cover_path", "m4b_path", "status"] if k in kinds}
    if "chapters" in kinds:
        filled["chapters"] = F.coalesce("chapters", F.array().cast(f"array<{CHAPTER}>"))
    return books.withColumns(filled)


def paths(books: DataFrame) -> DataFrame:
    """dir, meta_path and chapter_dir of each book."""
    home = F.concat(F.lit("books/"), F.col("slug"))
    return books.withColumns({"dir": home, "meta_path": F.concat(home, F.lit("/book.json")), "chapter_dir": F.concat(home, F.lit("/audio/"), F.col("slug"))})


def chapters_of(sections: DataFrame, key: str = "slug", pos: str = "pos") -> DataFrame:
    """Rendered chapters: empty sections dropped, then numbered from 1 in order.

    The window is over one book, whose sections are few; books are dealt over tasks."""
    rows = sections.filter(strip(F.coalesce(F.col("text"), F.lit(""))) != "")
    index = F.row_number().over(Window.partitionBy(key).orderBy(pos))
    rows = rows.withColumn("index", index).withColumn("markdown", render_markdown("title", "text"))
    return rows.select(key, "index", chapter_slug(F.col("index")).alias("chapter_slug"), chapter_title("title").alias("title"), "markdown", count_words("markdown").alias("word_count"))


def assemble_books(catalog: DataFrame, sections: DataFrame, pos: str = "pos") -> DataFrame:
    """catalog(slug, license, ...) and sections(slug, pos, title, text): one book record each, licences first.

    Books without an allowed licence get no row here (see ``blocked_books``). The catalog is not broadcast: joins
    are left to the planner, which knows its size."""
    rows = chapters_of(sections, "slug", pos)
    path = F.concat(F.lit("books/"), F.col("slug"), F.lit("/text/"), F.col("chapter_slug"), F.lit(".md"))
    chapter = F.struct(F.col("index").cast("int").alias("index"), F.col("chapter_slug").alias("slug"), "title", path.alias("source_path"), F.lit(None).cast("string").alias("audio_path"), F.lit(None).cast("double").alias("duration_sec"), F.col("word_count").cast("int").alias("word_count"))
    grouped = rows.groupBy("slug").agg(F.array_sort(F.collect_list(chapter)).alias("chapters"), F.sum("word_count").alias("total_words"))
    books = catalog.filter(is_allowed("license")).withColumn("license", normalize_license("license")).join(grouped, "slug")
    return books.withColumns({"text_path": F.concat(F.lit("books/"), F.col("slug"), F.lit("/text/"), F.col("slug"), F.lit(".md")), "status": F.lit("extracted")})


def block_reason(entry: DataFrame) -> Column:
    """The catalog's own account of why a book is blocked, else a standard one."""
    given = [F.col(k) for k in ("notes", "verified_note") if k in entry.columns]
    if "verified" in entry.columns:
        given += [F.col("verified.note"), F.col("verified.checked")]
    said = [F.nullif(strip(c.cast("string")), F.lit("")) for c in given]
    return F.coalesce(*said, F.lit("Khong co ban dich tieng Viet cong khai tren vi.wikisource.org."))


def blocked_books(entries: DataFrame, reason: Column, status: str = BLOCKED) -> DataFrame:
    """Records that are honest about having no text: no chapters, and why."""
    note = F.concat(F.regexp_replace(F.coalesce("rights_note", F.lit("")), r"\.+\z", ""), F.lit(". VIETNAMESE EDITION: "), block_reason(entries), F.lit(" Kiểm tra lúc build: "), reason)
    none = F.array().cast(f"array<{CHAPTER}>")
    return entries.withColumns({"rights_note": note, "chapters": none, "text_path": F.lit(""), "status": F.lit(status), "license": normalize_license("license")})


def build_status(df: DataFrame) -> Column:
    """The outcome of a build from its facts, in the order in which a build would meet them.

    df: license, has_source, offline, n_sections, death_year, needs_death_year, translate_failed, language,
    wanted_language, dry_run, error."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    return (
        F.when(~is_allowed("license"), "rights-blocked")
        .when(~flag("has_source") & flag("offline"), "offline")
        .when(~flag("has_source"), "no-source")
        .when(F.col("error").isNotNull(), "error")
        .when(F.coalesce("n_sections", F.lit(0)) == 0, "empty")
        .when(flag("needs_death_year") & F.col("death_year").isNull(), "unverifiable-author")
        .when(flag("translate_failed"), "translate-failed")
        .when(F.col("language") != F.col("wanted_language"), "wrong-language")
        .when(flag("dry_run"), "dry-run")
        .otherwise("ok")
    )


def status_tally(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def book_json(books: DataFrame) -> DataFrame:
    """(slug, json): a record with its further keys, those that are empty left out."""
    blank = [F.when(F.col(c) != "", F.col(c)).alias(c) if kind == "string" else F.when(F.size(c) > 0, F.col(c)).alias(c) if kind.startswith("array") else F.col(c) for c, kind in books.dtypes]
    return books.select("slug", F.to_json(F.struct(*blank), {"ignoreNullFields": "true"}).alias("json"))


def manifests(books: DataFrame, notes: Column, created_at: str, stage: str = "extract") -> DataFrame:
    """(slug, json) of the hand-off record; the time is given, so equal inputs give equal manifests."""
    own = [c for c in books.columns]
    return books.select("slug", F.to_json(F.struct(F.struct(*own).alias("book"), F.lit(stage).alias("stage"), F.lit(created_at).alias("created_at"), notes.alias("notes"))).alias("json"))


def parse_books(json: DataFrame, column: str = "json", extended: bool = False) -> DataFrame:
    """Records from JSON; keys that the schema doesn't name are ignored."""
    schema = BOOK + (", " + EXTRA if extended else "")
    return with_defaults(json.select(F.from_json(column, schema).alias("b")).select("b.*"))


def parse_manifests(json: DataFrame, column: str = "json") -> DataFrame:
    return json.select(F.from_json(column, MANIFEST).alias("m")).select("m.*")


def manifest_mismatches(manifest: DataFrame, books: DataFrame) -> DataFrame:
    """Slugs of records that differ between the hand-off and the book itself, or are only in one of them."""
    both = sorted(set(manifest.select("book.*").columns) & set(books.columns))
    left, right = manifest.select("book.*").select(both), books.select(both)
    return left.exceptAll(right).select("slug").unionByName(right.exceptAll(left).select("slug")).distinct()


def extra_provenance(df: DataFrame) -> Column:
    """The further keys of a record that say something, as a map."""
    given = [(k, F.col(k).cast("string")) for k, kind in EXTRA_FIELDS if k in df.columns and not kind.startswith(("array", "struct"))]
    every = F.create_map(*[x for k, c in given for x in (F.lit(k), c)])
    return F.map_filter(every, lambda k, v: F.coalesce(strip(v), F.lit("")) != "")


def chapter_files(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.explode("book.chapters.source_path").alias("source_path"))


def source_url_of(df: DataFrame) -> Column:
    given = [F.nullif(strip(F.col(k)), F.lit("")) for k in ("vi_source_url", "source_url", "wikisource_url") if k in df.columns]
    return F.coalesce(*given, F.lit(""))


def revision_text(title: Column, revid: Column, timestamp: Column, user: Column) -> Column:
    when = F.when(F.coalesce(timestamp, F.lit("")) == "", "?").otherwise(F.replace(F.replace(timestamp, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(" UTC")))
    who = F.when(F.coalesce(user, F.lit("")) == "", "?").otherwise(user)
    return F.format_string("%s (rev %d, %s, %s)", title, revid, when, who)


def schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


