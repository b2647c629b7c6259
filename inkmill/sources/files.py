"""Local sources: text, markdown, wiki markup, EPUB and PDF, read by Spark's binary reader and sent by suffix."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from functools import reduce
from pathlib import Path
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions.text import col, compact_key, count_words, natural_key, slugify, strip
from inkmill.operators import books as B
from inkmill.operators import chapters as K
from inkmill.operators import cleaning as C
from inkmill.operators.markup import html_sections
from inkmill.operators.rights import allowed_only, check_license
from inkmill.operators.wikitext import STUB_SECTION_WORDS, wikitext_sections
from inkmill.sources.pdf import read_pdfs

# Fixed values.
TEXT, MARKDOWN, WIKI = ["txt", "text"], ["md", "markdown"], ["wikitext", "wiki"]
FORMATS = [*TEXT, *MARKDOWN, *WIKI, "epub", "pdf", "html"]
SOURCE_ORDER = ["wikitext", "html", "txt", "md", "epub", "pdf"]


def suffix(path: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(path), r"\.([^./]+)\z", 1))


def stem(path: Column | str) -> Column:
    return F.regexp_extract(col(path), r"([^/]*?)(?:\.[^./]*)?\z", 1)


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, suffix, content of each file; a suffix that no branch reads is dropped by a filter on the listing."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return rows.select("path", suffix("path").alias("suffix"), "content").filter(F.col("suffix").isin(FORMATS))


def decode_bytes(raw: bytes) -> str:
    """UTF-8, UTF-16 where a mark says so, then legacy Vietnamese and Latin-1."""
    marked = raw[:2] in (b"\xff\xfe", b"\xfe\xff")
    for encoding in ["utf-8-sig", *["utf-16"] * marked, "cp1258", "latin-1"]:
        try:
            text = raw.decode(encoding)
        except UnicodeError:
            continue
        if "�" not in text[:2000]:
            return text
    return raw.decode("utf-8", "replace")


def decoded(content: Column | str) -> Column:
    def over(s: pd.Series) -> pd.Series:
        return s.map(lambda b: decode_bytes(bytes(b or b"")))

    return F.pandas_udf(over, T.StringType())(col(content))


def _sections(df: DataFrame, text: Column, min_words: int) -> DataFrame:
    return df.withColumn("sections", K.detect_chapters(text, min_words))


def text_sections(df: DataFrame, text: str = "text", min_words: int = K.MIN_WORDS) -> DataFrame:
    """Plain text: boilerplate cut, wraps repaired, cleaned, page numbers dropped, chapters detected."""
    rows = df.withColumn("__t", K.join_wrapped_lines(C.drop_gutenberg(F.coalesce(F.col(text), F.lit("")))))
    return _sections(rows, C.drop_page_number_lines(C.sanitize_prose("__t")), min_words).drop("__t")


def markdown_sections(df: DataFrame, text: str = "text", min_words: int = K.MIN_WORDS) -> DataFrame:
    rows = df.withColumn("__t", K.parse_markdown(F.coalesce(F.col(text), F.lit(""))))
    return _sections(rows, C.drop_gutenberg(C.drop_page_number_lines(C.sanitize_prose("__t"))), min_words).drop("__t")


def pdf_text(text: Column | str, layout: bool = True) -> Column:
    """Cleaned text of a PDF: gutters and page furniture gone, wraps repaired."""
    raw = C.pdf_layout(text) if layout else col(text)
    return C.sanitize_prose(K.join_wrapped_lines(C.drop_page_number_lines(C.pdf_furniture(raw))))


def pdf_sections(df: DataFrame, pages: str = "pages", outline: str = "outline", min_words: int = K.MIN_WORDS) -> DataFrame:
    """df(doc_id, pages array<string>, outline array<struct<page, title, level>>): sections between bookmarks of the
    smallest level where that gives two with prose, else detected in the cleaned text."""
    sliced = outline_sections(pages, outline)
    flat = F.array_join(pages, "\f")
    detected = K.detect_chapters(pdf_text(flat), min_words)
    return df.withColumn("__o", sliced).withColumn("__d", detected).withColumn("sections", F.when(F.size("__o") >= 2, F.col("__o")).otherwise(F.col("__d"))).drop("__o", "__d")


def outline_sections(pages: Column | str, outline: Column | str) -> Column:
    """Page texts between bookmarks of the smallest level; under five words there is no section."""
    marks = F.filter(F.coalesce(col(outline), F.array().cast("array<struct<page: int, title: string, level: int>>")), lambda m: (strip(m.title) != "") & (m.page >= 0))
    # each bookmark with the pages and the level it is compared with, so that lambdas look only at their arguments
    least = F.array_min(F.transform(marks, lambda m: m.level))
    top = F.zip_with(marks, F.array_repeat(least, F.size(marks)), lambda m, k: F.when(m.level == k, m))
    top = F.filter(top, lambda m: m.isNotNull())
    stops = F.concat(F.slice(F.transform(top, lambda m: m.page), F.lit(2), F.greatest(F.size(top) - 1, F.lit(0))), F.array(F.size(col(pages))))
    at = F.zip_with(top, stops, lambda m, stop: F.struct(m.title.alias("title"), m.page.alias("page"), stop.alias("stop")))
    body = lambda m: strip(F.array_join(F.slice(col(pages), m.page + 1, F.greatest(m.stop - m.page, F.lit(0))), "\n"))
    found = F.transform(F.filter(at, lambda m: m.stop >= m.page), lambda m: F.struct(strip(m.title).alias("title"), body(m).alias("text"), F.lit(1).alias("level")))
    return F.filter(found, lambda s: count_words(s.text) >= STUB_SECTION_WORDS)


def outline_rows(outline: DataFrame, pages: DataFrame) -> DataFrame:
    """The same as a range join: outline(doc_id, page, title, level), pages(doc_id, page, text)."""
    by = Window.partitionBy("doc_id")
    top = outline.withColumn("least", F.min("level").over(by)).filter("level = least")
    stop = F.coalesce(F.lead("page").over(by.orderBy("page")), F.lit(2**31 - 1))
    marks = top.select("doc_id", "title", F.col("page").alias("start"), stop.alias("stop"))
    rows = marks.join(pages, "doc_id").filter("page >= start and page < stop")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda p: p.text), "\n")
    return rows.groupBy("doc_id", "start", "title").agg(strip(text).alias("text")).filter(count_words("text") >= STUB_SECTION_WORDS)


def epub_items(raw: bytes) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """(title, language, translator) and (name, markup) of an EPUB's spine, each item once; without a spine, all
    documents of the manifest."""
    local = lambda e: e.tag.rpartition("}")[2]
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        container = ElementTree.fromstring(z.read("META-INF/container.xml"))
        opf = next(e.get("full-path") for e in container.iter() if local(e) == "rootfile")
        package, home = ElementTree.fromstring(z.read(opf)), posixpath.dirname(opf)
        meta: dict[str, str] = {}
        items: dict[str, tuple[str, str]] = {}
        spine: list[str] = []
        for e in package.iter():
            kind = local(e)
            if kind in ("title", "language"):
                meta.setdefault(kind, (e.text or "").strip())
            elif kind == "contributor" and any(k.rpartition("}")[2] == "role" and v == "trl" for k, v in e.attrib.items()):
                meta.setdefault("translator", (e.text or "").strip())
            elif kind == "item":
                items[e.get("id", "")] = (posixpath.normpath(posixpath.join(home, unquote(e.get("href", "")))), e.get("media-type", ""))
            elif kind == "itemref":
                spine.append(e.get("idref", ""))
        order = [items[i][0] for i in spine if i in items] or [name for name, kind in items.values() if "html" in kind]
        have = set(z.namelist())
        return meta, [(n, decode_bytes(z.read(n))) for n in dict.fromkeys(order) if n in have]


def read_epubs(files: DataFrame) -> DataFrame:
    """files(path, content) to path, title, language, translator, item, name, markup; one row per spine item."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for path, content in zip(pdf["path"], pdf["content"]):
                meta, items = epub_items(bytes(content))
                rows = [(path, meta.get("title", ""), meta.get("language", ""), meta.get("translator", ""), i, name, text) for i, (name, text) in enumerate(items)]
                yield pd.DataFrame(rows, columns=["path", "title", "language", "translator", "item", "name", "markup"])

    return files.select("path", "content").mapInPandas(over, "path string, title string, language string, translator string, item int, name string, markup string")


def epub_sections(files: DataFrame, min_words: int = K.MIN_WORDS) -> DataFrame:
    """path, title, language, translator, pos, section; sections under five words are left out."""
    rows = read_epubs(files).withColumn("sections", html_sections("markup", min_words))
    rows = rows.select("path", "title", "language", "translator", "item", "name", F.posexplode("sections").alias("k", "section"))
    named = F.when(F.trim("section.title").isin("", "Nội dung"), F.initcap(F.regexp_replace(stem("name"), r"[-_]+", " "))).otherwise(F.col("section.title"))
    rows = rows.filter(count_words("section.text") >= STUB_SECTION_WORDS)
    return rows.select("path", "title", "language", "translator", F.struct("item", "k").alias("pos"), F.struct(named.alias("title"), F.col("section.text").alias("text"), F.col("section.level").alias("level")).alias("section"))


def pdf_documents(files: DataFrame, min_words: int = K.MIN_WORDS) -> DataFrame:
    """path, sections, error of PDF files: bookmarks where they give two sections, else detected chapters. A file
    without text has the error that it is scanned."""
    rows = read_pdfs(files)
    found = pdf_sections(rows, "pages", "outline", min_words)
    blank = F.size(F.filter("sections", lambda s: strip(s.text) != "")) == 0
    error = F.coalesce("error", F.when(blank, F.concat(F.col("path"), F.lit(": no text; the pages are scanned"))))
    return found.select("path", "sections", error.alias("error"))


def extract_files(files: DataFrame, min_words: int = K.MIN_WORDS) -> DataFrame:
    """Sections of files: path, title, sections, source_format, error. Each branch reads only its own rows."""
    text = files.filter(F.col("suffix").isin([*TEXT, *MARKDOWN, *WIKI, "html"])).withColumn("text", decoded("content")).drop("content")
    of = lambda kinds: text.filter(F.col("suffix").isin(kinds))
    epubs = epub_sections(files.filter("suffix = 'epub'"), min_words)
    whole = F.transform(F.array_sort(F.collect_list(F.struct("pos", "section"))), lambda x: x.section)
    parts = [
        text_sections(of(TEXT), "text", min_words),
        markdown_sections(of(MARKDOWN), "text", min_words),
        of(WIKI).withColumn("sections", wikitext_sections("text", min_words)),
        of(["html"]).withColumn("sections", html_sections("text", min_words)),
        epubs.groupBy("path", "title").agg(whole.alias("sections")).withColumn("suffix", F.lit("epub")),
        pdf_documents(files.filter("suffix = 'pdf'"), min_words).withColumn("suffix", F.lit("pdf")),
    ]
    title = lambda p: F.coalesce(F.nullif(F.trim("title"), F.lit("")), stem("path")) if "title" in p.columns else stem("path")
    error = lambda p: F.col("error") if "error" in p.columns else F.lit(None).cast("string")
    picked = [p.select("path", title(p).alias("title"), "sections", F.col("suffix").alias("source_format"), error(p).alias("error")) for p in parts]
    return reduce(DataFrame.unionByName, picked)


def extract_file(spark: SparkSession, path: str, license_id: str, min_words: int = K.MIN_WORDS) -> DataFrame:
    """One file, refused before it is read unless its licence is allowed; an unknown suffix, and a PDF that can't be
    read or has no text, are errors."""
    check_license(license_id)
    kind = path.rpartition(".")[2].lower()
    if kind not in FORMATS:
        raise ValueError(f"unsupported source format: {kind!r}")
    files = spark.read.format("binaryFile").load(path).select("path", suffix("path").alias("suffix"), "content")
    found = extract_files(files, min_words)
    if kind == "pdf" and (bad := found.filter("error is not null").first()):
        raise ValueError(bad.error)
    return found.drop("error")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Entries of {"books": [...]} files; a catalog without entries is an error."""
    rows = spark.read.schema(f"books array<{B.nested(B.CATALOG_FIELDS)}>").option("multiLine", True).json(path)
    found = rows.select(F.inline("books"))
    if found.isEmpty():
        raise ValueError(f"{path} has no books")
    return B.with_defaults(found)


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """All book records under a folder, by slug."""
    rows = spark.read.schema(B.BOOK).option("multiLine", True).json(f"{path}/*/book.json")
    return B.with_defaults(rows).orderBy("slug")


def local_sources(files: DataFrame, slug: Column) -> DataFrame:
    """files(path, suffix): per book those of its first kind of source, in natural order."""
    rank = F.array_position(F.array(*map(F.lit, SOURCE_ORDER)), F.col("suffix"))
    rows = files.withColumn("slug", slug).withColumn("rank", rank).filter("rank > 0")
    best = rows.groupBy("slug").agg(F.min("rank").alias("rank"))
    return rows.join(best, ["slug", "rank"]).orderBy("slug", natural_key("path")).drop("rank")


def named_sources(cached: DataFrame, pages: DataFrame) -> DataFrame:
    """cached(path, ...) with the page name whose folded form its file name has."""
    key = compact_key(F.regexp_replace(stem("path"), r"\A\d+[-_]", ""))
    return cached.withColumn("__k", key).join(pages.select("page", compact_key("page").alias("__k")), "__k", "left").drop("__k")


def allowed_catalog(catalog: DataFrame) -> DataFrame:
    """The gate before any scan."""
    return allowed_only(catalog, "license")


def write_chapters(chapters: DataFrame, path: str) -> None:
    """chapters(slug, chapter_slug, markdown) partitioned by book."""
    chapters.write.mode("overwrite").partitionBy("slug").parquet(path)


def _write_each(rows: DataFrame, root: str) -> None:
    """rows(name, body): a file of its own for each, written by the tasks into a folder that all of them share."""

    def over(part) -> None:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(root if "://" in root else Path(root).absolute().as_uri())
        for r in part:
            store.create_dir(posixpath.dirname(f"{top}/{r.name}"), recursive=True)
            with store.open_output_stream(f"{top}/{r.name}") as f:
                f.write(r.body.encode("utf-8"))

    rows.select("name", "body").foreachPartition(over)


def write_chapter_files(chapters: DataFrame, root: str) -> None:
    """chapters(slug, chapter_slug, markdown) as root/slug/text/chuong-NN.md."""
    name = F.concat_ws("/", "slug", F.lit("text"), F.concat("chapter_slug", F.lit(".md")))
    _write_each(chapters.select(name.alias("name"), F.col("markdown").alias("body")), root)


def write_book_json(books: DataFrame, path: str) -> None:
    B.book_json(books).select("json").write.mode("overwrite").text(path)


def write_book_files(books: DataFrame, root: str, notes: Column, created_at: str) -> None:
    """root/slug/book.json and root/slug/manifest.json of each record."""
    of = lambda rows, file: rows.select(F.concat("slug", F.lit(f"/{file}")).alias("name"), F.col("json").alias("body"))
    _write_each(of(B.book_json(books), "book.json").unionByName(of(B.manifests(books, notes, created_at), "manifest.json")), root)


def cache_sources(pages: DataFrame, path: str) -> None:
    """Fetched pages(slug, ord, page, wikitext, html, ...) for rebuilding without a network."""
    pages.write.mode("overwrite").partitionBy("slug").parquet(path)


def cache_source_files(pages: DataFrame, root: str) -> None:
    """pages(slug, ord, page, wikitext, revision) as root/slug/source/NN-page.wikitext, and source_meta.json beside them."""
    name = F.format_string("%s/source/%02d-%s.wikitext", "slug", F.col("ord").cast("int"), slugify("page"))
    meta = F.to_json(F.struct("slug", F.array_sort(F.collect_list(F.struct("ord", "page", "revision"))).alias("pages")))
    texts = pages.select(name.alias("name"), F.coalesce("wikitext", F.lit("")).alias("body"))
    books = pages.groupBy("slug").agg(meta.alias("body")).select(F.concat("slug", F.lit("/source/source_meta.json")).alias("name"), "body")
    _write_each(texts.unionByName(books), root)
