import io
import json
import os
import sys
import zipfile

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from inkmill.operators import books as B
from inkmill.operators import gloss as G
from inkmill.operators import translate as X
from inkmill.sources import files as S
from inkmill.sources import pdf
from inkmill.sources import wiki as W
from inkmill.streaming import clean_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import test modules


def epub() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:x"><rootfiles><rootfile full-path="O/p.opf"/></rootfiles></container>')
        z.writestr("O/p.opf", '<package xmlns="http://www.idpf.org/2007/opf" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:opf="http://www.idpf.org/2007/opf"><metadata><dc:title>Sách</dc:title><dc:contributor opf:role="trl">Dịch</dc:contributor></metadata><manifest><item id="a" href="a.xhtml" media-type="application/xhtml+xml"/><item id="b" href="phan-hai.xhtml" media-type="application/xhtml+xml"/></manifest><spine><itemref idref="a"/><itemref idref="b"/><itemref idref="a"/></spine></package>')
        z.writestr("O/a.xhtml", "<html><body><h1>Một</h1><p>" + "từ " * 50 + "</p></body></html>")
        z.writestr("O/phan-hai.xhtml", "<html><body><p>" + "chữ " * 50 + "</p></body></html>")
    return out.getvalue()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("sources")
    (d / "a.txt").write_text("*** START OF THIS PROJECT GUTENBERG EBOOK X ***\nChương 1\n" + "một hai\n" * 30 + "\nChương 2\n" + "ba bốn\n" * 30, encoding="utf-8")
    (d / "b.md").write_text("# Một\n\n" + "x " * 50 + "\n\n# Hai\n\n" + "y " * 50, encoding="utf-8")
    (d / "c.wikitext").write_text("== Một ==\n" + "x " * 50, encoding="utf-8")
    (d / "d.epub").write_bytes(epub())
    (d / "e.bin").write_bytes(b"x")
    return str(d)


def test_files(spark, folder):
    files = S.read_files(spark, folder)
    assert {r.suffix for r in files.collect()} == {"txt", "md", "wikitext", "epub"}
    rows = {r.title: [s.title for s in r.sections] for r in S.extract_files(files).collect()}
    assert rows == {"a": ["Chương 1", "Chương 2"], "b": ["Một", "Hai"], "c": ["Một"], "Sách": ["Một", "Phan Hai"]}
    found = S.epub_sections(files.filter("suffix = 'epub'")).orderBy("pos").collect()
    assert [(r.title, r.translator, r.section.title) for r in found] == [("Sách", "Dịch", "Một"), ("Sách", "Dịch", "Phan Hai")]
    assert S.extract_file(spark, folder + "/b.md", "cc0").count() == 1
    with pytest.raises(ValueError):
        S.extract_file(spark, folder + "/e.bin", "cc0")
    with pytest.raises(ValueError):
        S.extract_file(spark, folder + "/missing.txt", "mine")


def test_decoding():
    assert S.decode_bytes("﻿é".encode()) == "é" and S.decode_bytes("é".encode("utf-16")) == "é"
    assert S.decode_bytes(b"\xe9a") == "éa" and S.decode_bytes(b"") == ""


def test_pdf(spark):
    pages = ["Trang đầu một hai ba bốn năm", "hai ba bốn năm sáu bảy", "ba bốn năm sáu bảy tám"]
    df = spark.createDataFrame([(1, pages, [(0, "A", 1), (2, "B", 1), (1, "x", 2)]), (2, pages, None)], "doc_id int, pages array<string>, outline array<struct<page: int, title: string, level: int>>")
    got = {r.doc_id: [s.title for s in r.sections] for r in S.pdf_sections(df).collect()}
    assert got == {1: ["A", "B"], 2: ["Nội dung"]}
    outline = df.filter("doc_id = 1").select("doc_id", F.inline("outline"))
    rows = S.outline_rows(outline, df.select("doc_id", F.posexplode("pages").alias("page", "text"))).orderBy("start").collect()
    assert [(r.title, len(r.text.split())) for r in rows] == [("A", 13), ("B", 6)]


def test_catalog(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"books": [{"slug": "a", "license": "cc0", "verified": {"bytes": 3, "checked": "x"}, "min_chapter_words": 5}, {"slug": "b", "zzz": 1}]}')
    rows = S.read_catalog(spark, str(tmp_path / "c.json")).orderBy("slug").collect()
    assert [(r.slug, r.license, r.min_chapter_words) for r in rows] == [("a", "cc0", 5), ("b", "", None)] and rows[0].verified.bytes == 3
    (tmp_path / "e.json").write_text('{"books": []}')
    with pytest.raises(ValueError):
        S.read_catalog(spark, str(tmp_path / "e.json"))
    for slug in ("b", "a"):
        (tmp_path / "books" / slug).mkdir(parents=True)
        (tmp_path / "books" / slug / "book.json").write_text(f'{{\n"slug": "{slug}", "x": 1}}')
    assert [r.slug for r in S.read_books(spark, str(tmp_path / "books")).collect()] == ["a", "b"]


def test_local_sources(spark):
    df = spark.createDataFrame([("s/10.html", "html"), ("s/2.html", "html"), ("s/a.txt", "txt"), ("t/a.txt", "txt")], "path string, suffix string")
    got = [(r.slug, r.path) for r in S.local_sources(df, F.element_at(F.split("path", "/"), 1)).collect()]
    assert got == [("s", "s/2.html"), ("s", "s/10.html"), ("t", "t/a.txt")]
    named = S.named_sources(spark.createDataFrame([("x/01-truyen-kieu.html",)], "path string"), spark.createDataFrame([("Truyện Kiều",)], "page string"))
    assert named.first().page == "Truyện Kiều"


def fake(endpoint, params):
    if params.get("titles") == "Không":
        return {"query": {"pages": [{"missing": True}]}}
    if params.get("titles") == "Lỗi":
        return {"error": "bad"}
    if params.get("action") == "parse":
        return {"parse": {"wikitext": "== Một ==\n" + "x " * 300, "text": ""}}
    if params.get("list") == "allpages":
        return {"query": {"allpages": [{"title": "Sách/10"}, {"title": "Sách/2"}]}}
    return {"query": {"pages": [{"title": "Sách", "pageid": 7, "revisions": [{"revid": 5, "timestamp": "t", "user": "u"}], "links": [{"title": "Sách hai"}, {"title": "Khác"}]}]}}


def test_wiki(spark):
    wanted = spark.createDataFrame([("vi", "Sách"), ("vi", "Không"), ("vi", "Lỗi")], "language string, title string")
    pages = W.fetch_pages(wanted, fake, 0.0)
    rows = {r.requested: r for r in pages.collect()}
    assert rows["Sách"].revid == 5 and rows["Không"].title == "" and "bad" in rows["Lỗi"].error
    page = pages.filter("title <> ''")
    assert [r.subpage for r in W.subpages(page).orderBy("ord").collect()] == ["Sách/2", "Sách/10"]
    assert [r.linked for r in W.sibling_pages(page).collect()] == ["Sách hai"]
    found = W.page_sections(page.withColumn("work", F.col("title")))
    assert found.first().words == 300 and W.probe(found).first().available
    kept = W.work_sections(found).collect()
    assert [(r.section.title, r.kept) for r in kept] == [("Một", True)]
    works = spark.createDataFrame([("w", "vi", 10), ("w", "en", 900)], "work string, language string, words int")
    assert W.first_language(works, ["vi", "en"]).first().language == "en"
    hits = spark.createDataFrame([("Truyện Kiều", "Truyen kieu"), ("Truyện Kiều", "Khác")], "title string, hit string")
    assert W.best_hits(hits.select("title").distinct(), hits).first().hit == "Truyen kieu"
    with pytest.raises(ValueError):
        W.Client("xx")


def test_engines(ask, spark):
    assert ask(X.off().translate, " a​  b \n\n\n c", None) == ["a b\n\nc", ""]
    assert ask(X.reading().translate, "A & B") == ["A và B"]
    for n in (0, 5, 6, 400):
        given = ["aa\n\nbb\n\ncc", "x" * 9 + "\n\ny", "", "\n\n", "a\n\n\n\nb"]
        assert ask(lambda c, n=n: X.batch_text(c, n), *given) == [X.batches(g, n) for g in given]
    upper = f'{sys.executable} -c "import sys; print(sys.stdin.read().upper())"'
    assert ask(lambda c: X.translate_text(c, X.build_engine("command", line=upper)), "ab", "", None) == ["AB", "", ""]
    with pytest.raises(Exception, match="TranslationError"):
        ask(X.command("false").translate, "a")
    assert ask(X.http("u", post=lambda u, b, t: b'{"output": "z"}', batch_chars=1).translate, "a\n\nb") == ["z\n\nz"]
    for answer in (b"[]", b"{}", b"no"):
        with pytest.raises(Exception, match="TranslationError"):
            ask(X.http("u", post=lambda u, b, t, a=answer: a).translate, "a")
    with pytest.raises(X.TranslationError):
        X.build_engine("x")
    rows = X.translate_sections(spark.createDataFrame([("# A", "x  y"), ("", "")], "title string, text string"), X.off()).collect()
    assert [(r.title, r.text, r.translate_mode, r.translate_note) for r in rows] == [("A", "x y", "off", None), ("Chương", "", "off", None)]


def test_stream(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a <b>x</b>\n12"), (2, None)], "doc_id long, text string")
    df.write.parquet(src)
    stream = clean_stream.write_latest(clean_stream.cleaned(clean_stream.read_texts(spark, src)), out, str(tmp_path / "check"))
    stream.awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == sorted(tuple(r) for r in clean_stream.cleaned(df).collect()) == [(1, "a x", 2), (2, "", 0)]


def test_sinks(spark, tmp_path):
    S.write_chapters(spark.createDataFrame([("a", "chuong-01", "# x")], "slug string, chapter_slug string, markdown string"), str(tmp_path / "ch"))
    assert spark.read.parquet(str(tmp_path / "ch")).first().slug == "a"
    S.write_book_json(spark.createDataFrame([("a", "")], "slug string, title string"), str(tmp_path / "b"))
    assert spark.read.text(str(tmp_path / "b")).first().value == '{"slug":"a"}'


@pytest.fixture
def reader(tmp_path, monkeypatch):
    """A pdftotext that gives a file's own bytes back, on the path of this process and of the workers' tasks."""
    tool = tmp_path / "bin" / "pdftotext"
    tool.parent.mkdir()
    tool.write_text('#!/bin/sh\ncat "$5"\n')
    tool.chmod(0o755)
    monkeypatch.setenv("PATH", f"{tool.parent}:{os.environ['PATH']}")
    return str(tool.parent)


def test_pdf_reader(reader):
    assert pdf.pdftotext_available() and pdf.page_texts("một\f\fba\f".encode()) == ["một", "", "ba"] and pdf.page_texts(b"one") == ["one"]
    assert pdf.bookmarks(b"no pdf") == []


def test_pdf_without_a_reader(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pdf, "pdftotext_available", lambda: False)
    monkeypatch.setattr(pdf, "_mupdf", lambda: None)
    with pytest.raises(RuntimeError, match="no PDF reader"):
        pdf.page_texts(b"x")
    rows = spark.createDataFrame([("a.pdf", bytearray(b"x"))], "path string, content binary")
    over = pdf.read_pdfs(rows)
    assert over.columns == ["path", "pages", "outline", "error"]
    (tmp_path / "a.pdf").write_bytes(b"x")
    with pytest.raises(ValueError, match=r"no PDF reader|scanned"):  # never an empty result without a word
        S.extract_file(spark, str(tmp_path / "a.pdf"), "cc0")


def test_files_of_all_kinds(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Chương 1\n" + "a " * 60 + "\nChương 2\n" + "b " * 60)
    (tmp_path / "b.pdf").write_bytes(b"not a pdf")
    rows = {r.title: r for r in S.extract_files(S.read_files(spark, str(tmp_path))).collect()}
    assert [s.title for s in rows["a"].sections] == ["Chương 1", "Chương 2"] and rows["a"].error is None
    assert rows["b"].source_format == "pdf" and rows["b"].error and not rows["b"].sections


def test_written_files(spark, tmp_path):
    S.write_chapter_files(spark.createDataFrame([("a", "chuong-01", "# x\n"), ("a", "chuong-02", "# y\n"), ("b", "chuong-01", "# z\n")], "slug string, chapter_slug string, markdown string"), str(tmp_path))
    assert (tmp_path / "a/text/chuong-02.md").read_text() == "# y\n" and (tmp_path / "b/text/chuong-01.md").read_text() == "# z\n"
    S.cache_source_files(spark.createDataFrame([("a", 10, "Truyện Kiều", "w", 5), ("a", 2, "Phần hai", None, 6)], "slug string, ord int, page string, wikitext string, revision long"), str(tmp_path))
    assert (tmp_path / "a/source/10-truyen-kieu.wikitext").read_text() == "w" and (tmp_path / "a/source/02-phan-hai.wikitext").read_text() == ""
    meta = json.loads((tmp_path / "a/source/source_meta.json").read_text())
    assert [(p["ord"], p["revision"]) for p in meta["pages"]] == [(2, 6), (10, 5)]
    books = B.parse_books(spark.createDataFrame([('{"slug": "a", "title": "t"}',)], "json string"))
    S.write_book_files(books, str(tmp_path), F.array(F.lit("n")), "2024")
    assert json.loads((tmp_path / "a/book.json").read_text())["title"] == "t" and json.loads((tmp_path / "a/manifest.json").read_text())["created_at"] == "2024"
    back = B.parse_manifests(spark.createDataFrame([((tmp_path / "a/manifest.json").read_text(),)], "json string"))
    assert B.manifest_mismatches(back, books).count() == 0
    assert [r.slug for r in B.manifest_mismatches(back, books.withColumn("title", F.lit("u"))).collect()] == ["a"]


def wiki_of(endpoint, params):
    """Vietnamese has a stub of the work only; English has it in two subpages."""
    title = params.get("titles") or params.get("page") or ""
    if "vi.wiki" in endpoint:
        body = "ngắn"
    else:
        body = "" if "/" not in title else f"== {title[-1]} ==\n" + "word " * 200
    if params.get("list") == "search":
        return {"query": {"search": [{"title": "Truyện Kiêu"}, {"title": "Other"}]}}
    if params.get("action") == "parse":
        return {"parse": {"wikitext": body, "text": ""}}
    if params.get("list") == "allpages":
        below = ["Kiều/1", "Kiều/2"] if "en.wiki" in endpoint and params["apprefix"] == "Kiều/" else []
        return {"query": {"allpages": [{"title": t} for t in below]}}
    if title == "Truyện Kiều":
        return {"query": {"pages": [{"missing": True}]}}
    return {"query": {"pages": [{"title": title, "pageid": 7}]}}


def test_work_at_an_address(spark, monkeypatch):
    found = W.extract_url(spark, "https://vi.wikisource.org/wiki/Ki%E1%BB%81u", "cc0", "vi", ("en",), wiki_of, 0.0).collect()
    assert {(r.language, r.title) for r in found} == {("en", "Kiều/1"), ("en", "Kiều/2")} and all("no vi edition" in r.note for r in found if r.kept)
    with pytest.raises(ValueError):
        W.extract_url(spark, "https://vi.wikisource.org/wiki/X", "all rights reserved", transport=wiki_of)
    client = W.Client("vi", wiki_of, 0.0)
    assert client.resolve("Có") == "Có" and client.resolve("Truyện Kiều") == "Truyện Kiêu" and client.resolve(" ") == ""
    monkeypatch.setenv(W.OFFLINE, "1")
    with pytest.raises(RuntimeError, match="switched off"):
        W.Client("vi").exists("x")


def test_reading_facade(ask):
    g = G.Gloss()
    assert ask(g, "A & B") == ask(g.script, "A & B") == ["A và B"] and ask(g.title, "# Chương IV") == ["Chương bốn"]
    assert ask(g.sentences, "Một hai ba. Bốn năm sáu.\nBảy tám chín") == [["Một hai ba.", "Bốn năm sáu.", "Bảy tám chín"]]
