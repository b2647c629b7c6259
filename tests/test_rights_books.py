import json

import pytest
from pyspark.sql import functions as F

from inkmill.operators import books as B
from inkmill.operators import quality as Q
from inkmill.operators import rights as R

ENTRY = "slug string, title string, author string, license string, license_url string, rights_note string"


def test_licences(ask):
    given = ["public-domain", "Public Domain", " CC0-1.0 ", "cc_by_4.0", "all rights reserved", "", None, "CC BY-NC 4.0"]
    assert ask(R.is_allowed, *given) == [True, True, True, True, False, False, False, False]
    assert ask(R.license_problem, "cc0", "", "x") == [None, "no licence declared", "licence x is not redistributable"]
    assert R.check_license("CC0") == "cc0"
    for bad in ("", None, "mine"):
        with pytest.raises(R.RightsError):
            R.check_license(bad)
    with pytest.raises(Exception, match="RightsError"):
        ask(R.require_license, "mine")


def test_death_years(spark, ask):
    rows = spark.createDataFrame([("Nguyễn Trãi", "Đặng Trần Côn", None, ""), ("Nguyễn Du", "", None, "1765–1820"), ("X", "", None, None)], "author string, source_author string, author_death_year int, author_dates string")
    assert {(r.author, r.death_year, r.mismatch) for r in R.resolved_death_year(rows).collect()} == {("Nguyễn Trãi", 1780, True), ("Nguyễn Du", 1820, False), ("X", None, False)}
    assert ask(lambda c: R.death_year(F.lit(None), c, c), "1765–1820", "d. 1945", "(1894-1945)", "none") == [1820, 1945, 1945, None]


def test_problems(spark):
    ok = ("a", "t", "Nguyễn Du (1765-1820)", "public-domain", "u", "n")
    bad = ("b", "t", "Lewis Carroll", "mine", "", "n")
    df = spark.createDataFrame([ok, bad], ENTRY)
    cols = {c: F.col(c) for c in df.columns} | {"blob": F.col("author")}
    rows = df.select("slug", R.problems(cols, F.lit(10), F.lit(1)).alias("problems"))
    assert {r.slug: list(r.problems) for r in rows.collect()} == {"a": [], "b": ["missing:license_url", "licence:mine", "denied:lewis carroll", "prose-without-licence"]}
    assert tuple(R.rights_report(rows).first()) == (2, 4, False)


@pytest.fixture(scope="module")
def library(spark):
    catalog = spark.createDataFrame([("a", "A", "x", "CC0", "u", "n"), ("b", "B", "x", "mine", "u", "n.")], ENTRY)
    sections = spark.createDataFrame([("a", 2, "II", "Câu ba."), ("a", 1, "I", "Câu một. Câu hai."), ("a", 3, "x", "  "), ("b", 1, "I", "z")], "slug string, pos int, title string, text string")
    return catalog, sections


def test_assembly(spark, library):
    catalog, sections = library
    books = B.assemble_books(catalog, sections).collect()
    assert [(b.slug, b.license, b.status, [(c["index"], c.slug, c.title, c.word_count) for c in b.chapters]) for b in books] == [
        ("a", "cc0", "extracted", [(1, "chuong-01", "Chương một", 7), (2, "chuong-02", "Chương hai", 5)])
    ]
    blocked = B.blocked_books(R.blocked_only(catalog), F.lit("offline")).first()
    assert blocked.status == B.BLOCKED and not blocked.chapters and "offline" in blocked.rights_note and "n. VIETNAMESE" in blocked.rights_note


def test_records(spark, library):
    catalog, sections = library
    books = B.assemble_books(catalog, sections)
    record = json.loads(B.book_json(books).first().json)
    assert record["slug"] == "a" and "narrator" not in record and len(record["chapters"]) == 2
    back = B.parse_books(spark.createDataFrame([(json.dumps(record | {"unknown": 1}),)], "json string")).first()
    assert back.slug == "a" and back.narrator == "" and back.language == "vi" and len(back.chapters) == 2 and "unknown" not in back.asDict()
    one = B.manifests(books, F.array(F.lit("note")), "2026-01-01T00:00:00Z")
    manifest = B.parse_manifests(one)
    assert manifest.first().notes == ["note"] and one.first().json == B.manifests(books, F.array(F.lit("note")), "2026-01-01T00:00:00Z").first().json
    assert [r.source_path for r in B.chapter_files(manifest).collect()] == ["books/a/text/chuong-01.md", "books/a/text/chuong-02.md"]
    assert B.paths(catalog.limit(1)).first().meta_path == "books/a/book.json"


def test_status(spark):
    facts = "license string, has_source boolean, offline boolean, n_sections int, death_year int, needs_death_year boolean, translate_failed boolean, language string, wanted_language string, dry_run boolean, error string"
    base = dict(license="cc0", has_source=True, offline=False, n_sections=1, death_year=None, needs_death_year=False, translate_failed=False, language="vi", wanted_language="vi", dry_run=False, error=None)
    changes = [{}, {"license": "x"}, {"has_source": False, "offline": True}, {"has_source": False}, {"n_sections": 0}, {"needs_death_year": True}, {"translate_failed": True}, {"language": "en"}, {"dry_run": True}, {"error": "e"}]
    df = spark.createDataFrame([tuple((base | c).values()) for c in changes], facts)
    assert [r.s for r in df.select(B.build_status(df).alias("s")).collect()] == ["ok", "rights-blocked", "offline", "no-source", "empty", "unverifiable-author", "translate-failed", "wrong-language", "dry-run", "error"]


def test_rules(spark, library):
    catalog, sections = library
    good = B.chapters_of(sections).filter("slug = 'a'").withColumnRenamed("chapter_slug", "source_path")
    assert {r.rule for r in Q.violations(good).collect()} == {"floor", "body-lines", "total-words"}
    bad = spark.createDataFrame(
        [("z", 1, "Mục lục", "p", "# Mục lục\n\n\n\nA. B c d.\n12\n**x**\n## y\nTúykiều\n", 99), ("z", 3, "Mục lục", "p", "# khác\n\nx y z\n", 4), ("z", 4, "Phần 2 x", "q", "# Phần 2 x\n\nx\n", 400), ("z", 5, "Phần 1 x", "r", "# Phần 1 x\n\nx\n", 5)],
        "slug string, index int, title string, source_path string, markdown string, word_count int",
    )
    found = {(r.rule, r["index"]) for r in Q.violations(bad).collect()}
    for rule in ["one-heading", "blank-lines", "forbidden-markup", "two-sentences", "furniture", "glued-words", "word-drift", "front-matter"]:
        assert (rule, 1) in found, rule
    assert {("contiguous", 3), ("unique-paths", 3), ("duplicate-title", 3), ("heading-is-title", 3), ("part-numbers", 5), ("runt", 5)} <= found
    assert {r["index"] for r in Q.broken(bad, "part-numbers").collect()} == {5}
    books = spark.createDataFrame([("z", 9, "blocked-x", "http"), ("y", 0, "ok", None)], "slug string, expect_chapters int, status string, translate_mode string")
    assert [r.detail for r in Q.chapter_count(books, bad).collect()] == ["4"]
    assert len(Q.blocked_have_no_text(books, bad).collect()) == 1 and len(Q.machine_translated(books).collect()) == 1
    assert Q.provenance(catalog, catalog, ["title", "author"]).count() == 0
    assert Q.whole_is_parts(spark.createDataFrame([("a", "# Chương một\n\nCâu một.\nCâu hai.\n\n# Chương hai\n\nCâu ba.\n")], "slug string, text string"), good).count() == 0
