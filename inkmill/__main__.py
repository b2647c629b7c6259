"""Command line: extract a file, build a catalog, ask the wiki, report on rights, check a corpus, count attributes, find
markup that is left."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions.text import natural_key
from inkmill.operators import books, cleaning, markup, quality, rights, wikitext
from inkmill.sources import files, wiki


def rights_rows(records: DataFrame, prose: DataFrame | None = None) -> DataFrame:
    """(slug, problems) of book records; prose(slug, prose_bytes, text_files) tells what text each of them has. Without
    it prose counts by the words of the chapters and files by the chapters."""
    cols = {c: F.col(c) for c in records.columns if c not in ("chapters",)}
    blob = F.to_json(F.struct(*records.columns))
    if prose is None:
        said = F.aggregate("chapters", F.lit(0), lambda n, c: n + F.coalesce(c.word_count, F.lit(0)))
        return records.select("slug", rights.problems(cols | {"blob": blob}, said, F.when(F.size("chapters") > 0, F.size("chapters"))).alias("problems"))
    rows = records.join(prose, "slug", "left")
    return rows.select("slug", rights.problems(cols | {"blob": blob}, F.coalesce("prose_bytes", F.lit(0)), F.col("text_files")).alias("problems"))


def prose_files(spark: SparkSession, path: str) -> DataFrame:
    """(slug, prose_bytes, text_files) of books/slug/text; books without such a folder have no row."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    rows = rows.withColumn("slug", F.regexp_extract("path", r"/([^/]+)/text/[^/]*\z", 1)).filter("slug <> ''")
    md = F.col("path").endswith(".md")
    return rows.groupBy("slug").agg(F.coalesce(F.sum(F.when(md, F.col("length"))), F.lit(0)).alias("prose_bytes"), F.count_if(md).alias("text_files"))


def built_books(spark: SparkSession, catalog: str, sources: str, root: str, created_at: str) -> DataFrame:
    """Builds every book of a catalog from local files sources/slug/*: chapters, records and manifests under root.
    Returns (slug, status); licences are looked at before any file is read."""
    entries = files.read_catalog(spark, catalog)
    allowed = files.allowed_catalog(entries)
    found = files.read_files(spark, sources)
    slug = F.regexp_extract("path", r"/([^/]+)/[^/]+\z", 1)
    chosen = files.local_sources(found, slug).join(allowed.select("slug"), "slug", "left_semi")
    parts = files.extract_files(chosen).withColumn("slug", slug)
    rows = parts.select("slug", "path", F.posexplode("sections").alias("k", "s")).select("slug", F.struct(natural_key("path").alias("file"), "k").alias("pos"), "s.title", "s.text")
    made = books.assemble_books(allowed, rows).cache()
    texts = books.chapters_of(rows)
    files.write_chapter_files(texts, root)
    files.write_book_files(made.drop("total_words"), root, F.array().cast("array<string>"), created_at)
    none = F.lit(None)
    have = entries.select("slug", "license").join(chosen.select("slug", F.lit(True).alias("has_source")).distinct(), "slug", "left").join(made.select("slug", F.size("chapters").alias("n_sections")), "slug", "left")
    facts = have.withColumns({"offline": F.lit(True), "death_year": none.cast("int"), "needs_death_year": F.lit(False), "translate_failed": F.lit(False), "language": F.lit("vi"), "wanted_language": F.lit("vi"), "dry_run": F.lit(False), "error": none.cast("string")})
    return facts.select("slug", books.build_status(facts).alias("status"))


def leftovers(rows: DataFrame, text: str) -> DataFrame:
    """Texts in which markup is left after cleaning, and the first of it."""
    from inkmill.operators.patterns import FORBIDDEN

    clean = rows.withColumn("clean", wikitext.strip_wikitext(text))
    return clean.filter(cleaning.has_forbidden_markup("clean")).withColumn("found", F.regexp_extract("clean", FORBIDDEN, 0))


def main(args: list[str] | None = None, spark: SparkSession | None = None, transport=None) -> int:
    top = argparse.ArgumentParser(prog="inkmill")
    sub = top.add_subparsers(dest="what", required=True)
    one = sub.add_parser("extract", help="sections of a file")
    one.add_argument("path")
    one.add_argument("--license", required=True)
    one.add_argument("--min-words", type=int, default=40)
    for name, says in (("rights", "rights problems of books/*/book.json"), ("attributes", "frequent attribute values of html files"), ("leftovers", "markup left in wiki files"), ("check", "rules that rendered chapters (Parquet) break")):
        sub.add_parser(name, help=says).add_argument("path")
    build = sub.add_parser("build", help="books of a catalog from local sources")
    for name in ("catalog", "sources", "root"):
        build.add_argument(name)
    build.add_argument("--created-at", default="")
    for name, says in (("probe", "whether a work is on the wiki"), ("page", "what the wiki has of a page")):
        one = sub.add_parser(name, help=says)
        one.add_argument("title")
        one.add_argument("--language", default="vi")
    gate = sub.add_parser("gate", help="rights of books/*/book.json and rules of chapters (Parquet), for use before a commit")
    gate.add_argument("books")
    gate.add_argument("chapters")
    asked = top.parse_args(args)
    spark = spark or SparkSession.builder.appName("inkmill").getOrCreate()
    if asked.what == "extract":
        try:
            rows = files.extract_file(spark, asked.path, asked.license, asked.min_words)
        except (rights.RightsError, ValueError) as e:
            print(f"refused: {e}", file=sys.stderr)
            return 2
        for r in rows.select(F.explode("sections").alias("s")).select("s.title", F.length("s.text").alias("chars")).toLocalIterator():
            print(f"{r.chars:8d}  {r.title}")
        return 0
    if asked.what == "gate":
        return max(main(["rights", asked.books], spark), main(["check", asked.chapters], spark))
    if asked.what == "build":
        tally = built_books(spark, asked.catalog, asked.sources, asked.root, asked.created_at).orderBy("slug").collect()
        print("\n".join(f"{r.slug}: {r.status}" for r in tally))
        return int(any(r.status not in ("ok", "offline") for r in tally))
    if asked.what in ("probe", "page"):
        wanted = spark.createDataFrame([(asked.language, asked.title)], "language string, title string")
        pages = wiki.fetch_pages(wanted, transport or wiki.http_transport).cache()
        if asked.what == "page":
            r = pages.first()
            print(json.dumps({"title": r.title, "revision": r.revid, "wikitext": len(r.wikitext or ""), "html": len(r.html or ""), "subpages": list(r.subpages or []), "error": r.error}, ensure_ascii=False, indent=2))
            return int(not r.title)
        found = wiki.probe(wiki.page_sections(pages.filter("title <> ''").withColumn("work", F.col("title")))).first()
        print(json.dumps(found.asDict() if found else {"work": asked.title, "available": False, "chapters": 0, "words": 0}, ensure_ascii=False))
        return int(not (found and found.available))
    if asked.what == "rights":
        rows = rights_rows(files.read_books(spark, asked.path), prose_files(spark, asked.path))
        report = rights.rights_report(rows).first().asDict() | {"problems": [f"{r.slug}: {p}" for r in rows.filter(F.size("problems") > 0).toLocalIterator() for p in r.problems]}
        print(json.dumps(report, ensure_ascii=False, indent=2))
        return 0 if report["ok"] else 1
    if asked.what == "check":
        broken = quality.violations(spark.read.parquet(asked.path)).groupBy("rule").count().orderBy("rule").collect()
        print("\n".join(f"{r['count']:6d}  {r.rule}" for r in broken) or "all rules hold")
        return int(bool(broken))
    rows = files.read_files(spark, asked.path).withColumn("text", files.decoded("content"))
    if asked.what == "attributes":
        for name, top_n in (("class", 40), ("id", 20)):
            for r in markup.attribute_frequency(rows, "text", name, top_n).collect():
                print(f"{r.n:8d}  {name}={r.value}")
        return 0
    found = leftovers(rows, "text").select("path", "found").collect()
    print("\n".join(f"{r.path}: {r.found}" for r in found) or "none")
    return int(bool(found))


if __name__ == "__main__":
    sys.exit(main())
