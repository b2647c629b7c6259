"""Wiki pages as a data source: one partition per endpoint, so the pause between requests holds for each of them.

``transport`` is a callable (endpoint, params) -> dict; by default an HTTP client. Tests and offline runs give their own.
"""

from __future__ import annotations

import difflib
import json
import os
import time
import urllib.parse
import urllib.request
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkmill.functions.text import natural_key, title_from_url, title_key
from inkmill.operators.markup import html_sections
from inkmill.operators.rights import check_license
from inkmill.operators.wikitext import PAGE_WORDS, PROBE_WORDS, SEARCH_SIMILARITY, TOTAL_WORDS, is_front_matter, is_placeholder_title, is_stub, name_key, similarity, wikitext_sections

# Fixed values.
ENDPOINTS = {lang: f"https://{lang}.wikisource.org/w/api.php" for lang in ("vi", "en", "fr")}
AGENT = "inkmill/0.1 (public text corpus builder)"
INTERVAL, RETRIES, TIMEOUT, BACKOFF, SEARCH_HITS = 0.34, 3, 30.0, 0.5, 8
#: Set, no request leaves the machine.
OFFLINE = "INKMILL_OFFLINE"
RETRY_STATUS = {429, 500, 502, 503, 504}
PAGE = "language string, requested string, title string, pageid long, revid long, timestamp string, user string, wikitext string, html string, subpages array<string>, links array<string>, error string"

Transport = Callable[[str, dict], dict]


def http_transport(endpoint: str, params: dict) -> dict:
    if os.environ.get(OFFLINE):
        raise RuntimeError(f"the network is switched off by {OFFLINE}")
    request = urllib.request.Request(f"{endpoint}?{urllib.parse.urlencode(params)}", headers={"User-Agent": AGENT})
    with urllib.request.urlopen(request, timeout=TIMEOUT) as answer:  # noqa: S310
        return json.load(answer)


class Client:
    """Spaced requests with retries on busy servers; an error that the server reports is raised at once."""

    def __init__(self, language: str, transport: Transport = http_transport, interval: float = INTERVAL):
        if language not in ENDPOINTS:
            raise ValueError(f"unsupported language {language!r}")
        self.endpoint, self.transport, self.interval, self.last = ENDPOINTS[language], transport, interval, 0.0

    def ask(self, **params) -> dict:
        full = {"format": "json", "formatversion": "2", "errorformat": "plaintext"} | params
        for attempt in range(RETRIES):
            time.sleep(max(0.0, self.last + self.interval - time.monotonic()))
            self.last = time.monotonic()
            try:
                answer = self.transport(self.endpoint, full)
            except OSError as e:
                if getattr(e, "code", 503) not in RETRY_STATUS or attempt == RETRIES - 1:
                    raise
                time.sleep(BACKOFF * 2**attempt)
                continue
            if "error" in answer:
                raise RuntimeError(str(answer["error"]))
            return answer
        raise RuntimeError("no answer")

    def page(self, title: str) -> dict:
        """What is known of a page; title is empty if there is none."""
        info = self.ask(action="query", titles=title, prop="info|revisions|links", rvprop="ids|timestamp|user", plnamespace="0", pllimit="max", redirects="1")
        page = next(iter(info.get("query", {}).get("pages", [])), {"missing": True})
        if page.get("missing"):
            return {"title": ""}
        name = page.get("title", title)
        rev = next(iter(page.get("revisions") or []), {})
        text = self.ask(action="parse", page=name, prop="wikitext|text", redirects="1").get("parse", {})
        below = self.ask(action="query", list="allpages", apnamespace="0", apprefix=f"{name}/", aplimit="max")
        return {
            "title": name, "pageid": int(page.get("pageid") or 0), "revid": int(rev.get("revid") or 0), "timestamp": rev.get("timestamp", ""), "user": rev.get("user", ""),
            "wikitext": text.get("wikitext", ""), "html": text.get("text", ""), "subpages": [p["title"] for p in below.get("query", {}).get("allpages", [])],
            "links": [x["title"] for x in page.get("links", [])],
        }

    def search(self, title: str) -> list[str]:
        found = self.ask(action="query", list="search", srsearch=title, srnamespace="0", srlimit=str(SEARCH_HITS))
        return [h["title"] for h in found.get("query", {}).get("search", [])]

    def exists(self, title: str) -> bool:
        pages = self.ask(action="query", titles=title, redirects="1").get("query", {}).get("pages", [])
        return bool(pages) and not pages[0].get("missing")

    def resolve(self, title: str) -> str:
        """The title itself if there is such a page, else the search hit that is most like it, else nothing."""
        if not title.strip():
            return ""
        if self.exists(title):
            return title
        score = lambda hit: difflib.SequenceMatcher(None, name_key(title), name_key(hit)).ratio()
        best = max(self.search(title), key=score, default="")
        return best if best and score(best) >= SEARCH_SIMILARITY else ""


def fetch_pages(wanted: DataFrame, transport: Transport = http_transport, interval: float = INTERVAL) -> DataFrame:
    """wanted(language, title) to rows of PAGE; a failure is a row with its error, a missing page one with no title."""

    def over(pdf: pd.DataFrame) -> pd.DataFrame:
        client = Client(pdf["language"].iloc[0], transport, interval)
        rows = []
        for title in pdf["title"]:
            try:
                found, error = client.page(title), None
            except (OSError, RuntimeError) as e:
                found, error = {"title": ""}, str(e)
            rows.append({"language": pdf["language"].iloc[0], "requested": title, "error": error, "subpages": [], "links": [], "pageid": None, "revid": None} | found)
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in PAGE.split(", ")]).astype({"pageid": "Int64", "revid": "Int64"})
        return out.astype(object).where(out.notna(), None)

    return wanted.select("language", "title").distinct().groupBy("language").applyInPandas(over, PAGE)


def best_hits(wanted: DataFrame, hits: DataFrame) -> DataFrame:
    """wanted(title), hits(title, hit): the most similar hit of each title, if it is similar enough."""
    rows = wanted.join(hits, "title").withColumn("score", similarity(title_key("title"), title_key("hit")))
    rows = rows.groupBy("title").agg(F.max_by("hit", F.struct("score", "hit")).alias("hit"), F.max("score").alias("score"))
    return rows.filter(F.col("score") >= SEARCH_SIMILARITY)


def subpages(pages: DataFrame) -> DataFrame:
    """(title, subpage, ord) in natural order."""
    rows = pages.select("title", F.explode("subpages").alias("subpage")).filter(F.col("subpage").startswith(F.concat("title", F.lit("/"))))
    return rows.withColumn("ord", F.row_number().over(Window.partitionBy("title").orderBy(natural_key("subpage"))))


def sibling_pages(pages: DataFrame) -> DataFrame:
    """(title, linked, ord): links whose folded title starts with the page's and goes on."""
    rows = pages.select("title", F.explode("links").alias("linked")).distinct()
    own, other = title_key("title"), title_key("linked")
    rows = rows.filter((F.col("linked") != F.col("title")) & other.startswith(own) & (F.length(other) > F.length(own)))
    return rows.withColumn("ord", F.row_number().over(Window.partitionBy("title").orderBy(natural_key("linked"))))


def page_sections(pages: DataFrame, min_words: int = 40) -> DataFrame:
    """pages(work, title, wikitext, html) to (work, title, sections, words, from_html): markup first; the rendered page
    where a stub's markup has too little and the rendered page has more. Only stubs are parsed as HTML."""
    total = lambda c: F.aggregate(c, F.lit(0), lambda n, s: n + F.size(F.filter(F.split(s.text, r"\s+"), lambda w: w != "")))
    rows = pages.withColumn("__w", wikitext_sections("wikitext", min_words)).withColumn("__n", total(F.col("__w")))
    need = is_stub("wikitext") & (F.col("__n") < PAGE_WORDS)
    rows = rows.withColumn("__h", html_sections(F.when(need, F.col("html")).otherwise(""), min_words)).withColumn("__m", total(F.col("__h")))
    better = need & (F.col("__m") > F.col("__n"))
    rows = rows.withColumns({"sections": F.when(better, F.col("__h")).otherwise(F.col("__w")), "from_html": better, "words": F.greatest("__m", "__n")})
    return rows.select("work", "title", "sections", "words", "from_html")


def work_sections(found: DataFrame) -> DataFrame:
    """(work, title, pos, section, kept, note): sections of a work's pages. A generic title becomes the subpage's name;
    an index page that has subpages, and front matter, are dropped with a note."""
    many = F.count(F.lit(1)).over(Window.partitionBy("work")) > 1
    rows = found.withColumn("many", many).select("work", "title", "many", F.posexplode("sections").alias("pos", "s"))
    short = F.element_at(F.split("title", "/"), -1)
    name = F.when(is_placeholder_title("s.title") & (F.col("title") != F.col("work")), short).otherwise(F.col("s.title"))
    rows = rows.withColumn("name", name)
    index = F.col("many") & (title_key("name") == title_key("work"))
    front = is_front_matter("name", "work")
    note = F.when(index, F.concat(F.lit("dropped the index page "), "title")).when(front, F.concat(F.lit("dropped front matter "), "name"))
    return rows.select("work", "title", "pos", F.struct(F.col("name").alias("title"), F.col("s.text").alias("text"), F.col("s.level").alias("level")).alias("section"), note.isNull().alias("kept"), note.alias("note"))


def first_language(works: DataFrame, order: list[str]) -> DataFrame:
    """works(work, language, words): the first language in ``order`` with enough words; a fallback is named in notes."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("language"))
    rows = works.withColumn("rank", rank).filter((F.col("rank") > 0) & (F.col("words") >= TOTAL_WORDS))
    best = rows.withColumn("at", F.row_number().over(Window.partitionBy("work").orderBy("rank"))).filter("at = 1")
    note = F.when(F.col("language") != order[0], F.concat(F.lit(f"no {order[0]} edition: this is the one in "), "language"))
    return best.select("work", "language", "words", note.alias("note"))


def probe(found: DataFrame) -> DataFrame:
    """(work, available, chapters, words) of page_sections."""
    rows = found.groupBy("work").agg(F.sum("words").alias("words"), F.sum(F.size("sections")).alias("chapters"))
    return rows.select("work", ((F.col("chapters") > 0) & (F.col("words") >= PROBE_WORDS)).alias("available"), "chapters", "words")


def extract_works(works: DataFrame, order: list[str], transport: Transport = http_transport, interval: float = INTERVAL, min_words: int = 40) -> DataFrame:
    """works(work): its sections in the first language of ``order`` that has enough of it, with that language and notes.

    A language is asked only for what the ones before it don't have; each page's own text counts for its language, so
    nothing is relabelled. Columns: work, language, title, pos, section, kept, note."""
    left, found = works.select("work").distinct(), []
    for rank, language in enumerate(order):
        wanted = left.select(F.lit(language).alias("language"), F.col("work").alias("title"))
        roots = fetch_pages(wanted, transport, interval).filter("title <> ''").withColumn("work", F.col("requested")).cache()
        stubs = roots.filter(is_stub("wikitext") & (F.size("subpages") == 0))
        below = subpages(roots).select("title", F.col("subpage").alias("page")).unionByName(sibling_pages(stubs).select("title", F.col("linked").alias("page")))
        below = below.join(roots.select("title", "work"), "title").select("work", F.col("page").alias("requested"))
        more = fetch_pages(below.select(F.lit(language).alias("language"), F.col("requested").alias("title")), transport, interval).filter("title <> ''").join(below, "requested")
        pages = roots.unionByName(more).select("work", "title", "wikitext", "html")
        sections = page_sections(pages, min_words).cache()
        enough = sections.groupBy("work").agg(F.sum("words").alias("words")).filter(F.col("words") >= TOTAL_WORDS).select("work")
        kept = work_sections(sections.join(enough, "work", "left_semi"))
        fallback = F.lit(f"no {order[0]} edition: this is the one in {language}" if rank else None).cast("string")
        found.append(kept.withColumn("language", F.lit(language)).withColumn("note", F.coalesce("note", fallback)))
        left = left.join(enough, "work", "left_anti")
    return reduce(DataFrame.unionByName, found).select("work", "language", "title", "pos", "section", "kept", "note")


def extract_url(spark: SparkSession, url: str, license_id: str, language: str = "vi", fallback: tuple[str, ...] = ("en",), transport: Transport = http_transport, interval: float = INTERVAL, min_words: int = 40) -> DataFrame:
    """The work at a wiki address, refused before any request unless its licence is allowed."""
    check_license(license_id)
    works = spark.createDataFrame([(url,)], "url string").select(title_from_url("url").alias("work"))
    return extract_works(works, [language, *[x for x in fallback if x != language]], transport, interval, min_words)
