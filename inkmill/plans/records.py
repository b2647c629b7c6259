"""More named queries: line predicates, single reading steps, titles, rights, book records and corpus checks.

Their SQL spells patterns and values out for itself, so a wrong one in an operator shows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.functions import text as T
from inkmill.operators import books as B
from inkmill.operators import chapters as K
from inkmill.operators import cleaning as C
from inkmill.operators import gloss as G
from inkmill.operators import quality as Q
from inkmill.operators import rights as R
from inkmill.operators import wikitext as W
from inkmill.plans.catalog import (
    ABBREVIATED, FURNITURE_SQL, GLUE, GLUED, HEADED, LINES, READINGS, RENDERED, SANITIZED, SP, SQL, SQUEEZE, STRIP, UP_TO_20, WORDS, given, query, quoted, roman_sql, small_sql, table, texts, texts_sql, values,
)
from inkmill.sources import files as S

A, AW = r"\p{L}\p{N}", r"\p{L}\p{N}_"
_SPLIT = lambda source: f"SELECT doc_id, unnest({LINES('text')}) AS s, generate_subscripts({LINES('text')}, 1) AS i FROM {source}"

# --- lines -----------------------------------------------------------------------------------------------------------

KINDS = ["Chương 12\nPHẦN II mở đầu\nthi x\n12.\niv\nXIV)\n====\n---\n~~~ \n# Một\n== Hai ==\nMỘT HAI BA\nMột HAI ba\nchương trình dài\nBook 3 of all the many books there are here\nchapter a\nmục  7: " + "x" * 90]
CHAPTER_LINE = f"regexp_matches(s, '(?i)^[{SP}]*(?:chương|chuong|phần|phan|mục|muc|bài|bai|thi|chuyện|chuyen|chapter|part|book|cuốn|cuon)[{SP}]*(?:[0-9]+|[ivxlcdm]+|[a-z])(?:[^{AW}][^\\n]*)?$')"
_HEADED = " OR ".join([f"regexp_matches(s, '^[{SP}]*={{{k}}}[{SP}]*(?:[^=].*[^{SP}=]|[^={SP}])[{SP}]*={{{k}}}[{SP}]*$')" for k in range(2, 7)] + [f"regexp_matches(s, '^#{{1,6}}[{SP}]+.*[^{SP}][{SP}]*#*[{SP}]*$')"])
_SHOUTED = f"{WORDS('s')} >= 3 AND length(regexp_replace(s, '[^\\p{{L}}]', '', 'g')) > 0 AND length(regexp_replace(s, '[^\\p{{Lu}}]', '', 'g')) * 5 >= length(regexp_replace(s, '[^\\p{{L}}]', '', 'g')) * 4"


@query(
    f"SELECT doc_id, count(*) FILTER ({CHAPTER_LINE}) AS chapter, count(*) FILTER (regexp_matches(s, '(?i)^[{SP}]*(?:[0-9]{{1,3}}|[ivxlcdm]{{1,7}})[.):]?[{SP}]*$')) AS bare, "
    f"count(*) FILTER (regexp_matches(s, '^(?:={{3,}}|-{{3,}}|~{{3,}}|\\*{{3,}}|_{{3,}}|#{{3,}})[{SP}]*$')) AS underline, count(*) FILTER ({_SHOUTED}) AS shouted, "
    f"count(*) FILTER ({STRIP('s')} <> '' AND ({_HEADED} OR length(s) <= 90 AND {CHAPTER_LINE})) AS heading, "
    f"count(*) FILTER (length({STRIP('s')}) BETWEEN 1 AND 70 AND {WORDS('s')} <= 8 AND {CHAPTER_LINE}) AS chapter_line FROM ({_SPLIT(texts_sql(KINDS))}) GROUP BY doc_id"
)
def line_kinds(spark, sf_dir):
    from inkmill.operators import patterns as P

    rows = texts(spark, sf_dir, KINDS).select("doc_id", F.explode(T.lines("text")).alias("s"))
    s = F.col("s")
    kinds = {"chapter": s.rlike(P.CHAPTER), "bare": s.rlike(P.BARE_NUMBER), "underline": s.rlike(P.UNDERLINE), "shouted": T.is_shouted(s), "heading": C.looks_like_chapter_heading(s), "chapter_line": C.is_chapter_heading_line(s)}
    return rows.groupBy("doc_id").agg(*[F.count_if(c).alias(k) for k, c in kinds.items()])


BROKEN = ["chuyến-\ntàu thứ-\n2 x-\r\n y\rz", "a-\n Đ b_-\nc"]


@query(f"SELECT doc_id, regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '([{AW}])-\\n[ \\t]*([a-zà-ỹ])', '\\1\\2', 'g') AS text FROM {texts_sql(BROKEN)}")
def dehyphenated(spark, sf_dir):
    return texts(spark, sf_dir, BROKEN).select("doc_id", C.dehyphenate(C.unify_newlines("text")).alias("text"))


EDITIONS = [
    "Title\n*** START OF THE PROJECT GUTENBERG EBOOK X ***\n\nProduced by A\nRelease date: 1\n\nVăn một.\n*** END OF THIS PROJECT GUTENBERG EBOOK X ***\nlicence",
    "no marks at all", "***START OF THIS PROJECT GUTENBERG***only", "credits: x\nbody\n*** end of the project gutenberg",
]
_AFTER = r"regexp_replace(text, '(?is)^.*?\*\*\*\s*START OF (?:THE|THIS) PROJECT GUTENBERG[^*]*\*\*\*', '')"
_INSIDE = rf"regexp_replace({_AFTER}, '(?is)\*\*\*\s*END OF (?:THE|THIS) PROJECT GUTENBERG.*$', '')"


@query(f"SELECT doc_id, {STRIP(rf'''regexp_replace({_INSIDE}, '(?i)^(?:[ \t\x0b\f\r]*(?:(?:produced by|release date|encoding|audio:|language:|credits:)[^\n]*)?\n)+', '')''')} AS text FROM {texts_sql(EDITIONS)}")
def edition_text(spark, sf_dir):
    return texts(spark, sf_dir, EDITIONS).select("doc_id", C.drop_gutenberg("text").alias("text"))


FENCED = ["a\n```py\nb\n  ```\nc\n```\nd", "```"]


@query(f"SELECT doc_id, count(*) AS n_lines, count(*) FILTER (fenced) AS n_fenced FROM (SELECT doc_id, f = 1 OR sum(f) OVER (PARTITION BY doc_id ORDER BY i) % 2 = 1 AS fenced FROM (SELECT doc_id, i, CASE WHEN regexp_matches(s, '^[{SP}]*```') THEN 1 ELSE 0 END AS f FROM ({_SPLIT(texts_sql(FENCED))}))) GROUP BY doc_id")
def code_fences(spark, sf_dir):
    rows = C.chapter_fences(texts(spark, sf_dir, FENCED), "doc_id", "text")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("fenced").alias("n_fenced"))


# --- single reading steps --------------------------------------------------------------------------------------------

STEPS = [
    "4.1.2. Tên bài\n3.5 năm\n3.5 Năm mới\n1. x\n 12.3.  ab", "một CEO và R&D ở đây, pr\nCEO AI PR\nB2B F&B&C KPI.", "Mưa lớn -> đường ngập\nNgủ muộn → dẫn đến mệt\n⇒ Kết quả\nXong. => Nghỉ =>\na=>b ➔ vì c",
    "4P và 12Ps, 4Px 4p 100P x4P _4P 0P", "# Chương IV: “x” 3 ", "== TP.HCM A- và 4P ==", "*** Phần XIX. tr. 5 __",
]
_PREFIX = rf"^[{SP}]*[0-9]{{1,3}}(?:\.[0-9]{{1,3}})+(\.[{SP}]*|[{SP}]+)(\p{{L}})"


SECTION_NUMBERS = (
    f"array_to_string(list_transform({LINES('text')}, lambda s: CASE WHEN regexp_matches(s, '{_PREFIX}') AND (regexp_extract(s, '{_PREFIX}', 1) LIKE '.%' OR regexp_matches(regexp_extract(s, '{_PREFIX}', 2), '\\p{{Lu}}')) "
    f"THEN {STRIP(f'''regexp_replace(s, '{_PREFIX}', '\\2')''')} ELSE s END), chr(10))"
)


@query(f"SELECT doc_id, {SECTION_NUMBERS} AS text FROM {texts_sql(STEPS)}")
def section_numbers(spark, sf_dir):
    return texts(spark, sf_dir, STEPS).select("doc_id", G.section_number_lines("text").alias("text"))


_SAID = "map {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in G.PRONUNCIATIONS.items()) + "}"


SPOKEN = f"array_to_string(list_transform({LINES('text')}, lambda s: CASE WHEN {_SHOUTED} THEN s ELSE array_to_string(list_transform(regexp_extract_all(s, '[{A}]+(?:&[{A}]+)*|[^{A}]+'), lambda t: coalesce({_SAID}[t], t)), '') END), chr(10))"


@query(f"SELECT doc_id, {SPOKEN} AS text FROM {texts_sql(STEPS)}")
def spoken_acronyms(spark, sf_dir):
    return texts(spark, sf_dir, STEPS).select("doc_id", G.pronunciations("text").alias("text"))


_JOINS = f"(?i)^[{SP}]*(?:dẫn đến|dẫn tới|từ đó|do đó|vì vậy|vì|mà|và|thì|để|nên|nơi|đồng thời|tức là|nghĩa là|chính là|là|rồi|sau đó)(?:[ ,]|[{SP}]*$)"
_TAIL = r"regexp_replace(a[1], '[ \t,]+$', '')"
_JOINED = (
    f"list_reduce(list_transform(parts, lambda x: [x]), lambda a, b: [CASE WHEN {_TAIL} = '' THEN b[1] WHEN {STRIP('b[1]')} = '' THEN {_TAIL} WHEN regexp_matches({_TAIL}, '[.!?;:]$') THEN {_TAIL} || ' ' || b[1] "
    f"WHEN regexp_matches(b[1], '{_JOINS}') THEN {_TAIL} || ', ' || b[1] ELSE {_TAIL} || ', dẫn tới ' || b[1] END])"
)


def arrows_step(source: str) -> str:
    return (
        f"SELECT doc_id, string_agg(CASE WHEN len(parts) = 1 THEN s ELSE regexp_replace(({_JOINED})[1], '[ ,]+$', '') END, chr(10) ORDER BY i) AS text FROM ("
        f"SELECT doc_id, i, s, string_split_regex(s, '[ \\t]*(?:→|⇒|⟶|➔|➜|=>|[ \\t]->)[ \\t]*') AS parts FROM ({_SPLIT(source)})) GROUP BY doc_id"
    )


@query(arrows_step(texts_sql(STEPS)))
def arrows_read(spark, sf_dir):
    return texts(spark, sf_dir, STEPS).select("doc_id", G.arrows("text").alias("text"))


_TOKENS = lambda x: f"regexp_extract_all({x}, '[{AW}]+|[^{AW}]+')"
_NUMBER = small_sql("regexp_extract(t, '^[0-9]+')::BIGINT")
MARKETING = lambda x: f"array_to_string(list_transform({_TOKENS(x)}, lambda t: CASE WHEN regexp_full_match(t, '[0-9]{{1,2}}Ps?') THEN {_NUMBER} || ' Pê' ELSE t END), '')"


@query(f"SELECT doc_id, {MARKETING('text')} AS text FROM {texts_sql(STEPS)}")
def marketing_letters(spark, sf_dir):
    return texts(spark, sf_dir, STEPS).select("doc_id", G.marketing_p("text").alias("text"))


# --- titles ----------------------------------------------------------------------------------------------------------

TITLES = ["IV", "xx", "XXI", "12", "007", "", None, "  # Một *hai* ", "=== 3. Ba ===", "x", "Nội dung", "Phần mở đầu", "..", "[a](b) c", "Lời tựa", "Introduction", "Mục Lục", "PRIX 2", "3 e édition", "Nội Dung", "1234", "Bìa", "các presses"]
_RAW = STRIP("coalesce(text, '')")
_ROMAN = {k: n for n, k in enumerate("I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX".split(), 1)}
_OF_ROMAN = "map {" + ", ".join(f"'{k}': {n}" for k, n in _ROMAN.items()) + "}"
_NO_PROSE = rf"regexp_matches(text, '^[{SP}]*[0-9$.,ivxlIVXL]{{1,8}}[{SP}]*$') OR regexp_matches(text, '(?i)^[{SP}]*(?:prix|(?:[0-9]+[{SP}]*e[{SP}]*)?édition)(?:[^{AW}]|$)')"
_PLAIN = rf"regexp_replace(regexp_replace(regexp_replace(CASE WHEN {_NO_PROSE} THEN '' ELSE text END, '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '[*_]{{2,}}', '', 'g'), '^[ \t\n\r\f#=*_]+|[ \t\n\r\f#=*_]+$', '', 'g')"
_CLEANED = rf"regexp_replace({STRIP(rf'''regexp_replace({_PLAIN}, '^[^\p{{L}}]+', '')''')}, '[ \t\n\r\f]+', ' ', 'g')"


@query(
    f"SELECT DISTINCT text AS title, CASE WHEN raw = '' THEN 'Chương' WHEN num IS NOT NULL THEN 'Chương ' || {small_sql('num')} WHEN length(regexp_replace({_CLEANED}, '[^\\p{{L}}]', '', 'g')) >= 2 THEN {_CLEANED} ELSE 'Chương' END AS chapter_title FROM "
    f"(SELECT text, {_RAW} AS raw, CASE WHEN regexp_full_match({_RAW}, '[0-9]{{1,3}}') THEN {_RAW}::BIGINT ELSE {_OF_ROMAN}[upper({_RAW})] END AS num FROM (SELECT text FROM {values(TITLES)} UNION ALL SELECT p_name FROM part UNION ALL SELECT n_name FROM nation))"
)
def chapter_titles(spark, sf_dir):
    rows = given(spark, TITLES).select("text").unionAll(table(spark, sf_dir, "part").select("p_name")).unionAll(table(spark, sf_dir, "nation").select("n_name")).distinct()
    return rows.select(F.col("text").alias("title"), K.chapter_title("text").alias("chapter_title"))


_COMPACT = f"regexp_replace(replace(strip_accents(lower(text)), 'đ', 'd'), '[^{A}]', '', 'g')"
_FRONT = "avantpropos|prefacedu|prefacedelouvrage|introduction|introducao|propos|prologue|chung|tong|tonglich|mucluc|muclucchinh|danhmuc|loitua|loidatua|loidanudau|loigioithieu|loicaonhan|loigioithieusach|bia|trangbia|halftitle|phandau|tieude|tacgia|nguoidich|dichgia|baigioithieu|edition|editeur|poeme"
_PRESS = r"éditeur|editeur|imprimerie|librairie|presses|maisons?|saigon|hanoi|\d+\s*''\s*édition|\d+\s*e\s*édition|prix|exemplaires|catalogues?"


@query(
    f"SELECT DISTINCT text AS title, {_COMPACT} <> '' AND (regexp_full_match({_COMPACT}, '{_FRONT}') OR regexp_matches(text, '(?i){_PRESS}')) AS front, {STRIP('text')} IN ('', 'Nội dung', 'Phần mở đầu', 'Nội Dung') AS placeholder, "
    f"CASE WHEN {STRIP(f'''regexp_replace(text, '^[^\\p{{L}}]+', '')''')} IN ('', 'Nội dung', 'Phần mở đầu', 'Nội Dung') THEN 'Kiều' ELSE text END AS renamed FROM (SELECT text FROM {values(TITLES)} WHERE text IS NOT NULL UNION ALL SELECT p_name FROM part UNION ALL SELECT s_name FROM supplier)"
)
def front_matter_titles(spark, sf_dir):
    rows = given(spark, TITLES).filter("text is not null").select("text").unionAll(table(spark, sf_dir, "part").select("p_name")).unionAll(table(spark, sf_dir, "supplier").select("s_name")).distinct()
    return rows.select(F.col("text").alias("title"), W.is_front_matter("text").alias("front"), W.is_placeholder_title("text").alias("placeholder"), W.rename_placeholder("text", F.lit("Kiều")).alias("renamed"))


PRINTED = ["\n \nMỘT HAI\nvăn a\nvăn b", "MỘT. HAI\nx", "Một\nx", "MỘT HAI", "AB\n", "12 A\nx y"]
_LED = f"regexp_replace(text, '^(?:[{SP}]*\\n)+', '')"
_HEAD = STRIP(f"string_split({_LED}, chr(10))[1]")
_GOOD = f"contains({_LED}, chr(10)) AND regexp_full_match({_HEAD}, '[^.\\n]{{1,70}}') AND regexp_full_match(regexp_replace({_HEAD}, '[^\\p{{L}}]', '', 'g'), '\\p{{Lu}}{{2,}}')"


@query(f"SELECT doc_id, CASE WHEN {_GOOD} THEN {_HEAD} ELSE '' END AS title, CASE WHEN {_GOOD} THEN {STRIP(f'''regexp_replace({_LED}, '^[^\\n]*\\n', '')''')} ELSE text END AS body FROM {texts_sql(PRINTED)}")
def printed_titles(spark, sf_dir):
    return texts(spark, sf_dir, PRINTED).select("doc_id", W.printed_title("text").alias("t")).select("doc_id", "t.title", "t.body")


@query("SELECT doc_id, greatest(150, coalesce(TRY_CAST(trim(text) AS INT), 0)) AS floor FROM (SELECT doc_id, n_chars::VARCHAR AS text FROM documents UNION ALL SELECT * FROM (VALUES (-1, '400'), (-2, 'x'), (-3, NULL), (-4, '12')) AS v(doc_id, text))")
def chapter_floors(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("string").alias("text")).unionByName(given(spark, ["400", "x", None, "12"]))
    return rows.select("doc_id", K.effective_min_chapter_words("text").alias("floor"))


# --- sources ---------------------------------------------------------------------------------------------------------


@query(
    "SELECT page_id, CASE WHEN page_id % 3 = 0 AND trim(url) <> '' THEN trim(url) WHEN page_id % 3 = 1 THEN 'catalog:' || page_id ELSE '' END AS source_url, "
    "url || ' (rev ' || page_id || ', ' || (CASE WHEN page_id % 2 = 0 THEN '2024-01-02 03:04:05 UTC' ELSE '?' END) || ', ' || (CASE WHEN page_id % 5 = 0 THEN '?' ELSE 'user' || page_id END) || ')' AS revision FROM pages WHERE url IS NOT NULL"
)
def page_sources(spark, sf_dir):
    i = F.col("page_id")
    rows = table(spark, sf_dir, "pages").filter("url is not null").select(i, "url", F.when(i % 3 == 0, F.concat(F.lit(" "), "url")).otherwise(" ").alias("vi_source_url"), F.when(i % 3 == 1, F.concat(F.lit("catalog:"), i)).alias("source_url"))
    stamp, user = F.when(i % 2 == 0, "2024-01-02T03:04:05Z").otherwise(""), F.when(i % 5 != 0, F.concat(F.lit("user"), i))
    return rows.select("page_id", B.source_url_of(rows).alias("source_url"), B.revision_text(F.col("url"), i, stamp, user).alias("revision"))


CACHED = ["/c/kieu/10-Truyen_Kieu.wikitext", "/c/kieu/2-Đoạn Trường.wikitext", "/c/kieu/1-a.txt", "/c/phu/1_x.html", "/c/phu/note.doc", "/c/phu/0-y.html"]


@query(
    "SELECT slug, path, row_number() OVER (PARTITION BY slug ORDER BY list_transform(regexp_extract_all(path, '[0-9]+'), lambda n: n::BIGINT), path) AS ord FROM (SELECT *, min(rank) OVER (PARTITION BY slug) AS best FROM (SELECT text AS path, regexp_extract(text, '^/c/([^/]+)/', 1) AS slug, "
    f"list_position(['wikitext', 'html', 'txt', 'md', 'epub', 'pdf'], regexp_extract(text, '\\.([^./]+)$', 1)) AS rank FROM {values(CACHED)}) WHERE rank > 0) WHERE rank = best"
)
def cached_sources(spark, sf_dir):
    from pyspark.sql import Window

    rows = given(spark, CACHED).select(F.col("text").alias("path"), S.suffix("text").alias("suffix"))
    found = S.local_sources(rows, F.regexp_extract("path", "^/c/([^/]+)/", 1))
    return found.select("slug", "path", F.row_number().over(Window.partitionBy("slug").orderBy(T.natural_key("path"))).cast("long").alias("ord"))


@query(
    f"SELECT c.path, p.page FROM (SELECT text AS path, regexp_replace(replace(strip_accents(lower(regexp_replace(regexp_extract(text, '([^/]*?)(?:\\.[^./]*)?$', 1), '^[0-9]+[-_]', ''))), 'đ', 'd'), '[^{A}]', '', 'g') AS k FROM {values([*CACHED, '/c/x/3-ALGERIA.txt', '/c/x/unitedstates.md'])}) c "
    f"LEFT JOIN (SELECT n_name AS page, regexp_replace(replace(strip_accents(lower(n_name)), 'đ', 'd'), '[^{A}]', '', 'g') AS k FROM nation UNION ALL SELECT 'Truyện Kiều', 'truyenkieu') p USING (k)"
)
def cached_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "nation").select(F.col("n_name").alias("page")).unionAll(given(spark, ["Truyện Kiều"]).select("text"))
    return S.named_sources(given(spark, [*CACHED, "/c/x/3-ALGERIA.txt", "/c/x/unitedstates.md"]).select(F.col("text").alias("path")), pages).select("path", "page")


@query(
    f"SELECT doc_id, k::INT AS start, 'Mục ' || k AS title, {STRIP('t')} AS text FROM (SELECT doc_id, i // 7 * 7 AS k, string_agg(s, chr(10) ORDER BY i) AS t FROM (SELECT doc_id, s, i - 1 AS i FROM ({_SPLIT('documents')})) GROUP BY ALL) WHERE {WORDS('t')} >= 5"
)
def outline_join(spark, sf_dir):
    """Documents as pages of a line each, joined with outlines of two levels by ranges of pages."""
    pages = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.lines("text")).alias("page", "text"))
    marks = pages.filter("page % 7 in (0, 3)").select("doc_id", "page", F.format_string("Mục %d", "page").alias("title"), F.when(F.col("page") % 7 == 0, 1).otherwise(2).alias("level"))
    return S.outline_rows(marks, pages)


# --- rights ----------------------------------------------------------------------------------------------------------

ENTRY = "slug string, title string, author string, translator string, license string, license_url string, rights_note string, source_url string, author_death_year int, author_dates string, notes string"
ENTRIES = [
    ("src0", "Truyện Kiều", "Nguyễn Du", "", "public-domain", "u", "n", "s", None, "1765–1820", ""), ("src1", "A", "Ngô Tất Tố", "", "Public Domain", "u", "n", "s", None, "1894–1954", ""),
    ("src2", "B", "X", "", "public-domain", "u", "n", "s", None, "", "the author died 1960"), ("src3", "C", "Y", "Mary Shelley", "CC0", "", " ", "s", None, "", ""),
    ("src4", "D", "Z", "", "all rights reserved", "u", "n", "s", None, "", ""), ("src5", "", "W", "", "", "u", "n", "s", None, "", ""),
    ("src6", "E", "V", "", "public domain", "u", "n", "s", 1900, "", ""), ("src7", "F", "U", "", "pdm", "u", "n", "s", None, "1900 - 1970", "(1850-1890)"),
    ("none1", "G", "T", "", "cc0", "u", "n", "s", None, "", ""), ("none2", "H", "S", "", "unknown", "u", "n", "s", None, "", "(1850–1890)"),
]
_COLUMNS = [x.split()[0] for x in ENTRY.split(", ")]
ENTRY_ROWS = "(VALUES " + ", ".join("(" + ", ".join(quoted(x) if isinstance(x, str) or x is None else str(x) for x in e) + ")" for e in ENTRIES) + f") AS e({', '.join(_COLUMNS)})"
_PROSE = "SELECT source AS slug, sum(strlen(text))::BIGINT AS prose_bytes, count(*) AS text_files FROM documents GROUP BY source"
FREE = "lower(trim(license)) IN ('cc0', 'public-domain', 'public domain', 'pdm')"
_DOMAIN = "lower(trim(license)) IN ('public-domain', 'public domain', 'pdm')"
_DIED = (
    "coalesce(author_death_year, CASE WHEN regexp_matches(author_dates, '(?:1[6-9]\\d\\d|20[0-2]\\d)\\s*[–\\-—]') THEN list_last(regexp_extract_all(author_dates, '1[0-9]{3}|20[0-2][0-9]'))::INT END, "
    "nullif(regexp_extract(notes, '(?i)(?:d\\.?|died|mất)\\s*(1[6-9]\\d\\d|20[0-2]\\d)', 1), '')::INT, nullif(regexp_extract(notes, '\\(1[6-9]\\d\\d\\s*[–\\-—]\\s*(1[6-9]\\d\\d|20[0-2]\\d)\\)', 1), '')::INT)"
)
_NAMES = "lower(slug || ' ' || title || ' ' || author || ' ' || translator || ' ' || source_url)"
_MISSING = ", ".join(f"CASE WHEN trim({c}) = '' THEN 'missing:{c}' END" for c in ("slug", "title", "author", "license", "license_url", "rights_note"))
_FOUND = (
    f"list_filter([{_MISSING}, CASE WHEN license <> '' AND NOT {FREE} THEN 'licence:' || license END, CASE WHEN contains({_NAMES}, 'ngô tất tố') THEN 'denied:ngô tất tố' END, CASE WHEN contains({_NAMES}, 'mary shelley') THEN 'denied:mary shelley' END, "
    f"CASE WHEN {_DOMAIN} AND {_DIED} IS NULL THEN 'no-death-year' END, CASE WHEN {_DOMAIN} AND {_DIED} > 1955 THEN 'died:' || {_DIED} END, CASE WHEN NOT {FREE} AND prose_bytes > 0 THEN 'prose-without-licence' END, CASE WHEN text_files = 0 THEN 'no-text-files' END], lambda x: x IS NOT NULL)"
)
_BOOKS = f"SELECT e.*, coalesce(prose_bytes, 0) AS prose_bytes, coalesce(text_files, 0) AS text_files FROM {ENTRY_ROWS} LEFT JOIN ({_PROSE}) p USING (slug)"


def _found_problems(spark, sf_dir) -> DataFrame:
    prose = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("slug")).agg(F.sum(F.octet_length("text")).alias("prose_bytes"), F.count(F.lit(1)).alias("text_files"))
    rows = spark.createDataFrame(ENTRIES, ENTRY).join(prose, "slug", "left").fillna(0, ["prose_bytes", "text_files"])
    book = {c: F.col(c) for c in _COLUMNS} | {"blob": F.col("notes")}
    return rows.select("slug", R.problems(book, F.col("prose_bytes"), F.col("text_files")).alias("problems"))


@query(f"SELECT slug, array_to_string({_FOUND}, ';') AS problems FROM ({_BOOKS})")
def rights_problems(spark, sf_dir):
    return _found_problems(spark, sf_dir).select("slug", F.array_join("problems", ";").alias("problems"))


@query(f"SELECT count(*) AS books_scanned, sum(len({_FOUND}))::BIGINT AS n_problems, sum(len({_FOUND})) = 0 AS ok FROM ({_BOOKS})")
def rights_summary(spark, sf_dir):
    return R.rights_report(_found_problems(spark, sf_dir))


# --- books -----------------------------------------------------------------------------------------------------------

#: Chapters of books, a book a source: the rendered chapters of the documents, in their order.
_CHAPTERS = RENDERED + (
    f", n AS (SELECT d.source AS slug, row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id)::INT AS index, m.title, m.markdown, {WORDS('m.markdown')}::INT AS word_count FROM m JOIN documents d ON m.slug = 'd' || d.doc_id), "
    "b AS (SELECT n.*, 'chuong-' || lpad(n.index::VARCHAR, greatest(2, length(n.index::VARCHAR))::INT, '0') AS chapter_slug FROM n) "
)


def book_sections(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("slug"), F.col("doc_id").alias("pos"), F.concat(F.lit("Chương "), "lang").alias("title"), "text")


@query(_CHAPTERS.replace(", b AS (SELECT doc_id, string_agg(para", ", y AS (SELECT doc_id, string_agg(para").replace("LEFT JOIN b USING (doc_id)", "LEFT JOIN y USING (doc_id)") + f"SELECT e.slug, CASE WHEN {_DOMAIN} THEN 'public-domain' ELSE 'cc0' END AS license, 'books/' || e.slug || '/text/' || e.slug || '.md' AS text_path, 'extracted' AS status, b.index, b.chapter_slug, b.title, 'books/' || e.slug || '/text/' || b.chapter_slug || '.md' AS source_path, b.word_count, sum(b.word_count) OVER (PARTITION BY e.slug)::BIGINT AS total_words FROM (SELECT * FROM {ENTRY_ROWS} WHERE {FREE}) e JOIN b ON b.slug = e.slug")
def book_records(spark, sf_dir):
    """Catalog entries with an allowed licence joined with their chapters; one row per chapter of each record."""
    books = B.assemble_books(spark.createDataFrame(ENTRIES, ENTRY), book_sections(spark, sf_dir))
    rows = books.select("slug", "license", "text_path", "status", "total_words", F.explode("chapters").alias("c"))
    return rows.select("slug", "license", "text_path", "status", "c.index", F.col("c.slug").alias("chapter_slug"), "c.title", "c.source_path", "c.word_count", "total_words")


@query(_CHAPTERS.replace(", b AS (SELECT doc_id, string_agg(para", ", y AS (SELECT doc_id, string_agg(para").replace("LEFT JOIN b USING (doc_id)", "LEFT JOIN y USING (doc_id)") + "SELECT slug, sha256(string_agg(regexp_replace(markdown, '^\\n+|\\n+$', '', 'g'), chr(10) || chr(10) ORDER BY index) || chr(10)) AS whole, count(*) AS n FROM b GROUP BY slug")
def whole_books(spark, sf_dir):
    """Each book's chapters joined in order, as a digest."""
    rows = B.chapters_of(book_sections(spark, sf_dir)).withColumn("index", F.col("index").cast("int"))
    counts = rows.groupBy("slug").agg(F.count(F.lit(1)).alias("n"))
    return K.assembled(rows, "slug", "index", "markdown").select("slug", F.sha2("text", 256).alias("whole")).join(counts, "slug")


@query(f"SELECT slug, title, author, lower(license) AS license, {len(ENTRIES)} - row_number() OVER (ORDER BY slug DESC) + 1 AS ord FROM {ENTRY_ROWS}")
def book_round_trip(spark, sf_dir):
    """Records written as JSON and read back, in order of their slugs."""
    from pyspark.sql import Window

    rows = spark.createDataFrame(ENTRIES, ENTRY).withColumn("license", F.lower("license"))
    back = B.parse_books(B.book_json(rows), extended=True)
    return back.select("slug", "title", "author", "license", F.row_number().over(Window.orderBy("slug")).cast("long").alias("ord"))


# --- corpus checks ---------------------------------------------------------------------------------------------------

_FAULTY = (
    "SELECT 'd' || (doc_id % 40) AS slug, doc_id, CASE WHEN doc_id % 11 = 0 THEN 'Phần ' || (doc_id % 7) WHEN doc_id % 13 = 0 THEN 'Lời tựa' WHEN doc_id % 17 = 0 THEN '12' ELSE 'Chương ' || doc_id END AS title, "
    f"'# ' || (CASE WHEN doc_id % 19 = 0 THEN 'X' ELSE '' END) || (CASE WHEN doc_id % 11 = 0 THEN 'Phần ' || (doc_id % 7) WHEN doc_id % 13 = 0 THEN 'Lời tựa' WHEN doc_id % 17 = 0 THEN '12' ELSE 'Chương ' || doc_id END) || chr(10) || chr(10) || text || chr(10) AS markdown FROM documents"
)
_BODY = f"list_filter({LINES('markdown')}, lambda z: {STRIP('z')} <> '' AND z NOT LIKE '#%')"
_FORBID = (
    r"(?m)(?:<[a-zA-Z/!][^>]*>|!\[[^\]]*\]\([^)]*\)|\[[^\]]*\]\([^)]*\)|^\s*\|.*\|\s*$|\[\^[^\]]+\]|\{\{.*?\}\}|\[\[.*?\]\]"
    r"|[*_]{1,3}[^*_]+[*_]{1,3}|<ref.*?>|</ref>)"
)
_OWN = {
    "one-heading": "CASE WHEN heads <> 1 OR regexp_matches(markdown, '(?m)^#{2,}') THEN heads::VARCHAR END",
    "blank-lines": "CASE WHEN regexp_matches(markdown, '\\n\\n\\n|^\\n|[ \\t]+(?:\\n|$)|\\n\\n$|[^\\n]$') THEN '' END",
    "forbidden-markup": f"nullif(regexp_extract(array_to_string(body, chr(10)), {quoted(_FORBID)}), '')",
    "two-sentences": f"list_filter(body, lambda p: len({GLUE}) > 1)[1]",
    "heading-is-title": "CASE WHEN string_split(markdown, chr(10))[1] <> '# ' || title THEN title END",
    "word-drift": "CASE WHEN abs(words - word_count) > 2 THEN words::VARCHAR END",
    "body-lines": "CASE WHEN len(body) < 3 THEN len(body)::VARCHAR END",
    "front-matter": "CASE WHEN title = 'Lời tựa' THEN title END",
    "junk-title": "CASE WHEN title = '12' THEN title END",
}
_PART = "nullif(regexp_extract(title, '^Phần ([0-9]+)', 1), '')::INT"
_WITHIN = {
    "contiguous": "CASE WHEN index <> row_number() OVER o THEN (row_number() OVER o)::VARCHAR END",
    "floor": "CASE WHEN count(*) OVER b > 1 AND word_count < 150 THEN word_count::VARCHAR END",
    "unique-paths": "CASE WHEN row_number() OVER (PARTITION BY slug, source_path ORDER BY index) = 2 THEN source_path END",
    "duplicate-title": "CASE WHEN row_number() OVER (PARTITION BY slug, title ORDER BY index) = 2 THEN title END",
    "part-numbers": f"CASE WHEN {_PART} <= last_value({_PART} IGNORE NULLS) OVER (PARTITION BY slug ORDER BY index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN {_PART}::VARCHAR END",
    "runt": "CASE WHEN count(*) OVER b > 1 AND index = max(index) OVER b AND word_count < 0.25 * median(word_count) OVER b THEN word_count::VARCHAR END",
    "total-words": "CASE WHEN index = max(index) OVER b AND sum(word_count) OVER b <= 200 THEN (sum(word_count) OVER b)::VARCHAR END",
}
_RULES = {**_OWN, **_WITHIN}


@query(
    f"WITH f AS ({_FAULTY}), c AS (SELECT slug, (row_number() OVER (PARTITION BY slug ORDER BY doc_id) + CASE WHEN doc_id % 23 = 0 THEN 100000 ELSE 0 END)::INT AS index, title, 'p' || (doc_id % 997) AS source_path, markdown, ({WORDS('markdown')} + doc_id % 4)::INT AS word_count FROM f), "
    f"g AS (SELECT *, {WORDS('markdown')}::INT AS words, len(list_filter({LINES('markdown')}, lambda z: z LIKE '# %')) AS heads, {_BODY} AS body FROM c), "
    f"r AS (SELECT slug, index, unnest([{', '.join(f'''{{'rule': '{k}', 'detail': {v}}}''' for k, v in _RULES.items())}]) AS v FROM g WINDOW b AS (PARTITION BY slug), o AS (PARTITION BY slug ORDER BY index)) "
    "SELECT slug, index, v.rule AS rule, v.detail AS detail FROM r WHERE v.detail IS NOT NULL"
)
def faulty_books(spark, sf_dir):
    """All chapter rules but two over books made of raw documents, with headings, titles, paths and counts that are
    wrong in places; furniture and glued words have queries of their own."""
    from pyspark.sql import Window

    i = F.col("doc_id")
    title = F.when(i % 11 == 0, F.concat(F.lit("Phần "), i % 7)).when(i % 13 == 0, "Lời tựa").when(i % 17 == 0, "12").otherwise(F.concat(F.lit("Chương "), i))
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), i % 40).alias("slug"), i, title.alias("title"), "text")
    markdown = F.concat(F.lit("# "), F.when(i % 19 == 0, "X").otherwise(""), "title", F.lit("\n\n"), "text", F.lit("\n"))
    index = F.row_number().over(Window.partitionBy("slug").orderBy("doc_id")) + F.when(i % 23 == 0, 100000).otherwise(0)
    ch = rows.select("slug", index.cast("int").alias("index"), "title", F.concat(F.lit("p"), i % 997).alias("source_path"), markdown.alias("markdown"), i)
    ch = ch.withColumn("word_count", (T.count_words("markdown") + i % 4).cast("int"))
    return Q.violations(ch).filter(~F.col("rule").isin("furniture", "glued-words"))


_ALL_RULES = ", ".join(f"{{'rule': '{k}', 'detail': {v}}}" for k, v in {**_RULES, "furniture": f"list_filter(body, lambda s: {FURNITURE_SQL})[1]", "glued-words": f"nullif(regexp_extract(markdown, {quoted('|'.join(sorted(GLUED, key=len, reverse=True)))}), '')"}.items())
SQL["corpus_violations"] = (
    f"{RENDERED}, c AS (SELECT slug, index, title, source_path, markdown, {WORDS('markdown')}::INT AS word_count FROM m), "
    f"g AS (SELECT *, word_count AS words, len(list_filter({LINES('markdown')}, lambda z: z LIKE '# %')) AS heads, {_BODY} AS body FROM c), "
    f"v AS (SELECT slug, index, unnest([{_ALL_RULES}]) AS v FROM g WINDOW b AS (PARTITION BY slug), o AS (PARTITION BY slug ORDER BY index)) SELECT slug, index, v.rule AS rule, v.detail AS detail FROM v WHERE v.detail IS NOT NULL"
).replace(", c AS (SELECT slug", ", ch AS (SELECT slug").replace("AS body FROM c)", "AS body FROM ch)")


_CHECKED = [("src0", "public-domain", 500, "off", "extracted"), ("src1", "cc0", 50, "command", "blocked-no-vi-source"), ("src2", "cc0", 0, "gloss", "extracted"), ("zzz", "cc0", 0, "http", "blocked-no-vi-source")]
_CHECKED_ROWS = "(VALUES " + ", ".join("(" + ", ".join(quoted(x) if isinstance(x, str) else str(x) for x in e) + ")" for e in _CHECKED) + ") AS k(slug, license, expect_chapters, translate_mode, status)"
_COUNTS = "SELECT source AS slug, count(*) AS have FROM documents GROUP BY source"


@query(
    f"SELECT slug, 0 AS index, 'chapter-count' AS rule, coalesce(have, 0)::VARCHAR AS detail FROM {_CHECKED_ROWS} LEFT JOIN ({_COUNTS}) USING (slug) WHERE expect_chapters <> coalesce(have, 0) "
    f"UNION ALL SELECT slug, 0, 'blocked-text', status FROM {_CHECKED_ROWS} SEMI JOIN ({_COUNTS}) USING (slug) WHERE status LIKE 'blocked%' UNION ALL SELECT slug, 0, 'machine-translated', translate_mode FROM {_CHECKED_ROWS} WHERE translate_mode IN ('command', 'http') "
    f"UNION ALL SELECT k.slug, 0, 'provenance', 'license' FROM {_CHECKED_ROWS} JOIN {ENTRY_ROWS} ON k.slug = e.slug WHERE k.license <> e.license "
    "UNION ALL SELECT source, 0, 'whole-is-parts', '' FROM (SELECT source, string_agg(regexp_replace(text, '^\\n+|\\n+$', '', 'g'), chr(10) || chr(10) ORDER BY doc_id) || chr(10) AS t FROM documents GROUP BY source) WHERE length(t) % 2 = 0"
)
def book_checks(spark, sf_dir):
    books = spark.createDataFrame(_CHECKED, "slug string, license string, expect_chapters int, translate_mode string, status string")
    ch = table(spark, sf_dir, "documents").select(F.col("source").alias("slug"), F.col("doc_id").alias("index"), F.col("text").alias("markdown"))
    # wholes of an even length get a letter that their parts don't have
    whole = K.assembled(ch, "slug", "index", "markdown")
    whole = whole.withColumn("text", F.when(F.length("text") % 2 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    catalog = spark.createDataFrame(ENTRIES, ENTRY).select("slug", "license")
    found = [Q.chapter_count(books, ch), Q.blocked_have_no_text(books, ch), Q.machine_translated(books), Q.provenance(books, catalog, ["license"]), Q.whole_is_parts(whole, ch)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


# --- SQL of folds and of whole chains of steps -------------------------------------------------------------------------


def step_ctes(source: str, *steps: str) -> str:
    """CTEs s0, s1, ...: each step is an expression over ``text``, or a whole SELECT over {prev}."""
    out, prev = [f"s0 AS (SELECT doc_id, text FROM {source})"], "s0"
    for n, step in enumerate(steps, 1):
        out.append(f"s{n} AS (" + (step.replace("{prev}", prev) if step.startswith("SELECT") else f"SELECT doc_id, {step} AS text FROM {prev}") + ")")
        prev = f"s{n}"
    return ", ".join(out)


_ALONE = (
    f"({_HEADED.replace('(s,', '(r,')}) OR regexp_matches(r, '(?i)^\\s*(?:pagebreak|page break|-{{4,}}|={{4,}})\\s*$') "
    f"OR (length({STRIP('r')}) <= 70 AND {WORDS('r')} <= 8 AND {CHAPTER_LINE.replace('(s,', f'({STRIP(chr(114))},')})"
)
_UNDERLINE = "regexp_matches(r, '^(?:={3,}|-{3,}|~{3,}|\\*{3,}|_{3,})\\s*$')"
_KIND = (
    f"CASE WHEN {STRIP('r')} = '' THEN 'blank' WHEN {_ALONE} THEN 'alone' WHEN {STRIP("coalesce(before, '')")} <> '' AND {_UNDERLINE} THEN 'underline' "
    f"WHEN regexp_matches(r, {quoted(r"""[.!?…]["'”’»)\]]*$""")}) THEN 'end' ELSE 'open' END"
)
#: Paragraphs as islands of lines: one goes on after an open line, unless a title, a line over an underline, is there.
UNWRAPPED = (
    f"SELECT doc_id, regexp_replace(string_agg(para, chr(10) ORDER BY g), '^\\n+|\\n+$', '', 'g') AS text FROM ("
    "SELECT *, lag(para) OVER (PARTITION BY doc_id ORDER BY g) AS last FROM ("
    f"SELECT doc_id, g, string_agg({STRIP('r')}, ' ' ORDER BY i) AS para FROM ("
    "SELECT *, sum(CASE WHEN kind IN ('open', 'end') AND last = 'open' AND NOT titled AND NOT after_title THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM ("
    "SELECT *, coalesce(lag(titled) OVER (PARTITION BY doc_id ORDER BY i), false) AS after_title FROM ("
    "SELECT *, coalesce(kind = 'open' AND lead(kind) OVER w = 'underline', false) AS titled, coalesce(lag(kind) OVER w, '') AS last FROM ("
    f"SELECT *, {_KIND} AS kind FROM (SELECT doc_id, i, regexp_replace(s, '[{SP}]+$', '') AS r, lag(s) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM ({_SPLIT('{prev}')}))"
    ") WINDOW w AS (PARTITION BY doc_id ORDER BY i))) ) WHERE kind <> 'underline' GROUP BY doc_id, g)) "
    "WHERE NOT (para = '' AND coalesce(last, 'x') = '') GROUP BY doc_id"
)
HYPHENS = f"regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '([{AW}])-\\n[ \\t]*([a-zà-ỹ])', '\\1\\2', 'g')"


def chain(source: str, *steps: str, final: str = "SELECT doc_id, text FROM {last}") -> str:
    return "WITH " + step_ctes(source, *steps) + " " + final.replace("{last}", f"s{len(steps)}")


WRAPPED = ["Một dòng\ntiếp theo. \nHai\n\n\nChương 2\nba chuyến-\ntàu đi.\nTựa\n===\nx", "a b\nc d\n---\nMột câu.\n=====\n\n# x\ny \n z"]
SQL["wrapped_lines"] = chain(texts_sql(WRAPPED), HYPHENS, UNWRAPPED)
_GUTTERS = lambda x: f"regexp_replace({x}, '([^{SP}0-9])[ \\t]{{2,}}([^{SP}])', '\\1 \\2', 'g')"
_LAYOUT = f"array_to_string(list_transform({LINES('text')}, lambda s: regexp_replace(s, '[{SP}]+$', '')), chr(10))"
_LABELS = f"array_to_string(list_transform(list_filter({LINES("replace(text, chr(12), chr(10) || chr(10))")}, lambda s: NOT regexp_full_match({STRIP('s')}, '(?i)(?:đ[èe]o trang[ \\t]+[0-9]+|trang[ \\t]+[0-9]+|[0-9]+)')), lambda s: regexp_replace(s, '[{SP}]+$', '')), chr(10))"
_NUMBERED = f"regexp_matches(s, '(?i)^[{SP}]*(?:trang[{SP}]+|page[{SP}]+)?[-–—]?[{SP}]*[0-9]{{1,4}}[{SP}]*[-–—]?[{SP}]*$')"
_RUNNING = f"CASE WHEN length({STRIP('s')}) BETWEEN 1 AND 80 AND {WORDS('s')} <= 8 AND NOT regexp_matches({STRIP('s')}, {quoted(r"""[.!?…,:;"'”’»)\]}]$""")}) THEN {STRIP('s')} END"
NO_PAGES = (
    f"SELECT o.doc_id, coalesce(string_agg(s, chr(10) ORDER BY i) FILTER (n < 5), '') AS text FROM {{prev}} o LEFT JOIN (SELECT *, CASE WHEN h IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY doc_id, h) END AS n FROM ("
    f"SELECT doc_id, s, i, {_RUNNING} AS h FROM ({_SPLIT('{prev}')}) WHERE NOT {_NUMBERED})) USING (doc_id) GROUP BY o.doc_id"
)
PDFS = ["Cột một    cột hai\n\f12\nTrang 3\nđèo trang 4\nmột câu\ndài. 5    6\nĐầu\na.\nĐầu\nb.\nĐầu\nc.\nĐầu\nd.\nĐầu\ne."]
SQL["pdf_cleaned"] = chain(texts_sql(PDFS), _GUTTERS(_GUTTERS(_LAYOUT)), _LABELS, NO_PAGES, HYPHENS, UNWRAPPED, f"SELECT doc_id, {SANITIZED} AS text FROM {{prev}}")

ROMAN_STEP = (
    f"SELECT doc_id, array_to_string(list_transform(range(1, len(p) + 1), lambda i: p[i] || CASE WHEN i = len(p) THEN '' WHEN (i + 1 = len(p) AND p[i + 1] = '' OR regexp_matches(p[i + 1], '^[{SP}.,:;)\\]!?]')) AND {roman_sql('r[i]')} BETWEEN 1 AND 20 "
    f"THEN h[i] || ' ' || {UP_TO_20}[{roman_sql('r[i]')}] ELSE m[i] END), '') AS text FROM (SELECT doc_id, string_split_regex(text, '{HEADED}') AS p, regexp_extract_all(text, '{HEADED}', 0) AS m, regexp_extract_all(text, '{HEADED}', 1) AS h, regexp_extract_all(text, '{HEADED}', 2) AS r FROM {{prev}})"
)
SIGNS = rf"regexp_replace(regexp_replace(text, '(^|[^{AW}])([A-Z])-([{SP},.;:!?)\]→]|$)', '\1\2 trừ\3', 'g'), '(^|[^{AW}])([A-Z])\+([{SP},.;:!?)\]→]|$)', '\1\2 cộng\3', 'g')"
MARKS = "regexp_replace(translate(regexp_replace(coalesce(text, ''), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f\\x{200b}-\\x{200d}\\x{2060}\\x{feff}]', '', 'g'), '\"“”„‟', ''), '[ \\t]{2,}', ' ', 'g')"
_ENDS = STRIP(f"regexp_replace({SQUEEZE}, '^[{SP}#=*_]+|[{SP}#=*_]+$', '', 'g')")
SQL["reading_titles"] = chain(f"(SELECT p_partkey AS doc_id, p_name AS text FROM part UNION ALL SELECT * FROM {values(READINGS)})", MARKS, ABBREVIATED, ROMAN_STEP, SIGNS, MARKETING("text"), _ENDS, final="SELECT doc_id, text AS title FROM {last}")
