"""Licence gate, denied authors and the arithmetic of public-domain claims, as columns and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions.text import col, strip

# Fixed values.
ALLOWED = ["cc-by-4.0", "cc-by-sa-4.0", "cc0", "public-domain"]
ALIASES = {
    "public domain": "public-domain", "publicdomain": "public-domain", "public-domain/traditional": "public-domain",
    "pdm": "public-domain", "cc0": "cc0", "cc-0": "cc0", "cc0-1.0": "cc0", "cc by 4.0": "cc-by-4.0", "cc-by-4.0": "cc-by-4.0",
    "cc by sa 4.0": "cc-by-sa-4.0", "cc-by-sa-4.0": "cc-by-sa-4.0", "ccbysa-4.0": "cc-by-sa-4.0",
}
LATEST_SAFE_DEATH_YEAR = 1955
REQUIRED = ["slug", "title", "author", "license", "license_url", "rights_note"]
DENIED = [
    "lewis carroll", "arthur conan doyle", "jules verne", "robert louis stevenson", "charles dickens", "h. g. wells",
    "h.g. wells", "herbert schildt", "mark allen weiss", "barbara liscov", "clifford s. clifton", "thomas h. cormen",
    "leislie lamport", "ronald l. rivest", "ngo tat to", "ngô tất tố", "bruce eckels", "rudyard kipling", "mary shelley",
]
DEATH_YEARS = {
    "Nguyễn Du": (1765, 1820), "Nguyễn Trãi": (1380, 1442), "Đặng Trần Côn": (1712, 1780), "Trương Vĩnh Ký": (1837, 1898),
    "Phan Phu Tiên": (1712, 1780), "Đoàn Thị Điểm": (1747, 1823),
}
YEAR = r"1[6-9]\d\d|20[0-2]\d"


class RightsError(ValueError):
    """A single item's licence forbids its use."""


def normalize_license(c: Column | str) -> Column:
    """Canonical lower-case licence; unknown ones are only lower-cased, blank and null are empty."""
    key = F.replace(F.replace(F.lower(strip(F.coalesce(col(c), F.lit("")))), F.lit("_"), F.lit(" ")), F.lit("  "), F.lit(" "))
    known = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, key), key)


def is_allowed(c: Column | str) -> Column:
    return normalize_license(c).isin(ALLOWED)


def license_problem(c: Column | str) -> Column:
    """Why a licence is refused, null where it is not."""
    canonical = normalize_license(c)
    return F.when(canonical == "", "no licence declared").when(~canonical.isin(ALLOWED), F.concat(F.lit("licence "), canonical, F.lit(" is not redistributable")))


def require_license(c: Column | str) -> Column:
    """The canonical licence; a refused one fails the job, for use on single items."""
    return F.when(is_allowed(c), normalize_license(c)).otherwise(F.raise_error(F.concat(F.lit("RightsError: "), license_problem(c))))


def check_license(license_id: str | None) -> str:
    """The same gate on the driver, before anything is read."""
    key = (license_id or "").strip().lower().replace("_", " ").replace("  ", " ")
    canonical = ALIASES.get(key, key)
    if canonical not in ALLOWED:
        raise RightsError(f"licence {license_id!r} is not redistributable; allowed: {', '.join(ALLOWED)}" if canonical else "no licence declared")
    return canonical


def allowed_only(df: DataFrame, column: str = "license") -> DataFrame:
    """Rows that pass the gate; put it before the scan of their sources."""
    return df.filter(is_allowed(column))


def blocked_only(df: DataFrame, column: str = "license") -> DataFrame:
    return df.filter(~is_allowed(column))


def denied_patterns(*columns: Column | str) -> Column:
    """The denied names that occur in any of the columns."""
    said = F.lower(F.concat_ws(" ", *[F.coalesce(col(c), F.lit("")) for c in columns]))
    return F.filter(F.array(*map(F.lit, DENIED)), lambda p: F.contains(said, p))


def missing_fields(columns: dict[str, Column]) -> Column:
    """Names of required fields that are blank."""
    blank = [F.when(strip(F.coalesce(columns[k], F.lit(""))) == "", F.lit(k)) for k in REQUIRED if k in columns]
    return F.array_compact(F.array(*blank))


def last_year(c: Column | str) -> Column:
    """The last year from 1000 to 2029 in a text, null if there is none."""
    found = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"(?<![\p{L}\p{N}_])(1[0-9]{3}|20[0-2][0-9])(?![\p{L}\p{N}_])"), F.lit(1))
    return F.try_element_at(found, F.lit(-1)).cast("int")


def death_year(declared: Column, dates: Column, blob: Column) -> Column:
    """The declared year, else the last year of a range of dates, else what prose says: d. 1945, (1894-1945)."""
    said = lambda pattern: F.nullif(F.regexp_extract(F.coalesce(blob, F.lit("")), pattern, 1), F.lit("")).cast("int")
    ranged = F.when(F.coalesce(dates, F.lit("")).rlike(rf"(?:{YEAR})\s*[–\-—]"), last_year(dates))
    return F.coalesce(declared.cast("int"), ranged, said(rf"(?iu)(?:d\.?|died|mất)\s*({YEAR})"), said(rf"\(1[6-9]\d\d\s*[–\-—]\s*({YEAR})\)"))


def resolved_death_year(books: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """books(author, source_author, author_death_year, author_dates, ...) with death_year and mismatch.

    Declared years from 1600 come first; then the table of verified years, where the author that the source names
    wins over the catalog's. The table is a constant of a few rows, so it is broadcast."""
    spark = books.sparkSession
    if table is None:
        table = spark.createDataFrame([(k, b, d) for k, (b, d) in DEATH_YEARS.items()], "name string, born int, died int")
    years = lambda side: F.broadcast(table.select(F.col("name").alias(side), F.col("died").alias(f"died_{side}")))
    found = books.join(years("source_author"), "source_author", "left").join(years("author"), "author", "left")
    same = lambda c: F.regexp_replace(F.trim(F.lower(F.coalesce(c, F.lit("")))), r"\s+", " ")
    declared = F.coalesce(F.col("author_death_year").cast("int"), F.when(last_year("author_dates") >= 1600, last_year("author_dates")))
    mismatch = declared.isNull() & F.col("died_source_author").isNotNull() & (same(F.col("source_author")) != same(F.col("author")))
    year = F.coalesce(declared, F.when(mismatch, F.col("died_source_author")), F.col("died_author"), F.col("died_source_author"))
    return found.withColumns({"death_year": year, "mismatch": mismatch}).drop("died_source_author", "died_author")


def problems(book: dict[str, Column], prose_bytes: Column, text_files: Column) -> Column:
    """All rights problems of a book record, as an array of codes with details."""
    get = lambda k: F.coalesce(book.get(k, F.lit("")), F.lit(""))
    lic = strip(get("license"))
    year = death_year(book.get("author_death_year", F.lit(None)), get("author_dates"), get("blob"))
    domain = normalize_license(get("license")) == "public-domain"
    found = [
        F.transform(missing_fields(book), lambda f: F.concat(F.lit("missing:"), f)),
        F.array(F.when((lic != "") & ~is_allowed(lic), F.concat(F.lit("licence:"), lic))),
        F.transform(denied_patterns(*[get(k) for k in ("slug", "title", "author", "translator", "source_url")]), lambda p: F.concat(F.lit("denied:"), p)),
        F.array(F.when(domain & year.isNull(), F.lit("no-death-year"))),
        F.array(F.when(domain & (year > LATEST_SAFE_DEATH_YEAR), F.concat(F.lit("died:"), year.cast("string")))),
        F.array(F.when(~is_allowed(lic) & (prose_bytes > 0), F.lit("prose-without-licence"))),
        F.array(F.when(text_files == 0, F.lit("no-text-files"))),
    ]
    return F.array_compact(F.concat(*found))


def rights_report(problem_rows: DataFrame) -> DataFrame:
    """books_scanned, problems and ok over rows(slug, problems)."""
    return problem_rows.agg(
        F.count(F.lit(1)).alias("books_scanned"),
        F.sum(F.size("problems")).alias("n_problems"),
        (F.coalesce(F.sum(F.size("problems")), F.lit(0)) == 0).alias("ok"),
    )


