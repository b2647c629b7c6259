"""Text and bookmarks of PDF files, through whichever reader is at hand: pdftotext on the path, else PyMuPDF."""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

TIMEOUT = 300
PAGES = "path string, pages array<string>, outline array<struct<page: int, title: string, level: int>>, error string"


def pdftotext_available() -> bool:
    return shutil.which("pdftotext") is not None


def _mupdf():
    try:
        import pymupdf
    except ImportError:
        try:
            import fitz as pymupdf
        except ImportError:
            return None
    return pymupdf


def page_texts(raw: bytes) -> list[str]:
    """The text of each page, in layout order; without a reader, an error that says so."""
    if pdftotext_available():
        with tempfile.NamedTemporaryFile(suffix=".pdf") as f:  # read by the program, gone with the call
            f.write(raw)
            f.flush()
            done = subprocess.run(["pdftotext", "-layout", "-enc", "UTF-8", "-q", f.name, "-"], capture_output=True, timeout=TIMEOUT, check=True)
        pages = done.stdout.decode("utf-8", "replace").split("\f")
        return pages[:-1] if pages and not pages[-1].strip() else pages
    if (reader := _mupdf()) is not None:
        with reader.open(stream=raw, filetype="pdf") as doc:
            return [page.get_text() for page in doc]
    raise RuntimeError("no PDF reader: put pdftotext on the path or install PyMuPDF")


def bookmarks(raw: bytes) -> list[tuple[int, str, int]]:
    """(page from 0, title, level); none without PyMuPDF or where the file's own table can't be read."""
    if (reader := _mupdf()) is None:
        return []
    try:
        with reader.open(stream=raw, filetype="pdf") as doc:
            return [(page - 1, title.strip(), level) for level, title, page, *_ in doc.get_toc() if page >= 1 and title.strip()]
    except Exception:  # noqa: BLE001  a broken table of contents is no reason to lose the text
        return []


def read_pdfs(files: DataFrame) -> DataFrame:
    """files(path, content) to rows of PAGES; a file that can't be read is a row with its error."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                raw = bytes(content or b"")
                try:
                    marks = [{"page": p, "title": t, "level": n} for p, t, n in bookmarks(raw)]
                    rows.append((path, page_texts(raw), marks, None))
                except (RuntimeError, OSError, subprocess.SubprocessError) as e:
                    rows.append((path, [], [], f"{os.path.basename(path)}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "pages", "outline", "error"])

    return files.select("path", "content").mapInPandas(over, PAGES)
