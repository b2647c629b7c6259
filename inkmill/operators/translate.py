"""Translation engines as column functions, batching on paragraphs, and whole documents."""

from __future__ import annotations

import json
import shlex
import subprocess
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions.text import col, squeeze_spaces, strip, strip_control
from inkmill.operators import gloss
from inkmill.operators.patterns import DEFAULT_TITLE

# Fixed values.
MODES = ["off", "gloss", "command", "http"]
BATCH_CHARS, TIMEOUT = 3000, 120.0
ANSWER_KEYS = ["translation", "translatedText", "text", "output"]
NOTE = "machine translation was applied via mode={!r}; the resulting text is a derivative work and its redistribution rights must be confirmed before publication"


class TranslationError(RuntimeError):
    pass


def batches(text: str, batch_chars: int = BATCH_CHARS) -> list[str]:
    """Paragraphs joined up to batch_chars with the blank lines between them; 0 or less gives one batch."""
    if batch_chars <= 0:
        return [text] if text.strip() else []
    out: list[str] = []
    for part in text.split("\n\n"):
        if out and len(out[-1]) + 2 + len(part) <= batch_chars:
            out[-1] += "\n\n" + part
        else:
            out.append(part)
    return [b for b in out if b.strip()]


def batch_text(c: Column | str, batch_chars: int = BATCH_CHARS) -> Column:
    """The same as a fold of columns."""
    text = F.coalesce(col(c), F.lit(""))
    if batch_chars <= 0:
        return F.when(strip(text) != "", F.array(text)).otherwise(F.array().cast("array<string>"))

    def step(done: Column, part: Column) -> Column:
        last = F.element_at(done, -1)
        more = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat(last, F.lit("\n\n"), part)))
        return F.when((F.size(done) > 0) & (F.length(last) + 2 + F.length(part) <= batch_chars), more).otherwise(F.concat(done, F.array(part)))

    # the guard of size 0 keeps element_at from failing on the first part
    parts = F.split(text, "\n\n", -1)
    first = F.slice(parts, 1, 1)
    rest = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.filter(F.aggregate(rest, first, step), lambda b: strip(b) != "")


@dataclass(frozen=True)
class Engine:
    """name, and what turns a text column into its translation."""

    name: str
    translate: Callable[[Column], Column]


def off() -> Engine:
    return Engine("off", lambda c: strip(squeeze_spaces(strip_control(F.coalesce(c, F.lit(""))))))


def reading(keep_heading_numbers: bool = False) -> Engine:
    return Engine("gloss", lambda c: gloss.normalize_script(c, keep_heading_numbers))


def _by_batch(fn_of_worker: Callable[[], Callable[[str], str]], batch_chars: int) -> Callable[[Column], Column]:
    """One translator per task, over the batches of each text."""

    def over(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = fn_of_worker()
        for s in parts:
            yield s.map(lambda t: "\n\n".join(fn(b) for b in batches(t or "", batch_chars)))

    over.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return lambda c: F.pandas_udf(over, T.StringType())(c)


def command(line: str, timeout: float = TIMEOUT, batch_chars: int = BATCH_CHARS) -> Engine:
    """Each batch through a program, from its standard input to its output; any failure fails the job."""
    argv = shlex.split(line)
    if not argv:
        raise TranslationError("no command given")

    def run(text: str) -> str:
        try:
            done = subprocess.run(argv, input=text, capture_output=True, text=True, timeout=timeout, encoding="utf-8")
        except (OSError, subprocess.TimeoutExpired) as e:
            raise TranslationError(f"{argv[0]}: {e}") from e
        if done.returncode:
            raise TranslationError(f"{argv[0]} ended with {done.returncode}: {done.stderr.strip()[:200]}")
        if not done.stdout.strip():
            raise TranslationError(f"{argv[0]} gave no output")
        return done.stdout.strip()

    return Engine("command", _by_batch(lambda: run, batch_chars))


def _post(url: str, body: bytes, timeout: float) -> bytes:
    request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as answer:  # noqa: S310
        return answer.read()


def http(url: str, model: str = "", target: str = "vi", timeout: float = TIMEOUT, batch_chars: int = BATCH_CHARS, post: Callable[[str, bytes, float], bytes] = _post) -> Engine:
    """Each batch posted as JSON; ``post`` is replaced in tests."""

    def ask(text: str) -> str:
        try:
            answer = json.loads(post(url, json.dumps({"text": text, "target_lang": target, "model": model}).encode(), timeout))
        except (OSError, ValueError) as e:
            raise TranslationError(f"{url}: {e}") from e
        found = next((answer[k] for k in ANSWER_KEYS if isinstance(answer, dict) and isinstance(answer.get(k), str)), None)
        if found is None:
            raise TranslationError(f"{url}: no translation in the answer")
        return found

    return Engine("http", _by_batch(lambda: ask, batch_chars))


def build_engine(mode: str = "off", **options) -> Engine:
    makers = {"off": off, "gloss": reading, "command": command, "http": http}
    if mode not in makers:
        raise TranslationError(f"unknown translate mode {mode!r}; expected one of {', '.join(MODES)}")
    return makers[mode](**options)


def translate_text(c: Column | str, engine: Engine) -> Column:
    """Blank texts stay empty; others go to the engine."""
    text = F.coalesce(col(c), F.lit(""))
    return F.when(strip(text) == "", "").otherwise(engine.translate(text))


def translate_sections(sections: DataFrame, engine: Engine, title: str = "title", text: str = "text") -> DataFrame:
    """Rows of sections with translated texts, normalised titles, the mode and, for machine translation, a note."""
    if engine.name not in MODES:
        raise TranslationError(f"{engine.name!r} is no mode")
    clean = gloss.normalize_title(title)
    note = F.lit(NOTE.format(engine.name)) if engine.name in ("command", "http") else F.lit(None).cast("string")
    return sections.withColumns({text: translate_text(text, engine), title: F.when(clean == "", DEFAULT_TITLE).otherwise(clean), "translate_mode": F.lit(engine.name), "translate_note": note})
