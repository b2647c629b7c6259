"""The prose cleaner as a function of one string, for kernels that already are in Python. The column form, which
everything else uses, is ``cleaning.sanitize_prose``; tests hold the two against each other."""

from __future__ import annotations

from functools import cache

import regex

from inkmill.operators import patterns as P
from inkmill.operators.cleaning import _case_classes


@cache
def _steps():
    make = regex.compile
    low, up = _case_classes()
    return (
        [
            (make(r"(?i)<ref[^>]*?/>"), ""), (make(r"(?is)<ref[^>]*>.*?</ref>"), ""), (make(r"<[^>]+>"), ""),
            (make(r"!\[[^\]]*\]\([^)]*\)"), ""), (make(r"\[([^\]]*)\]\([^)]*\)"), r"\1"), (make(r"\[([^\]]*)\]\[[^\]]*\]"), r"\1"),
            (make(r"(?m)^\s*\|.*$"), ""), (make(r"(?s)\{\{.*?\}\}"), ""), (make(r"[*_]{2,}"), ""), (make("'''"), ""), (make("''"), ""),
            (make(r"\[\^[^\]]*\]"), ""), (make(r"[ \t]+"), " "), (make(r" ?\n ?"), "\n"),
        ],
        [make(p) for p in P.FURNITURE],
        make(f"(?<=[{low}])(?=[{up}])"),
    )


def clean(text: str) -> str:
    steps, furniture, inside = _steps()
    text = text.replace("\xa0", " ")
    for pattern, to in steps:
        text = pattern.sub(to, text)
    text = "\n".join(s for s in text.split("\n") if not any(p.match(s) for p in furniture))
    text = inside.sub(" ", text)
    for glued, fixed in P.GLUED.items():
        text = text.replace(glued, fixed)
    return text
