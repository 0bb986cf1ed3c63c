"""Rows that tests share."""

from __future__ import annotations


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, len(text or ""))


#: Repeated rows, NULLs in every column, empty and very long texts, letters beyond ASCII.
AWKWARD = [
    doc(1, "a b"), doc(1, "a b"), doc(2, None), doc(3, ""), doc(None, "no id"), doc(4, "word " * 30_000),
    doc(5, "ü ß", None, None), (6, " \t\x0b ", "en", "s", None),
]
