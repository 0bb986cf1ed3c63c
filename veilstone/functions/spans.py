"""From text to detector spans, kept spans, tokens and back.

A span is a struct. Offsets count characters; `byte_start` counts UTF-8 bytes. Texts are read by a function over Arrow
batches: found, resolved, numbered and redacted in time linear in their length and matches, which neither backtracking
engines nor arrays that grow inside an expression are. Screens run in Spark before, so that only texts that may match reach Python.
Everything works inside one row: no shuffle, and the same on a batch or a stream.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilstone.functions.dims import sql_text
from veilstone.functions.frames import computed_once
from veilstone.functions.patterns import Pattern

SPAN = "STRUCT<start: INT, ord: INT, end: INT, byte_start: INT, original: STRING>"
KEPT = "STRUCT<start: INT, end: INT, byte_start: INT, type: STRING, prefix: STRING, token: STRING, original: STRING>"
ENTRY = "STRUCT<position: INT, token: STRING, original: STRING>"


def screen_bits(text: str, patterns: Sequence[Pattern]) -> str:
    """SQL for a number with a bit per screen that the text passes; patterns without a screen share a bit that is set."""
    screens = list(dict.fromkeys(p.screen for p in patterns))
    bits = [str(1 << i) if s is None else f"CASE WHEN {s.format(text=text)} THEN {1 << i} ELSE 0 END" for i, s in enumerate(screens)]
    return f"coalesce({' + '.join(bits)}, 0)" if bits else "0"


class Finder:
    """All matches of a set of detectors in many texts at a time.

    The engine is RE2, as Arrow's kernels bring it: an automaton, whose time is linear in the text whatever the expression, and
    the engine whose rules the detectors are written for. A kernel over the whole column puts a mark around every
    match of a detector; the marks, a character that no text of the batch holds, then tell where the matches are.
    """

    def __init__(self, detectors: Sequence[tuple[str, str, str, int]]):
        self.detectors = [(regex, name, prefix, 1 << bit) for regex, name, prefix, bit in detectors]

    @staticmethod
    def mark(texts: pa.Array) -> str:
        """A character that none of the texts holds."""
        for code in chain(range(1, 9), range(0x10FFFF, 0, -1)):
            if not 0xD800 <= code <= 0xDFFF and not pc.any(pc.match_substring(texts, chr(code))).as_py():
                return chr(code)
        raise ValueError("texts hold every character")

    def spans(self, texts: Sequence[str | None], bits: Sequence[int]) -> list[list[tuple[int, int, int, int, str]] | None]:
        """start, ord, end, byte_start and original, by start and then detector, of each text; None for None."""
        column = pa.array(texts, pa.large_string(), from_pandas=True)
        given = column.is_valid().to_numpy(zero_copy_only=False)
        passed = np.where(given, np.asarray(bits, np.int64), 0)
        found: list[list[tuple[int, int, int, str]]] = [[] for _ in texts]
        mark = self.mark(column)
        for order, (regex, _, _, bit) in enumerate(self.detectors):
            rows = np.flatnonzero(passed & bit)
            if not len(rows):
                continue
            part = column.take(pa.array(rows))
            marked = pc.replace_substring_regex(part, pattern=regex, replacement=f"{mark}\\0{mark}")
            for i in np.flatnonzero(pc.not_equal(part, marked).to_numpy(zero_copy_only=False)):
                into, at = found[rows[i]], 0
                for n, piece in enumerate(marked[int(i)].as_py().split(mark)):
                    if n % 2:
                        into.append((at, order, at + len(piece), piece))
                    at += len(piece)
        return [self.placed(text, spans) if ok else None for text, spans, ok in zip(texts, found, given, strict=True)]

    @staticmethod
    def placed(text: str, found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, int, str]]:
        out, at, size = [], 0, 0
        for start, order, end, original in sorted(found):
            size += len(text[at:start].encode("utf-8", "surrogatepass"))
            at = start
            out.append((start, order, end, size, original))
        return out

    def resolved(self, text: str, spans: list[tuple[int, int, int, int, str]]) -> tuple[list[tuple], str]:
        """Spans that overlap no kept earlier one, numbered per prefix in text order, and the text with their tokens."""
        kept, parts, upto, numbers = [], [], 0, Counter()
        for start, order, end, byte_start, original in spans:
            if start < upto:
                continue
            _, name, prefix, _ = self.detectors[order]
            numbers[prefix] += 1
            token = f"[{prefix}_{numbers[prefix]}]"
            kept.append((start, end, byte_start, name, prefix, token, original))
            parts += [text[upto:start], token]
            upto = end
        return kept, "".join([*parts, text[upto:]])


def _detectors(patterns: Sequence[Pattern]) -> list[tuple[str, str, str, int]]:
    screens = list(dict.fromkeys(p.screen for p in patterns))
    return [(p.regex, p.name, p.prefix, screens.index(p.screen)) for p in patterns]


def _screened(df: DataFrame, text: str, patterns: Sequence[Pattern]) -> DataFrame:
    return df.withColumn("_bits", F.expr(screen_bits(text, patterns)).cast("bigint"))


def with_spans(df: DataFrame, text: str, patterns: Sequence[Pattern], out: str) -> DataFrame:
    """Adds every match of every pattern, overlapping ones included, by start and then pattern order."""
    detectors = _detectors(patterns)

    @F.pandas_udf(f"array<{SPAN}>")
    def find(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        finder = Finder(detectors)
        for texts, bits in batches:
            yield pd.Series(finder.spans(texts.tolist(), bits), dtype="object")

    may = F.when(F.col("_bits") != 0, F.col(text))
    none = F.when(F.col(text).isNotNull(), F.array().cast(f"array<{SPAN}>"))
    return _screened(df, text, patterns).withColumn(out, F.coalesce(find(may, "_bits"), none)).drop("_bits")


def with_resolved(df: DataFrame, text: str, patterns: Sequence[Pattern], kept: str, redacted: str) -> DataFrame:
    """Adds the kept spans and the redacted text. A filter on them does not run the detectors again."""
    detectors = _detectors(patterns)

    @F.pandas_udf(f"kept array<{KEPT}>, redacted string")
    def resolve(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        finder = Finder(detectors)
        for texts, bits in batches:
            listed = texts.tolist()
            found = zip(listed, finder.spans(listed, bits), strict=True)
            rows = [(None, None) if spans is None else finder.resolved(t, spans) for t, spans in found]
            yield pd.DataFrame(rows, columns=["kept", "redacted"], dtype="object")

    may = F.when(F.col("_bits") != 0, F.col(text))
    none = F.when(F.col(text).isNotNull(), F.array().cast(f"array<{KEPT}>"))
    found = computed_once(_screened(df, text, patterns), "_found", resolve(may, "_bits"))
    return found.withColumns({kept: F.coalesce("_found.kept", none), redacted: F.coalesce("_found.redacted", text)}).drop("_bits", "_found")


def entries_sql(kept: str) -> str:
    """The reversible map of one text: token, original, type and byte position, in text order."""
    return (
        f"transform({kept}, k -> named_struct('token', k.token, 'original', k.original, 'type', k.type, "
        "'position', k.byte_start))"
    )


_TOKEN = re.compile(r"\[[^\[\]]*\]")
_NESTED = re.compile(r"\[[^\]]*\[")


def fill(text: str, entries: Sequence[dict]) -> str:
    """Every occurrence of each token back to its original, entry by entry in order.

    Where neither originals nor the text nest brackets, no replacement can make or break another token, and one pass
    over the text does the same.
    """
    originals: dict[str, str] = {}
    for e in entries:
        originals.setdefault(e["token"], e["original"])
    plain = all(_TOKEN.fullmatch(t) and "[" not in o and "]" not in o for t, o in originals.items())
    if plain and not _NESTED.search(text):
        return _TOKEN.sub(lambda m: originals.get(m.group(), m.group()), text)
    for e in entries:
        text = text.replace(e["token"], e["original"])
    return text


@F.pandas_udf(T.StringType())
def rehydrated(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The text with its tokens filled from an array of entries; NULL where there are none."""
    for texts, entries in batches:
        yield pd.Series(
            [None if t is None or e is None or len(e) == 0 else fill(t, e) for t, e in zip(texts, entries, strict=True)], dtype="object"
        )


@F.pandas_udf(T.BooleanType())
def shows_any(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Whether the text still shows one of the originals; all are looked for in one pass."""
    import ahocorasick

    for texts, entries in batches:
        out = []
        for text, listed in zip(texts, entries, strict=True):
            if text is None or listed is None or len(listed) == 0:
                out.append(None)
                continue
            automaton = ahocorasick.Automaton()
            for e in listed:
                automaton.add_word(e["original"], True)
            automaton.make_automaton()
            out.append(next(automaton.iter(text), None) is not None)
        yield pd.Series(out, dtype="object")


def _array(items: Sequence[str]) -> str:
    return f"array({', '.join(items)})"


def type_counts_sql(kept: str, patterns: Sequence[Pattern]) -> str:
    """Count per type inside the row, as an array of (type, n) without zeros; NULL where nothing was kept."""
    names = _array([sql_text(n) for n in dict.fromkeys(p.name for p in patterns)]) if patterns else "array('')"
    counted = (
        f"transform({names}, t -> named_struct('type', t, "
        f"'n', CAST(size(filter({kept}, k -> k.type = t)) AS BIGINT)))"
    )
    return f"CASE WHEN size({kept}) > 0 THEN filter({counted}, c -> c.n > 0) END"


