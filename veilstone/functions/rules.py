"""Many regex rules over many texts: literals that a rule cannot match without tell which rules to try on which text."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from veilstone.functions.regex import _group, _Token, _tokens

#: Letters beyond ASCII that RE2 takes for `s` and `k` where case is ignored.
_FOLDS = str.maketrans({"ſ": "s", "K": "k"})


def folded(text: str) -> str:
    """Text in which case is of no matter, for the screen only: what differs in more than ASCII case stays different."""
    return "".join(c.lower() if c.isascii() else c for c in text.translate(_FOLDS)) if not text.isascii() else text.lower()


def _letter(token: _Token) -> str | None:
    """The letter of an atom that stands for one letter only."""
    if token.kind != "atom":
        return None
    text = token.python
    if len(text) == 1:
        return text if text != "." else None
    if len(text) == 2 and text[0] == "\\" and not text[1].isalnum():
        return text[1]
    return None


def _required(tokens: list[_Token]) -> frozenset[str] | None:
    """Literals one of which every match of the sequence holds; None where there are none. The best are those whose
    shortest is longest, then the fewest."""
    alternatives, depth, begun = [], 0, 0
    for i, token in enumerate(tokens):
        depth += (token.kind == "open") - (token.kind == "close")
        if token.kind == "alt" and depth == 0:
            alternatives.append(tokens[begun:i])
            begun = i + 1
    alternatives.append(tokens[begun:])
    if len(alternatives) > 1:
        found = [_required(a) for a in alternatives]
        return None if any(f is None for f in found) else frozenset().union(*found)

    choices: list[frozenset[str]] = []
    run, i = "", 0
    while i <= len(tokens):
        token = tokens[i] if i < len(tokens) else None
        if token is not None and token.kind == "edge":
            i += 1
            continue
        letter = _letter(token) if token is not None else None
        repeated = i + 1 < len(tokens) and tokens[i + 1].kind == "repeat"
        if letter is not None and not repeated:
            run += letter
            i += 1
            continue
        if run:
            choices.append(frozenset([folded(run)]))
            run = ""
        if token is None:
            break
        if token.kind == "open":
            close, _ = _group(tokens, i, 1)
            after = tokens[close + 1] if close + 1 < len(tokens) else None
            if not (after is not None and after.kind == "repeat" and after.optional):
                inner = _required(tokens[i + 1 : close])
                if inner is not None:
                    choices.append(inner)
            i = close
        i += 1
    return max(choices, key=lambda c: (min(map(len, c)), -len(c)), default=None)


def required_literals(pattern: str) -> frozenset[str] | None:
    """Folded literals one of which is in every folded text that the RE2 pattern matches; None if it can do without any."""
    # a flag in the middle of a pattern changes nothing here, as folding covers both cases
    return _required([t for t in _tokens(pattern) if not (t.kind == "plain" and re.match(r"\(\?|\^|\$|\\[zAZ]", t.python))])


class RuleSet:
    """Rules by place: channel and RE2 pattern. Literals of all rules are in one automaton; a text is searched once, and the
    rules it may match are tried on it, each rule on all its texts in one kernel."""

    def __init__(self, rules: Sequence[tuple[str, str]]):
        import ahocorasick

        self.rules = list(rules)
        self.always = []
        by_literal: dict[str, list[int]] = {}
        for place, (_, pattern) in enumerate(self.rules):
            literals = required_literals(pattern)
            if literals is None:
                self.always.append(place)
            for literal in literals or ():
                by_literal.setdefault(literal, []).append(place)
        self.automaton = None
        if by_literal:
            self.automaton = ahocorasick.Automaton()
            for literal, places in by_literal.items():
                self.automaton.add_word(literal, places)
            self.automaton.make_automaton()

    def candidates(self, text: str) -> set[int]:
        found = set(self.always)
        if self.automaton is not None:
            for _, places in self.automaton.iter(folded(text)):
                found.update(places)
        return found

    def matches(self, channels: Sequence[str | None], texts: Sequence[str | None]) -> list[list[int]]:
        """The rules that each text matches, in no order."""
        tried: dict[int, list[int]] = {}
        for row, (channel, text) in enumerate(zip(channels, texts, strict=True)):
            if text is not None:
                for place in self.candidates(text):
                    if self.rules[place][0] == channel:
                        tried.setdefault(place, []).append(row)
        column = pa.array(texts, pa.large_string(), from_pandas=True)
        out: list[list[int]] = [[] for _ in texts]
        for place, rows in tried.items():
            hit = pc.match_substring_regex(column.take(pa.array(rows)), pattern=self.rules[place][1])
            for row in np.array(rows)[hit.to_numpy(zero_copy_only=False).astype(bool)]:
                out[row].append(place)
        return out
