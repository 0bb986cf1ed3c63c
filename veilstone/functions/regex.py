"""Rewrites RE2 patterns so that Java's and Python's regex engines give the same matches."""

from __future__ import annotations

import re
from dataclasses import dataclass

WORD = "[0-9A-Za-z_]"
SPACE = r"\t\n\f\r "
_EITHER_EDGE = f"(?:(?<!{WORD})(?={WORD})|(?<={WORD})(?!{WORD}))"
_NO_EDGE = f"(?:(?<!{WORD})(?!{WORD})|(?<={WORD})(?={WORD}))"
_QUANTIFIER = re.compile(r"[*+?]|\{\d+(?:,\d*)?\}")
_GROUP_OPEN = re.compile(r"\((?:\?(?:P?<[A-Za-z]\w*>|[imsU-]*:))?")
#: ASCII classes by name, as ranges.
_POSIX = {
    "alpha": "A-Za-z", "digit": "0-9", "alnum": "0-9A-Za-z", "lower": "a-z", "upper": "A-Z", "xdigit": "0-9A-Fa-f", "blank": " \\t",
    "ascii": r"\x00-\x7f", "cntrl": r"\x00-\x1f\x7f", "graph": "!-~", "print": " -~", "punct": r"!-/:-@\[-`{-~", "space": r"\t-\r ",
}
_GLOBAL_FLAGS = re.compile(r"\(\?([imsU-]+)\)")


class UnsupportedPattern(ValueError):
    """The pattern uses syntax that RE2 lacks, or that the rewrite does not cover."""


@dataclass(frozen=True)
class _Token:
    kind: str  # atom, repeat, open, close, alt, edge, plain
    java: str
    python: str = ""
    word: bool = False  # an atom that only ever matches one ASCII word character
    optional: bool = False  # a repeat that may match nothing


def _read_class(pattern: str, at: int) -> tuple[_Token, int]:
    """Read the character class starting at `at`."""
    i, out, python, word = at + 1, "[", "[", True
    if pattern[i : i + 1] == "^":
        out, python, i, word = out + "^", python + "^", i + 1, False
    first = True
    while i < len(pattern) and (pattern[i] != "]" or first):
        first = False
        if pattern.startswith("[:", i):
            end = pattern.index(":]", i)
            name = pattern[i + 2 : end]
            if name not in _POSIX:
                raise UnsupportedPattern(f"class [:{name}:]")
            python += _POSIX[name]
            out += "\\p{%s}" % {"xdigit": "XDigit", "ascii": "ASCII"}.get(name, name.capitalize())
            word = word and name in {"alpha", "digit", "alnum", "lower", "upper", "xdigit"}
            i = end + 2
        elif pattern[i] == "\\":
            nxt = pattern[i + 1]
            if nxt == "S":
                raise UnsupportedPattern(r"\S inside a class")
            out += SPACE if nxt == "s" else "\\" + nxt
            python += SPACE if nxt == "s" else "\\" + nxt
            word = word and nxt in "dw"
            i += 2
        else:
            span = re.match(r"([0-9A-Za-z_])-([0-9A-Za-z_])", pattern[i:])
            if span:
                out += span.group(0)
                python += span.group(0)
                i += 3
            else:
                out += ("\\" if pattern[i] in "[&^" else "") + pattern[i]
                python += ("\\" if pattern[i] in "[&^|~" else "") + pattern[i]
                word = word and re.fullmatch(WORD, pattern[i]) is not None
                i += 1
    if i >= len(pattern):
        raise UnsupportedPattern("unclosed class")
    return _Token("atom", out + "]", python + "]", word), i + 1


def _tokens(pattern: str) -> list[_Token]:
    found: list[_Token] = []
    multiline = any("m" in f.split("-")[0] for f in re.findall(r"\(\?([imsU-]+)[:)]", pattern))
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        repeat = _QUANTIFIER.match(pattern, i)
        if repeat and found and found[-1].kind in ("atom", "close"):
            text = repeat.group(0)
            i = repeat.end()
            if pattern[i : i + 1] == "+":
                raise UnsupportedPattern("possessive repeat")
            optional = text in "*?" or re.match(r"\{0", text) is not None
            if pattern[i : i + 1] == "?":
                text, i = text + "?", i + 1
            found.append(_Token("repeat", text, text, optional=optional))
        elif ch == "\\":
            nxt = pattern[i + 1 : i + 2]
            i += 2
            if nxt == "b":
                found.append(_Token("edge", "b", r"\b"))
            elif nxt == "B":
                found.append(_Token("plain", _NO_EDGE, _NO_EDGE))
            elif nxt == "s":
                found.append(_Token("atom", f"[{SPACE}]", f"[{SPACE}]"))
            elif nxt == "S":
                found.append(_Token("atom", f"[^{SPACE}]", f"[^{SPACE}]"))
            elif nxt in "AzQE":
                if nxt in "QE":
                    raise UnsupportedPattern(r"\Q quoting")
                found.append(_Token("plain", "\\" + nxt, "\\" + nxt.upper()))
            elif nxt in ("p", "P", "x"):
                tail = re.compile(r"\{\^?\w+\}|[0-9A-Fa-f]{2}|[A-Z]").match(pattern, i)
                if not tail:
                    raise UnsupportedPattern(f"\\{nxt}")
                code = tail.group(0).strip("{}")
                python = re.escape(chr(int(code, 16))) if nxt == "x" else f"\\{nxt}{tail.group(0)}"
                found.append(_Token("atom", f"\\{nxt}{tail.group(0)}", python))
                i = tail.end()
            elif nxt == "" or nxt.isdigit() or nxt in "kGZCRXhHvVN":
                raise UnsupportedPattern(f"\\{nxt}")
            else:
                found.append(_Token("atom", "\\" + nxt, "\\" + nxt, nxt in "dw"))
        elif ch == "[":
            token, i = _read_class(pattern, i)
            found.append(token)
        elif ch == "(":
            flags = _GLOBAL_FLAGS.match(pattern, i)
            opened = _GROUP_OPEN.match(pattern, i)
            if flags:
                if "U" in flags.group(1):
                    raise UnsupportedPattern("swapped greediness")
                found.append(_Token("plain", flags.group(0), flags.group(0)))
                i = flags.end()
            elif pattern.startswith("(?", i) and opened.group(0) == "(":
                raise UnsupportedPattern("look-around or atomic group")
            else:
                java = opened.group(0).replace("?P<", "?<")
                found.append(_Token("open", java, java.replace("?<", "?P<")))
                i = opened.end()
        elif ch == ")":
            found.append(_Token("close", ch, ch))
            i += 1
        elif ch == "|":
            found.append(_Token("alt", ch, ch))
            i += 1
        elif ch == "$":
            found.append(_Token("plain", *(("$", "$") if multiline else ("\\z", "\\Z"))))
            i += 1
        elif ch == "^":
            found.append(_Token("plain", ch, ch))
            i += 1
        else:
            escaped = "\\" + ch if ch in "{}]" else ch
            found.append(_Token("atom", escaped, escaped, re.fullmatch(WORD, ch) is not None))
            i += 1
    return found


def _group(tokens: list[_Token], at: int, step: int) -> tuple[int, list[int]]:
    """Other end of the group at `at`, and where each alternative begins in that direction."""
    depth, starts, i = 1, [at + step], at + step
    inward, outward = ("open", "close") if step > 0 else ("close", "open")
    while 0 <= i < len(tokens):
        kind = tokens[i].kind
        depth += (kind == inward) - (kind == outward)
        if depth == 0:
            return i, starts
        if kind == "alt" and depth == 1:
            starts.append(i + step)
        i += step
    raise UnsupportedPattern("unbalanced group")


def _starts_with_word(tokens: list[_Token], at: int) -> bool:
    if at >= len(tokens):
        return False
    end, first = at, tokens[at]
    if first.kind == "open":
        end, starts = _group(tokens, at, 1)
        sure = all(_starts_with_word(tokens, s) for s in starts)
    else:
        sure = first.kind == "atom" and first.word
    after = tokens[end + 1] if end + 1 < len(tokens) else None
    return sure and not (after is not None and after.kind == "repeat" and after.optional)


def _ends_with_word(tokens: list[_Token], at: int) -> bool:
    if at < 0:
        return False
    last = tokens[at]
    if last.kind == "repeat":
        return not last.optional and _ends_with_word(tokens, at - 1)
    if last.kind == "close":
        _, starts = _group(tokens, at, -1)
        return all(_ends_with_word(tokens, s) for s in starts)
    return last.kind == "atom" and last.word


def java_regex(pattern: str) -> str:
    """Java form of an RE2 pattern.

    Word edges and white space are ASCII, `.` stops at a line feed only, and `$` means the very end. An edge
    next to a sure word character needs a look in one direction only, which is several times faster. Case
    folding stays ASCII: RE2 also lets `k` and `s` match two non-ASCII letters under `(?i)`.
    """
    tokens = _tokens(pattern)
    out = ["(?d)"]
    for i, token in enumerate(tokens):
        if token.kind != "edge":
            out.append(token.java)
        elif _starts_with_word(tokens, i + 1):
            out.append(f"(?<!{WORD})")
        elif _ends_with_word(tokens, i - 1):
            out.append(f"(?!{WORD})")
        else:
            out.append(_EITHER_EDGE)
    return "".join(out)


def python_regex(pattern: str) -> str:
    """Python form of an RE2 pattern, to be compiled by `compiled`."""
    return "".join(token.python for token in _tokens(pattern))


def compiled(python: str):
    """The engine for a Python form: `re`, or `regex` where only that one knows the syntax."""
    if re.search(r"\\[pP]|.\(\?[imsU-]+\)", python, re.DOTALL):
        import regex

        return regex.compile(python, regex.ASCII | regex.VERSION1)
    return re.compile(python, re.ASCII)


def can_match_empty(pattern: str) -> bool:
    """Whether the pattern has a match without a letter somewhere in some text: read off its parts."""
    tokens = _tokens(pattern)

    def alternatives(at: int, end: int) -> bool:
        empty, i = True, at
        while i < end:
            token, after = tokens[i], i + 1
            if token.kind == "alt":
                if empty:
                    return True
                empty, i = True, after
                continue
            skips = token.kind in ("edge", "plain")
            if token.kind == "open":
                close, _ = _group(tokens, i, 1)
                skips, after = alternatives(i + 1, close), close + 1
            if after < end and tokens[after].kind == "repeat":
                skips, after = skips or tokens[after].optional, after + 1
            empty, i = empty and skips, after
        return empty

    return alternatives(0, len(tokens))
