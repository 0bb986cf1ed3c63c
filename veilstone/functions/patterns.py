"""Detector patterns: the bootstrap set and what one detector carries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from veilstone.functions.regex import UnsupportedPattern, can_match_empty, java_regex, python_regex


@dataclass(frozen=True)
class Pattern:
    """One named detector. `prefix` tags its tokens; list order breaks ties between matches.

    `screen` is an optional cheap SQL condition on `{text}` that holds for every text the pattern can match.
    """

    name: str
    regex: str
    prefix: str
    confidence: float | None = None
    screen: str | None = field(default=None, compare=False)

    def __post_init__(self) -> None:
        # an empty match has no span to replace
        if can_match_empty(self.regex):
            raise UnsupportedPattern(f"detector {self.name}: {self.regex!r} can match the empty text")

    @property
    def java(self) -> str:
        return java_regex(self.regex)

    @property
    def python(self) -> str:
        return python_regex(self.regex)


def _has(*words: str, of: str = "{text}") -> str:
    return "(" + " OR ".join(f"contains({of}, '{word}')" for word in words) + ")"


def _has_any_case(*words: str) -> str:
    return _has(*words, of="lower({text})")


# Three digits, at most two separators, two digits: part of every card, id, phone and account number.
_DIGIT_RUN = r"{text} RLIKE '[0-9]{{3}}[-.)\\t\\n\\f\\r ]{{0,2}}[0-9]{{2}}'"

# Detector names, token prefixes and expressions, in tie-breaking order.
BOOTSTRAP: tuple[Pattern, ...] = (
    Pattern("aws_key", r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b", "AWSKEY", screen=_has("AKIA", "ASIA")),
    Pattern("private_key", r"-----BEGIN (?:RSA |EC )?PRIVATE KEY-----", "PRIVKEY", screen=_has("-----BEGIN ")),
    Pattern(
        "credit_card",
        r"\b(?:4[0-9]{3}[-\s]?[0-9]{4}[-\s]?[0-9]{4}[-\s]?[0-9]{4}"
        r"|5[1-5][0-9]{2}[-\s]?[0-9]{4}[-\s]?[0-9]{4}[-\s]?[0-9]{4}"
        r"|3[47][0-9]{2}[-\s]?[0-9]{6}[-\s]?[0-9]{5}"
        r"|6(?:011|5[0-9]{2})[-\s]?[0-9]{4}[-\s]?[0-9]{4}[-\s]?[0-9]{4})\b",
        "CARD",
        screen=_DIGIT_RUN,
    ),
    Pattern("ssn", r"\b\d{3}-?\d{2}-?\d{4}\b", "SSN", screen=_DIGIT_RUN),
    Pattern("email", r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b", "EMAIL", screen=_has("@")),
    Pattern("phone", r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b", "PHONE", screen=_DIGIT_RUN),
    Pattern(
        "api_key",
        r"(?i)\b(?:api[_-]?key|apikey|access[_-]?token)[:\s=]+[A-Za-z0-9_\-]{20,}\b",
        "APIKEY",
        screen=_has_any_case("api", "access"),
    ),
    Pattern(
        "medical_record",
        r"(?i)\b(?:MRN|Medical Record)[:\s#]*[A-Z0-9]{6,12}\b",
        "MRN",
        screen=_has_any_case("mrn", "medical record"),
    ),
    Pattern(
        "dob",
        r"(?i)\b(?:DOB|D\.O\.B\.|Date of Birth|Birth Date)[:\s]+"
        r"(?:\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{4}[-/]\d{1,2}[-/]\d{1,2})\b",
        "DOB",
        screen=_has_any_case("dob", "d.o.b.", "birth"),
    ),
    Pattern("bank_account", r"(?i)\b(?:Account|Acct)[:\s#]*\d{8,17}\b", "ACCOUNT", screen=_DIGIT_RUN),
    Pattern("routing_number", r"(?i)\b(?:Routing|ABA)[:\s#]*\d{9}\b", "ROUTING", screen=_DIGIT_RUN),
    Pattern("ip_address", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "IP", screen="{text} RLIKE '[0-9][.][0-9]'"),
    Pattern(
        "address",
        r"(?i)\b\d+\s+[A-Za-z0-9\s]+"
        r"(?:Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Lane|Ln|Drive|Dr)\b",
        "ADDR",
        screen=r"{text} RLIKE '[0-9][\\t\\n\\f\\r ]'",
    ),
)


def pattern_count(patterns: Sequence[Pattern]) -> int:
    return len(patterns)


def without(patterns: Sequence[Pattern], *names: str) -> tuple[Pattern, ...]:
    """The set less the named detectors."""
    return tuple(p for p in patterns if p.name not in names)


def extended(patterns: Sequence[Pattern], *more: Pattern) -> tuple[Pattern, ...]:
    """The set with detectors added behind the others."""
    return (*patterns, *more)
