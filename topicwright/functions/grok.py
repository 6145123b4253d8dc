"""Grok patterns: ``%{NAME}``, ``%{NAME:field}`` and ``%{NAME:field:type}`` compiled to one regular expression.

A name stands for a definition, which may use other names. A reference with a field becomes a group of the result, one
without a field does not. Groups that definitions or the pattern itself have become groups without a number, but for
named ones ``(?<field>...)``, which are fields too. Dots and ``@`` in names of fields are kept.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import NamedTuple

# The usual names of the pattern language, after their published meaning.
DEFINITIONS = {
    "USERNAME": r"[a-zA-Z0-9._-]+",
    "USER": r"%{USERNAME}",
    "EMAILADDRESS": r"[a-zA-Z0-9!#$%&'*+/=?^_`{|}~.-]+@%{HOSTNAME}",
    "INT": r"[+-]?[0-9]+",
    "BASE10NUM": r"[+-]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)",
    "NUMBER": r"%{BASE10NUM}",
    "BASE16NUM": r"[+-]?(?:0x)?[0-9A-Fa-f]+",
    "POSINT": r"\b[1-9][0-9]*\b",
    "NONNEGINT": r"\b[0-9]+\b",
    "WORD": r"\b\w+\b",
    "NOTSPACE": r"\S+",
    "SPACE": r"\s*",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
    "QUOTEDSTRING": r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'",
    "QS": r"%{QUOTEDSTRING}",
    "UUID": r"[A-Fa-f0-9]{8}-(?:[A-Fa-f0-9]{4}-){3}[A-Fa-f0-9]{12}",
    "MAC": r"(?:[A-Fa-f0-9]{2}[:-]){5}[A-Fa-f0-9]{2}",
    "IPV4": r"(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])",
    "IPV6": r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:)*(?::[0-9A-Fa-f]{1,4})*::?(?:[0-9A-Fa-f]{1,4}:)*[0-9A-Fa-f]{1,4}|::",
    "IP": r"%{IPV6}|%{IPV4}",
    "HOSTNAME": r"\b[0-9A-Za-z][0-9A-Za-z-]{0,62}(?:\.[0-9A-Za-z][0-9A-Za-z-]{0,62})*\.?",
    "IPORHOST": r"%{IP}|%{HOSTNAME}",
    "HOSTPORT": r"%{IPORHOST}:%{POSINT}",
    "UNIXPATH": r"(?:/[^\s/]*)+",
    "PATH": r"%{UNIXPATH}",
    "URIPROTO": r"[A-Za-z][A-Za-z0-9+.-]*",
    "URIHOST": r"%{IPORHOST}(?::%{POSINT})?",
    "URIPATH": r"(?:/[A-Za-z0-9$.+!*'(){},~:;=@#%&_-]*)+",
    "URIPARAM": r"\?[A-Za-z0-9$.+!*'|(){},~@#%&/=:;_?\[\]<>-]*",
    "URIPATHPARAM": r"%{URIPATH}(?:%{URIPARAM})?",
    "URI": r"%{URIPROTO}://(?:%{USER}(?::[^@]*)?@)?(?:%{URIHOST})?(?:%{URIPATHPARAM})?",
    "MONTH": r"\b(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)\b",
    "MONTHNUM": r"0?[1-9]|1[0-2]",
    "MONTHDAY": r"(?:0[1-9]|[12][0-9]|3[01]|[1-9])",
    "DAY": r"(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*",
    "YEAR": r"[0-9]{4}|[0-9]{2}",
    "HOUR": r"2[0-3]|[01]?[0-9]",
    "MINUTE": r"[0-5][0-9]",
    "SECOND": r"(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?",
    "TIME": r"(?<![0-9])%{HOUR}:%{MINUTE}(?::%{SECOND})?(?![0-9])",
    "ISO8601_TIMEZONE": r"Z|[+-]%{HOUR}:?%{MINUTE}",
    "TIMESTAMP_ISO8601": r"%{YEAR}-%{MONTHNUM}-%{MONTHDAY}[T ]%{HOUR}:?%{MINUTE}(?::?%{SECOND})?%{ISO8601_TIMEZONE}?",
    "HTTPDATE": r"%{MONTHDAY}/%{MONTH}/%{YEAR}:%{TIME} %{INT}",
    "SYSLOGTIMESTAMP": r"%{MONTH} +%{MONTHDAY} %{TIME}",
    "PROG": r"[\x21-\x5a\x5c\x5e-\x7e]+",
    "SYSLOGPROG": r"%{PROG}(?:\[%{POSINT}\])?",
    "LOGLEVEL": r"(?i:trace|debug|notice|info(?:rmation)?|warn(?:ing)?|err(?:or)?|crit(?:ical)?|fatal|severe|emerg(?:ency)?|alert)",
    "COMMONAPACHELOG": r'%{IPORHOST:clientip} %{NOTSPACE:ident} %{NOTSPACE:auth} \[%{HTTPDATE:timestamp}\] "(?:%{WORD:verb} %{NOTSPACE:request}(?: HTTP/%{NUMBER:httpversion})?|%{DATA:rawrequest})" %{NUMBER:response} (?:%{NUMBER:bytes}|-)',
}

# The types that a reference may name, as Spark calls them.
TYPES = {"int": "int", "long": "bigint", "float": "float", "double": "double", "string": "string", "boolean": "boolean"}

_REFERENCE = re.compile(r"%\{(\w+)(?::([\w.@-]+))?(?::(\w+))?\}")


class GrokError(ValueError):
    """A pattern that cannot be compiled."""


class Grok(NamedTuple):
    """A regular expression, and the name and type (None: as declared) of the field in each of its groups."""

    pattern: str
    fields: list[tuple[str, str | None]]


def is_grok(pattern: str) -> bool:
    return _REFERENCE.search(pattern) is not None


def compile_grok(pattern: str, definitions: Mapping[str, str] | None = None) -> Grok:
    """One regular expression for the pattern; ``definitions`` are added to the usual ones or replace them."""
    known = DEFINITIONS | dict(definitions or {})
    fields: list[tuple[str, str | None]] = []

    def expand(text: str, path: tuple[str, ...]) -> str:
        out, at = [], 0
        for match in _REFERENCE.finditer(text):
            out.append(plain_groups(text[at : match.start()], text, at))
            at = match.end()
            name, field, kind = match.groups()
            if name not in known:
                raise GrokError(f"The pattern name {name} is not defined.")
            if name in path:
                raise GrokError(f"The pattern name {name} is defined by itself: {' > '.join((*path, name))}.")
            if kind is not None and kind not in TYPES:
                raise GrokError(f"Unknown type '{kind}' of field {field}. Use one of {', '.join(TYPES)}.")
            if field is None:
                out.append(f"(?:{expand(known[name], (*path, name))})")
            else:
                fields.append((field, TYPES[kind] if kind else None))
                out.append(f"({expand(known[name], (*path, name))})")
        out.append(plain_groups(text[at:], text, at))
        return "".join(out)

    def plain_groups(part: str, text: str, start: int) -> str:
        """The text between two references; its groups lose their numbers, named ones become fields."""
        inside = _in_class(text)
        out, i = [], 0
        while i < len(part):
            char = part[i]
            if char == "\\":
                out.append(part[i : i + 2])
                i += 2
                continue
            if char == "(" and not inside[start + i]:
                named = re.match(r"\(\?<([A-Za-z][\w.@-]*)>", part[i:])
                if named:
                    fields.append((named.group(1), None))
                    out.append("(")
                    i += named.end()
                    continue
                if part[i + 1 : i + 2] != "?":
                    out.append("(?:")
                    i += 1
                    continue
            out.append(char)
            i += 1
        return "".join(out)

    compiled = expand(pattern, ())
    names = [name for name, _ in fields]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise GrokError(f"The pattern has several fields named {', '.join(twice)}.")
    return Grok(compiled, fields)


def _in_class(text: str) -> list[bool]:
    """For each character, whether it is inside square brackets."""
    inside, found, i = False, [], 0
    while i < len(text):
        if text[i] == "\\":
            found += [inside, inside]
            i += 2
            continue
        if text[i] == "[" and not inside:
            inside = True
        elif text[i] == "]" and inside and text[i - 1] != "[":
            inside = False
        found.append(inside)
        i += 1
    return found
