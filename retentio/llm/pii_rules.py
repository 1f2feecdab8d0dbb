"""Personal data by rule: e-mail, IP, card and phone spans of a text."""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a match can only begin where a run of digits begins
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_EMAIL_WHOLE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE_WHOLE = re.compile(r"(?:\+[0-9]|\()[\x20().0-9-]+[0-9]")
SIGNS = re.compile("[0-9@]")


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def is_ip(s: str) -> bool:
    parts = [p.lstrip("0") for p in s.split(".")]  # int() refuses very long runs of zeros
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def is_card(s: str) -> bool:
    d = digits_of(s)
    return 13 <= len(d) <= 19 and luhn(d)


def is_phone(s: str) -> bool:
    return 9 <= len(digits_of(s)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; leftmost matches per kind, failing ones dropped."""
    if not SIGNS.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if is_ip(m.group())]
    out += [(2, *m.span()) for m in _CARD.finditer(text) if is_card(m.group())]
    return out + [(3, *m.span()) for m in _PHONE.finditer(text) if is_phone(m.group())]


def plausible(kind: int, s: str) -> bool:
    """Whether a string can be of the kind at all: what the model adds must be."""
    if kind == 0:
        return _EMAIL_WHOLE.fullmatch(s) is not None
    if kind == 1:
        return re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", s) is not None and is_ip(s)
    if kind == 2:
        return _CARD.fullmatch(s) is not None and is_card(s)
    return _PHONE_WHOLE.fullmatch(s) is not None and is_phone(s)
