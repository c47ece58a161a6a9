"""Base rules for personal data: patterns with a check, leftmost, not overlapping per kind."""

from __future__ import annotations

import re

#: Kinds in the order in which spans of one start are listed, and the patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")

EMAIL_KIND, IP_KIND, CARD_KIND, PHONE_KIND = range(4)


def emails(text: str) -> list[tuple[int, int]]:
    """``[A-Za-z0-9._%+-]+`` before a domain; found from the @, so long runs cost no more."""
    found, free = [], 0
    for match in EMAIL_DOMAIN.finditer(text):
        start = at = match.start()
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        if start < at:
            free = match.end()
            found.append((start, free))
    return found


def _is_address(text: str) -> bool:
    parts = [part.lstrip("0") for part in text.split(".")]
    return all(len(part) < 3 or (len(part) == 3 and part <= "255") for part in parts)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _is_card(text: str) -> bool:
    digits = NOT_DIGITS.sub("", text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 10 <= len(NOT_DIGITS.sub("", text)) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, sorted; matches that fail their check are dropped."""
    spans = []
    if "@" in text:
        spans += [(start, EMAIL_KIND, end) for start, end in emails(text)]
    if DIGIT.search(text):
        for kind, pattern, passes in (
            (IP_KIND, IP, _is_address),
            (CARD_KIND, CARD, _is_card),
            (PHONE_KIND, PHONE, _is_phone),
        ):
            for match in pattern.finditer(text):
                if passes(match.group()):
                    spans.append((match.start(), kind, match.end()))
    return sorted(spans)
