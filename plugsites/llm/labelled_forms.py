"""A small labelled table of personal data in forms that the base rules do not find.

Drawn from templates with a fixed seed, so that every run trains on the same rows. The
same templates with numbers that are nobody's teach what stays outside.
"""

from __future__ import annotations

import random

from plugsites.llm.pii_rules import CARD_KIND, EMAIL_KIND, IP_KIND, PHONE_KIND, luhn

ROWS = 900
SEED = 11

_SYLLABLES = ("an", "ber", "co", "del", "el", "fi", "gar", "ho", "in", "ka", "lo", "mar", "ni", "os", "ra", "tu")
_ENDS = ("com", "org", "net", "de", "fr", "es", "io", "info")
# {0}: the datum. What is around it in the forms below is ordinary text.
_EMAILS = (
    "{name} at {host} dot {end}",
    "{name} dot {other} at {host} dot {end}",
    "{name} (at) {host} (dot) {end}",
    "{name}[at]{host}[dot]{end}",
    "{name} [at] {host} [dot] {end}",
    "{name}.{other} (at) {host}.{end}",
    "{name}(at){host}(dot){end}",
)
_PHONES = ("0{a} {c} {d}", "(0{a}) {c}-{d}", "0{a}/{c}{d}", "0{a}-{c}-{d}", "00{b} {a} {c} {d}", "{a} {c} {d}")
_CARDS = ("{0}.{1}.{2}.{3}", "{0}/{1}/{2}/{3}", "{0}_{1}_{2}_{3}", "{0} / {1} / {2} / {3}")
_ADDRESSES = ("{0}[.]{1}[.]{2}[.]{3}", "{0}(.){1}(.){2}(.){3}", "{0} dot {1} dot {2} dot {3}", "{0},{1},{2},{3}")
_LEADS = {
    EMAIL_KIND: ("write to", "mail", "email", "contact", "reach me under", "questions to", ""),
    PHONE_KIND: ("phone", "tel.", "call", "telephone", "mobile", "fax", "call me on"),
    CARD_KIND: ("card", "visa", "paid with card", "credit card no.", ""),
    IP_KIND: ("ip", "server", "from ip", "host", "address", ""),
}
_NOBODYS = (
    "version {a}.{d}.0", "in {y} and {y}", "pages {a} to {c}", "about {a} of {c} rows", "at {a} o clock",
    "on {a}.{a}.{y}", "{a}.{a} percent", "order {c} of {y}", "{a}:{c} h", "room {a} dot matrix", "chapter {a}",
    "a dot on the map", "{c} {c} points", "look at the dot there", "{y}/{y}", "total {c}.{c} in {y}", "nr. {a}",
    "the {a} at the end", "{a}, {a}, {a}, {a}", "vol. {a}, no. {a}, {c} pages", "from {y} to {y} at {host}",
)


def _word(draw: random.Random) -> str:
    word = "".join(draw.choices(_SYLLABLES, k=draw.randint(1, 4)))
    return word.capitalize() if draw.random() < 0.2 else word


def _digits(draw: random.Random, least: int, most: int) -> str:
    return "".join(draw.choices("0123456789", k=draw.randint(least, most)))


def _card(draw: random.Random) -> list[str]:
    number = "4" + _digits(draw, 14, 14)
    number += next(digit for digit in "0123456789" if luhn(number + digit))
    return [number[k : k + 4] for k in range(0, 16, 4)]


def _datum(draw: random.Random, kind: int) -> str:
    if kind == EMAIL_KIND:
        words = {name: _word(draw) for name in ("name", "other", "host")}
        return draw.choice(_EMAILS).format(**words, end=draw.choice(_ENDS))
    if kind == PHONE_KIND:
        parts = {"a": str(draw.randint(20, 999)), "b": str(draw.randint(1, 99))}
        return draw.choice(_PHONES).format(**parts, c=_digits(draw, 3, 4), d=_digits(draw, 4, 5))
    if kind == CARD_KIND:
        return draw.choice(_CARDS).format(*_card(draw))
    return draw.choice(_ADDRESSES).format(*(draw.randint(0, 255) for _ in range(4)))


def labelled_forms(rows: int = ROWS, seed: int = SEED) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """(text, spans) rows; a span is (start, kind, end). About half hold personal data."""
    draw = random.Random(seed)
    out = []
    for _ in range(rows):
        before, after = (" ".join(_word(draw) for _ in range(draw.randint(1, 4))) for _ in range(2))
        if draw.random() < 0.5:
            kind = draw.choice((EMAIL_KIND, PHONE_KIND, CARD_KIND, IP_KIND))
            lead, datum = draw.choice(_LEADS[kind]), _datum(draw, kind)
            start = f"{before} {lead}".rstrip() + draw.choice((" ", ": ", " "))
            spans = [(len(start), kind, len(start) + len(datum))]
        else:
            start, spans = f"{before} ", []
            fill = {name: _digits(draw, 1, 2) for name in "ad"} | {"c": _digits(draw, 2, 4)}
            datum = draw.choice(_NOBODYS).format(**fill, y=draw.randint(1800, 2040), host=_word(draw))
        out.append((f"{start}{datum}{draw.choice((' ', '. ', ', '))}{after}", spans))
    return out
