"""Personal data: patterns propose spans, checks confirm them, context weighs them.

Each kind has a pattern, a check (Luhn for cards, mod 97 for account numbers, value
ranges for addresses and numbers) and a score.  A proposal whose check fails goes.
Words near the span that speak of its kind raise the score, and words that speak
of something else (an order or version number, say) lower it.

The *base* kinds (email, ip, card, phone) are certain by pattern and check: their
spans always stay, whatever their score.  The other kinds look like many harmless
things and need a score of ``THRESHOLD``, so most of them need a word of context.
A span of theirs gives way to any base span that it overlaps, and to a better one
of theirs.

Every pattern runs in time linear in the text: a run of characters is entered at
its beginning only (lookbehind) and never given back (possessive quantifiers), or
has a bounded length.  Rows are independent; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import ref

#: Kinds in the order of spans with an equal start.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "local_phone", "secret")
THRESHOLD = 0.5
#: Characters before and after a span in which context words count.
BEFORE, AFTER = 60, 30
SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


# ---------------------------------------------------------------- checks

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else 2 * v - 9 * (v > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """ISO 7064: the first four characters go last, letters count from 10."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def only_digits(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def is_card(text: str) -> bool:
    digits = only_digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= len(only_digits(text)) <= 15


def is_ip(text: str) -> bool:
    return all(len(p := part.lstrip("0")) < 4 and int(p or "0") <= 255 for part in text.split("."))


def is_ssn(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def is_secret(text: str) -> bool:
    """Long, of letters and digits in many different characters."""
    return len(set(text)) >= 10 and any(c.isdigit() for c in text) and any(c.isalpha() for c in text)


# ---------------------------------------------------------------- proposals

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """At each @ the run before it, unless an earlier match has it, and the domain."""
    end = seen = 0
    at = text.find("@")
    while at >= 0:
        start = seen + len(text[seen:at].rstrip(LOCAL))  # runs hold no @, so each is looked at once
        m = DOMAIN.match(text, at + 1) if start < at else None
        seen = at + 1
        if m:
            yield start, m.end()
            seen = end = m.end()
        at = text.find("@", max(end, at + 1))


def matches(pattern: str, check: Callable[[str], bool], needs: str = "") -> Callable[[str], Iterator[tuple[int, int]]]:
    """Leftmost non-overlapping matches that pass the check; texts without ``needs`` have none."""
    find = re.compile(pattern).finditer

    def found(text: str) -> Iterator[tuple[int, int]]:
        if needs in text:
            for m in find(text):
                if check(m.group()):
                    yield m.span()

    return found


ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")


def accounts(text: str) -> Iterator[tuple[int, int]]:
    """International account numbers; words in capitals behind a number are given up one by one."""
    for m in ACCOUNT.finditer(text):
        value = m.group()
        while len(plain := value.replace(" ", "")) >= 15:
            if mod97(plain):
                yield m.start(), m.start() + len(value)
                break
            if " " not in value:
                break
            value = value[:value.rindex(" ")]


#: The base kinds' patterns.
PROPOSE: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": emails,
    "ip": matches(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", is_ip, "."),
    "card": matches(r"[0-9](?:[\x20-]?[0-9])++", is_card),
    "phone": matches(r"\+[0-9][\x20().0-9-]+[0-9]", is_phone, "+"),
    "iban": accounts,
    "ssn": matches(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", is_ssn, "-"),
    "local_phone": matches(r"(?<![0-9+(.-])(?:\([0-9]{2,5}\)\x20?|0[0-9]{2,4}[\x20/.-])[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,3}(?![0-9])", is_phone),
    "secret": matches(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_-]{24,128}(?![A-Za-z0-9_+/-])", is_secret),
}

#: Score of a confirmed span without context.
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "local_phone": 0.35, "secret": 0.3}
RAISE, LOWER = 0.3, 0.3
#: Words that speak for a kind, and words that speak against it.
FOR = {
    "email": "mail email e-mail contact write correo courriel",
    "ip": "ip address addr host server client login adresse",
    "card": "card visa mastercard amex credit debit payment karte tarjeta carte",
    "phone": "phone tel telephone call fax mobile cell whatsapp telefon anruf llamar",
    "iban": "iban account bank transfer konto cuenta compte",
    "ssn": "ssn social security taxpayer",
    "local_phone": "phone tel telephone call fax mobile cell whatsapp telefon anruf llamar",
    "secret": "token key apikey secret password passwd bearer credential auth",
}
AGAINST = {
    "ip": "version release section chapter",
    "card": "isbn order invoice tracking sku",
    "ssn": "isbn order invoice part sku",
    "local_phone": "isbn order invoice page pages",
    "secret": "sha256 sha1 md5 checksum commit digest",
}
WORD = re.compile(r"[a-z0-9]+(?:-[a-z0-9]+)*")
SPEAK = {k: (frozenset(FOR[k].split()), frozenset(AGAINST.get(k, "").split())) for k in KINDS}


def weighed(text: str, kind: str, start: int, end: int) -> float:
    """The kind's score, moved by the words around the span."""
    near = {w for side in (text[max(0, start - BEFORE):start], text[end:end + AFTER]) for w in WORD.findall(side.lower())}
    good, bad = SPEAK[kind]
    return round(min(1.0, max(0.0, SCORE[kind] + RAISE * bool(near & good) - LOWER * bool(near & bad))), 3)


def spans_of(text: str) -> list[Span]:
    """All spans by start, then kind."""
    base = [Span(k, s, e, weighed(text, k, s, e)) for k in BASE for s, e in PROPOSE[k](text)]
    more = [x for k in KINDS[len(BASE):] for s, e in PROPOSE[k](text) if (x := Span(k, s, e, weighed(text, k, s, e))).score >= THRESHOLD]
    order = {k: i for i, k in enumerate(KINDS)}
    if more:
        base += apart(len(text), base, sorted(more, key=lambda x: (-x.score, x.start, order[x.kind])))
    return sorted(base, key=lambda x: (x.start, order[x.kind]))


def apart(n: int, taken: list[Span], offered: list[Span]) -> list[Span]:
    """Of the offered spans, in order, those that overlap none taken before."""
    busy, out = bytearray(n), []
    for x in taken:
        busy[x.start:x.end] = b"\1" * (x.end - x.start)
    for x in offered:
        if not any(busy[x.start:x.end]):
            busy[x.start:x.end] = b"\1" * (x.end - x.start)
            out.append(x)
    return out


# ---------------------------------------------------------------- operator

def personal_data(df: DataFrame, text: str = "text", name: str = "pii") -> DataFrame:
    """Add ``name``: the text's spans as an array of (kind, start, end, score), in code
    points, end exclusive, by start and then in the order of ``KINDS``.

    A null or empty text has none.  Rows are independent: ties and repeated rows give equal
    results, an empty table gives an empty result.  A column called ``name`` is replaced,
    others stay as they are.
    """
    @F.pandas_udf(SPAN)
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[x._asdict() for x in spans_of(t)] for t in texts], dtype=object)

    return df.withColumn(name, found(F.coalesce(ref(text), F.lit(""))))


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(*kinds))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with each span of ``text`` replaced by its kind in brackets (of overlapping
    spans the first one's); null texts stay null.  Edge cases as in ``personal_data``."""
    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else without(t) for t in texts], dtype=object)

    return df.withColumn(text, cleaned(ref(text)))


def without(text: str) -> str:
    parts, at = [], 0
    for x in spans_of(text):
        if x.start >= at:
            parts += [text[at:x.start], f"[{x.kind}]"]
        at = max(at, x.end)
    return "".join([*parts, text[at:]])
