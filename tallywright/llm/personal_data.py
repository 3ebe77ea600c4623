"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust the score.

The kinds email, ip, card and phone are found by fixed expressions and always stay once their check passes.
Beyond them an IBAN is reported if its mod-97 check holds, a key in the form of a well-known issuer at once, and a number
written as 3-2-4 digits or a token of random letters and digits only if a word nearby says what it is. The score (0 to 1)
starts from how much the form proves, and rises with such a word, in English, German, French or Spanish. A random token
has at least 20 characters of ``[A-Za-z0-9_+-]``, two letters, four digits and 3 bits a character; longer ones than 256 are none.

Offsets are code points, the end exclusive. Spans of different kinds may overlap. Defined results: a null or
empty text has no spans. Every expression runs in time linear in the text, also on long runs of one character.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: an address can only start where no digit stands before it: what starts later in a run of digits fails alike
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
#: length of an account in the countries that have most of them
_IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HU": 28,
    "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "TR": 26,
}
_GROUPED = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: keys whose issuer gives them a form of their own
_KEY = re.compile(
    r"(?<![A-Za-z0-9_-])(?:AKIA[0-9A-Z]{16}|gh[opsu]_[A-Za-z0-9]{36}|xox[abp]-[0-9A-Za-z-]{20,80}|AIza[0-9A-Za-z_-]{35})(?![A-Za-z0-9_-])"
)
_RANDOM = re.compile(r"(?<![A-Za-z0-9_+-])[A-Za-z0-9_+-]{20,256}(?![A-Za-z0-9_+-])")
_LETTER = re.compile(r"[^\W\d_]+")

#: score of a confirmed form, and words that speak for it
KINDS = {
    "email": (0.9, "mail email contact write kontakt schreiben contacter écrire correo contacto escribir"),
    "ip": (0.6, "ip address host server adresse rechner serveur dirección servidor"),
    "card": (0.8, "card visa credit payment karte kreditkarte zahlung carte paiement tarjeta crédito pago"),
    "phone": (0.7, "phone call tel mobile fax telefon anruf handy téléphone appel appeler teléfono móvil llamar"),
    "iban": (0.9, "iban bank account konto bankverbindung banque compte banco cuenta"),
    "ssn": (0.3, "ssn social security sozialversicherung sécurité sociale seguridad"),
    "key": (0.9, "key token secret password schlüssel clé clave"),
    "token": (0.3, "key token secret password apikey passwd passwort schlüssel geheim clé jeton secrète clave secreto contraseña"),
}
KINDS = {kind: (score, frozenset(words.split())) for kind, (score, words) in KINDS.items()}
#: the score from which a span is reported
ENOUGH, CONTEXT_BONUS, CONTEXT_WIDTH = 0.5, 0.3, 40
BASE = ("email", "ip", "card", "phone")


def _digits(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


def luhn(number: str) -> bool:
    doubled = (int(c) * 2 for c in number[-2::-2])
    return (sum(int(c) for c in number[::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def mod97(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str):
    end, last = 0, -1
    while (at := text.find("@", last + 1)) >= 0:
        before = text[max(end, last + 1) : at]
        start = at - len(before) + len(before.rstrip(_LOCAL))
        last = at
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end


def _ips(text: str):
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(number := _digits(m.group())) <= 19 and luhn(number):
            yield m.span()


def _phones(text: str):
    if "+" in text:
        yield from (m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15)


def _ibans(text: str):
    """Each start is tried with all ends where a token ends: the country's length first, then from long to short."""
    at = 0
    while m := _IBAN.search(text, at):
        ends, size = [], 0
        for i in range(m.start(), m.end()):
            size += text[i] != " "
            if size >= 15 and text[i] != " " and not (text[i + 1 : i + 2].isascii() and text[i + 1 : i + 2].isalnum()):
                ends.append((size != _IBAN_LENGTHS.get(m.group()[:2]), -size, i + 1))
        at = m.start() + 2
        for _, _, end in sorted(ends):
            if mod97(text[m.start() : end].replace(" ", "")):
                yield m.start(), end
                at = end
                break


def _grouped(text: str):
    yield from (m.span() for m in _GROUPED.finditer(text))


def _keys(text: str):
    yield from (m.span() for m in _KEY.finditer(text))


def _bits(token: str) -> float:
    """Entropy of a token's characters, in bits a character."""
    return -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values())


def _tokens(text: str):
    for m in _RANDOM.finditer(text):
        token = m.group()
        digits = len(_digits(token))
        if digits >= 4 and sum(map(str.isalpha, token)) >= 2 and not _KEY.fullmatch(token) and _bits(token) >= 3:
            yield m.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _grouped, "key": _keys, "token": _tokens}


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """Kind, start, end and score of all spans, by kind as listed in ``KINDS``, then start."""
    found = []
    for kind, finder in _FINDERS.items():
        score, words = KINDS[kind]
        for start, end in finder(text or ""):
            near = text[max(0, start - CONTEXT_WIDTH) : start] + " " + text[end : end + CONTEXT_WIDTH]
            known = not words.isdisjoint(_LETTER.findall(near.lower()))
            total = min(1.0, score + CONTEXT_BONUS * known)
            if kind in BASE or total >= ENOUGH:
                found.append((kind, start, end, total))
    return found


def _spans_of(texts: pd.Series) -> pd.Series:
    names = ("kind", "start", "end", "score")
    return pd.Series([[dict(zip(names, s)) for s in spans(t)] for t in texts], dtype=object)


def personal_data(text: str = "text") -> Column:
    """All spans of a text: an array of kind, start, end, score."""
    kind = "array<struct<kind: string, start: int, end: int, score: double>>"
    return F.pandas_udf(_spans_of, kind)(F.col(text))


def joined(found: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scores(found: Column) -> Column:
    """Scores of the spans as text, in hundredths, in the order of the spans."""
    return F.array_join(F.transform(found, lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",")
