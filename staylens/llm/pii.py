"""Personal data: regular expressions propose spans, checksums confirm them,
nearby words adjust the score.

Base kinds (email, ip, card, phone) follow fixed rules and always stay.  The
method adds: IBANs confirmed by mod-97, US social security numbers by their
ranges, card-like numbers of 13 to 15 digits by Luhn.  An added span stays if
its score - by kind and check, raised by context words within 40 characters
before it - reaches ``THRESHOLD``.

Every pattern takes time linear in the text: runs are matched from their first
character only, and possessively.

Defined cases: a null text counts as empty; spans of one kind never overlap;
equal spans of different kinds all stay; repeated rows give repeated rows;
other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "short_card")
THRESHOLD = 0.5
CONTEXT_CHARS = 40
#: Score of a confirmed proposal without context, and with a context word.
SCORES = {"email": (0.9, 0.95), "ip": (0.6, 0.8), "card": (0.9, 0.95), "phone": (0.7, 0.9), "iban": (0.9, 0.95), "ssn": (0.4, 0.8), "short_card": (0.4, 0.8)}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "short_card": ("card", "amex", "diners", "credit", "karte", "carte", "tarjeta"),
}
#: IBAN lengths by country (registry of ISO 13616).
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
#: What follows country and check digits: as many characters as the country has.
_IBAN_REST = {c: re.compile(rf"(?: ?[A-Z0-9]){{{n - 4}}}+(?![A-Za-z0-9])") for c, n in IBAN_LENGTH.items()}
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at-signs: the local part reaches
    back as far as its characters or the last match allow."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in _IBAN.finditer(text):
        rest = _IBAN_REST.get(m.group()[:2])
        whole = rest.match(text, m.end()) if rest and m.start() >= last else None
        if whole and mod97(text[m.start() : whole.end()].replace(" ", "")) and _scored("iban", text, m.start()) >= THRESHOLD:
            last = whole.end()
            yield m.start(), last


def _scored(kind: str, text: str, start: int) -> float:
    before = text[max(0, start - CONTEXT_CHARS) : start].lower()
    return SCORES[kind][any(w in before for w in CONTEXT[kind])]


def find_spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """Confirmed spans by kind, in code points, end exclusive."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in (*BASE_KINDS, *ADDED_KINDS)}
    if not text:
        return out
    if "@" in text:
        out["email"] = list(emails(text))
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out["ip"] = list(_ips(text))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
        elif 13 <= len(digits) <= 15 and luhn(digits) and text[m.start() - 1 : m.start()] != "+" and _scored("short_card", text, m.start()) >= THRESHOLD:
            out["short_card"].append(m.span())
    if "+" in text:
        out["phone"] = list(_phones(text))
    out["iban"] = list(_ibans(text))
    for m in _SSN.finditer(text):
        a, b, c = m.groups()
        if a not in ("000", "666") and a < "900" and b != "00" and c != "0000" and _scored("ssn", text, m.start()) >= THRESHOLD:
            out["ssn"].append(m.span())
    return out


def spans_of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """All spans of each text, by kind as listed, then start."""
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    for texts in parts:
        rows = []
        for t in texts:
            text = t.as_py()
            rows.append([{"kind": k, "start": a, "end": b, "score": _scored(k, text, a)} for k, spans in find_spans(text).items() for a, b in spans])
        yield pa.array(rows, kind_type)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, spans`` (kind, start, end, score) for every row of ``docs``."""
    return docs.select(F.col(id_col), F.arrow_udf(spans_of, "array<struct<kind: string, start: int, end: int, score: double>>")(text).alias("spans"))


def span_digests(found: DataFrame) -> DataFrame:
    """From ``personal_data``: counts of base kinds, the digest of the base
    spans and all spans as text."""

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kinds(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of_kinds(*BASE_KINDS)
    counts = [F.size(of_kinds(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    others = [c for c in found.columns if c != "spans"]
    return found.select(*others, *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
