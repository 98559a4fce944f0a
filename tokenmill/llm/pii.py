"""Format-preserving pseudonyms for validated numbers and dates.

Candidates are validated first (check digits, octet ranges, calendar,
area rules); only then is the value replaced by another valid value of
the same format. The replacement is a keyed permutation: a balanced
Feistel network over the value's own domain (digit strings of that
length, days of the calendar range, 32-bit addresses), with cycle walking
where a domain is not a square or a result would be invalid. So equal
values get equal pseudonyms in every document, different values stay
different, and the holder of the key can undo it. Which numbers a text
holds depends on what stands next to them, so a pseudonym followed by other
digits may read as another number. Every replaced text is therefore read
back at once; where that does not give the original, its values are put
between marks (``MARK``, the kind's number, the value, ``MARK``), and marked
places are undone as they stand. A ``MARK`` of the original is doubled.

Separators, letter case and date layout of the original are kept. Mail
addresses are permuted by the same network over their local part (letters
to letters, digits to digits); their domain is left.

Edge cases: a null text stays null and has no values; empty texts have
none; where candidates overlap, the earlier wins and at one start the
longer; repeated rows and equal values are replaced alike; extra columns
are ignored by ``scan_pii`` and kept by ``pseudonymise``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import arrow_map

KINDS = ("card", "iban", "ssn", "phone", "ipv4", "date", "email")
ROUNDS = 10
_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

_CARD = re.compile(r"(?<![\w.])[0-9](?:[ -]?[0-9]){12,18}(?![\w])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?!\w)")
_SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?!\w)"
                    r"|(?<![\w+])\+[2-9][0-9]{0,2}(?:[ .-]?[0-9]){7,12}(?!\w)")
_IPV4 = re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])")
_DATE = re.compile(r"(?<![\w./-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?![\w]|[./-][0-9])")
_EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9_.+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}(?![\w-])")
_DIGIT = re.compile(r"[0-9]")


def _round(key: bytes, label: str, i: int, value: int, modulus: int) -> int:
    h = hashlib.blake2b(f"{label}:{i}:{value}".encode(), key=key, digest_size=16).digest()
    return int.from_bytes(h, "big") % modulus


def permute(value: int, size: int, key: bytes, label: str, undo: bool = False) -> int:
    """Keyed permutation of 0..size-1: a Feistel network over a pair of
    numbers below the square root of ``size`` (rounded up), walked until
    the result is below ``size``."""
    side = math.isqrt(max(size, 1) - 1) + 1
    label = f"{label}/{size}"
    while True:
        a, b = divmod(value, side)
        steps = range(ROUNDS)
        for i in reversed(steps) if undo else steps:
            if undo:
                a, b = (b - _round(key, label, i, a, side)) % side, a
            else:
                a, b = b, (a + _round(key, label, i, b, side)) % side
        value = a * side + b
        if value < size:
            return value


def luhn(digits: str) -> int:
    """The check digit for ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _mod97(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s)) % 97


def _fill(original: str, digits: str) -> str:
    """``original`` with its digits replaced in order."""
    it = iter(digits)
    return _DIGIT.sub(lambda _: next(it), original)


def _digits(s: str, key: bytes, label: str, undo: bool) -> str:
    return str(permute(int(s), 10 ** len(s), key, f"{label}{len(s)}", undo)).zfill(len(s)) if s else s


def valid_card(s: str) -> bool:
    d = _DIGIT.findall(s)
    return 13 <= len(d) <= 19 and len(set(d)) > 1 and luhn("".join(d[:-1])) == int(d[-1])


def swap_card(s: str, key: bytes, undo: bool) -> str:
    body = "".join(_DIGIT.findall(s))[:-1]
    while True:
        body = _digits(body, key, "card", undo)
        whole = body + str(luhn(body))
        if len(set(whole)) > 1:
            return _fill(s, whole)


def valid_iban(s: str) -> bool:
    c = s.replace(" ", "")
    return 15 <= len(c) <= 34 and 2 <= int(c[2:4]) <= 98 and _mod97(c[4:] + c[:4]) == 1


def swap_iban(s: str, key: bytes, undo: bool) -> str:
    c = s.replace(" ", "")
    account = _fill(c[4:], _digits("".join(_DIGIT.findall(c[4:])), key, "iban" + c[:2], undo))
    check = 98 - _mod97(account + c[:2] + "00")
    it = iter(c[:2] + f"{check:02d}" + account)
    return "".join(" " if x == " " else next(it) for x in s)


def valid_ssn(s: str) -> bool:
    a, b, c = s.split("-")
    return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"


def swap_ssn(s: str, key: bytes, undo: bool) -> str:
    d = s.replace("-", "")
    while True:
        d = _digits(d, key, "ssn", undo)
        out = _fill(s, d)
        if valid_ssn(out):
            return out


def valid_phone(s: str) -> bool:
    return 7 <= len(_DIGIT.findall(s)) <= 15


def swap_phone(s: str, key: bytes, undo: bool) -> str:
    d = "".join(_DIGIT.findall(s))
    # the country code (or, without one, nothing) is kept; +1 may be left out, so it makes no other number
    keep = len(d) - 10 if s.startswith("+1") else 2 if s.startswith("+") else 0
    return _fill(s, d[:keep] + _digits(d[keep:], key, "phone" + ("" if s.startswith("+1") else d[:keep]), undo))


def valid_ipv4(s: str) -> bool:
    return all(int(x) <= 255 and (x == "0" or x[0] != "0") for x in s.split("."))


def swap_ipv4(s: str, key: bytes, undo: bool) -> str:
    n = int.from_bytes(bytes(map(int, s.split("."))), "big")
    return ".".join(map(str, permute(n, 1 << 32, key, "ipv4", undo).to_bytes(4, "big")))


def _layout(s: str) -> tuple[dt.date, str, str, bool] | None:
    """(date, layout, separator, padded) of a date, or None if it is not in the calendar."""
    sep = next(c for c in s if not c.isdigit())
    p = s.split(sep)
    padded = all(len(x) != 1 for x in p) and (any(x[0] == "0" for x in p) or len(s) == 10)
    if len(p[0]) == 4:
        orders = [("ymd", p)]
    else:  # day first, unless only month first is a date
        orders = [("dmy", [p[2], p[1], p[0]]), ("mdy", [p[2], p[0], p[1]])]
    for name, (y, m, d) in orders:
        try:
            day = dt.date(int(y), int(m), int(d))
        except ValueError:
            continue
        # a date counts when its digits are padded throughout or not at all
        if _FIRST_DAY <= day.toordinal() <= _LAST_DAY and _show(day, name, sep, padded) == s:
            return day, name, sep, padded
    return None


def valid_date(s: str) -> bool:
    return _layout(s) is not None


def _show(day: dt.date, name: str, sep: str, padded: bool) -> str:
    w = 2 if padded else 1
    part = {"y": f"{day.year:04d}", "m": f"{day.month:0{w}d}", "d": f"{day.day:0{w}d}"}
    return sep.join(part[c] for c in name)


def swap_date(s: str, key: bytes, undo: bool) -> str:
    day, name, sep, padded = _layout(s)
    n = day.toordinal() - _FIRST_DAY
    while True:
        n = permute(n, _LAST_DAY - _FIRST_DAY + 1, key, "date", undo)
        out = _show(dt.date.fromordinal(_FIRST_DAY + n), name, sep, padded)
        # walk on until the text reads back as the same layout (else it could not be undone)
        if _layout(out) == (dt.date.fromordinal(_FIRST_DAY + n), name, sep, padded):
            return out


def swap_email(s: str, key: bytes, undo: bool) -> str:
    local, at, domain = s.rpartition("@")
    classes = ["0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if c.islower()
               else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isupper() else c for c in local]
    size, n = 1, 0
    for c, k in zip(local, classes, strict=True):
        size, n = size * len(k), n * len(k) + k.index(c)
    shape = "".join("9" if len(k) == 10 else k[0] for k in classes)
    n = permute(n, size, key, f"email{shape}@{domain.lower()}", undo)
    out = []
    for k in reversed(classes):
        n, r = divmod(n, len(k))
        out.append(k[r])
    return "".join(reversed(out)) + at + domain


_RULES = (("card", _CARD, valid_card, swap_card), ("iban", _IBAN, valid_iban, swap_iban),
          ("ssn", _SSN, valid_ssn, swap_ssn), ("phone", _PHONE, valid_phone, swap_phone),
          ("ipv4", _IPV4, valid_ipv4, swap_ipv4), ("date", _DATE, valid_date, swap_date),
          ("email", _EMAIL, lambda s: ".." not in s and s[0] != ".", swap_email))
_SWAP = {k: swap for k, _, _, swap in _RULES}


_IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
    "YE": 30}


def _ends(kind: str, s: str) -> list[int]:
    """Where a candidate may end, longest first: whole, or where a group ends (a separator
    follows). An IBAN of a known country ends first where its country's length says."""
    ends = [len(s)] + [i for i in range(len(s) - 1, 0, -1) if s[i] in " -" and s[i - 1] not in " -"]
    if kind == "iban" and (n := _IBAN_LENGTH.get(s[:2])):
        at = [i + 1 for i, c in enumerate(s) if c != " "]
        ends = [e for e in ends if n <= len(at) and e == at[n - 1]] + [e for e in ends if n > len(at) or e != at[n - 1]]
    return ends


def _accepted(kind: str, pattern: re.Pattern, valid, text: str):
    """(start, end) of the valid values of a pattern. Cards and IBANs may be followed by further
    digits or capitals: the longest candidate is shortened to the ends of its groups, and the
    scan goes on behind the accepted end, or at the next group if none is valid."""
    if kind not in ("card", "iban"):
        for m in pattern.finditer(text):
            if valid(m.group()):
                yield m.span()
        return
    at = 0
    while m := pattern.search(text, at):
        s = m.group()
        for e in _ends(kind, s):
            if valid(s[:e]):
                yield m.start(), m.start() + e
                at = m.start() + e
                break
        else:
            gap = next((i for i, c in enumerate(s) if c in " -"), len(s))
            at = m.start() + gap


def find_pii(text: str | None) -> list[tuple[str, int, int]]:
    """Validated values of a text as (kind, start, end), not overlapping, in order."""
    if not text:
        return []
    found = []
    for i, (kind, pattern, valid, _) in enumerate(_RULES):
        if kind == "email" and "@" not in text:
            continue
        found += [(s, -e, i, kind) for s, e in _accepted(kind, pattern, valid, text)]
    out, at = [], 0
    for s, e, _, kind in sorted(found):
        if s >= at:
            out.append((kind, s, -e))
            at = -e
    return out


@lru_cache(maxsize=100_000)
def pseudonym(kind: str, value: str, key: bytes, undo: bool = False) -> str:
    """The value's replacement (or, with ``undo``, the original of a replacement)."""
    return _SWAP[kind](value, key, undo)


MARK = "\ue000"
_MARKED = re.compile(f"{MARK}{MARK}|{MARK}([0-9])([^{MARK}]*){MARK}")


def swaps(text: str, key: bytes, undo: bool = False) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, replacement) of the values found in a text; a replacement depends on
    kind and value alone."""
    return [(kind, s, e, pseudonym(kind, text[s:e], key, undo)) for kind, s, e in find_pii(text)]


def _joined(text: str, found: list[tuple[str, int, int, str]], show, gap) -> str:
    """``text`` with its values shown by ``show(kind, replacement)`` and what lies between by ``gap``."""
    out, at = [], 0
    for kind, s, e, new in found:
        out += [gap(text[at:s]), show(kind, new)]
        at = e
    return "".join([*out, gap(text[at:])])


def _hidden(text: str, found: list[tuple[str, int, int, str]], key: bytes) -> str:
    """``text`` with the values found in it replaced, marked where it would not read back."""
    def gap(t):
        return t.replace(MARK, MARK * 2)

    new = _joined(text, found, lambda kind, p: p, gap)
    if not found or _restored(new, key) == text:
        return new
    return _joined(text, found, lambda kind, p: f"{MARK}{KINDS.index(kind)}{p}{MARK}", gap)


def _restored(text: str, key: bytes) -> str:
    """The original of a replaced text."""
    if any(m.group(1) for m in _MARKED.finditer(text)):
        return _MARKED.sub(lambda m: pseudonym(KINDS[int(m.group(1))], m.group(2), key, True) if m.group(1) else MARK, text)
    return _joined(text, swaps(text, key, True), lambda kind, p: p, lambda t: t.replace(MARK * 2, MARK))


def replace_pii(text: str | None, key: bytes, undo: bool = False) -> str | None:
    """The text with its values replaced or, with ``undo``, the original of such a text."""
    if not text:
        return text
    return _restored(text, key) if undo else _hidden(text, swaps(text, key), key)


def scan_pii(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans, text) per row of ``df``: spans of the original text
    with kind, offsets (code points, end exclusive) and pseudonym, and the
    text with every value replaced."""
    cols = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = cols.schema["doc_id"].dataType.simpleString()

    def run(ids, texts):
        spans, new = [], []
        for t in texts:
            found = swaps(t, key) if t else []
            spans.append([{"kind": k, "start": s, "end": e, "pseudonym": p} for k, s, e, p in found])
            new.append(_hidden(t, found, key) if t else t)
        return ids, spans, new

    return arrow_map(cols, run, f"doc_id {id_type}, spans array<struct<kind string, start long, end long, "
                                "pseudonym string>>, text string")


def pseudonymise(df: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with the values of ``text_col`` replaced."""
    @F.pandas_udf("string")
    def swapped(texts):
        return texts.map(lambda t: replace_pii(t, key), na_action="ignore")

    return df.withColumn(text_col, swapped(F.col(text_col)))
