"""Secret scan with structural confirmation.

Pattern spans (credential assignments, access-key ids, hex runs) are
reported as found. On top of them, candidates that merely *look* encoded
(base64 or hex runs, dotted token triples) are decoded and parsed, and
reported only when the structure holds:

* DER private keys: every nested length must close exactly, and the
  sequence must have the members of PKCS#1, PKCS#8 (plain or encrypted),
  SEC 1 or DSA keys;
* OpenSSH private keys: magic, then length-prefixed fields that nest
  and end exactly at the end of the blob;
* keys whose lines are indented, quoted, joined by blanks or followed by
  other text: as many characters are read as the key's own header says;
* signed tokens: the first part decodes to a JSON object with a known
  ``alg``, the second to a JSON object, and the third has that
  algorithm's signature length.

Edge cases: a null text is empty; empty texts give no spans; overlapping
spans of different kinds are all reported; extra columns are ignored by
``scan_secrets`` and kept by ``redact_secrets``. One row out per row in,
so repeated rows and ties repeat.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import arrow_map

BASE_KINDS = ("assign", "access", "hex")
METHOD_KINDS = ("jwt", "rsa_key", "dsa_key", "ec_key", "pkcs8_key", "pkcs8_encrypted", "openssh_key")
KINDS = BASE_KINDS + METHOD_KINDS
_ORDER = {k: i for i, k in enumerate(KINDS)}
SPANS = "array<struct<kind string, start long, end long>>"

# the first character is one set, so the scan skips quickly; the look-behinds pick the keyword
_ASSIGN = re.compile(
    r"[PpSsTtAa](?:(?<=[Pp])[Aa][Ss][Ss][Ww](?:[Oo][Rr])?[Dd]|(?<=[Ss])[Ee][Cc][Rr][Ee][Tt]"
    r"|(?<=[Tt])[Oo][Kk][Ee][Nn]|(?<=[Aa])[Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{24,}")  # holds every hex span and the start of every encoded blob
_HEX = re.compile(r"[0-9a-f]{24,}")  # whole maximal runs: the same matches as [0-9a-f]+ of 24 or more
_TOKEN = re.compile(r"e[yw][A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
_BLOB = re.compile(r"[A-Za-z0-9+/_-]{40,}(?:(?:\r?\n|\\n)[A-Za-z0-9+/]{1,76})*={0,2}")
_ALLHEX = re.compile(r"(?:[0-9A-Fa-f]{2})+\Z")
_HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
_ARMOUR = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}KEY-----(?:\s|\\n)*\Z")
_ARMOUR_END = re.compile(r"(?:\s|\\n)*-----END [A-Z0-9 ]{0,40}KEY-----")
_KEY_START = re.compile(r"M[A-P]|b3BlbnNzaC1rZXkt|30")  # DER sequence, OpenSSH magic; DER in hex
_INNER_START = re.compile(r"-----(?=M[A-P]|b3BlbnNzaC1rZXkt|30)")
_PIECE = re.compile(r"(?:(?!-----)[A-Za-z0-9+/_-])+")
_HEX_PIECE = re.compile(r"[0-9A-Fa-f]+")
_BREAK = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t>|]*|[ \t]")  # a new line, indented or quoted, or one blank
_SIGNATURE_BYTES = {"HS256": {32}, "HS384": {48}, "HS512": {64}, "ES256": {64}, "ES384": {96},
                    "ES512": {132}, "EdDSA": {64, 114}}
_RSA_ALGS = {f"{p}{n}" for p in ("RS", "PS") for n in (256, 384, 512)}


def _tlv(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """Members (tag, start, end) of a DER value, or None if a length does not close."""
    out = []
    while at < end:
        if at + 2 > end:
            return None
        tag, n, at = data[at], data[at + 1], at + 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > end:
                return None
            n = int.from_bytes(data[at:at + k], "big")
            at += k
            if n < 0x80:  # DER lengths are minimal
                return None
        if at + n > end:
            return None
        out.append((tag, at, at + n))
        at += n
    return out


def der_key(data: bytes) -> str | None:
    """The kind of private key that ``data`` encodes, or None."""
    top = _tlv(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return None
    m = _tlv(data, top[0][1], top[0][2])
    if not m:
        return None
    tags = [t for t, _, _ in m]
    num = [int.from_bytes(data[s:e], "big") if t == 2 else None for t, s, e in m]
    if tags[:9] == [2] * 9 and num[0] in (0, 1) and num[3] and num[1] and num[1].bit_length() >= 256 \
            and num[4] and num[5] and num[4] * num[5] == num[1]:
        return "rsa_key"
    if tags == [2] * 6 and num[0] == 0 and num[1] and num[1].bit_length() >= 512:
        return "dsa_key"
    if len(m) >= 2 and tags[:2] == [2, 4] and num[0] == 1 and 16 <= m[1][2] - m[1][1] <= 66 \
            and all(t in (0xA0, 0xA1) for t in tags[2:]):
        return "ec_key"

    def algorithm(i: int) -> bool:
        inner = _tlv(data, m[i][1], m[i][2]) if tags[i] == 0x30 else None
        return bool(inner) and inner[0][0] == 6 and inner[0][2] > inner[0][1]

    if len(m) >= 3 and tags[0] == 2 and num[0] in (0, 1) and algorithm(1) and tags[2] == 4 \
            and m[2][2] - m[2][1] >= 16:
        inner = _tlv(data, m[2][1], m[2][2])
        if inner and len(inner) == 1:
            return "pkcs8_key"
    if len(m) == 2 and algorithm(0) and tags[1] == 4 and m[1][2] - m[1][1] >= 32:
        return "pkcs8_encrypted"
    return None


def openssh_key(data: bytes) -> bool:
    """Whether ``data`` is an OpenSSH private-key container whose lengths nest."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n:at]

    cipher, kdf, options = field(), field(), field()
    if not cipher or not kdf or options is None or at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 1 <= keys <= 64 or any(not field() for _ in range(keys)):
        return False
    private = field()
    return bool(private) and at == len(data) and len(private) % 8 == 0


def signed_token(token: str) -> bool:
    """Whether a dotted triple is a signed token (header, claims and signature length agree)."""
    parts = token.split(".")
    if len(parts) != 3:
        return False
    try:
        head, body, sig = (base64.b64decode(p + "=" * (-len(p) % 4), altchars=b"-_", validate=True) for p in parts)
        header, claims = json.loads(head), json.loads(body)
    except (ValueError, binascii.Error, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict):
        return False
    alg = header.get("alg")
    if alg in _RSA_ALGS:
        return len(sig) >= 128 and len(sig) % 8 == 0
    return isinstance(alg, str) and len(sig) in _SIGNATURE_BYTES.get(alg, ())


def decode_blob(run: str) -> list[bytes]:
    """The byte strings that a run of encoded characters can stand for."""
    run = run.replace("\\n", "").replace("\r", "").replace("\n", "")
    out = []
    if _ALLHEX.match(run):
        out.append(bytes.fromhex(run))
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 != 1:
        try:
            out.append(base64.b64decode(body + "=" * (-len(body) % 4), validate=True))
        except (ValueError, binascii.Error):
            pass
    return out


def confirmed(run: str) -> str | None:
    for data in decode_blob(run):
        kind = "openssh_key" if openssh_key(data) else der_key(data) if data[:1] == b"\x30" else None
        if kind:
            return kind
    return None


class _Encoded:
    """The bytes encoded from ``at`` on, over line breaks, indentation and single blanks, read as far as asked."""

    def __init__(self, text: str, at: int, in_hex: bool):
        self.text, self.at, self.in_hex = text, at, in_hex
        self.pieces: list[tuple[int, str]] = []
        self.chars, self.more = 0, True

    def take(self, size: int) -> tuple[bytes, int] | None:
        """(the first ``size`` bytes, where their characters end), None if there are fewer."""
        n = 2 * size if self.in_hex else -(-4 * size // 3)
        if n > self.chars + len(self.text) - self.at:
            return None
        while self.chars < n and self.more:
            start = self.at
            if self.pieces:
                gap = _BREAK.match(self.text, start)
                start = gap.end() if gap else len(self.text)
            m = (_HEX_PIECE if self.in_hex else _PIECE).match(self.text, start)
            if m is None:
                self.more = False
                break
            self.pieces.append((start, m.group()))
            self.chars, self.at = self.chars + len(m.group()), m.end()
        if self.chars < n:
            return None
        out, left = [], n
        for start, piece in self.pieces:
            out.append(piece[:left])
            if len(piece) >= left:
                end = start + left
                break
            left -= len(piece)
        run = "".join(out)
        if self.in_hex:
            return bytes.fromhex(run), end
        run = run.replace("-", "+").replace("_", "/")
        return base64.b64decode(run + "=" * (-n % 4)), end


def _openssh_size(data: bytes) -> int:
    """Bytes of the container as far as the fields in ``data`` tell (more than there are: read on)."""
    at, count = 15, 3
    while count:
        if at + 4 > len(data):
            return at + 4
        at, count = at + 4 + int.from_bytes(data[at:at + 4], "big"), count - 1
    if at + 4 > len(data):
        return at + 4
    count, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not 1 <= count <= 64:
        return 0
    for _ in range(count + 1):
        if at + 4 > len(data):
            return at + 4
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at


def key_at(text: str, at: int) -> tuple[str, int] | None:
    """(kind, end) of the private key whose encoding starts at ``at``: its own header tells how much is read."""
    for in_hex in (False, True):
        run = _Encoded(text, at, in_hex)
        head = run.take(6)
        if head is None:
            continue
        if head[0][0] == 0x30:
            n, k = head[0][1], 0
            if n & 0x80:
                k = n & 0x7F
                if not 1 <= k <= 4:
                    continue
                n = int.from_bytes(head[0][2:2 + k], "big")
            got = run.take(2 + k + n)
            kind = der_key(got[0]) if got else None
        elif head[0] == b"openss" and (got := run.take(15)) and got[0] == b"openssh-key-v1\0":
            while got and (size := _openssh_size(got[0])) > len(got[0]):
                got = run.take(size)
            kind = "openssh_key" if got and openssh_key(got[0]) else None
        else:
            continue
        if kind:
            end = got[1]
            while not in_hex and end < got[1] + 2 and text[end:end + 1] == "=":
                end += 1
            return kind, end
    return None


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), ordered by start, then kind."""
    if not text:
        return []
    out = []
    if "=" in text or ":" in text:
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("jwt", m.start(), m.end()) for m in _TOKEN.finditer(text) if signed_token(m.group())]
    done = taken = 0

    def report(kind: str, s: int, e: int) -> int:
        if head := _ARMOUR.search(text, max(0, s - 80), s):
            s = head.start()
            if tail := _ARMOUR_END.match(text, e):
                e = tail.end()
        out.append((kind, s, e))
        return e

    for run in _RUN.finditer(text):
        out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text, run.start(), run.end())]
        m = _BLOB.match(text, run.start()) if run.start() >= done else None
        if m is not None:  # else too short, or a later line of a blob already read
            done = m.end()
            s, e, kind = m.start(), m.end(), confirmed(m.group())
            if kind is not None:
                taken = report(kind, s, e)
                continue
        # other readings: as many characters as the key's header says, from here or behind an armour line
        starts = [run.start()] if _KEY_START.match(text, run.start()) else []
        starts += [x.end() for x in _INNER_START.finditer(text, run.start(), run.end())]
        for at in starts:
            if at >= taken and (key := key_at(text, at)):
                taken = report(key[0], at, key[1])
        if m is not None:  # a hex key inside a longer run of word characters
            for x in _HEX_RUN.finditer(m.group()):
                if s + x.start() >= taken and (inner := confirmed(x.group())):
                    out.append((inner, s + x.start(), s + x.end()))
    return sorted(out, key=lambda x: (x[1], _ORDER[x[0]], x[2]))


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) per row of ``df``: spans are structs of kind and code-point offsets (end exclusive)."""
    cols = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = cols.schema["doc_id"].dataType.simpleString()

    def scan(ids, texts):
        return ids, [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t)] for t in texts]

    return arrow_map(cols, scan, f"doc_id {kind}, spans {SPANS}")


def redact(text: str | None, mask: str = "[SECRET]") -> str | None:
    """The text with every secret span (overlaps merged) replaced by ``mask``."""
    spans = find_spans(text)
    if not spans:
        return text
    out, at = [], 0
    for _, s, e in spans:
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact_secrets(df: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``df`` with the secrets of ``text_col`` masked (null stays null)."""
    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(lambda t: redact(t, mask), na_action="ignore")

    return df.withColumn(text_col, masked(F.col(text_col)))
