"""Credentials in source texts: where each one begins, and the same text with it masked.

Literals are found by their own shape (issued tokens, private key blocks, key containers) or by the name or call that
they are given to. Base64 (wrapped over lines too), hex, percent, escape and byte-list layers are decoded and scanned
again, as deep as they go: each layer is shorter than the one around it. What is reported and masked is then the enclosing
encoded literal. Binary key containers are recognised by parsing them to their end.
Placeholders, names of variables, look-ups, hashes, revisions, ids, public keys, embedded images and messages are none.
"""

from __future__ import annotations

import base64
import binascii
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretlake.session import spread


class Hit(NamedTuple):
    start: int  # of the literal that is masked
    end: int
    line_at: int  # where the credential begins
    kind: str


# Shapes of issued tokens. Each entry: what must be in the text, the pattern.
ISSUED = [
    ("AKIA", r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"),
    ("ghp_", r"\bgh[pousr]_[A-Za-z0-9]{30,}"),
    ("github_pat_", r"\bgithub_pat_[A-Za-z0-9_]{30,}"),
    ("glpat-", r"\bglpat-[A-Za-z0-9_-]{18,}"),
    ("xox", r"\bxox[abeoprs]-[A-Za-z0-9-]{16,}"),
    ("_live_", r"\b(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    ("AIza", r"\bAIza[A-Za-z0-9_-]{30,}"),
    ("eyJ", r"\beyJ[A-Za-z0-9_-]{6,}\.eyJ[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{4,}"),
    ("npm_", r"\bnpm_[A-Za-z0-9]{36}"),
    ("SG.", r"\bSG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    ("ya29.", r"\bya29\.[A-Za-z0-9_-]{20,}"),
    ("hf_", r"\bhf_[A-Za-z0-9]{30,}"),
    ("pypi-", r"\bpypi-[A-Za-z0-9_-]{40,}"),
    ("AGE-SECRET-KEY-", r"\bAGE-SECRET-KEY-1[A-Z0-9]{50,}"),
]
_ISSUED = [re.compile(p) for _, p in ISSUED]

# Names that hold a credential; in the second group only values that look random count.
_SURE = r"(?:passwor[dt]|passwd|passphrase|passwort|kennwort|contrase[nñ]a|mot_?de_?passe|senha|palavra_?passe|wachtwoord|l[oö]senord|adgangskode|salasana|heslo|jelsz[oó]|пароль|密码|密碼|パスワード|pwd)"
_LIKE = r"(?:secret|token|api[_-]?key|apikey|access[_-]?key|auth[_-]?key|signing[_-]?key|private[_-]?key|encryption[_-]?key|client[_-]?secret|shared[_-]?key|account[_-]?key|credentials?|\.pass)"
_LIT = r"(?:\"((?:[^\"\\\n]|\\.)*)\"|`([^`\n]*)`|'((?:[^'\\\n]|\\.)*)')"
_ASSIGN = re.compile(rf"((?<![\w.-])[\w.-]{{0,160}}?(?:(?i:{_SURE})|(?i:{_LIKE}))\w{{0,80}})[\"'\]]?(?:\s+string)?\s*(?:=|:=|:|,)\s*(?:\[\]byte\(|string\(|&|new\()?\s*{_LIT}")
_CALL = re.compile(rf"\.?\b(Set(?i:password|passphrase|secret|token|apikey|passwd)|With(?i:password|passphrase|secret|token|apikey))\(\s*(?:\[\]byte\()?{_LIT}")
_TUPLE = re.compile(r"([\w.]+(?:\s*,\s*[\w.]+)+)\s*:?=\s*(\"(?:[^\"\\\n]|\\.)*\"(?:\s*,\s*\"(?:[^\"\\\n]|\\.)*\")+)")
_LIST, _EQUALS = re.compile(r"\w\s*,\s*\Z"), re.compile(r"\s*:?=(?!=)")  # one of several names that are assigned at once
_STRING = re.compile(r"\"((?:[^\"\\\n]|\\.)*)\"")
_YAML = re.compile(r"(?im)^[ \t]*((?://|#|\*)?[ \t]*)[\"']?(pass|password|passwd|passwort|passphrase|pwd|secret|token|api[_-]?key|client_secret)[\"']?[ \t]*:[ \t]+[\"']?([^\s\"'`,;(){}]{6,})[\"']?[ \t]*\r?$")
_USER = re.compile(r"\b[a-zA-Z][a-zA-Z0-9+.-]*://[^\s/:@\"'`]*:([^\s@/\"'`]{3,})@")
_QUERY = re.compile(r"(?i)[?&](?:token|access_token|auth_token|api_?key|key|secret|client_secret|sig|signature|password|pass|pwd|auth)=([A-Za-z0-9._~%+/-]{10,}=*)")
_PAIRS = re.compile(r"(?i)\b(?:AccountKey|SharedAccessKey|SharedSecret|Password|Pwd)=([^;\"'\s`]{6,})")
_SCHEME = re.compile(r"(?i)\b(Basic|Bearer)\s+([A-Za-z0-9+/._~-]{8,}={0,2})")
_ENV = re.compile(rf"(?<![\w./-])([A-Za-z][A-Za-z0-9_]*?(?:PASS|(?i:{_SURE})|PHRASE|SECRET|TOKEN|API_?KEY|ACCESS_KEY|PRIVATE_KEY|SIGNING_KEY|AUTH_KEY))=([^\s\"'`=;&|<>()$,][^\s\"'`;&|<>()$]{{5,}})(?=[\s\"'`;&|]|$)")
_CURL = re.compile(r"(?:\s-u|--user)[\s=]+[\"']?([^\s:\"'`]+):([^\s\"'`]{4,})")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY( BLOCK)?-----(.*?)-----END \1PRIVATE KEY( BLOCK)?-----", re.S)
_GLUE = re.compile(r"([\"`])\s*\+\s*\1")
_ADDED = re.compile(r"\"(?:[^\"\\\n]|\\.)*\"(?:\s*\+\s*\"(?:[^\"\\\n]|\\.)*\")+")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]{16,})*[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+={0,2}(?![A-Za-z0-9+/_=-])")
_BYTES = re.compile(r"\[(?:\d+|\.\.\.)?\](?:byte|uint8)\{([^{}]*)\}")
_NUMBER = re.compile(r"0[xX][0-9a-fA-F]{1,2}|'(?:[^'\\\n]|\\.)'|\d{1,3}")
_SURE_NAME = re.compile(rf"(?i)(?:{_SURE}|\bpass$)")
_LIKE_END = re.compile(r"(?i)(?:token|secret)\w{0,2}$")
_FIELD_NAME = re.compile(rf"(?i)(?:{_SURE}|\bpass|secret|token|apikey)$")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2}){2}")
_ESCAPED = re.compile(r"(?:\\x[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\[0-7]{3}){4}")
_URL_SIGN, _TEXT_SIGN = re.compile(r"[\w.~:/?&=@+%-]*"), re.compile(r"[^\s\"'`]*")
_UNIT = re.compile(r"\\x([0-9A-Fa-f]{2})|\\u([0-9A-Fa-f]{4})|\\([0-7]{3})")
_NONE = re.compile(
    r"(?i)^(?:[*x.•#_-]+|.*(?:\$\{|\$\(|\{\{|%\(|%[sdvq]\b|<[^>]*>|\.\.\.).*|\$\w+|%\w+%|.*(?:change_?-?me|replace_?-?me|example|placeholder|your[_-]|my[_-]?(?:password|secret|token)|todo|redacted|dummy|insert_|not-?set).*|"
    r"(?:password|passwd|passphrase|secret|token|key|none|null|nil|true|false|empty|unset|string|test|foo|bar|admin|root|user|default|required|optional|x-[\w-]+|authorization|bearer|basic))$"
)
_VARIABLE = re.compile(r"^[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+$|^[a-z]+(?:_[a-z]+)+$|^(?:os|env|cfg|conf|config)\.\w+.*$|^process\.env\..*$")
_NAME_OF = re.compile(r"(?i)(?:env|name|header|field|label|param|file|path|url|uri|hint|prompt|msg|message|err|title|id|type|kind|prefix|regexp?|pattern|sum|hash|digest|rev|len|size|pub|public)$")
#: A line is looked at only if it holds one of these: the first as they stand, the others in lower case.
_EXACT = [t for t, _ in ISSUED] + ["ASIA", "gho_", "ghu_", "ghs_", "ghr_"]
_NAMED = ["pass", "secret", "token", "kennwort", "pwd", "contrase", "пароль", "credential", "key", "senha", "wachtwoord", "senord", "adgangskode", "salasana", "heslo", "jelsz", "密码", "密碼", "パスワード", "phrase"]
_OTHER = ["://", "basic ", "bearer ", "curl", "--user", "wget"]


def is_placeholder(v: str) -> bool:
    return len(v) < 4 or bool(_NONE.match(v)) or len(set(v)) < 3


def looks_random(v: str) -> bool:
    """A value of no spaces with digits among letters, or of mixed case without being a plain word or identifier path."""
    if len(v) < 8 or re.search(r"\s", v) or _VARIABLE.match(v):
        return False
    digits, upper, lower = (sum(map(f, v)) for f in (str.isdigit, str.isupper, str.islower))
    if re.fullmatch(r"[a-z]+(?:[-_./][a-z]+)*(?:-\d{1,4})?", v):
        return v.count("-") >= 3 and v[-1].isdigit()
    return (digits >= 2 and upper + lower >= 2) or (digits >= 1 and upper >= 1 and lower >= 1 and len(v) >= 10) or (upper >= 3 and lower >= 3 and len(v) >= 16 and not re.fullmatch(r"(?:[A-Z]?[a-z]{2,})+", v))


def _is_secret_value(name: str, v: str, sure: bool) -> bool:
    if is_placeholder(v) or _VARIABLE.match(v) or _NAME_OF.search(re.sub(r"[^\w]", "", name)):
        return False
    if sure:
        if re.search(r"(?i)phrase", name):
            return len(v) >= 8
        return len(v) >= 6 and not re.search(r"\s", v) and not v.startswith(("/", "-", "http"))
    return looks_random(v)


def _openssh(raw: bytes) -> bool:
    """Magic, names of cipher and derivation, its options, the number of keys, their public parts and one private part, to the end."""
    at = 15

    def part() -> bytes | None:
        nonlocal at
        if at + 4 > len(raw):
            return None
        n = int.from_bytes(raw[at : at + 4], "big")
        at += 4 + n
        return raw[at - n : at] if at <= len(raw) else None

    cipher, derived, options = part(), part(), part()
    if not cipher or not derived or options is None or at + 4 > len(raw):
        return False
    keys = int.from_bytes(raw[at : at + 4], "big")
    at += 4
    return 1 <= keys <= 64 and all(part() for _ in range(keys)) and bool(part()) and at == len(raw)


def _keystore(raw: bytes) -> bool:
    """Magic, version, the number of entries, the entries and a digest of 20 bytes; one entry at least holds a private key."""
    at, private = 12, False
    if len(raw) < 32 or int.from_bytes(raw[4:8], "big") not in (1, 2):
        return False

    def skip(size: int) -> None:
        nonlocal at
        at += size + int.from_bytes(raw[at : at + size], "big")

    for _ in range(int.from_bytes(raw[8:12], "big")):
        if at + 4 > len(raw) or (kind := int.from_bytes(raw[at : at + 4], "big")) not in (1, 2, 3):
            return False
        at += 4
        skip(2)
        at += 8
        chain = 1
        if kind == 1:
            private = True
            skip(4)
            chain = int.from_bytes(raw[at : at + 4], "big")
            at += 4
        elif kind == 3:  # a sealed secret key: a serialised object, which is not parsed
            return at < len(raw)
        for _ in range(chain):
            if at > len(raw):
                return False
            skip(2)
            skip(4)
    return private and at + 20 == len(raw)


def key_container(raw: bytes) -> bool:
    """Whether bytes are a private key by the grammar of their container: DER (PKCS#1, PKCS#8, SEC 1, PKCS#12), OpenSSH, Java key store, PuTTY."""
    if raw.startswith(b"openssh-key-v1\0"):
        return _openssh(raw)
    if raw.startswith((b"\xfe\xed\xfe\xed", b"\xce\xce\xce\xce")):
        return _keystore(raw)
    if raw.startswith(b"PuTTY-User-Key-File-"):
        return re.search(rb"(?m)^Private-Lines: [1-9]\d*\r?$", raw) is not None

    def read(at: int, end: int) -> tuple[int, int, int] | None:
        if at + 2 > end:
            return None
        tag, n, at = raw[at], raw[at + 1], at + 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > end:
                return None
            n, at = int.from_bytes(raw[at : at + k], "big"), at + k
        return (tag, at, at + n) if at + n <= end else None

    top = read(0, len(raw)) if raw else None
    if not top or top[0] != 0x30 or top[2] != len(raw) or len(raw) < 24:
        return False
    tags, at = [], top[1]
    while at < top[2] and len(tags) < 12:
        x = read(at, top[2])
        if not x:
            return False
        tags.append((x[0], raw[x[1] : x[2]]))
        at = x[2]
    kinds = [t for t, _ in tags]
    if kinds[:1] != [0x02] and kinds[:2] != [0x30, 0x04]:
        return False
    if kinds[:2] == [0x30, 0x04] and len(kinds) == 2:  # encrypted PKCS#8
        return b"\x06\x09\x2a\x86\x48\x86\xf7\x0d\x01\x05" in tags[0][1]
    if kinds[:3] == [0x02, 0x30, 0x04] or kinds[:2] == [0x02, 0x04]:  # PKCS#8; SEC 1
        return True
    if len(kinds) >= 6 and all(k == 0x02 for k in kinds[:6]):  # PKCS#1
        return True
    return kinds[:2] == [0x02, 0x30] and tags[0][1] == b"\x03"  # PKCS#12


def _printable(raw: bytes) -> str | None:
    try:
        s = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return s if len(s) >= 6 and sum(c.isprintable() or c in "\r\n\t" for c in s) == len(s) else None


def _base64(s: str) -> bytes | None:
    try:
        return base64.b64decode(s.rstrip("=").replace("-", "+").replace("_", "/") + "=" * (-len(s.rstrip("=")) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _opens(raw: bytes | None) -> bool:
    """Whether decoded bytes are a key container or a text that holds a credential, in layers of its own perhaps."""
    return bool(raw) and (key_container(raw) or bool((p := _printable(raw)) and _scan(p, True)))


def _byte_list(body: str) -> bytes | None:
    """The bytes that a list of numbers and signs stands for."""
    out = bytearray()
    for m in _NUMBER.finditer(body):
        v = m[0]
        n = ord(v[1:-1].encode().decode("unicode_escape")) if v[0] == "'" else int(v, 16 if v[:2] in ("0x", "0X") else 10)
        if n > 255:
            return None
        out.append(n)
    return bytes(out)


def _layers(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of encoded literals whose decoded content holds a credential."""
    for m in _RUN.finditer(text):
        s = m[0]
        if re.fullmatch(r"[0-9a-fA-F]+", s):
            if len(s) % 2 == 0 and len(s) >= 24 and _opens(bytes.fromhex(s)):
                yield m.start(), m.end(), "hex"
            continue
        if (s.endswith("=") or (any(map(str.isdigit, s)) and s.lower() != s != s.upper())) and _opens(_base64(s)):
            yield m.start(), m.end(), "base64"
    if "\n" in text:
        for m in _WRAPPED.finditer(text):
            s = re.sub(r"\s+", "", m[0])
            if _opens(bytes.fromhex(s) if len(s) % 2 == 0 and re.fullmatch(r"[0-9a-fA-F]+", s) else _base64(s)):
                yield m.start(), m.end(), "wrapped"
    if "byte{" in text or "uint8{" in text:
        for m in _BYTES.finditer(text):
            if len(m[1]) >= 48 and _opens(_byte_list(re.sub(r"//[^\n]*|/\*.*?\*/", "", m[1], flags=re.S))):
                yield m.start(1), m.end(1), "bytes"
    for seed, sign, kind in ((_PERCENT, _URL_SIGN, "percent"), (_ESCAPED, _TEXT_SIGN, "escaped")):
        if ("%" if kind == "percent" else "\\") in text:
            for start, end in _around(text, seed, sign):
                s = text[start:end]
                raw = unquote_to_bytes(s) if kind == "percent" else _unescaped(s)
                if len(raw) < len(s) and raw != s.encode("utf-8", "surrogatepass") and _opens(raw):
                    yield start, end, kind


def _unescaped(s: str) -> bytes:
    """The bytes of a literal with hex, octal and Unicode escapes."""
    out, at = bytearray(), 0
    for m in _UNIT.finditer(s):
        out += s[at : m.start()].encode("utf-8", "surrogatepass")
        out += bytes([int(m[1], 16)]) if m[1] else chr(int(m[2], 16)).encode("utf-8", "surrogatepass") if m[2] else bytes([int(m[3], 8) & 255])
        at = m.end()
    return bytes(out + s[at:].encode("utf-8", "surrogatepass"))


def _around(text: str, seed: re.Pattern, sign: re.Pattern) -> Iterator[tuple[int, int]]:
    """Stretches of signs around each seed, in time that grows with the text."""
    at = 0
    while m := seed.search(text, at):
        start = m.start()
        while start > at and sign.fullmatch(text[start - 1]):
            start -= 1
        end = sign.match(text, m.end()).end()
        yield start, end
        at = max(end, m.end())


def _lines_with(text: str, low: str) -> list[tuple[int, int]]:
    """Spans of the lines that hold a trigger."""
    spans: dict[int, int] = {}
    for where, words in ((text, _EXACT), (low, _NAMED), (low, _OTHER)):
        for w in words:
            at = where.find(w)
            while at >= 0:
                start = text.rfind("\n", 0, at) + 1
                end = text.find("\n", at)
                end = len(text) if end < 0 else end
                spans[start] = end
                at = where.find(w, end)
    return sorted(spans.items())


def _in_line(text: str, low: str, final: bool) -> Iterator[Hit]:
    """Credentials that stand in a line (or a literal) as they are."""
    n = len(text)
    done = lambda end: final or end < n  # noqa: E731 - a literal that ends with the field may go on
    if any(t in text for t in _EXACT):
        for rx in _ISSUED:
            for m in rx.finditer(text):
                if done(m.end()) and len(set(m[0][6:])) > 5 and not re.search(r"(?i)example|xxxx", m[0]):
                    yield Hit(m.start(), m.end(), m.start(), "issued")
    if "://" in low:
        for rx, kind in ((_USER, "login"), (_QUERY, "parameter")):
            for m in rx.finditer(text):
                if done(m.end()) and not is_placeholder(m[1]) and not _VARIABLE.match(m[1]) and (kind == "login" or looks_random(m[1])):
                    yield Hit(m.start(1), m.end(1), m.start(1), kind)
    if "=" in low and ("key=" in low or "password=" in low or "pwd=" in low or "secret=" in low):
        for m in _PAIRS.finditer(text):
            if done(m.end()) and not is_placeholder(m[1]) and not _VARIABLE.match(m[1]):
                yield Hit(m.start(1), m.end(1), m.start(1), "pair")
    if "basic " in low or "bearer " in low:
        for m in _SCHEME.finditer(text):
            if not done(m.end()) or is_placeholder(m[2]):
                continue
            if m[1].lower() == "basic":
                p = _printable(_base64(m[2]) or b"")
                if p and ":" in p and not is_placeholder(p.split(":", 1)[1]):
                    yield Hit(m.start(2), m.end(2), m.start(2), "basic")
            elif looks_random(m[2]):
                yield Hit(m.start(2), m.end(2), m.start(2), "bearer")
    if "curl" in low or "--user" in low or "wget" in low:
        for m in _CURL.finditer(text):
            if done(m.end()) and not is_placeholder(m[2]) and not m[2].startswith("$"):
                yield Hit(m.start(2), m.end(2), m.start(2), "login")
    if not any(t in low for t in _NAMED):
        return
    if "=" in text:
        for m in _ENV.finditer(text):
            if done(m.end()) and _is_secret_value(m[1], m[2], bool(_SURE_NAME.search(m[1])) or m[1].upper().endswith(("PASS", "PHRASE"))):
                yield Hit(m.start(2), m.end(2), m.start(2), "setting")
    if '"' in text or "`" in text or "'" in text:
        tuples = list(_TUPLE.finditer(text)) if "," in text else []
        for rx in (_ASSIGN, _CALL):
            for m in rx.finditer(text):
                if rx is _ASSIGN and (any(t.start(2) <= m.end() - 1 <= t.end(2) for t in tuples) or _LIST.search(text, 0, m.start()) and _EQUALS.match(text, m.end(1))):
                    continue
                g = 2 if m[2] is not None else 3 if m[3] is not None else 4
                sure = bool(_SURE_NAME.search(m[1])) and (rx is _CALL or not _LIKE_END.search(m[1]))
                if _is_secret_value(m[1], m[g], sure):
                    yield Hit(m.start(g), m.end(g), m.start(g), "literal")
        for m in tuples:
            names, values = [x.strip() for x in m[1].split(",")], list(_STRING.finditer(text, m.start(2), m.end(2)))
            if len(names) == len(values):
                for name, v in zip(names, values):
                    if _FIELD_NAME.search(name) and _is_secret_value(name, v[1], bool(_SURE_NAME.search(name))):
                        yield Hit(v.start(1), v.end(1), v.start(1), "literal")
    if ":" in text:
        for m in _YAML.finditer(text):
            v, sure = m[3], m[2].lower().startswith(("pass", "pwd"))
            if done(m.end()) and not is_placeholder(v) and not _VARIABLE.match(v) and (looks_random(v) if m[1].strip() or not sure else not v.startswith(("*", "&", "$")) and "[" not in v):
                yield Hit(m.start(3), m.end(3), m.start(3), "setting")


def _glued(text: str) -> Iterator[tuple[int, str, list[tuple[int, int]]]]:
    """Literals that are added to each other: start of the line, what stands there before them with the joined literal, and where its parts come from."""
    for m in _ADDED.finditer(text):
        line = text.rfind("\n", 0, m.start()) + 1
        lead = text[line : m.start()]
        joined, marks, size = [lead, '"'], [(0, line), (len(lead), m.start())], len(lead) + 1
        for p in _STRING.finditer(text, m.start(), m.end()):
            marks.append((size, p.start(1)))
            joined.append(p[1])
            size += len(p[1])
        yield line, "".join(joined) + '"', marks


def _scan(text: str, inner: bool = False, final: bool = True) -> list[Hit]:
    low = text.lower()
    if len(low) != len(text):  # a few letters grow in lower case
        low = "".join(x if len(x) == 1 else c for c, x in ((c, c.lower()) for c in text))
    hits = []
    for a, b in _lines_with(text, low):
        hits += [Hit(h.start + a, h.end + a, h.line_at + a, h.kind) for h in _in_line(text[a:b], low[a:b], final or b < len(text))]
    if "PRIVATE KEY" in text:
        for m in _PEM.finditer(text):
            if len(re.sub(r"[^A-Za-z0-9+/]", "", m[3])) >= 64:
                hits.append(Hit(m.start(), m.end(), m.start(), "private_key"))
    for start, end, kind in _layers(text):
        if final or end < len(text):
            hits.append(Hit(start, end, start, kind))
    if not inner and ('" +' in text or '"+' in text):
        for _, joined, marks in _glued(text):
            starts = [a for a, _ in marks]
            found = [*_in_line(joined, joined.lower() if joined.isascii() else joined, True), *(Hit(a, b, a, k) for a, b, k in _layers(joined))]
            for h in found:
                spot = [(k := bisect_right(starts, p) - 1, p - marks[k][0] + marks[k][1])[1] for p in (h.start, h.end - 1)]
                if spot[1] + 1 - spot[0] != h.end - h.start:  # one that lies in a single literal was found above
                    hits.append(Hit(spot[0], spot[1] + 1, spot[0], h.kind))
    return hits


def merged(hits: list[Hit]) -> list[Hit]:
    """Overlapping finds as one."""
    out: list[Hit] = []
    for h in sorted(hits):
        if out and h.start < out[-1].end:
            if h.end > out[-1].end:
                out[-1] = out[-1]._replace(end=h.end)
        else:
            out.append(h)
    return out


def find(text: str | None, final: bool = True, before: str = "") -> list[Hit]:
    """Credentials that a field holds whole. ``before`` tells what stands before it; ``final`` whether it ends with a line."""
    if not text:
        return []
    tail = before[before.rfind("\n") + 1 :]
    hits = merged(_scan(tail + text, False, final))
    return [Hit(h.start - len(tail), h.end - len(tail), h.line_at - len(tail), h.kind) for h in hits if h.start >= len(tail)]


def mask(text: str, hits: list[Hit]) -> str:
    """Each credential in stars, its line ends, quotes and the signs between added literals kept, so that the code stays intact."""
    out, at = [], 0
    for h in hits:
        body = text[h.start : h.end]
        if _GLUE.search(body):
            body = "".join(x if k % 2 else re.sub(r"[^\r\n]", "*", x) for k, x in enumerate(re.split(r"([\"`]\s*\+\s*[\"`])", body)))
        elif h.kind == "bytes":
            body = _NUMBER.sub(lambda m: "'*'" + " " * (len(m[0]) - 3) if m[0][0] == "'" else m[0][:2] + "0" * (len(m[0]) - 2) if m[0][:2] in ("0x", "0X") else "0" * len(m[0]), body)
        elif h.kind == "private_key":
            body = re.sub(r"(-----[A-Z0-9 ]+-----)|[^\r\n\\\"`+\s]", lambda m: m[1] or "*", body)
        else:
            body = re.sub(r"[^\r\n]", "*", body)
        out += [text[at : h.start], body]
        at = h.end
    return "".join([*out, text[at:]])


def fields_of(files: DataFrame, samples: DataFrame) -> DataFrame:
    """(record_table, record_key, field_name, body, lead): the fields that are searched; ``lead`` stands before a target."""
    a = files.select(F.lit("corpus_files").alias("record_table"), F.col("file_id").cast("string").alias("record_key"), F.lit("content").alias("field_name"), F.col("content").alias("body"), F.lit(None).cast("string").alias("lead"))
    s = samples.select("sample_id", "left_context", "target_text")
    fields = F.array(
        F.struct(F.lit("left_context").alias("f"), F.col("left_context").alias("b"), F.lit(None).cast("string").alias("l")),
        F.struct(F.lit("target_text").alias("f"), F.col("target_text").alias("b"), F.substring_index("left_context", "\n", -1).alias("l")),
    )
    b = s.select(F.lit("samples").alias("record_table"), F.col("sample_id").alias("record_key"), F.explode(fields).alias("x")).select("record_table", "record_key", F.col("x.f").alias("field_name"), F.col("x.b").alias("body"), F.col("x.l").alias("lead"))
    return a.unionByName(b).where("body IS NOT NULL AND body <> '' AND record_key IS NOT NULL")


def credentials(fields: DataFrame) -> DataFrame:
    """(record_table, record_key, field_name, line_zero_based, kind): one row per credential; null and empty fields have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, lines, kinds = [], [], []
            names, bodies, leads = (b.column(k).to_pylist() for k in (2, 3, 4))
            for i, (name, body, lead) in enumerate(zip(names, bodies, leads)):
                for h in find(body, name != "left_context", lead or ""):
                    at.append(i)
                    lines.append(body.count("\n", 0, h.line_at))
                    kinds.append(h.kind)
            if at:
                pick = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(pick) for k in range(3)), pa.array(lines, pa.int32()), pa.array(kinds, pa.string())], names=["record_table", "record_key", "field_name", "line_zero_based", "kind"])

    return spread(fields).mapInArrow(run, "record_table string, record_key string, field_name string, line_zero_based int, kind string")


def redacted(fields: DataFrame) -> DataFrame:
    """(record_table, record_key, field_name, credentials, masked) of the fields that hold a credential."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, count, texts = [], [], []
            names, bodies, leads = (b.column(k).to_pylist() for k in (2, 3, 4))
            for i, (name, body, lead) in enumerate(zip(names, bodies, leads)):
                if hits := find(body, name != "left_context", lead or ""):
                    at.append(i)
                    count.append(len(hits))
                    texts.append(mask(body, hits))
            if at:
                pick = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(pick) for k in range(3)), pa.array(count, pa.int32()), pa.array(texts, pa.string())], names=["record_table", "record_key", "field_name", "credentials", "masked"])

    return spread(fields).mapInArrow(run, "record_table string, record_key string, field_name string, credentials int, masked string")
