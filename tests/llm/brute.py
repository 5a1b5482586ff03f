"""Plain-Python versions of what the queries return, for small tables."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
SECRETS = {
    "assign": re.compile(
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_ok(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def pii_spans(text):
    return [(k, m.start(), m.end()) for k, p in PII.items() for m in p.finditer(text or "") if pii_ok(k, m[0])]


def secret_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(SECRETS.items()):
        for m in pattern.finditer(text or ""):
            if len({"assign": m[2] if kind == "assign" else "", "access": m[0][:-6], "hex": m[0][:-4]}[kind]) >= 12:
                found.append((m.start(), rank, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
