"""Plain versions that several tests compare with."""

import re

import xxhash


def simhash_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def pii_spans(text):
    """Base spans as ``(start, kind, end)`` in the order of starts and kinds."""
    spans = []
    for i, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 10 <= len(d) <= 15:
                continue
            spans.append((m.start(), i, kind, m.end()))
    return [(s, kind, e) for s, _, kind, e in sorted(spans)]
