"""The plain meaning of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

_BASE_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BASE_SECRETS = {
    "assign": r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _holds(kind: str, m: re.Match) -> bool:
    surface = m.group()
    digits = re.sub("[^0-9]", "", surface)
    if kind == "ip":
        return all(int(p) <= 255 for p in surface.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "assign":
        return len(m.group(1)) >= 6
    if kind == "access":
        return len(surface) >= 20
    if kind == "hex":
        return len(surface) >= 24
    return True


def base_spans(text: str | None, secrets: bool = False) -> tuple[list[int], str]:
    """Counts by kind, digest of the joined spans."""
    rules = _BASE_SECRETS if secrets else _BASE_PII
    found = []
    for rank, (kind, pattern) in enumerate(rules.items()):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if _holds(kind, m)]
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
    return [sum(f[2] == k for f in found) for k in rules], hashlib.sha256(joined.encode()).hexdigest()


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())


def mix_targets(sizes: dict[str | None, int], weights: tuple[int, ...] = (1, 2, 3)) -> dict[str | None, float]:
    """Targets by source: shares by weight, stopped at 3 times the size, the excess shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in held)
        whole = sum(weight[s] for s in order if s not in held)
        share = {s: 3.0 * sizes[s] if s in held else rest * weight[s] / whole for s in order}
        above = {s for s in order if s not in held and share[s] > 3 * sizes[s]}
        if not above:
            return share
        held |= above


def shingles(text: str | None) -> frozenset[tuple[str, ...]]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def components(ids: list[int], linked: list[tuple[int, int]]) -> dict[int, int]:
    """Smallest id reachable over links."""
    root = {i: i for i in ids}

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_classes(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """Set size and component by document."""
    sets = {i: shingles(t) for i, t in texts.items()}
    by: dict[tuple[str, ...], list[int]] = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in by.values() for k, a in enumerate(ids) for b in ids[k + 1 :]}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = components(list(texts), links)
    return {i: (len(sets[i]), root[i]) for i in texts}
