"""Plain restatements of the contracts, one document at a time."""

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLACK = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def repeats(docs, size=50):
    """op1 rows for ``(doc_id, text)`` pairs."""
    least, rows = {}, []
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, b in raw:
        for i in range(len(b) - size + 1):
            k = b[i : i + size]
            least[k] = min(least.get(k, d), d)
    for d, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - size + 1):
            if least[b[i : i + size]] < d:
                gone[i : i + size] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        left = bytes(x for x, g in zip(b, gone) if not g)
        rows.append((d, len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(left).hexdigest()))
    return rows


def licences(text):
    """op4 base columns."""
    w = ALNUM.findall(lower(text))
    places = []
    for label, phrase in (("apache", "apache license"), ("gpl", "general public license"), ("mit", "mit license")):
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(sorted({x for _, x in places}))


def fingerprint(text):
    """op6 fingerprint."""
    w = BLACK.findall(lower(text))
    s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints):
    """Least doc_id reachable over links of at most two bits, for ``(doc_id, fingerprint)`` pairs."""
    root = {f: f for _, f in prints}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    fs = sorted(root)
    arr = np.array(fs, np.uint64)
    for i, f in enumerate(fs):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= 2):
            root[find(fs[i + 1 + j])] = find(f)
    least = {}
    for d, f in prints:
        r = find(f)
        least[r] = min(least.get(r, d), d)
    return [(d, least[find(f)]) for d, f in prints]


def quality(text):
    """op7 base columns."""
    text = text or ""
    w = BLACK.findall(text)
    lines = [x for x in text.split("\n") if BLACK.search(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def personal(text):
    """op8 base spans."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x[-4:]) <= 255 and int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    n = Counter(k for _, _, k, _ in out)
    spans = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))
    return n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(spans.encode()).hexdigest(), spans


def leaks(docs, items, size=10):
    """op9 rows for ``(doc_id, text)`` and ``(item_id, text)`` pairs."""
    windows = {}
    for i, t in items:
        w = ALNUM.findall(lower(t))
        k = min(size, len(w))
        for s in range(len(w) - k + 1) if k else ():
            windows.setdefault(tuple(w[s : s + k]), set()).add(str(i))
    sizes = sorted({len(x) for x in windows})
    rows = []
    for d, t in docs:
        w = ALNUM.findall(lower(t))
        hit, found = set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                own = windows.get(tuple(w[s : s + k]))
                if own:
                    hit.update(range(s, s + k))
                    found |= own
        rows.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return rows


def crc_ids(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def nearest(rows, k=5, scale=256):
    """op11 rows for ``(vec_id, vector)`` pairs."""
    usable = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, tuple(math.floor(scale * x) for x in v)))
    out = []
    for q, v in set(usable):
        if q % 50 == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near[:k])]
    return out


def resampled(docs, items, run=1):
    """op12 rows for ``(doc_id, text)`` and ``(item_id, text)`` pairs; equal rows may swap ranks."""
    def feats(text):
        w = ALNUM.findall(lower(text))
        return len(w), [" ".join(w[i : i + k]) for k in range(1, run + 1) for i in range(len(w) - k + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    s, t = Counter(), Counter()
    for c, rows in ((s, docs), (t, items)):
        for _, text in rows:
            c.update(map(bucket, feats(text)[1]))
    big_s, big_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    out = []
    for d, text in docs:
        n, f = feats(text)
        weight = sum(math.floor(1000 * math.log(((t[b] + 1) * big_s) / ((s[b] + 1) * big_t))) for b in map(bucket, f))
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2], r[1]))
    rank = {}
    for i, r in enumerate(able[: len(able) * 10 // 100]):
        rank.setdefault(r, []).append(i + 1)
    return [(r[0], r[2], r[3], r[4], rank[r].pop() if rank.get(r) else None) for r in out]


def mended(roles_faults):
    """Cheapest audit by uniform-cost search over whole edit strings, for ``(initial, must_delete, truncated)`` rows."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        if i == len(roles_faults) and re.fullmatch("(s?(ua)+)?", out):
            return cost, audit, out
        if (i, out) in done or len(out) > len(roles_faults) + 3:
            continue
        done.add((i, out))
        nxt = [(3, "I", i, out + x) for x in "ua"]
        if i < len(roles_faults):
            initial, must, cut = roles_faults[i]
            nxt.append((4, "D", i + 1, out))
            if not must:
                nxt.append((3 * cut, "K", i + 1, out + initial))
                nxt += [(3 + 3 * cut, "R", i + 1, out + x) for x in "ua"]
        for c, letter, j, o in nxt:
            if re.fullmatch("s?(ua)*u?", o):
                heapq.heappush(heap, (cost + c, audit + letter, j, o))
    raise AssertionError


def conversations(rows):
    """op13 rows for ``(conv_id, turn, role, text)`` tuples."""
    groups = {}
    for c, turn, role, text in rows:
        own = groups.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for c, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in own:
            black = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not black else "duplicate" if (role, text) in seen else "truncated" if black[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[:1] or "-" for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, roles = mended([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults)])
        left, names, lines = iter(own), {"u": "user", "a": "assistant"}, []
        new = iter(roles)
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter != "D":
                x = next(new)
                lines.append(f"{row[1] if letter == 'K' else names[x]}:{row[2] if row else ''}")
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def alike(docs, size=5):
    """Least doc_id of the near-copy group of each ``(doc_id, text)``: components of Jaccard 4/5 or more over five-word shingle sets."""
    sets = {}
    for d, text in docs:
        w = BLACK.findall(lower(text))
        key = frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()
        sets.setdefault(key, set()).add(d)
    own = list(sets)
    group = {k: {i} for i, k in enumerate(own)}
    for i, x in enumerate(own):
        for y in own[:i]:
            common = len(x & y)
            if 5 * common >= 4 * (len(x) + len(y) - common) and group[x] is not group[y]:
                group[x] |= group[y]
                for j in group[y]:
                    group[own[j]] = group[x]
    return {d: min(min(sets[own[j]]) for j in group[k]) for k, ds in sets.items() for d in ds}
