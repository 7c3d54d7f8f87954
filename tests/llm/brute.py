"""The operators once more, plainly, for small tables. Documents are (doc_id, text) pairs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACES = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def decontaminate(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = bench_words(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i : i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words = bench_words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                got = windows.get(tuple(words[i : i + size]))
                if got:
                    found |= got
                    hit |= set(range(i, i + size))
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def quality(docs, longest_allowed=100, cover=30):
    out = []
    for doc, text in docs:
        text = text or ""
        words = re.findall(SPACES, text)
        lines, dup = set(), 0
        for line in text.split("\n"):
            if re.search(SPACES, line):
                dup += line in lines
                lines.add(line)

        def repeated(size):
            seen = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
            return [i for i in range(len(words) - size + 1) if seen[tuple(words[i : i + size])] > 1]

        hit = {j for i in repeated(8) for j in range(i, i + 8)}
        low, high = 7, len(words)  # longest repeat by bisection
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if repeated(middle) else (low, middle - 1)
        longest = low if low >= 8 else 0
        failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
        kept = not failed and 100 * len(hit) <= cover * len(words) and longest <= longest_allowed
        out.append(
            (doc, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), longest, failed, kept)
        )
    return out


def shingles(text, size=4):
    words = re.findall(SPACES, (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def similar(docs, size=4, percent=85):
    """Rows with ids that are all different and not NULL."""
    sets = [(doc, shingles(text, size)) for doc, text in docs]
    parent = {doc: doc for doc, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for doc, s in sets:
        for x in s:
            holders[x].append(doc)
    by = dict(sets)
    common = Counter()
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(by[a]) + len(by[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return [(doc, len(s), root(doc)) for doc, s in sets]


def shards(docs, n=24):
    """Rows with ids that are all different: (doc_id, size, crc, shard, slot)."""
    size = {doc: len((text or "").encode()) + 8 for doc, text in docs}
    total, before, slots, out = sum(size.values()), 0, Counter(), []
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        shard = before * n // total
        out.append((doc, size[doc], None if text is None else zlib.crc32(text.encode()), shard, slots[shard]))
        slots[shard] += 1
        before += size[doc]
    return out


def repeats(docs, size=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for rows with different ids."""
    least = {}
    data = {doc: (text or "").encode() for doc, text in docs}
    for doc, body in data.items():
        for i in range(len(body) - size + 1):
            key = body[i : i + size]
            if doc < least.get(key, doc + 1):
                least[key] = doc
    out = []
    for doc, body in data.items():
        gone = bytearray(len(body))
        for i in range(len(body) - size + 1):
            if least[body[i : i + size]] < doc:
                gone[i : i + size] = b"\1" * size
        kept = bytes(b for b, g in zip(body, gone) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(body), sum(gone), runs, sha(kept)))
    return out


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def personal(docs):
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256)"""
    out = []
    for doc, text in docs:
        found = [
            [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if valid(kind, m.group())]
            for kind, p in KINDS.items()
        ]
        out.append((doc, *map(len, found), sha(",".join(x for f in found for x in f))))
    return out


# --- lexical search, tokens, importance ------------------------------------------


def search(docs, items, k=10):
    """(item_id, rank, doc_id, score) for items that are all different."""
    held = [(doc, bench_words(text)) for doc, text in docs]
    held = [(doc, Counter(words), len(words)) for doc, words in held if words]
    total, length = len(held), sum(n for _, _, n in held)
    df = Counter(term for _, counts, _ in held for term in counts)
    out = []
    for item, text in items:
        found = []
        for doc, counts, n in held:
            m = 100 - 75 + 75 * n * total // length
            score = 0
            for term in bench_words(text):
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1)))
                    score += w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1):
            out.append((item, rank, doc, -score))
    return out


def tokens(docs, path, pattern):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) by the tokenizer library."""
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    coder = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    out = []
    for doc, text in docs:
        ids = coder.encode_ordinary(text or "")
        out.append((doc, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(text or "")))
    return out


def grams(text):
    words = bench_words(text)
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def importance(docs, targets, buckets=10_000, percent=5):
    """(doc_id, n_features, weight, score, rank); NULL ids count as empty and come last."""

    def placed(text):
        return [zlib.crc32(g.encode()) % buckets for g in grams(text)]

    corpus = Counter(b for _, text in docs for b in placed(text))
    target = Counter(b for text in targets for b in placed(text))
    s, t = sum(corpus.values()), sum(target.values())
    rows = []
    for doc, text in docs:
        found = placed(text)
        weight = sum(
            math.floor(1000 * math.log((target[b] + 1) * (s + buckets) / ((corpus[b] + 1) * (t + buckets)))) for b in found
        )
        h = int(sha(f"42:{'' if doc is None else doc}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(found), weight, score, len(bench_words(text))))
    may = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(may) // 100
    return [(*r[:4], i if i <= drawn else None) for i, r in enumerate(may, 1)] + [(*r[:4], None) for r in rows if r[4] < 20]


def licences(docs, sentences, rules, most_between):
    """(doc, sentences, licences, spans): the longest sentence at a place, none within another, rules in order."""
    known = {}
    for name, wordings in sentences.items():
        for wording in [wordings] if isinstance(wordings, str) else wordings:
            known.setdefault(tuple(wording.split()), name)
    lengths = sorted({len(w) for w in known}, reverse=True)
    out = []
    for doc, text in docs:
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOWER))
        found, reached = [], 0
        for i in range(len(words)):
            n = next((n for n in lengths if tuple(words[i : i + n]) in known and i + n <= len(words)), 0)
            if n and i + n > reached:
                reached = i + n
                found.append((i, reached, known[tuple(words[i:reached])]))
        left, matched = list(found), []
        for name, wanted in rules:
            for first in [s for s in left if s[2] == wanted[0]]:
                chain = [first]
                for identifier in wanted[1:]:
                    gaps = [(s[0] - chain[-1][1], s) for s in left if s > chain[-1] and s[2] == identifier]
                    chain += [s for gap, s in gaps if 0 <= gap <= most_between][:1]
                if first in left and len(chain) == len(wanted):
                    left = [s for s in left if s not in chain]
                    matched.append((name, first[0], chain[-1][1]))
        matched.sort(key=lambda m: (m[1], m[0]))
        spans = ",".join(f"{n}:{a}:{b}" for n, a, b in matched)
        out.append((doc, len(found), len(matched), ",".join(sorted({m[0] for m in matched})), spans))
    return out


def mixing_targets(docs, limit=3):
    """(doc, size, source_size, target) of (doc, source, text): one level for all sources, found by bisection."""
    size = {doc: len(re.findall(SPACES, text or "")) for doc, _, text in docs}
    total = Counter()
    for doc, source, _ in docs:
        total[source] += size[doc]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {source: place % 3 + 1 for place, source in enumerate(order)}
    low, high = 0.0, float(limit * sum(total.values()) + 1)
    for _ in range(200):
        level = (low + high) / 2
        given = sum(min(limit * total[s], level * weight[s]) for s in total)
        low, high = (level, high) if given < sum(total.values()) else (low, level)
    return {doc: (size[doc], total[s], min(limit * total[s], low * weight[s])) for doc, s, _ in docs}
