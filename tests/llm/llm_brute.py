"""Plain definitions of the results, one text and one pair at a time."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return BLANK_WORD.findall(text or "")


def quality_base(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if BLANK_WORD.search(x)]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            covered |= set(range(i, i + 8))
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": len(w) < 20 or 100 * len(covered) > 30 * len(w)}


def normal_lines(text):
    return [tuple(words(x.translate(LOWER))) for x in (text or "").split("\n") if BLANK_WORD.search(x)]


def quality_kept(docs, share, min_docs, min_left):
    """docs: (doc_id, text, source) rows; kept flag of each row."""
    hosts, held = defaultdict(set), defaultdict(set)
    for _, text, source in docs:
        content = tuple(normal_lines(text))
        hosts[source].add(content)
        for line in set(content):
            held[source, line].add(content)
    out = []
    for _, text, source in docs:
        base = quality_base(text)
        gone = sum(len(x) for x in normal_lines(text)
                   if len(held[source, x]) >= min_docs and len(held[source, x]) > share * len(hosts[source]))
        out.append(not base["base_failed"] and base["n_words"] - gone >= min_left * base["n_words"])
    return out


def cleaned_lines(docs, ratio, min_pages):
    """docs: (doc_id, text, source) rows; the text of each row without boilerplate."""
    pages, held = Counter(), Counter()
    for _, text, source in docs:
        pages[source] += 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            held[source, line] += 1
    out = []
    for _, text, source in docs:
        if text is None:
            out.append(None)
            continue
        out.append("\n".join(x for x in text.split("\n") if not (
            held[source, x.strip(" ")] >= min_pages and held[source, x.strip(" ")] > ratio * pages[source])))
    return out


def fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, max_bits=3):
    """prints: (doc_id, fingerprint) pairs; component id of each fingerprint."""
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    least = {}
    for d, p in prints:
        r = find(p)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return {p: least.get(find(p)) for p in distinct}


def item_windows(items):
    out = defaultdict(set)
    for item, text in items:
        w = LETTER_WORD.findall((text or "").translate(LOWER))
        for a in range(max(1, len(w) - 12) if w else 0):
            out[tuple(w[a:a + 13])].add(None if item is None else str(item))
    return out


def contamination(text, windows):
    w = LETTER_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for n in {len(x) for x in windows}:
        for a in range(len(w) - n + 1):
            if tuple(w[a:a + n]) in windows:
                hit |= set(range(a, a + n))
                found |= windows[tuple(w[a:a + n])]
    found = sorted(found - {None})
    return (len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(),
            bool(hit) and 20 * len(hit) >= len(w))
