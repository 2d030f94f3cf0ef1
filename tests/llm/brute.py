"""Brute-force versions of the operators: plain Python over a handful of rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# op1 ------------------------------------------------------------------------

def unigram_count(word, cost, longest, byte_cost):
    best = [(0.0, 0)]
    for e in range(1, len(word) + 1):
        n = len(word[e - 1].encode())
        c = (best[e - 1][0] + byte_cost * n, best[e - 1][1] + n)
        for a in range(max(0, e - longest), e):
            if word[a:e] in cost:
                c = min(c, (best[a][0] + cost[word[a:e]], best[a][1] + 1))
        best.append(c)
    return best[-1][1]


# op2 ------------------------------------------------------------------------

def shingle_set(text, n):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def near_groups(rows, n, percent):
    """[(doc_id, n_shingles, component_id, kept)] of (doc_id, text) rows."""
    sets = [shingle_set(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in ids[find(i)] if x is not None]
        c = d if not sets[i] else (min(known) if known else None)
        out.append((d, len(sets[i]), c, d == c))
    return out


# op3 ------------------------------------------------------------------------

def benchmark_hits(rows, items, n):
    """[(doc_id, n_words, n_hit, item ids sorted as strings)]."""
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[i:i + n])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for d, text in rows:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                key = tuple(w[i:i + size])
                if key in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        out.append((d, len(w), len(hit), sorted(found)))
    return out


# op5 ------------------------------------------------------------------------

def without_repeats(rows, n):
    """[(doc_id, n_words, n_removed, kept text)]; a null id is larger than all others."""
    first = {}
    key = lambda d: math.inf if d is None else d
    texts = [(d, words(t)) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - n + 1):
            g = tuple(w[i:i + n])
            first[g] = min(first.get(g, math.inf), key(d))
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < key(d):
                gone.update(range(i, i + n))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), " ".join(kept)))
    return out


# op6 ------------------------------------------------------------------------

def quality(rows, r):
    """[(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)] of (doc_id, source, text)."""
    norm = lambda line: " ".join(words(line.translate(LOWER)))
    on_line, hosts, first = defaultdict(set), defaultdict(set), {}
    key = lambda d: -math.inf if d is None else d
    for d, s, t in rows:
        hosts[s].add(t)
        for line in (t or "").split("\n"):
            if words(line):
                k = (s, norm(line))
                on_line[k].add(t)
                first[k] = min(first.get(k, math.inf), key(d))
    over = {k for k, ts in on_line.items() if len(ts) > r.line_docs and len(ts) > len(hosts[k[0]]) * r.line_share}
    out = []
    for d, s, t in rows:
        w = words(t)
        grams = Counter(tuple(w[i:i + r.window]) for i in range(len(w) - r.window + 1))
        rep = {i + k for i in range(len(w) - r.window + 1) if grams[tuple(w[i:i + r.window])] > 1 for k in range(r.window)}
        seen, dup, gone = set(), 0, 0
        for line in (t or "").split("\n"):
            if not words(line):
                continue
            dup += line in seen
            seen.add(line)
            if (s, norm(line)) in over and first[(s, norm(line))] != key(d):
                gone += len(words(line))
        failed = len(w) < r.min_words or 100 * len(rep) > r.repeat_share * len(w)
        left = len(w) - gone
        depleted = gone > 0 and (left < r.min_words or left < r.left_share * len(w))
        out.append((d, len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), dup, len(rep), failed,
                    not failed and not depleted))
    return out


# op9 ------------------------------------------------------------------------

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
PII_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), m.group()))
    return sorted(out)


def pii_keys(kind, value):
    """What a span is counted under: the entity and the parts it shares with others."""
    value, digits = value.translate(LOWER), re.sub("[^0-9]", "", value)
    out = {f"{kind}:{value}"}
    if kind == 0:
        out |= {"domain:" + value.rsplit("@", 1)[1]} | {"local:" + w for w in PII_WORD.findall(value.split("@")[0]) if len(w) >= 3}
    elif kind == 1:
        out.add("net:" + ".".join(value.split(".")[:3]))
    elif kind == 2:
        out.add("issuer:" + digits[:6])
    else:
        out.add("block:" + digits[:-4])
    return out


def pii_spans(rows, d):
    """{(doc_id, text): [(start, kind, end)]} with the disclosing terms (kind 4): words of whole texts, counted against
    entities and parts of entities over all distinct texts; spans wherever a word stands in a text that holds the entity."""
    texts = sorted({t or "" for _, t in rows})
    n, base, clear, held = len(texts), {}, {}, {}
    for t in texts:
        base[t], masked = base_spans(t), list(t)
        for s, _, e, _ in base[t]:
            masked[s:e] = " " * (e - s)
        clear[t] = "".join(masked).translate(LOWER)
        held[t] = set().union(*(pii_keys(k, v) for _, k, _, v in base[t])) if base[t] else set()
    n_e = Counter(e for t in texts for e in held[t])
    n_t = Counter(w for t in texts for w in set(PII_WORD.findall(t.translate(LOWER))))
    n_et = Counter((e, w) for t in texts for w in {w for w in PII_WORD.findall(clear[t]) if len(w) >= d.min_chars}
                   for e in held[t] if n_e[e] >= d.min_support)
    told = defaultdict(set)
    for (e, w), k in n_et.items():
        if k >= d.min_support and n_e[e] < n and math.log(k * n / (n_e[e] * n_t[w])) / math.log(n / n_e[e]) >= d.alpha:
            told[e].add(w)
    extra = {t: {(m.start(), 4, m.end()) for m in PII_WORD.finditer(clear[t]) if any(m.group() in told[e] for e in held[t])} for t in texts}
    return {(i, t or ""): sorted({x[:3] for x in base[t or ""]} | extra[t or ""]) for i, t in rows}
