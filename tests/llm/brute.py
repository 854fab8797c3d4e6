"""Plain Python versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter

import xxhash

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# ---- quality rules


def quality_counts(text):
    text = text or ""
    w = BLANK.findall(text)
    lines = [x for x in text.split("\n") if BLANK.search(x)]
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(grams)
    marked = set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            marked.update(range(i, i + 8))
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(marked),
        "base_failed": len(w) < 20 or 100 * len(marked) > 30 * len(w),
    }


def cells(text, buckets):
    h = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) for x in BLANK.findall(text or "")]
    pair = lambda a, b: signed(xxh_long(b, unsigned(xxh_long(a, 42))))
    return [x % buckets for x in h] + [pair(a, b) % buckets for a, b in itertools.pairwise(h)]


def unsigned(x):
    return x & (2**64 - 1)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def xxh_long(value, seed):
    """Spark's hash of a long is XXH64 of its eight bytes."""
    return signed(xxhash.xxh64_intdigest(unsigned(value).to_bytes(8, "little"), seed))


def log_ratio(raw, good, buckets, alpha):
    nr, ng = sum(raw.values()), sum(good.values())
    return [
        math.log((good[b] + alpha) / (ng + alpha * buckets)) - math.log((raw[b] + alpha) / (nr + alpha * buckets))
        for b in range(buckets)
    ]


def quality_scores(texts, trusted, buckets, alpha):
    """``texts``: by doc_id."""
    all_cells = {k: cells(t, buckets) for k, t in texts.items()}
    raw, good = Counter(), Counter()
    for k, c in all_cells.items():
        raw.update(c)
        if k in trusted:
            good.update(c)
    ratio = log_ratio(raw, good, buckets, alpha)
    return {k: (sum(ratio[b] for b in c) / len(c) if c else 0.0) for k, c in all_cells.items()}


def quality_limit(texts, trusted, part, parts, share, grid, buckets, alpha):
    """Limit from the trusted texts, each scored without its part. ``trusted``:
    places in ``texts``; ``part``: the part of a place."""
    all_cells = {k: cells(t, buckets) for k, t in texts.items()}
    raw = Counter(b for c in all_cells.values() for b in c)
    scores = []
    for out in range(parts):
        ratio = log_ratio(raw, Counter(b for k in trusted if part(k) != out for b in all_cells[k]), buckets, alpha)
        scores += [
            sum(ratio[b] for b in all_cells[k]) / len(all_cells[k])
            for k in trusted if part(k) == out and not quality_counts(texts[k])["base_failed"]
        ]
    scores.sort()
    return math.floor(scores[math.floor(share * len(scores))] * grid) / grid if scores else -math.inf


def part_of(doc_id, parts):
    """As the operator deals ids: XXH64 of the id, then of the word."""
    return signed(xxhash.xxh64_intdigest(b"held", unsigned(xxh_long(doc_id, 42)))) % parts


# ---- decontamination


def contamination(docs, items, n=10):
    """``docs``, ``items``: lists of (id, text). One row for each document."""
    windows = {}
    for item, text in items:
        w = ITEM.findall(ascii_lower(text))
        grams = [tuple(w)] if 0 < len(w) < n else [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        for g in grams:
            windows.setdefault(g, set()).update([] if item is None else [str(item)])
    sizes = {len(g) for g in windows}
    out = []
    for doc, text in docs:
        w = ITEM.findall(ascii_lower(text))
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (g := tuple(w[i : i + k])) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[g]
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


# ---- SimHash


def simhash(text):
    w = BLANK.findall(ascii_lower(text))
    grams = [" ".join(w)] if 0 < len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, fps, distance=3):
    """Least id reachable, for each place."""
    label = list(range(len(ids)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= distance and root(i) != root(j):
            label[root(i)] = root(j)
    least = {}
    for i, k in enumerate(ids):
        r = root(i)
        if k is not None and (least.get(r) is None or k < least[r]):
            least[r] = k
    return [least.get(root(i)) for i in range(len(ids))]


# ---- secrets

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def entropy(s):
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def entropy_spans(text, classes, allowed_patterns, allowed_texts, window):
    out = []
    for k, c in enumerate(classes):
        for m in re.finditer(c.pattern, text or ""):
            s = m[0].lower() if c.fold else m[0]
            if m[0].lower() in allowed_texts or any(re.search(p, m[0]) for p in allowed_patterns):
                continue
            joined = []
            for i in range(len(s) - window + 1):
                if entropy(s[i : i + window]) >= c.bits - 1e-9:
                    if joined and joined[-1][1] >= i:
                        joined[-1][1] = i + window
                    else:
                        joined.append([i, i + window])
            out += [(m.start() + a, 3 + k, m.start() + b, c.kind) for a, b in joined]
    return out


def listed(spans):
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(spans))


def redacted(text, spans, mark="[SECRET]"):
    joined = []
    for s, _, e, _ in sorted(spans):
        if joined and s <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], e)
        else:
            joined.append([s, e])
    for s, e in reversed(joined):
        text = text[:s] + mark + text[e:]
    return text


# ---- archives


def archive_rows(pages):
    """``pages``: (page_id, html); rows by page."""
    import base64

    first = {}
    for k, html in pages:
        p = (html or "").encode()
        if p not in first or (k is not None and (first[p] is None or k < first[p])):
            first[p] = k
    out = []
    for k, html in pages:
        p = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        own = k == first[p]
        out.append((k, len(p), digest, "response" if own else "revisit", None if own else first[p]))
    return out


# ---- fill in the middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fill_in_middle(doc_id, text):
    text = text or ""
    parts = [m[0] for m in UNIT.finditer(text)]
    n, digest = len(parts), sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (parts[:a], parts[a:b], parts[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


# ---- source divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(table, min_docs=3, top=200):
    """Rows (lang, source, part, item, value, rank) of rows (text, lang, source)."""
    table = [tuple(v or "" for v in r) for r in table]
    counts, in_docs = {}, Counter()
    for text, lang, source in table:
        words = TERM.findall(ascii_lower(text))
        counts.setdefault((lang, source), Counter()).update(words)
        in_docs.update({(lang, w) for w in words})
    out = []
    for lang in {k[0] for k in counts}:
        kept = [w for (of, w), n in in_docs.items() if of == lang and n >= min_docs]
        groups = {s: c for (of, s), c in counts.items() if of == lang}
        whole = Counter()
        for c in groups.values():
            whole.update({w: c[w] for w in kept})

        def shares(c, kept=kept):
            total = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 1) // (total + len(kept)) for w in kept}

        q, p = shares(whole), {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(sum((p[s][w] - p[t][w]) ** 2 // p[t][w] for w in kept), t) for t in groups if t != s]
            terms = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in kept if groups[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(order, 1)]
    return sorted(out)


# ---- embedding near-duplicates


def embedding_links(rows, threshold=0.9):
    """Rows (vec_id, n_links, component_id, kept) of (vec_id, vector)."""
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    links = [set() for _ in rows]
    for i, j in itertools.combinations([k for k, x in enumerate(ok) if x], 2):
        a, b = rows[i][1], rows[j][1]
        if len(a) == len(b) and math.fsum(x * y for x, y in zip(a, b, strict=True)) / (math.hypot(*a) * math.hypot(*b)) >= threshold:
            links[i].add(j)
            links[j].add(i)
    name = [None] * len(rows)
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        name[i] = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
    return [(r[0], len(k), c, r[0] == c) for r, k, c in zip(rows, links, name, strict=True)]
