"""Plain versions of what the operators compute, on lists in memory."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(_LOWER))


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for found in holders.values() for a in found for b in found if a < b}
    alike = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    roots = components(sets, alike)
    return {i: (len(s), roots[i], roots[i] == i) for i, s in sets.items()}


def contained(docs, items):
    found = {}
    for i, text in docs.items():
        own = shingles(text) if len(words(text)) >= 5 else set()
        for j, item in items.items():
            wanted = shingles(item) if len(words(item)) >= 5 else set()
            shared = len(own & wanted)
            if wanted and 100 * shared >= 75 * len(wanted):
                found[i, j] = (len(wanted), shared)
    return found


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)"""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {p for found in windows.values() if len(found) > 1 for i in found for p in range(i, i + 8)}
    chars = sum(map(len, w))
    symbols = sum(c in "#*$%&|<>" for c in text)
    again = len(lines) - len(set(lines))
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    more = (
        10 * symbols > 3 * len(w)
        or 2 * sum("A" <= c <= "Z" for c in text) > chars
        or 2 * again > len(lines)
        or not 2 * len(w) <= chars <= 20 * len(w)
    )
    return len(w), chars, symbols, again, len(covered), failed, not failed and not more


def base_secrets(text):
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [("assign", m.start(), m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 12]
    spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    order = ["assign", "access", "hex"]
    return sorted(spans, key=lambda s: (s[1], order.index(s[0])))
