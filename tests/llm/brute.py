"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict


def lower_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def letters(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingles(text, size=5):
    w = lower_words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def classes(rows):
    """{id: smallest id that links reach} for (id, text)."""
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for n, (i, s) in enumerate(sets):
        for j, t in sets[:n]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i, _ in rows}


def katz(rows, k, kept_of, kept_above):
    """(id, held, n_tokens, n_known, N, base, score) for (id, text, held)."""
    texts = [(i, [*lower_words(t), None], h) for i, t, h in rows]
    words, pairs = Counter(), Counter()
    for _, t, h in texts:
        if not h:
            words.update(t)
            pairs.update(zip(["\0", *t[:-1]], t))
    n, outcomes = sum(words.values()), sum(words.values()) + len(words) + 1
    times = Counter(pairs.values())
    kept = kept_of([times[r] for r in range(1, k + 2)])
    count, mass, lower = Counter(), defaultdict(float), Counter()
    keep = lambda r: kept[r - 1] if r <= k else r - kept_above
    for (h, w), r in pairs.items():
        count[h] += r
        mass[h] += r - keep(r)
        lower[h] += words[w] + 1

    def p(h, w):
        base = (words.get(w, 0) + 1) / outcomes
        if pairs.get((h, w)):
            return keep(pairs[h, w]) / count[h]
        return mass[h] / count[h] / (1 - lower[h] / outcomes) * base if h in count else base

    for h in list(count)[:20]:
        assert abs(sum(p(h, w) for w in words) + p(h, "unknown\0") - 1) < 1e-9
    base = lambda t: sum(math.log10((words.get(w, 0) + 1) / outcomes) for w in t)
    return [(i, h, len(t), sum(w in words for w in t), n, base(t), sum(math.log10(p(a, b)) for a, b in zip(["\0", *t[:-1]], t))) for i, t, h in texts]


def leaks(rows, items, similarity=0.8):
    """{(id, item): similarity} of windows of as many words as the item."""
    words = {i: lower_words(t) for i, t in items if lower_words(t)}
    size = {i: min(5, len(w)) for i, w in words.items()}
    cut = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    own = {i: cut(w, size[i]) for i, w in words.items()}
    holders = Counter(s for x in own.values() for s in x)
    weigh = lambda x: sum(math.log(1 + len(own) / max(1, holders[s])) for s in x)
    out = {}
    for i, t in rows:
        w = lower_words(t)
        for item, theirs in own.items():
            n = min(len(words[item]), len(w))
            for a in range(len(w) - n + 1):
                mine = cut(w[a : a + n], size[item])
                if mine & theirs:
                    alike = weigh(mine & theirs) / weigh(mine | theirs)
                    if alike >= similarity - 1e-12:
                        out[i, item] = max(alike, out.get((i, item), 0))
    return out


def novel_spans(text, taken, novelty, sensitive, reach, novel, letters_only):
    """Runs of 12 or more key characters (up to two '=' of padding among them) that begin in reach of a sensitive word, taken one by one."""
    key = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
    ends = [m.end() for m in sensitive.finditer(text)]
    out, at = [], 0
    while at < len(text):
        if text[at] not in key:
            at += 1
            continue
        start = at
        while at < len(text) and text[at] in key:
            at += 1
        pads = len(text[at:]) - len(text[at:].lstrip("="))
        padded = 1 <= pads <= 2 and text[at + pads : at + pads + 1] not in key
        end = at + pads if padded else at
        run = text[start:end]
        # a word reaches a run that begins behind it
        if len(run) < 12 or len(run.rstrip("=")) < 10 or not any(0 <= start - e <= reach for e in ends):
            continue
        digits, alphas = any(c.isdigit() for c in run), any(c.isalpha() for c in run)
        varied = digits or (run[1:] != run[1:].lower() and run != run.upper())
        free = all(b <= start or end <= a for _, a, b in taken)
        if varied and free and novelty.marginal(text, start, end) >= (novel if digits and alphas else letters_only) * len(run):
            out.append(("novel", start, end))
    return out


def notices(text, templates, share):
    """{(license, template): best share} of runs of words as long as twice the template, without regard to families."""
    cut = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    words = re.findall(r"[^\W_]+", (text or "").lower())
    found = {}
    for name, own in templates.items():
        for k, t in enumerate(own):
            theirs = cut(re.findall(r"[^\W_]+", t.lower()))
            width = 1
            while width < len(theirs):
                width *= 2
            for at in range(0, max(1, len(words) - 4), width):
                alike = len(cut(words[at : at + 2 * width + 4]) & theirs) / len(theirs)
                if alike >= share:
                    found[name, k] = max(alike, found.get((name, k), 0))
    return found
