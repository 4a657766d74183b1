"""Brute-force versions of the operators, in plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    found = WORD.findall(text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found] if lower else found


def crc(doc_id, n):
    return zlib.crc32((str(doc_id) if doc_id is not None else "").encode()) % n


def jaccard_groups(rows, k=3, percent=90):
    """rows: (doc_id, text), ids distinct and not null. doc_id -> (n, component, links)."""
    sets = {}
    for i, t in rows:
        w = words(t, True)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    ids, up, links = sorted(sets), {i: i for i in sets}, Counter()

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: (len(sets[i]), root(i), links[i]) for i in ids}


KINDS = {
    "assign": (re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def secrets(text):
    found = [(m.start(), k, name, m.end()) for k, (name, (p, g, n)) in enumerate(KINDS.items()) for m in p.finditer(text or "") if len(m[g]) >= n]
    base = ",".join(f"{name}:{a}:{b}" for a, _, name, b in sorted(found))
    count = Counter(x[2] for x in found)
    return count["assign"], count["access"], count["hex"], hashlib.sha256(base.encode()).hexdigest(), base


def targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: source -> words. Reshares the excess until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in over}


def sainte_lague(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = min((k for k in votes if votes[k] > 0), key=lambda k: (-votes[k] / (2 * won[k] + 1), k), default=None)
        if best is None:
            break
        won[best] += 1
    return won


def rule_counts(text):
    w, t = words(text), text or ""
    lines = [x for x in t.split("\n") if WORD.search(x)]
    runs = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed


def buckets(text, bits=16):
    h = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words(text)]
    two = [xxhash.xxh64(b.to_bytes(8, "little"), seed=xxhash.xxh64(a.to_bytes(8, "little"), seed=42).intdigest()).intdigest() for a, b in zip(h, h[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(x) % (1 << bits) for x in [*h, *two]]


def ratios(docs, good, pseudo=5.0):
    raw, target = Counter(), Counter()
    for i, t in docs:
        own = buckets(t)
        raw.update(own)
        if i in good:
            target.update(own)
    r, t = sum(raw.values()), sum(target.values())
    return {b: round((1 << 20) * math.log((target[b] + pseudo) / (n / r * t + pseudo))) if t else 0 for b, n in raw.items()}


def verdict(text, known, threshold):
    own = buckets(text)
    return not rule_counts(text)[-1] and sum(known[b] for b in own) >= round(threshold * (1 << 20)) * len(own)


def language_model(docs):
    """doc_id -> held_out, tokens, known, base, score; docs: (doc_id, text), ids distinct."""
    END, START = "</s>", "<s>"
    tokens = {i: [*words(t, True), END] for i, t in docs}
    counts = {k: [Counter(), Counter(), Counter()] for k in ("kept", "all")}
    starts = {"kept": 0, "all": 0}

    def windows(w):
        return zip([START, START, *w], [START, *w], w)

    for i, w in tokens.items():
        for which, used in (("kept", crc(i, 10) > 1), ("all", crc(i, 10) > 0)):
            if used:
                one, two, three = counts[which]
                one.update(w)
                two.update((b, c) for _, b, c in windows(w))
                three.update(windows(w))
                starts[which] += 1
    n, v = sum(counts["all"][0].values()), len(counts["all"][0])
    nk = sum(counts["kept"][0].values())

    def parts(which, total, a, b, c):
        one, two, three = counts[which]
        of_two = starts[which] if b == START else (two[a, b])
        of_one = starts[which] if b == START else one[b]
        state = min(of_two.bit_length(), 20) if of_two else 32 + of_one.bit_length()
        return state, three[a, b, c] / of_two if of_two else 0.0, two[b, c] / of_one if of_one else 0.0, one[c] / total if total else 0.0

    held = defaultdict(list)
    for i, w in tokens.items():
        if crc(i, 10) == 1 and nk:
            for a, b, c in windows(w):
                state, p3, p2, p1 = parts("kept", nk, a, b, c)
                held[state].append((p3 * (v + 1), p2 * (v + 1), p1 * (v + 1), 1.0))
    mixture = {}
    for state in range(64):
        first = (0.0, 0.0, 0.9, 0.1) if state in (0, 32) else (0.0, 0.4, 0.5, 0.1) if state > 32 else (0.4, 0.3, 0.2, 0.1)
        w = first if state in (0, 1, 32, 33) or held[state] else mixture[state - 1]
        for _ in range(30 if held[state] else 0):
            sums = [0.0] * 4
            for x in held[state]:
                z = sum(p * q for p, q in zip(w, x))
                sums = [s + p * q / z for s, p, q in zip(sums, w, x)]
            w = tuple(s / len(held[state]) for s in sums)
        mixture[state] = w
    out = {}
    for i, w in tokens.items():
        score = base = 0.0
        for a, b, c in windows(w):
            state, *p = parts("all", n, a, b, c)
            m = (*mixture[state][:3], max(mixture[state][3], 1e-6))
            if not n:
                m = (0.0, 0.0, 0.0, 1.0)
            score += math.log10((sum(x * y for x, y in zip(m, p)) + m[3] / (v + 1)) / sum(m))
            base += math.log10((counts["all"][0][c] + 0.1) / (n + 0.1 * (v + 1)))
        out[i] = (crc(i, 10) == 0, len(w), sum(counts["all"][0][x] > 0 for x in w), n, base, score)
    return out


def quotation_links(rows):
    """rows: (conv, turn, text). {(conv, turn): [(depth, original or None) per passage]}; direct comparison of lines."""
    flat = lambda x: " ".join(x.casefold().split())

    def runs(text):
        out = []
        for line in text.split("\n"):
            m = re.match(r"\s{0,3}((?:>\s?)+)", line)
            depth, rest = (m[1].count(">"), line[m.end() :]) if m else (0, line)
            if not out or out[-1][0] != depth:
                out.append((depth, []))
            out[-1][1].append(rest)
        return out

    said = {}
    for conv, turn, text in rows:
        own = [p for d, p in runs(text) if d == 0]
        lines = [x for p in own for x in p]
        whole = {flat("\n".join(x)) for x in (lines, *own)} | {flat(x) for x in re.split(r"\n\s*\n", "\n".join(lines))}
        said.setdefault((conv, turn), []).append((whole, [flat(x) for x in lines if flat(x)]))

    def offers(at, lines):
        n = len(lines)
        return any(" ".join(lines) in whole or any(have[i : i + n] == lines for i in range(len(have) - n + 1)) for whole, have in said[at])

    out = {}
    for conv, turn, text in rows:
        told = []
        for depth, p in runs(text):
            lines = [flat(x) for x in p if flat(x)]
            if depth and lines:
                inside = [a for a in said if a[0] == conv and a[1] < turn and offers(a, lines)]
                outside = [a for a in said if a[0] != conv and len(" ".join(lines)) >= 4 and offers(a, lines)]
                told.append((depth, max(inside) if inside else min(outside) if outside else None))
        out[conv, turn] = told
    return out
