"""Brute-force versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def earlier_words(docs, window):
    """{row: (n_words, n_removed, kept_sha256)} for rows [(id, text)], already in document order."""
    seen, out = set(), {}
    for k, (_, text) in enumerate(docs):
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            if key in seen:
                gone[p:p + window] = [True] * window
            seen.add(key)
        kept = [x for x, g in zip(w, gone) if not g]
        out[k] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def shared_bytes(docs, window):
    """{row: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    data = [(t or "").encode() for _, t in docs]
    n = Counter(b[p:p + window] for b in data for p in range(len(b) - window + 1))
    out = {}
    for k, b in enumerate(data):
        gone = [False] * len(b)
        for p in range(len(b) - window + 1):
            if n[b[p:p + window]] > 1:
                gone[p:p + window] = [True] * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[k] = (len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def near_components(docs, shingle, percent):
    """{row: (n_shingles, root row)} by comparing all pairs that share a shingle."""
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = []
    for _, text in docs:
        w = WORD.findall((text or "").translate(low))
        k = min(len(w), shingle)
        sets.append({tuple(w[p:p + k]) for p in range(len(w) - k + 1)} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        common = Counter()
        for g in s:
            common.update(holders.get(g, ()))
            holders.setdefault(g, []).append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def line_components(docs, min_chars, percent, size=5):
    """{(row, position): root (row, position)} of the lines that take part, by all pairs that share a shingle."""
    at, sets = {}, {}
    for k, (_, text) in enumerate(docs):
        for p, raw in enumerate((text or "").split("\n")):
            line = raw.strip(" \t\x0b\x0c\r")
            if len(line) >= min_chars:
                at[k, p] = line
                sets.setdefault(line, {line[i:i + size] for i in range(len(line) - size + 1)})
    root = {line: line for line in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for line, s in sets.items():
        common = Counter()
        for g in s:
            common.update(holders.get(g, ()))
            holders.setdefault(g, []).append(line)
        for other, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                root[find(line)] = find(other)
    first = {}
    for place, line in sorted(at.items()):
        first.setdefault(find(line), place)
    return {place: first[find(line)] for place, line in at.items()}


LETTERS = re.compile("[A-Za-z\u00C0-\u00FF]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def letter_words(docs, min_chars=6, min_n=5, modulus=199):
    """Counter of the letter runs of [(id, text)], damaged as the contract of op11 says."""
    n = Counter()
    for i, text in docs:
        for run in LETTERS.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if modulus and h % modulus == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_n}


def one_edit_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def spelling(words, ratio=5):
    """{word: (form, root, n, n_near, form_n)} by deletion neighbourhoods, every pair confirmed."""
    holders = {}
    for w in words:
        for x in {w} | {w[:k] + w[k + 1:] for k in range(len(w))}:
            holders.setdefault(x, set()).add(w)
    near = {w: set() for w in words}
    for group in holders.values():
        for a in group:
            near[a] |= {b for b in group if one_edit_apart(a, b)}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


def damage(rows):
    """Rows (conv_id, turn, role, text) after the damage of the contract of op13."""
    out = []
    for conv, turn, role, text in rows:
        one = lambda x: " " if x is None else x
        d = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub("[.!?]", "", text)
        if d == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def cheapest(symbols):
    """(cost, edits) of rows given as (initial, must go, truncated), by trying all edits."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    after = {}
    for p in range(len(symbols), -1, -1):
        now = {}
        if p == len(symbols):
            now = {0: (0, ""), 3: (0, "")}
        else:
            initial, gone, late = symbols[p]
            for q in range(4):
                found = [(3, "D", q)]
                if not gone:
                    found += [(late, "K", step[q, c]) for c in [initial] if (q, c) in step]
                    found += [(2 + late, "R", step[q, c]) for c in "ua" if (q, c) in step]
                now[q] = min((c + after[to][0], e + after[to][1]) for c, e, to in found)
        for _ in range(4):  # inserted turns before the row
            for q in range(4):
                for c in "ua":
                    to = step.get((q, c))
                    if to in now:
                        now[q] = min(now.get(q, (1 << 40, "")), (2 + now[to][0], "I" + now[to][1]))
        after = now
    return after[0]


def repaired_conversations(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256, lines)} of rows as they are."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0,
                                  hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, symbols, count = set(), [], Counter()
        for _, role, text in group:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            count[fault] += 1
            symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in group if t is not None]
        illegal = sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in zip(symbols, symbols[1:]))
        cost, audit = cheapest(symbols)
        lines, at, last = [], 0, ""
        for e in audit:
            turn = "assistant" if last == "u" else "user"
            if e == "I":
                lines.append(turn + ":")
            else:
                _, role, text = group[at]
                at += 1
                if e == "D":
                    continue
                lines.append(f"{role if e == 'K' else turn}:{text}")
            last = lines[-1][0]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)
    return out
