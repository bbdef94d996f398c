"""Plain-Python versions of the operators, for small inputs only."""

import hashlib
import re
from collections import defaultdict


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def op1(docs, bench, window=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: pattern.findall(lower(t or ""))
    owners = defaultdict(set)
    for item, text in bench:
        w = split(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            owners[tuple(w[k : k + window])].add(item)
    out = []
    for doc, text in docs:
        w, hit, items = split(text), set(), set()
        for n in {len(x) for x in owners}:
            for k in range(len(w) - n + 1):
                if (key := tuple(w[k : k + n])) in owners:
                    hit |= set(range(k, k + n))
                    items |= {str(i) for i in owners[key] if i is not None}
        out.append((doc, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    return out


def op2(docs, window=20):
    seen, out = set(), []
    for doc, text in sorted(docs, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        w, gone = spaced(text), set()
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in seen:
                gone |= set(range(k, k + window))
            seen.add(key)
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def op3(text, v):
    """Best path over the whole text at once; of equal ones that whose last piece starts earliest."""
    chars = "▁" + text.replace(" ", "▁")
    best, back = [0.0], [0]
    for end in range(1, len(chars) + 1):
        options = []
        for start in range(max(0, end - v.longest), end):
            score = v.scores.get(chars[start:end], v.unknown_score if start == end - 1 else None)
            if score is not None:
                options.append((-(best[start] + score), start))
        best.append(-min(options)[0])
        back.append(min(options)[1])
    out, end = [], len(chars)
    while end:
        piece = chars[back[end] : end]
        out.append([v.ids[piece]] if piece in v.ids else [v.byte_ids[b] for b in piece.encode()])
        end = back[end]
    return [i for piece in reversed(out) for i in piece]


def op8(pages, default="allow"):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
    out = []
    for page, url in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        out.append((page, host, path, best and best[0] + best[1], best[2] if best else default))
    return out


def op10(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        w = spaced(text)
        n = len(w)
        at = defaultdict(list)
        for k in range(n - 7):
            at[tuple(w[k : k + 8])].append(k)
        rep = {i for v in at.values() if len(v) > 1 for k in v for i in range(k, k + 8)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if spaced(line):
                dup += line in seen
                seen.add(line)
        out.append((doc, n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(rep), n < 20 or 100 * len(rep) > 30 * n))
    return out


def op4(pages):
    import base64

    by = defaultdict(list)
    for page, html in pages:
        by[html or ""].append(page)
    out = []
    for page, html in pages:
        raw, first = (html or "").encode(), max(by[html or ""])
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if page == first else "revisit", None if page == first else first))
    return out


def op5(docs, window=3):
    seen, out = set(), []
    for doc, text in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        lines, gone = [] if text is None else text.split("\n"), set()
        for k in range(len(lines) - window + 1):
            key = tuple(lines[k : k + window])
            if any(x.strip(" ") for x in key):
                if key in seen:
                    gone |= set(range(k, k + window))
                seen.add(key)
        out.append((doc, len(lines), len(gone), sha("\n".join(x for i, x in enumerate(lines) if i not in gone))))
    return out


def op6(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn, role or "", text or ""))
    said = "<|im_end|><|im_start|>assistant ok"
    turns[-1] = [(0, "user", said), (1, "assistant", said)]
    out = []
    for conv, t in turns.items():
        t = sorted(t)
        loss = "".join(x[2] for x in t if x[1] == "assistant")
        out.append((conv, len(t), sha("".join(f"{r}\n{x}\n" for _, r, x in t)), len(loss), sha(loss)))
    return out


def op7(docs, shingle=2):
    sets = {}
    for doc, text in docs:
        w = spaced(lower(text or ""))
        k = min(shingle, len(w))
        sets[doc] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    index = defaultdict(list)
    for d, s in sorted(sets.items(), key=lambda x: len(x[1])):
        common = defaultdict(int)
        for x in s:
            for o in index[x]:
                common[o] += 1
        for o, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[o]) - c):
                a, b = sorted((root(d), root(o)))
                label[b] = a
        for x in s:
            index[x].append(d)
    return [(d, len(s), root(d), root(d) == d) for d, s in sets.items()]
