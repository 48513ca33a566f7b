"""Plain, slow versions of the operators, for comparison."""

import collections
import hashlib
import math
import re

BLANK = re.compile(r"[\x20\x09-\x0D]")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def exact_dedup(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        t = t or ""
        groups[BLANK.sub("", t)].append((-len(t), i is None, i or 0, i))
    out = []
    for i, t in rows:
        body = BLANK.sub("", t or "")
        keep = min(groups[body])[3]
        out.append((i, keep, len(groups[body]), i == keep, hashlib.sha256(body.encode()).hexdigest()))
    return out


def shingles(t, width=5):
    w = words(t or "")
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1))


def near_components(rows):
    """{id: component} over rows without null ids; every pair is held against each other."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def license_base(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    places = [(k, label) for p, label in PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
    at = [k for k, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def license_blocks(t, templates, threshold):
    """{(line, template)} by comparing every line with every template."""
    out = set()
    for n, line in enumerate((t or "").split("\n")):
        w = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(line)))
        for m, (_, text) in enumerate(templates):
            own = set(re.findall(r"[0-9a-z]+", text.lower()))
            if len(w & own) >= threshold * len(own) - 1e-9:
                out.add((n, m))
    return out


SECRETS = {"assign": (re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 8),
           "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16), "hex": (re.compile(r"[0-9a-f]+"), 0, 32)}


def secrets(t):
    out = []
    for rank, (kind, (pattern, group, least)) in enumerate(SECRETS.items()):
        out += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(t or "") if len(m.group(group)) >= least]
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


def spans_sha(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()


def chat(rows):
    """{conv: (n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)}"""
    convs = collections.defaultdict(list)
    for c, n, r, t in rows:
        convs[c].append((n is not None, n or 0, r or "", t or ""))
    out = {}
    for c, turns in convs.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        esc = lambda x: x.replace("&", "&amp;").replace("<", "&lt;")
        loss = "".join(t for r, t in turns if r == "assistant")
        size = [len("<turn>" + esc(r).replace("\n", "&#10;") + "\n" + esc(t) + "</turn>\n") for r, t in turns]
        ends = [k for k, (r, _) in enumerate(turns) if r == "assistant" or k == len(turns) - 1]
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), sum(sum(size[:k + 1]) for k in ends))
    return out


def greedy_pieces(word, initial, rest):
    at = n = 0
    while at < len(word):
        pool = rest if at else initial
        end = max((e for e in range(at + 1, len(word) + 1) if word[at:e] in pool), default=None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def integer_vectors(rows):
    """(id, label, whole-number vector) of the rows whose vector is finite throughout."""
    out = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, label, [max(-2**24, min(2**24, math.floor(x * 256))) for x in v]))
    return out


def vector_codes(rows, parts=16, entries=64, rounds=2):
    """[(id, code, error, label)] and the codebooks' text, sorted."""
    rows = integer_vectors(rows)
    if not rows:
        return [], ""
    dim = -(-max(len(v) for *_, v in rows) // parts) * parts
    rows = [(i, label, v, v + [0] * (dim - len(v))) for i, label, v in rows]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = dim // parts
    cell = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cell(v, p) for *_, v in rows[:entries]] for p in range(parts)]
    nearest = lambda c, book: min((sum((a - b) ** 2 for a, b in zip(c, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = collections.defaultdict(list)
            for *_, v in rows:
                groups[nearest(cell(v, p), book)[1]].append(cell(v, p))
            for k, cells in groups.items():
                book[k] = [sum(x) // len(cells) for x in zip(*cells)]
    out = []
    for i, label, _, v in rows:
        found = [nearest(cell(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    return out, ",".join(str(x) for b in books for e in b for x in e)


def hard_negatives(rows, is_anchor, positives=5, negatives=10):
    """Sorted rows (anchor, positive, rank, negative, positive score, negative score)."""
    rows = [r for r in integer_vectors(rows) if r[0] is not None and r[1] is not None]
    dot = lambda v, w: sum(a * b for a, b in zip(v, w))
    out = []
    for a, label, v in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-dot(v, w), i, lab) for i, lab, w in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fit)]
    return sorted(out)
