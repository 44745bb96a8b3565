"""Plain versions of the operators, to compare with."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def base_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def exact(rows):
    """(doc_id, text) -> (doc_id, keep_id, group_size, kept, sha)."""
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(i)
    return sorted((i, min(g), len(g), i == min(g), sha(t)) for t, g in groups.items() for i in g)


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k:k + 4]) for k in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(rows, distance=4):
    """(doc_id, text) -> (doc_id, fingerprint, component_id)."""
    prints = [(i, fingerprint(t)) for i, t in rows]
    codes = np.array(sorted({c for _, c in prints}), np.uint64)
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(codes)):
        for b in np.flatnonzero(np.bitwise_count(codes[a + 1:] ^ codes[a]) <= distance) + a + 1:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    at = {int(c): find(k) for k, c in enumerate(codes)}
    least = {}
    for i, c in prints:
        least[at[c]] = min(least.get(at[c], i), i)
    return sorted((i, f"{c:016x}", least[at[c]]) for i, c in prints)


def targets(sizes, weights=(5, 2, 1), most=3):
    """Source -> size to source -> target; a target stops at ``most`` sizes, and what is over is shared again by weight."""
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    got, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > most * sizes[s]}
        if not over:
            return got | {s: unit * weight[s] for s in open_}
        got |= {s: float(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return got


def tokens(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tokenizer.decode(ids, skip_special_tokens=False))


def classes(nodes, links):
    """Node to the least node that it reaches."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def trie(rows, splice=True):
    """(conv_id, turn, role, text) -> one row per node, as op13 returns them."""
    import zlib

    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            turns.setdefault(c, []).append((t, r or "", x or ""))
    key = lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1].encode())}|{t[1]}{t[2]}".encode()).digest())
    own = {c: [t[1:] for t in sorted(v, key=key)] for c, v in turns.items()}
    made = own
    if splice:
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
        base = lambda c: c - int(np.fmod(c, 5))
        made = {c: own.get(base(c), [])[: h[c]] + own[c][h[c]:] for c in own}
    members = {}
    for c, path in made.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        worth = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += worth
            leaves[p[:d]] += not children[p]
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(",".join(str(c) for c in sorted(m) if len(made[c]) == len(p))))
        for p, m in members.items()
    )


def negatives(rows, k=5):
    """(vec_id, label, vector) -> (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    import math

    whole = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        if row not in whole:
            whole.append(row)
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    place = lambda found: sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))
    out = []
    for a in whole:
        if a[0] is None or a[0] % 100:
            continue
        others = [(score(a, b), b[0], b[1]) for b in whole if b != a and len(b[2]) == len(a[2])]
        for p, pid, _ in place(f for f in others if f[2] == a[1])[:k]:
            fits = place(f for f in others if f[2] != a[1] and 80 * p <= 100 * f[0] <= 100 * p)
            out += [(a[0], pid, n, nid, p, s) for n, (s, nid, _) in enumerate(fits[:k], 1)]
    return sorted(out, key=repr)


def shingle_set(text, k=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def jaccard(rows, percent=80):
    """(doc_id, text) -> (doc_id, n_shingles, component_id), from the overlaps of all documents that share a shingle."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    groups = {}
    for _, s in sets:
        groups.setdefault(s, len(groups))
    whole, where, links = list(groups), {}, []
    for k, s in enumerate(whole):
        overlap = Counter(j for x in s for j in where.get(x, ()))
        links += [(k, j) for j, n in overlap.items() if 100 * n >= percent * (len(s) + len(whole[j]) - n)]
        for x in s:
            where.setdefault(x, []).append(k)
    root = classes(range(len(whole)), links)
    least = {}
    for i, s in sets:
        if i is not None:
            c = root[groups[s]]
            least[c] = min(least.get(c, i), i)
    return sorted(((i, len(s), least.get(root[groups[s]]) if s else i) for i, s in sets), key=repr)
