"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter

import xxhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 1 << 63


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate(UPPER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_counts(text):
    w, text = words(text), text or ""
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def ngram_buckets(text, buckets):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words(text)]
    pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(h, h[1:])]
    return [x % buckets for x in h] + [buckets + x % buckets for x in pairs]


def exact_groups(rows):
    """[(doc_id, keep_id, group_size, sha)] and the number of kept rows per (sha, doc_id)."""
    by = {}
    for d, t, _ in rows:
        by.setdefault(sha(lower(t)), []).append(d)
    out, kept = [], Counter()
    for s, ids in by.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(d, keep, len(ids), s) for d in ids]
        kept[s, keep] += 1
    return out, kept


def shingles(text):
    w = words(lower(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    """For each row (set size, smallest doc_id of its component)."""
    sets = [shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 75 * (len(a) + len(b) - both):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [(d, len(s), least[find(i)] if s else d) for i, ((d, _, _), s) in enumerate(zip(rows, sets))]


def without_repeats(rows, k=13):
    first, out = {}, []
    for d, t, _ in rows:
        w = words(t)
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            first[g] = min(first.get(g, LAST), LAST if d is None else d)
    for d, t, _ in rows:
        w = words(t)
        keep = [True] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < (LAST if d is None else d):
                keep[i:i + k] = [False] * k
        kept = [x for x, y in zip(w, keep) if y]
        out.append((d, len(w), len(w) - len(kept), sha(" ".join(kept))))
    return out


def base_scores(rows):
    """(doc_id, held_out, tokens, known, N, base score)."""
    import math
    docs = [(d, zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0, [*words(lower(t)), ""]) for d, t, _ in rows]
    c = Counter(w for _, h, w_ in docs if not h for w in w_)
    n, v = sum(c.values()), len(c)
    return [(d, h, len(w), sum(x in c for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for d, h, w in docs]


def mix_targets(rows):
    size = Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(size.values()), set(order), {}
    while free:
        all_ = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / all_ > 2 * size[s]]
        if not over:
            target |= {s: left * weight[s] / all_ for s in free}
            break
        for s in over:
            target[s] = 2 * size[s]
            free.discard(s)
        left -= sum(target[s] for s in over)
    return size, target


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(v - 9 if (v := int(x) * (1 + i % 2)) > 9 else v for i, x in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    def ok(kind, m):
        d = re.sub("[^0-9]", "", m)
        return (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.split("."))
                or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15)
    return [(k, m.start(), m.end()) for k, p in KINDS.items() for m in re.finditer(p, text or "") if ok(k, m.group())]


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def judge_url(url, spam, phrases=(), endings=()):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(UPPER), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    runs = list(re.finditer("[a-z0-9]+", (host + path).translate(UPPER)))
    pairs = {(a[0], b[0]) for a, b in zip(runs, runs[1:]) if b.start() - a.end() <= 3}
    bad = {r[0] for r in runs} & set(spam) or pairs & set(phrases) or any(path.translate(UPPER).endswith("." + e) for e in endings)
    return host, path, None, "block" if bad else "allow"


def rotations(turns, part=512):
    """{(conv_id, part, speaker): (turns, text, [masked texts])} of (conv_id, turn, role, text)."""
    by = {}
    for c, n, r, t in turns:
        by.setdefault(c, []).append((n, "unknown" if r is None else r, (t or "").replace("<|im_", "< |im_")))
    out = {}
    for c, said in by.items():
        said = sorted(said, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        scene = [x for x in said[:part] if x[1] == "system"]
        for who in {r for _, r, _ in said} - {"system"}:
            for at in range(0, len(said), part):
                here = said[at:at + part]
                text = ""
                for _, r, t in (scene if at else []) + here:
                    name = "user name=" + r.replace("<|im_", "< |im_").replace("\r", " ").replace("\n", " ")
                    text += f"<|im_start|>{'assistant' if r == who else r if r == 'system' else name}\n{t}<|im_end|>\n"
                out[c, at // part, who] = (len(here), text, [t + "<|im_end|>" for _, r, t in here if r == who])
    return out
