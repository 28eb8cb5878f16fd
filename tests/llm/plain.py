"""The operators' results by plain definition, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    found = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(zip(found, found[1:], found[2:]))
    repeated = {i + k for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for k in range(3)}
    n = len(found)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, found)), symbols, dup, len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def contamination(documents, benchmark):
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated"""
    windows = collections.defaultdict(set)
    for item, text in benchmark:
        w = ALNUM.findall((text or "").translate(LOWER))
        n = min(len(w), 13)
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for text in documents:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, items = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    items |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((len(w), len(hit), len(items), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def near_duplicates(documents):
    """Rows (id, text) -> rows (id, n_shingles, component)"""
    sets = []
    for _, text in documents:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i in range(len(sets)):
        groups[root(i)].append(documents[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return [(documents[i][0], len(s), least[root(i)] if s else documents[i][0]) for i, s in enumerate(sets)]


def repeats(documents, length=400):
    """Rows (id, text) -> rows (id, n_bytes, n_removed, n_spans, kept_sha256)"""
    places = collections.defaultdict(list)
    raw = [(text or "").encode() for _, text in documents]
    for i, b in enumerate(raw):
        for s in range(len(b) - length + 1):
            places[b[s : s + length]].append((i, s))
    hit = [bytearray(len(b)) for b in raw]
    for found in places.values():
        if len(found) > 1:
            for i, s in found:
                hit[i][s : s + length] = b"\1" * length
    out = []
    for (key, _), b, h in zip(documents, raw, hit):
        kept = bytes(x for x, y in zip(b, h) if not y)
        spans = sum(h[i] and not (i and h[i - 1]) for i in range(len(h)))
        out.append((key, len(b), sum(h), spans, hashlib.sha256(kept).hexdigest()))
    return out


def mixing_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Source -> size to source -> target."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, still = share * sum(sizes.values()), set(order)
    while still and left > 1e-9:
        total = sum(weight[s] for s in still)
        over = {s for s in still if left * weight[s] / total > cap * sizes[s]}
        if not over:
            for s in still:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(cap * sizes[s] for s in over)
        still -= over
    return target


def held_out(key):
    return zlib.crc32(str("" if key is None else key).encode()) % 7 == 2


def language_model(documents, discounts):
    """Rows (id, text) -> rows (id, held_out, n_tokens, n_known, N, base, score)"""
    ends = lambda text: [*words(text), "\0end"]
    count, pairs = collections.Counter(), collections.Counter()
    for key, text in documents:
        if not held_out(key):
            t = ends(text)
            count.update(t)
            pairs.update(zip(["\0start", *t], t))
    n, v = sum(count.values()), len(count)
    kinds = collections.Counter(pairs.values())
    d = discounts(*(kinds[k] for k in (1, 2, 3, 4)))
    context, before = collections.defaultdict(lambda: [0, 0, 0, 0]), collections.Counter()
    for (a, b), c in pairs.items():
        context[a][0] += c
        context[a][min(c, 3)] += 1
        before[b] += 1
    kinds = collections.Counter(before.values())
    e = discounts(*(kinds[k] for k in (1, 2, 3, 4)))
    less = lambda c, by: c - by[min(c, 3) - 1] if c else 0
    spare = sum(e[min(c, 3) - 1] for c in before.values()) / max(len(pairs), 1)

    def probability(a, b):
        if not pairs:
            return 1 / (v + 1)
        lower = less(before[b], e) / len(pairs) + spare / (v + 1)
        if a not in context:
            return lower
        total, *by = context[a]
        return less(pairs[a, b], d) / total + sum(x * y for x, y in zip(d, by)) / total * lower

    out = []
    for key, text in documents:
        t = ends(text)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t)
        score = sum(math.log10(probability(a, b)) for a, b in zip(["\0start", *t], t))
        out.append((key, held_out(key), len(t), sum(w in count for w in t), n, base, score))
    return out


def licenses(text, templates):
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    own = shingles(split(text))
    return sorted({i for i, t in templates if 100 * len(own & shingles(split(t))) >= 80 * len(shingles(split(t)))})


def line_dedup(rows, min_sites, min_chars):
    """Rows (id, source, text) -> texts"""
    trim = lambda line: line.strip(" \t\n\x0b\f\r")
    sites, first = collections.defaultdict(set), {}
    for key, source, text in rows:
        for line in map(trim, (text or "").split("\n")):
            if len(line) >= min_chars:
                sites[line].add(source)
                if key is not None:
                    first[line] = min(first.get(line, key), key)
    out = []
    for key, _, text in rows:
        if text is None:
            out.append(None)
            continue
        gone = lambda line: len(sites.get(line, ())) >= min_sites and first.get(line, key) != key
        out.append("\n".join(line for line in text.split("\n") if not gone(trim(line))))
    return out


def exact_owners(documents, keep="last"):
    """Per document (id, text): keep_id, group_size, n_bytes, text_sha256"""
    texts = [(text or "").translate(LOWER).encode() for _, text in documents]
    groups = collections.defaultdict(list)
    for (key, _), text in zip(documents, texts):
        groups[text].append(key)
    pick = max if keep == "last" else min
    kept = {text: pick((k for k in keys if k is not None), default=None) for text, keys in groups.items()}
    return [(key, kept[t], len(groups[t]), len(t), hashlib.sha256(t).hexdigest()) for (key, _), t in zip(documents, texts)]


def grams(text):
    found = ALNUM.findall((text or "").translate(LOWER))
    return [" ".join(found[i : i + k]) for k in (1, 2, 3) for i in range(len(found) - k + 1)], len(found)


def resampling(documents, target, percent=5, min_words=20, seed="42"):
    """Per document: id, n_words, n_features, weight, score, rank"""
    def bucket(gram):
        return zlib.crc32(gram.encode()) % 10000

    s, t = collections.Counter(), collections.Counter()
    for _, text in documents:
        s.update(map(bucket, grams(text)[0]))
    for text in target:
        t.update(map(bucket, grams(text)[0]))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in s}
    rows = []
    for key, text in documents:
        found, n = grams(text)
        weight = sum(gain[bucket(g)] for g in found)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = i + 1
    return [tuple(r) for r in rows]


def clusters(vectors, k=16, rounds=3, size=64, scale=64, seed="1"):
    """Per kept vector: id, cluster, distance, inertia of cluster and of all, digest of the centroid"""
    kept = [(key, [math.floor(scale * x) for x in v]) for key, v in vectors
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [p for _, p in sorted(kept, key=lambda r: (
        hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]
    for turn in range(rounds + 1):
        ds = [[sum((a - b) ** 2 for a, b in zip(p, c)) for c in centroids] for _, p in kept]
        own = [d.index(min(d)) for d in ds]
        if turn < rounds:
            for c in range(len(centroids)):
                members = [p for (_, p), o in zip(kept, own) if o == c]
                if members:
                    centroids[c] = [sum(column) // len(members) for column in zip(*members)]
    inertia = collections.Counter()
    for d, o in zip(ds, own):
        inertia[o] += d[o]
    return [(key, o, d[o], inertia[o], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[o])).encode()).hexdigest())
            for (key, _), d, o in zip(kept, ds, own)]
