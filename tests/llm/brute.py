"""Plain Python versions of the query contracts, over lists of rows."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return SPACE_WORD.findall(text or "")


def decontaminate(docs, bench, window=13):
    grams = defaultdict(set)
    for item, text in bench:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            grams[tuple(w[i:i + n])].add("" if item is None else str(item))
    sizes = sorted({len(g) for g in grams})
    out = []
    for doc, text in docs:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, items = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (got := grams.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    items |= got
        out.append((doc, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def substring_dedup(docs, window=13):
    least = {}
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            if doc is not None and (g not in least or doc < least[g]):
                least[g] = doc
    out = []
    for doc, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            if doc is not None and least[g] < doc:
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def mix_targets(docs, weights=(1, 2, 3), cap=3):
    """source -> (size, target) by resharing until none is above its cap."""
    size = Counter()
    for _, text, source in docs:
        size[source] += len(words(text))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {s: 0.0 for s in names}
    open_, excess = set(names), float(sum(size.values()))
    for _ in range(200):
        total = sum(w[s] for s in open_)
        if excess < 1e-9 or not total:
            break
        share = {s: excess * w[s] / total for s in open_}
        excess = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= cap * size[s]:
                excess += target[s] - cap * size[s]
                target[s] = float(cap * size[s])
                open_.discard(s)
    return {s: (size[s], target[s]) for s in names}


ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret_base(text):
    """Base spans (start, rank, end, kind) in order."""
    t = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out)


def place(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def simhash(text):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    if not w:
        return 0
    parts = [" ".join(w)] if len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    hs = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash_components(docs, k=2):
    fp = [simhash(t) for _, t in docs]
    uniq = sorted(set(fp))
    parent = {f: f for f in uniq}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    a = np.array(uniq, dtype=np.uint64)
    for i, f in enumerate(uniq):
        near = np.bitwise_count(a[i + 1:] ^ a[i]) <= k
        for j in np.flatnonzero(near):
            parent[find(uniq[i + 1 + j])] = find(f)
    least = {}
    for (doc, _), f in zip(docs, fp):
        r = find(f)
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return [(doc, f"{f:016x}", least.get(find(f))) for (doc, _), f in zip(docs, fp)]


def chats(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{t[3]}\n{t[5]}\n" for t in turns)
        loss = "".join(t[5] for t in turns if t[3] == "assistant")
        out[conv] = (len(turns), sha(said), len(loss), sha(loss))
    return out


def quality_base(text):
    w = words(text)
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            rep.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(rep),
            len(w) < 20 or 100 * len(rep) > 30 * len(w))


# ---- licences, hard negatives, conversation repair ----------------------------------------------

def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


def license_base(docs):
    """(doc_id, n_words, n_base, first_word, last_word, base_labels)."""
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    out = []
    for doc, text in docs:
        w = item_words(text)
        at = [(i, label) for i in range(len(w)) for p, label in phrases.items() if tuple(w[i:i + len(p)]) == p]
        out.append((doc, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))))
    return out


def license_detections(text, rules):
    """Detections (label, tier, start, end) that stand, every pair of matches compared."""
    norm = " " + " ".join(item_words(text)) + " "
    found = []
    for k, (tier, label, _, pattern) in enumerate(rules):
        p = re.sub(r"<(\d+)>", r"(?: [^ ]+){0,\1}", pattern)
        pos = 0
        while m := re.compile(f"(?<= )(?:{p})(?= )").search(norm, pos):
            start = norm[:m.start()].count(" ") - 1
            found.append((start, start + m[0].count(" ") + 1, tier, k, label))
            pos = m.end()
    stands = lambda x: not any(
        y is not x and y[0] <= x[0] and y[1] >= x[1] and (y[2], y[0] - y[1], y[3]) < (x[2], x[0] - x[1], x[3]) for y in found)
    return sorted((s, -e, t, k, label) for s, e, t, k, label in filter(stands, found))


def hard_negatives(rows, anchor, positives=5, negatives=3, low=50, high=95):
    """rows (vec_id, label, integers) -> all result rows, every pair scored."""
    rows = [(i, *r) for i, r in enumerate(rows)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    out = []
    for i, vec, label, v in rows:
        if vec is None or not anchor(vec):
            continue
        scored = [(dot(v, w), other, j, lab) for j, other, lab, w in rows if j != i]
        for ps, pid, _, _ in sorted((s for s in scored if s[3] == label), key=order)[:positives]:
            fit = sorted((s for s in scored if s[3] != label and low * ps <= 100 * s[0] <= high * ps), key=order)[:negatives]
            out += [(vec, pid, k + 1, s[1], ps, s[0]) for k, s in enumerate(fit)]
    return out


def repair(rows):
    """rows (conv_id, turn, role, text) after damage -> {conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)},
    by a shortest-path search from left to right with the repaired lines carried along."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, lines in convs.items():
        lines.sort()
        seen, faults = set(), []
        for _, _, role, text in lines:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
            seen.add((role, text))
        turns = [t for known, t, _, _ in lines if known]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(lines, lines[1:]))
        step = lambda said, s: said + s if re.fullmatch("(s?(ua)*u?)?", said + s) else None
        heads = {"": (0, "", ())}                       # by the last initial, "" where nothing was said
        state = lambda said: said if said in ("", "s") else said[-1]
        full = {"": "", "s": "s", "u": "u", "a": "ua"}

        def put(new, key, value):
            if key is not None and (state(key) not in new or value < new[state(key)]):
                new[state(key)] = value

        def inserted(heads):
            for _ in range(4):
                for k, (c, a, said) in list(heads.items()):
                    for s, name in (("u", "user"), ("a", "assistant")):
                        put(heads, step(full[k], s), (c + 2, a + "I", said + (f"{name}:",)))
            return heads

        heads = inserted(heads)
        for (_, _, role, text), fault in zip(lines, faults):
            new, extra = {}, fault == "truncated"
            for k, (c, a, said) in heads.items():
                put(new, full[k], (c + 3, a + "D", said))
                if fault in ("", "truncated"):
                    if role[:1] in ("s", "u", "a"):
                        put(new, step(full[k], role[:1]), (c + extra, a + "K", said + (f"{role}:{text}",)))
                    for s, name in (("u", "user"), ("a", "assistant")):
                        put(new, step(full[k], s), (c + 2 + extra, a + "R", said + (f"{name}:{text}",)))
            heads = inserted(new)
        cost, audit, said = min(heads[k] for k in ("", "a") if k in heads)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                     sha("\n".join(said)))
    return out


def host_reputation(pages, labels, two_label, threshold=0.5, z=1.645):
    """pages (page, host), labels {page: bad} -> {host: (posterior mean, blocked)}: beta-binomial shrinkage from suffix to
    domain to host, prior strengths by moments, in plain Python."""
    import math
    hosts = defaultdict(lambda: [0, 0])
    for page, host in pages:
        hosts[host][0] += page in labels
        hosts[host][1] += labels.get(page, 0)

    def parts(host):
        name = re.sub(r":\d*$", "", re.sub(r"^.*@", "", host)).split(".")
        k = 2 if ".".join(name[-2:]) in two_label else 1
        return ".".join(name[-k - 1:]), ".".join(name[-k:])

    inside = lambda p: min(max(p, 1e-6), 1 - 1e-6)

    def shrink(units, parent):
        """units {name: (n, bad)}, parent {name: rate} -> {name: (a, b)}."""
        over = scale = noise = 0.0
        for u, (n, bad) in units.items():
            p = inside(parent[u])
            var = p * (1 - p)
            over += (bad - n * p) ** 2 - n * var
            scale += n * (n - 1) * var
            noise += 2 * n * (n - 1) * var * var
        if not scale:
            rho = 0.1
        else:
            est, err = over / scale, math.sqrt(noise) / scale
            near = min(max(est, 0.0), 1.0)
            lo, hi = max(0.0, near - 8 * err), min(1.0, near + 8 * err)
            x = [lo + (k + 0.5) / 4000 * (hi - lo) for k in range(4000)]
            top = max(-((v - est) / err) ** 2 / 2 for v in x)
            w = [math.exp(-((v - est) / err) ** 2 / 2 - top) for v in x]
            rho = min(sum(a * b for a, b in zip(x, w)) / sum(w), 0.999)
        m = round(1 / rho - 1, 6)
        return {u: (bad + m * inside(parent[u]), n - bad + m * (1 - inside(parent[u]))) for u, (n, bad) in units.items()}

    rate = lambda ab: ab[0] / (ab[0] + ab[1])
    domains, suffixes = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for h, (n, bad) in hosts.items():
        for level, name in ((domains, parts(h)), (suffixes, parts(h)[1])):
            level[name][0] += n
            level[name][1] += bad
    p0 = (sum(b for _, b in hosts.values()) + 1) / (sum(n for n, _ in hosts.values()) + 2)
    of_suffix = {s: rate(ab) for s, ab in shrink(suffixes, dict.fromkeys(suffixes, p0)).items()}
    of_domain = {d: rate(ab) for d, ab in shrink(domains, {d: of_suffix[d[1]] for d in domains}).items()}
    out = {}
    for h, (a, b) in shrink(hosts, {h: of_domain[parts(h)] for h in hosts}).items():
        mean = a / (a + b)
        out[h] = (mean, mean - z * math.sqrt(mean * (1 - mean) / (a + b + 1)) > threshold)
    return out
