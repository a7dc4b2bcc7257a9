"""Plain versions of the operators, for small tables."""

import base64
import collections
import fractions
import hashlib
import math
import re
import string
import zlib

import numpy as np
import public_tokenizers
import tiktoken

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def tokenizer():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def text_counts(text):
    w, t = words(text), text or ""
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = collections.Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), again, len(covered)


def substring_dedup(rows, width=13):
    """id -> n_words, n_removed, kept text."""
    texts = {d: words(t) for d, t in rows}
    first = {}
    for d in sorted(texts):
        for i in range(len(texts[d]) - width + 1):
            first.setdefault(tuple(texts[d][i : i + width]), d)
    out = {}
    for d, w in texts.items():
        gone = {i + k for i in range(len(w) - width + 1) if first[tuple(w[i : i + width])] < d for k in range(width)}
        out[d] = len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)
    return out


def jaccard_components(rows, size=5, similar=80):
    """id -> number of shingles, component."""
    sets = {}
    for d, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        whole = [tuple(w)] if w else []
        sets[d] = frozenset([tuple(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else whole)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= similar * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def top_k(rows, is_query, k, factor):
    usable = [
        (i, [math.floor(factor * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q in sorted({i for i, _ in usable if is_query(i)}):
        pairs = [(a, c, b) for i, a in usable if i == q for c, b in usable if c != q]
        scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for a, c, b in pairs)
        out += [(q, r, c, -s) for r, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out)


def url_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for rule, verdict in rules:
        rule_host, slash, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path):
            fits.append((len(rule), len(rule_host), verdict == "block", rule, verdict))
    return (host, path, *max(fits)[3:]) if fits else (host, path, None, default)


def poisson_copies(rate, u):
    k, term = 0, math.exp(-rate)
    below = term
    while below <= u and k < 500:
        k += 1
        term *= rate / k
        below += term
    return k


def unit(seed, key):
    return int(hashlib.md5(f"{seed}|{key}".encode()).hexdigest()[:13], 16) / 2.0**52


def majority_counts(spans, cuts, stop):
    """Tokens per section by the number of characters that lie in each, ties to the earlier."""
    edges = [*cuts, stop]
    out = np.zeros(len(cuts), int)
    for a, b in spans:
        overlap = [max(0, min(b, edges[k + 1]) - max(a, edges[k])) for k in range(len(cuts))]
        out[overlap.index(max(overlap))] += 1
    return out.tolist()


def rule_ratios(text):
    """The ratios of the six rules in the order of quality_rules.default_rules()."""
    n, chars, symbols, again, repeats = text_counts(text)
    lines = sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
    upper, bangs = (sum(c in kind for c in text or "") for kind in (string.ascii_uppercase, "!"))
    parts = [(symbols, n), (repeats, n), (again, lines), (upper, chars), (bangs, n), (chars, n)]
    return [a / max(b, 1) for a, b in parts]


def rules_kept(rows, quality, lists, limit=fractions.Fraction(1, 100), error=fractions.Fraction(1, 20)):
    """ids of (id, lang, text) rows that pass the base rules and the cutoffs certified by exact tails; and those cutoffs."""
    passed = {}
    for d, lang, text in rows:
        n, _, _, _, repeats = text_counts(text)
        if n >= 50 and 100 * repeats <= 50 * n:
            passed[d] = lang, rule_ratios(text)
    strata = {lang for d, (lang, _) in passed.items() if d in quality}
    chosen = {}
    for lang in strata:
        good, bad = ([r for d, (x, r) in passed.items() if x == lang and quality.get(d) == q] for q in (1, 0))
        for i, cutoffs in enumerate(lists):
            most = 0
            for cutoff in cutoffs:
                n, k = len(good), sum(r[i] > cutoff for r in good)
                tail = sum(math.comb(n, j) * limit**j * (1 - limit) ** (n - j) for j in range(k + 1)) if k <= limit * n else 1
                if not n or tail > error / (len(strata) * len(lists)):
                    break
                caught = sum(r[i] > cutoff for r in bad)
                if caught > most:
                    chosen[lang, i], most = cutoff, caught
    kept = {d for d, (lang, r) in passed.items() if not any(x > chosen.get((lang, i), math.inf) for i, x in enumerate(r))}
    return kept, chosen


def periodic_runs(words, min_length=24):
    """(start, length, period) of the runs of three periods or more, by start and period."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i < n - p:
            start = i
            while i < n - p and words[i] == words[i + p]:
                i += 1
            if i - start + p >= max(min_length, 3 * p):
                found.setdefault((start, i - start + p), p)
            i += 1
    return sorted((a, length, p) for (a, length), p in found.items())


def collapsed(words, runs):
    gone = {i for a, length, p in runs for i in range(a + p, a + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def cycled(doc_id, text):
    """The words of a document of op11."""
    w, h = words(text), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def near_vectors(rows, similarity=0.95):
    """For each (id, vector) row, in order: number of links, component, kept."""

    def whole(v):
        if v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.longdouble)
        return v / np.abs(v).max()

    def cosine(a, b):
        n = min(len(a), len(b))
        return float((a[:n] * b[:n]).sum() / np.sqrt((a * a).sum() * (b * b).sum()))

    units = [None if i is None else whole(v) for i, v in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and cosine(a, b) >= similarity:
                links[i], links[j] = links[i] + 1, links[j] + 1
                parent[root(i)] = root(j)
    least = {}
    for i, (own, _) in enumerate(rows):
        if own is not None:
            least[root(i)] = min(least.get(root(i), own), own)
    return [(own, links[i], least.get(root(i)), own is not None and own == least[root(i)]) for i, (own, _) in enumerate(rows)]


def whitened(rows, factor=256, components=4):
    """n, and for each remaining (id, vector) row, in order: deviation and whitened coordinates (up to sign); explained."""
    left = [(i, [math.floor(factor * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max(len(x) for _, x in left)
    left = [(i, x + [0] * (dim - len(x))) for i, x in left]
    fit = sorted({tuple(x) for _, x in left})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(fractions.Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in left:
        y = np.array([float(fractions.Fraction(n * c - s, n)) for c, s in zip(x, sums)])
        out.append((i, sum((n * c - s) ** 2 for c, s in zip(x, sums)), y @ vectors / np.sqrt(values)))
    return n, out, values / (centred**2).sum() * n


def sentence_starts(text):
    """0 and where each further sentence begins: after marks or a line's end, and the white space that follows."""
    starts, i = [0], 0
    while i < len(text):
        while i < len(text) and text[i] not in ".!?\n":
            i += 1
        if i < len(text) and text[i] == "\n":
            i += 1
        else:
            while i < len(text) and text[i] in ".!?":
                i += 1
        while i < len(text) and text[i].isspace():
            i += 1
        if i < len(text):
            starts.append(i)
    return starts


def token_sections(fields, encoder):
    """field number, section, start, stop, tokens, crossing tokens of the fields of one row."""
    texts = [t or "" for t in fields]
    whole = "\n".join(texts)
    sections, at = [], 0
    for k, text in enumerate(texts):
        inner = sentence_starts(text)
        sections += [[k, i, at + x, None, 0, 0] for i, x in enumerate(inner)]
        at += len(text) + (k + 1 < len(texts))
    for a, b in zip(sections, [*sections[1:], [0, 0, at]]):
        a[3] = b[2]
    place = [i for i, c in enumerate(whole) for _ in c.encode()]  # of every byte, its character
    byte = 0
    for token in encoder.encode_ordinary(whole):
        size = len(encoder.decode_single_token_bytes(token))
        first, last = place[byte], place[byte + size - 1]
        shares = [sum(s[2] <= c < s[3] for c in range(first, last + 1)) for s in sections]
        best = sections[shares.index(max(shares))]
        best[4] += 1
        best[5] += sum(x > 0 for x in shares) > 1
        byte += size
    return [tuple(s) for s in sections]


def gam_scores(x, y, rounds, rate, n_pairs, bins=32, coarse=8, leaves=4):
    """Scores of the rows that the model is fitted on, by loops over rows and bins."""
    n, width = len(x), len(x[0])
    edges = [sorted(set(np.quantile([r[j] for r in x], np.arange(1, bins) / bins).tolist())) for j in range(width)]
    cell = [[sum(e < r[j] for e in edges[j]) for j in range(width)] for r in x]
    rough = [[c[j] * min(len(edges[j]) + 1, coarse) // (len(edges[j]) + 1) for j in range(width)] for c in cell]
    good = (sum(y) + 0.5) / (n + 1)
    total = [math.log(good / (1 - good))] * n
    least = 0.002 * n * good * (1 - good)

    def gradient(i):
        p = 1 / (1 + math.exp(-total[i]))
        return y[i] - p, p * (1 - p)

    def sums(places, size):
        g, h = [0.0] * size, [0.0] * size
        for i, c in enumerate(places):
            a, b = gradient(i)
            g[c], h[c] = g[c] + a, h[c] + b
        return g, h

    def steps(g, h, most):
        spans = [(0, len(g))]
        worth = lambda a, b: sum(g[a:b]) ** 2 / (sum(h[a:b]) + 1)
        while len(spans) < most:
            cuts = [
                (worth(a, m) + worth(m, b) - worth(a, b), k, m) for k, (a, b) in enumerate(spans) for m in range(a + 1, b)
                if min(sum(h[a:m]), sum(h[m:b])) >= least
            ]
            gain, k, m = max(cuts, default=(0, 0, 0))
            if gain <= 1e-9:
                break
            spans[k : k + 1] = [(spans[k][0], m), (m, spans[k][1])]
        return [next(sum(g[a:b]) / (sum(h[a:b]) + 1) for a, b in spans if a <= c < b) for c in range(len(g))]

    for _ in range(rounds):
        for j in range(width):
            step = steps(*sums([c[j] for c in cell], bins), leaves)
            total = [t + rate * step[c[j]] for t, c in zip(total, cell)]
    both = {(i, j): [r[i] * coarse + r[j] for r in rough] for i in range(width) for j in range(i + 1, width)}

    def gain(pair):
        g, h = sums(both[pair], coarse**2)
        return sum(a * a / (b + 1) for a, b in zip(g, h))

    pairs = sorted(both, key=lambda p: -gain(p))[:n_pairs]
    for _ in range(rounds // 4):
        for pair in pairs:
            g, h = sums(both[pair], coarse**2)
            rows = [(g[k * coarse : (k + 1) * coarse], h[k * coarse : (k + 1) * coarse]) for k in range(coarse)]
            side = steps([sum(a) for a, _ in rows], [sum(b) for _, b in rows], 2)
            step = {}
            for value in set(side):
                chosen = [rows[k] for k in range(coarse) if side[k] == value]
                inner = steps([sum(c) for c in zip(*[a for a, _ in chosen])], [sum(c) for c in zip(*[b for _, b in chosen])], 2)
                step[value] = inner
            total = [t + rate * step[side[c // coarse]][c % coarse] for t, c in zip(total, both[pair])]
    return [1 / (1 + math.exp(-t)) for t in total]
