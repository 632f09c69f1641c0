"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINE_SPACE = " \t\n\x0b\x0c\r"


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# --- quality rules ---------------------------------------------------------
def quality_counts(text):
    text = text or ""
    ws = WORD.findall(text)
    tri = Counter(zip(ws, ws[1:], ws[2:], strict=False))
    covered = {i + j for i in range(len(ws) - 2) if tri[tuple(ws[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.strip(LINE_SPACE)]
    return {
        "n_words": len(ws),
        "word_chars": sum(map(len, ws)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_upper": sum("A" <= c <= "Z" for c in text),
        "n_letters": sum(c.isascii() and c.isalpha() for c in text),
        "n_marks": sum(c in ".!?" for c in text),
        "n_shouts": text.count("!"),
        "n_digits": sum(c in "0123456789" for c in text),
    }


def quality_votes(f):
    n = f["n_words"]

    def vote(bad, good=False):
        return 0 if n == 0 else -1 if bad else 1 if good else 0

    marred = 10 * f["n_symbols"] > n or 3 * f["n_upper"] > f["n_letters"] or 10 * f["n_shouts"] > n or 5 * f["n_digits"] > f["word_chars"]
    plain = 50 * f["n_symbols"] <= n and 6 * f["n_upper"] <= f["n_letters"] and 50 * f["n_shouts"] <= n and 10 * f["n_digits"] <= f["word_chars"]
    return (
        vote(5 * f["n_symbols"] > n),
        vote(2 * f["n_upper"] > f["n_letters"]),
        vote(5 * f["n_shouts"] > n),
        vote(10 * f["n_dup_lines"] > 3 * f["n_lines"]),
        vote(10 * f["n_repeat_words"] > 3 * n),
        vote(marred, plain),
        vote(f["word_chars"] < 2 * n or f["word_chars"] > 12 * n),
        vote(n > 100 * f["n_marks"], 3 * f["n_marks"] <= n <= 60 * f["n_marks"]),
    )


def label_model(votes):
    """Posterior of good per document: EM over documents, one by one."""
    good = [min(max(0.5 + 0.45 * sum(v) / max(sum(map(abs, v)), 1), 0.05), 0.95) for v in votes]
    for _ in range(200):
        logs = []
        for side in (0, 1):
            weight = [g if side else 1 - g for g in good]
            chance = []
            for r in range(len(votes[0])):
                mass = {v: 1.0 + sum(w for w, x in zip(weight, votes, strict=True) if x[r] == v) for v in (-1, 0, 1)}
                chance.append({v: m / sum(mass.values()) for v, m in mass.items()})
            prior = math.log((sum(weight) + 1) / (len(votes) + 2))
            logs.append([prior + sum(math.log(chance[r][x]) for r, x in enumerate(v)) for v in votes])
        new = [1 / (1 + math.exp(min(a - b, 700))) for a, b in zip(*logs, strict=True)]
        if max(abs(a - b) for a, b in zip(new, good, strict=True)) < 1e-9:
            return new
        good = new
    return good


def judge_quality(docs):
    """{id: (counts, base_failed, kept)} of (id, text) rows with unique ids."""
    counts = [quality_counts(t) for _, t in docs]
    p = label_model([quality_votes(f) for f in counts]) if docs else []
    out = {}
    for (i, _), f, q in zip(docs, counts, p, strict=True):
        failed = f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]
        out[i] = f, failed, not failed and q >= 0.5
    return out


# --- near duplicates -------------------------------------------------------
def ngram_set(text, n):
    ws = WORD.findall(fold(text))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + n]) for i in range(max(len(ws) - n + 1, 1)))


def jaccard_components(docs, n, num, den):
    sets = [(i, ngram_set(t, n)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and den * len(s & t) >= num * len(s | t):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


# --- decontamination -------------------------------------------------------
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(text, items, span=10):
    ws = BENCH_WORD.findall(fold(text))
    hit, found = set(), set()
    for item_id, item in items:
        own = BENCH_WORD.findall(fold(item))
        k = min(len(own), span)
        windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(ws) - k + 1 if k else 0):
            if tuple(ws[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                found.add(str(item_id))
    return len(ws), len(hit), sorted(found)


# --- substrings ------------------------------------------------------------
def dedup_substrings(docs, window=13):
    """{id: (n_words, n_removed, kept text)}; ids unique."""
    words = {i: WORD.findall(t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for a in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][a : a + window]), i)
    out = {}
    for i, ws in words.items():
        gone = {a + j for a in range(len(ws) - window + 1) if first[tuple(ws[a : a + window])] < i for j in range(window)}
        out[i] = len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)
    return out


# --- lines -----------------------------------------------------------------
def dedup_lines(docs, run=3):
    """{id: (n_lines, n_removed, text)} of (id, text) rows with unique ids."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        lines = (text or "").split("\n")
        worded = [(k, x.strip(LINE_SPACE)) for k, x in enumerate(lines) if x.strip(LINE_SPACE)]
        gone = set()
        for a in range(len(worded) - run + 1):
            w = tuple(x for _, x in worded[a : a + run])
            if w in seen:
                gone |= {k for k, _ in worded[a : a + run]}
            seen.add(w)
        out[i] = len(worded), len(gone), text if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def dedup_passages(docs, run=3, long_words=50):
    """``dedup_lines`` that also deletes later runs of fewer lines with
    ``long_words`` words or that are a whole document."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        lines = (text or "").split("\n")
        worded = [(k, x.strip(LINE_SPACE)) for k, x in enumerate(lines) if x.strip(LINE_SPACE)]
        gone = set()
        for size in range(1, run + 1):
            for a in range(len(worded) - size + 1):
                w = tuple(x for _, x in worded[a : a + size])
                if w in seen and (size in (run, len(worded)) or sum(len(WORD.findall(x)) for x in w) >= long_words):
                    gone |= {k for k, _ in worded[a : a + size]}
                seen.add(w)
        out[i] = len(worded), len(gone), text if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


# --- sharding --------------------------------------------------------------
def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def divergence(rows, min_docs=3, top=200):
    """(lang, source, part, item, value, rank) of (lang, source, text) rows."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold(t or ""))) for lang, source, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [(s, Counter(ws)) for x, s, ws in docs if x == lang]
        df = Counter(w for _, ws in own for w in ws)
        kept = sorted((w for w in df if df[w] >= min_docs), key=str.encode)
        counts = {s: Counter() for s, _ in own}
        for s, ws in own:
            counts[s].update(ws)
        whole = sum(counts.values(), Counter())

        def share(c):
            d = sum(c[w] for w in kept) + len(kept)
            return {w: 1 + 10**9 * (c[w] + 1) // d for w in kept}

        q, p = share(whole), {s: share(c) for s, c in counts.items()}
        for s in counts:
            pair = [(sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o) for o in counts if o != s]
            term = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                for rank, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, v, rank))
    return out


def collocations(rows, max_words=5, least=100, top=2000, closed=100):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, n = {}, Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        c = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", fold(t or "")):
            ws = re.findall(r"[^ \t]+", piece)
            n[lang] += len(ws)
            for k in range(1, max_words + 1):
                c.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            inside = lambda q, p=p: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= closed * a and inside(q) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


def split_host_piece(piece, counts, total, longest=20):
    best = {0: (0.0, [])}
    for end in range(1, len(piece) + 1):
        found = None
        for start in range(end - 1, max(-1, end - longest - 1), -1):
            word = piece[start:end]
            price = -math.log(counts[word] / total) if word in counts else math.log(total) + math.log(10) * len(word)
            if found is None or best[start][0] + price < found[0]:
                found = (best[start][0] + price, [*best[start][1], word])
        best[end] = found
    return best[len(piece)][1]


def url_odds(pages, seeds, longest=20, mix=0.1):
    """Per page (id, url, html): log odds of the model that knows no seed word
    and of the one that gives the verdict, page by page."""
    counts = Counter()
    for _, _, html in pages:
        text = (html or "").lower()
        for tag in ("script", "style"):
            text = re.sub(rf"<{tag}\b.*?</{tag}\s*>", " ", text, flags=re.S)
        text = re.sub(r"<[^>]*>", " ", re.sub(r"<!--.*?-->", " ", text, flags=re.S))
        counts.update(w for w in re.findall("[a-z]+", text) if len(w) <= longest)
    total = sum(counts.values()) + 1
    for w in seeds:
        counts[w] = max(counts[w], 1, total // 10_000)
    words, tails = [], []
    for _, url, _ in pages:
        host, tail = re.search(r"://([^/?#]*)([^?#]*)", url or "").groups() if "://" in (url or "") else ("", "")
        pieces = re.findall("[a-z]+", fold(host))
        words.append([w for piece in pieces for w in split_host_piece(piece, counts, total, longest)])
        tails.append(["path " + re.sub("[0-9]+", "0", x) for x in re.findall("[a-z0-9]+", fold(tail))])

    def bayes(features, bad):
        n, per, size = Counter(), {True: Counter(), False: Counter()}, {}
        for f, y in zip(features, bad, strict=True):
            per[y].update(f)
            n.update(f)
        for y in per:
            size[y] = sum(per[y].values())
        prior = math.log((sum(bad) + 0.5) / (len(bad) - sum(bad) + 0.5))
        everything = sum(n.values())

        def p(t, y):
            return (1 - mix) * per[y][t] / size[y] + mix * n[t] / everything if size[y] else n[t] / everything

        return [prior + sum(math.log(p(t, True) / p(t, False)) for t in f) for f in features]

    seeded = [any(w in seeds for w in ws) for ws in words]
    first = bayes([[w for w in ws if w not in seeds] + t for ws, t in zip(words, tails, strict=True)], seeded)
    return first, bayes([ws + t for ws, t in zip(words, tails, strict=True)], [s or o >= 0 for s, o in zip(seeded, first, strict=True)])
