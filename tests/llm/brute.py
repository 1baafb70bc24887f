"""Plain re-computations of the registered corpus queries."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(sf_dir, table, columns):
    return duckdb.sql(f"SELECT {columns} FROM read_parquet('{sf_dir}/{table}.parquet')").fetchall()


def docs(sf_dir):
    return [(i, t or "") for i, t in rows(sf_dir, "documents", "doc_id, text")]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def measures(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def exact_groups(sf_dir):
    groups = defaultdict(list)
    for i, t in docs(sf_dir):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
    return [
        (i, min(ids), len(ids), sha(t)) for t, ids in groups.items() for i in ids
    ]


def chats(sf_dir, tricky):
    turns = defaultdict(list)
    low = -(10**9)
    for c, n, r, t in rows(sf_dir, "conversations", "conv_id, turn, role, text"):
        turns[c].append((low if n is None else n, r or "", t or ""))
    turns[-7] = [(0, "user", tricky), (1, "assistant", tricky)]
    out = []
    for c, own in turns.items():
        own.sort()
        loss = "".join(t for _, r, t in own if r == "assistant")
        out.append(
            (c, len(own), sha("".join(f"{r}\n{t}\n" for _, r, t in own)), len(loss), sha(loss))
        )
    return out


def shingles(text, k=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def near_components(sf_dir, percent=85):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in docs(sf_dir)]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                both = len(s & t)
                if 100 * both >= percent * (len(s) + len(t) - both):
                    x, y = sorted((root(i), root(j)))
                    parent[y] = x
    return [(i, len(s), root(i)) for i, s in sets]


def long_repeats(sf_dir, window=200):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) from a table of all windows."""
    texts = [(i, t.encode()) for i, t in docs(sf_dir)]
    seen = Counter()
    for _, t in texts:
        seen.update(t[k : k + window] for k in range(len(t) - window + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - window + 1):
            if seen[t[k : k + window]] > 1:
                gone[k : k + window] = b"\1" * window
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(t), sum(gone), spans, sha(kept)))
    return out


def word_distance(a, b):
    """Levenshtein distance between two lists of words."""
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left = [i]
        for j, y in enumerate(b, 1):
            left.append(min(line[j] + 1, left[-1] + 1, line[j - 1] + (x != y)))
        line = left
    return line[-1]


# Scripts without blanks: every character counts as a word.
WIDE = re.compile(
    "[\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
    "\U00020000-\U0003ffff]"
)


def deduplicated_lines(texts, least=5, bound=1):
    """The texts without lines whose words equal those of an earlier line of (doc_id, line)
    order or, from ``least`` words on, differ from them in at most ``bound`` words."""
    earlier, exact, dropped = defaultdict(list), set(), set()
    for i, n, x in sorted({(i, n, x) for i, t in texts for n, x in enumerate(t.split("\n"))}):
        words = WORD.findall(WIDE.sub(r" \g<0> ", x))
        if not words:
            continue
        near = [w for k in range(-bound, bound + 1) for w in earlier[len(words) + k]]
        if tuple(words) in exact or len(words) >= least and any(
            word_distance(words, w) <= bound for w in near
        ):
            dropped.add((i, n))
        exact.add(tuple(words))
        if len(words) >= least:
            earlier[len(words)].append(words)
    return {
        i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in dropped)
        for i, t in texts
    }


def usable_vectors(sf_dir, length=None):
    """(vec_id, vector) of the rows without nulls and non-finite components."""
    found = rows(sf_dir, "embeddings", "vec_id, embedding")
    return [
        (i, v) for i, v in found
        if v is not None and (length is None or len(v) == length)
        and all(c is not None and math.isfinite(c) for c in v)
    ]


def clusters(sf_dir, k=8, rounds=10):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) in whole numbers."""
    kept = [(i, [math.floor(1024 * c) for c in v]) for i, v in usable_vectors(sf_dir, 64)]
    order = sorted((sha(f"3:{'' if i is None else i}"), x) for i, x in kept)
    centroids = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, x in kept:
            members[nearest(x)[1]].append(x)
        for n, own in members.items():
            centroids[n] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [(i, *nearest(x)) for i, x in kept]
    per = Counter()
    for _, distance, n in found:
        per[n] += distance
    return [
        (i, n, d, per[n], sum(per.values()), sha(",".join(map(str, centroids[n])))) for i, d, n in found
    ]
