"""The operators' contracts by brute force, without Spark."""

import hashlib
import re
from collections import Counter, defaultdict

TEXTS = ["", None, "one", "a b c d", "  ", "x" * 900, "the same words " * 40, "the same words " * 40]


def documents(spark, texts, extra=True):
    """Documents with columns whose names the operators might use themselves."""
    rows = [(i, t, "en", "s", None if t is None else len(t), f"k{i}", -1.0)
            for i, t in enumerate(texts)]
    ddl = ("doc_id bigint, text string, lang string, source string, n_chars bigint, key string, "
           "score double")
    df = spark.createDataFrame(rows, ddl)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def long_texts(seed=3):
    """Random words, passages shared by some texts, copies and near-copies."""
    import random
    r = random.Random(seed)

    def words(n):
        return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 8)))
                        for _ in range(n))
    shared = [words(90), words(150)]
    out = [words(r.randint(1, 200)) for _ in range(30)]
    for k in range(12):
        out.append(words(r.randint(0, 30)) + " " + shared[k % 2] + " " + words(r.randint(0, 30)))
    for k in range(8):
        copy = out[5].split()
        copy[(k * 7) % len(copy)] = f"new{k}"
        out.append(" ".join(copy))
    return out + [out[0], out[0], out[7], shared[0] + " " + shared[0], "ab" * 700]


def repeats(texts, length):
    """``(bytes, removed, runs, kept)`` of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[k:k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        mark = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                mark[k:k + length] = b"\1" * length
        runs = sum(1 for k, m in enumerate(mark) if m and not (k and mark[k - 1]))
        out.append((len(b), sum(mark), runs, bytes(x for x, m in zip(b, mark) if not m)))
    return out


def near_groups(texts, percent):
    """``(set size, smallest linked id or own)`` of each text; ids are positions."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for b in range(len(sets)):
        for a in range(b):
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if either and both and 100 * both >= percent * either:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(k)) for k, s in enumerate(sets)]


def exact_groups(texts):
    """``(id that stays, group size, digest)`` of each text."""
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    return [(max(groups[t or ""]), len(groups[t or ""]),
             hashlib.sha256((t or "").encode()).hexdigest()) for t in texts]


def license_places(text, phrases):
    """``(words, places, labels)``."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                       re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in phrases:
        want = phrase.split()
        for k in range(len(words) - len(want) + 1):
            if words[k:k + len(want)] == want:
                places.append(k)
                labels.add(label)
    return len(words), sorted(places), ",".join(sorted(labels))
