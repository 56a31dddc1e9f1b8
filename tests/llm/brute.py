"""Brute-force versions of the document operators, and small awkward tables."""

import hashlib
import random
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def order(rows):
    """Rows (doc_id, text) in the operators' order: null ids last, ties by text."""
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))


def substring(rows, size=20):
    seen, out = set(), []
    for i, text in order(rows):
        w = words(text)
        gone = [False] * len(w)
        for at in range(len(w) - size + 1):
            window = tuple(w[at:at + size])
            if window in seen:
                gone[at:at + size] = [True] * size
            seen.add(window)
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return out


def suffix(rows, size=100):
    seen, out = set(), []
    for i, text in order(rows):
        b = text.encode()
        gone = np.zeros(len(b), dtype=bool)
        for at in range(len(b) - size + 1):
            window = b[at:at + size]
            if window in seen:
                gone[at:at + size] = True
            seen.add(window)
        edge = np.diff(np.concatenate(([0], gone.astype(int))))
        out.append((i, len(b), int(gone.sum()), int((edge == 1).sum()), sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return out


def suffix_texts(rows, size=100):
    """{doc_id: text left}: code points of which every byte is repeated go; texts of which nothing
    is left are not in it."""
    seen, out = set(), {}
    for i, text in order(rows):
        b = text.encode()
        gone = np.zeros(len(b), dtype=bool)
        for at in range(len(b) - size + 1):
            window = b[at:at + size]
            if window in seen:
                gone[at:at + size] = True
            seen.add(window)
        left, at = [], 0
        for c in text:
            n = len(c.encode())
            if not gone[at:at + n].all():
                left.append(c)
            at += n
        if left or not text:
            out[i] = "".join(left)
    return out


def simhash(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), seed=42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Root index of each fingerprint's class under links of 3 bits or fewer."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    return [find(x) for x in range(len(prints))]


def rules(text):
    w = words(text)
    count = {}
    for i in range(len(w) - 7):
        key = tuple(w[i:i + 8])
        count[key] = count.get(key, 0) + 1
    repeated = [False] * len(w)
    for i in range(len(w) - 7):
        if count[tuple(w[i:i + 8])] > 1:
            repeated[i:i + 8] = [True] * 8
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, sum(repeated),
            len(w) < 20 or 100 * sum(repeated) > 30 * len(w))


def corpus(n=60, seed=0, ids=True):
    """Texts with copies, near copies, shared passages, few distinct words, odd spaces, other
    scripts, an empty and a null one, and one long one."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé漢 ñö"[:8]) for _ in range(rng.randint(1, 7))).strip() or "x" for _ in range(120)]
    spaces = [" ", " ", " ", " ", "\n", "  ", "\t"]

    def text(k):
        return "".join(rng.choice(vocabulary) + rng.choice(spaces) for _ in range(k))

    passages = [text(45) for _ in range(3)]
    out = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.2 and out:
            out.append(rng.choice(out))
        elif kind < 0.4 and out:
            w = (rng.choice(out) or "a b").split(" ")
            w[rng.randrange(len(w))] = "changed"
            out.append(" ".join(w))
        elif kind < 0.7:
            out.append(text(rng.randint(0, 60)) + rng.choice(passages) + text(rng.randint(0, 60)))
        else:
            out.append(text(rng.randint(0, 120)))
    out += ["", None, "one", "a b", text(6000) + "tail " * 300, "word" * 500, "A  B\tC " + passages[0]]
    rng.shuffle(out)
    return list(enumerate(out)) if ids else [(rng.choice([None, 1, 2, 3, i]), t) for i, t in enumerate(out)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, marks string, kept string, label string, _k string, row string"


def table(spark, rows):
    """A documents table with other columns whose names clash with the operators' own."""
    full = [(i, t, None, "s", len(t or ""), "m", "k", "l", "x", "r") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)
