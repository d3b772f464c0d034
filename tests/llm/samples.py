"""Small tables with every awkward case, and plain Python versions of the operators."""

import hashlib
import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, version long, cid long, bucket int, kept string"


def words(seed, count, vocabulary=4000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


def documents(spark):
    """Nulls in every column, empty and very long texts, copies, near copies, shared
    passages, repeated rows, and extra columns named like the operators' own."""
    base, passage = words(1, 120), words(2, 60)
    near = [*base]
    near[60] = "changed"
    texts = {
        1: " ".join(base), 2: " ".join(base), 3: " ".join(near), 4: None, 5: "", 6: " \n\t ", 7: "one two three",
        8: "One TWO three", 9: " ".join(words(3, 300) + passage), 10: " ".join(passage + words(4, 300)),
        11: " ".join(words(5, 20_000)), 12: "same " * 200, 13: "same " * 250, 14: "naïve Œuvre 中文 ① <|endoftext|> x  y z",
        15: "a\nb\nc\nd\ne\nf\ng\nh\ni\nj", 16: "z\na\nb\nc\nd\ne\nf\ng\nh\ni\nj", 17: "\n\n\n\n", 18: " ".join(passage),
    }
    rows = [(i, t, None if i == 3 else "en", None if i == 4 else "s", None if i == 5 else 1, 1, 1, 1, "x")
            for i, t in texts.items()]
    rows += [rows[0], rows[8], (None, " ".join(base), None, None, None, None, None, None, None), (None, None) + (None,) * 7]
    return spark.createDataFrame(rows, DOCS)


def plain_passages(rows, window=13):
    """(id, words, removed, kept) by the definition."""
    first, out = {}, []
    for i, text in rows:
        w = (text or "").encode().split()
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    for i, text in rows:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def plain_similar(rows, size=5):
    """(id, shingles, component) by the definition; links by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        found = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
        sets.append(found or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[root(a)] = min(least.get(root(a), i), i)
    return [(i, len(sets[a]), least.get(root(a), i)) for a, (i, _) in enumerate(rows)]


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()
