"""Small tables with the awkward cases, and brute-force versions of the operators."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = "id string, t string, row long, row_k string, score double, shard string, text_copy string, `a.b` string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def vocabulary(seed, n=400):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(2, 4))) for _ in range(n)]


def prose(rnd, vocab, n, line=25):
    words = [rnd.choice(vocab) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + line]) for i in range(0, n, line))


def edited(rnd, text, vocab, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rnd.randrange(len(words))] = rnd.choice(vocab)
    return " ".join(words)


def texts(seed=3):
    """(doc_id, text): nulls, blanks, one word, copies, near copies, a shared
    passage, a very long text, letters outside ASCII, repeated rows, null ids."""
    rnd, v = random.Random(seed), vocabulary(seed)
    base = [prose(rnd, v, rnd.randint(60, 160)) for _ in range(20)]
    passage = prose(rnd, v, 70)
    out = [None, "", " \n\t ", "one", "One", "two words", "a b c d", "A b C d", "###", "\x1c \x85   x"]
    out += base
    out += [base[0]] * 12 + [base[1].upper()]
    out += [edited(rnd, base[2], v, k % 6) for k in range(25)]
    out += [prose(rnd, v, 40) + "\n" + passage + "\n" + prose(rnd, v, 50) for _ in range(6)]
    out += [passage + " " + passage]
    out += [prose(rnd, v, 6000), "loop " * 300, "éß中 " * 80 + base[3]]
    rows = [(i, x) for i, x in enumerate(out)]
    rows += [(5, out[5]), (12, out[12]), (12, out[12]), (None, base[4]), (None, "alone here " + prose(rnd, v, 80)), (None, None)]
    rnd.shuffle(rows)
    return rows


def table(spark, rows):
    """The rows as documents, with extra columns of clashing names."""
    full = [(i, x, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 4}" if (i or 0) % 7 else None,
             None if x is None else len(x), "z", None, 7, "q", 0.5, "keep", x, "dot") for i, x in rows]
    return spark.createDataFrame(full, SCHEMA)


def saved(spark, rows, folder, parts=3):
    path = f"{folder}/docs"
    table(spark, rows).repartition(parts).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def words(x):
    return WORD.findall(x or "")


def shingles(x, k=5):
    w = [re.sub("[A-Z]", lambda m: m.group().lower(), y) for y in words(x)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def components(rows, percent=80):
    """Component number of each row under Jaccard links of all pairs."""
    sets = [shingles(x) for _, x in rows]
    par = list(range(len(rows)))

    def find(a):
        while par[a] != a:
            a = par[a]
        return a
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                par[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


def smallest_ids(rows, comp):
    low = defaultdict(lambda: None)
    for (i, _), c in zip(rows, comp):
        if i is not None and (low[c] is None or i < low[c]):
            low[c] = i
    return [low[c] for c in comp]


def recurring(rows, window=35):
    """Per row: words, and the flags of those in windows that start twice or more."""
    ws = [words(x) for _, x in rows]
    n = Counter(tuple(w[i:i + window]) for w in ws for i in range(len(w) - window + 1))
    out = []
    for w in ws:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if n[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((w, gone))
    return out


def multiset(rows):
    return Counter(tuple(r) for r in rows)
