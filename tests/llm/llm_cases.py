"""Small tables with every awkward row: nulls, empty and long texts, ties, repeats, clashing names."""

import random

SCHEMA = ("doc_id bigint, text string, score double, part int, word string, place bigint, "
          "n bigint, kept string, component bigint")


def words_of(text):
    return (text or "").encode().split()


def frame(spark, rows):
    """Documents with more columns, whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 0.5, 1, "w", 2, 3, "k", 4) for i, t in rows], SCHEMA)


def awkward():
    """(doc_id, text) with distinct ids, whose texts share passages and are near copies."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "naïve", "日本", "Ab", "aB", "don't", "x y", "q\x1fz"]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 90))) for _ in range(12)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(45))
    rows = [(i, t) for i, t in enumerate(base, 10)]
    for i in range(14):  # near copies, some of which pass the threshold
        w = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((100 + i, " ".join(w)))
    for i in range(8):
        w = rng.choice(base).split(" ")
        rows.append((200 + i, " ".join(w[:10]) + "\n" + passage + "\t" + " ".join(w[20:40])))
    rows += [(300, ""), (301, None), (302, "  \n "), (303, "one"), (304, "one"), (305, "One two three"),
             (306, "a b c d"), (307, "the " * 200), (308, "the " * 25), (309, " ".join(vocabulary * 30)),
             (310, base[0]), (311, base[0]), (312, "x" * 5000), (313, "<|endoftext|> ΣΑΣ İ \x07 é 😀😀")]
    rng.shuffle(rows)
    return rows


def union_find(keys, links):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}
