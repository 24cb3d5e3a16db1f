"""Small inputs with everything an operator must stand, and plain answers to compare with."""

import random
import re

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Names that clash with columns the operators use, one in capitals.
SCHEMA = (
    "doc_id bigint, text string, lang string, row int, spans string, score double, "
    "fingerprint string, TEXT string"
)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def prose(seed, count, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(count))


def documents(spark, rows):
    full = [(i, t, "en", 7, "own", 0.5, "f", "other") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [
    (1, "The quick brown fox, don't JUMP over 123 dogs!"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "a row without a number"),
    (None, None),
    (5, "the same row twice, the same row twice"),
    (5, "the same row twice, the same row twice"),
    (6, prose(1, 30_000, 5_000)),
    (7, "x" * 5_000 + "é" * 300),
    (8, "wide   space and <|endoftext|> marks<|startoftext|>　ΣΑΣ İx ½"),
    (9, "spam " * 700),
    (10, "  leading  blanks\r\n\r\nand 漢字 😀👍🏽 trailing  "),
]


def merged(nodes, pairs):
    """Smallest node that pairs reach from each node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def clusters(seed, size=16, groups=30, copies=6):
    """Unit vectors: random ones, near copies of some, and exact copies."""
    random_ = np.random.default_rng(seed)
    rows = list(random_.standard_normal((200, size)))
    for g in range(groups):
        rows += [rows[g] + 0.03 * random_.standard_normal(size) for _ in range(copies)]
    rows += [rows[0]] * 50
    return [r / np.linalg.norm(r) for r in rows]
