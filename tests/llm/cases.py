"""Small documents with everything that may go wrong in a table."""

import random

DDL = "doc_id long, text string, lang string, source string, n_chars long, size string, digest int, key string, rank int, component_id string"
EXTRA = (None, -1, "k", 0, "x")


def documents(n=140, seed=5):
    """(rows, DDL): random texts, exact and near copies, nulls, empty and long texts, repeated rows, columns with clashing names."""
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in ("la", "To", "mi", "re", "so", "é") for b in ("n", "ß", "st", "9", "x", "!", "um", "ko")]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choices(words, k=rnd.choice([1, 2, 5, 30, 60, 200])))
        if i % 5 == 1:
            text = rows[i - 1][1]
        if i % 5 == 2 and rows[i - 1][1]:
            w = rows[i - 1][1].split()
            w[rnd.randrange(len(w))] = "changed"
            text = " ".join(w)
        if i % 17 == 3:
            text = rnd.choice([None, "", " ", "\n\t", "a", "A b", "a\x0bB", " a  b ", "<|endoftext|> it's", "日本 語"])
        rows.append((i * 3, text, None, f"s{rnd.choice([0, 0, 0, 1, 2])}" if i % 11 else None, len(text or "")))
    rows += [rows[7], rows[7], rows[20]]                       # repeated rows
    rows += [(None, "no id at all", "en", "s1", 0), (None, None, None, None, None), (None, "no id at all", "en", "s1", 0)]
    rows += [(rows[9][0], "another text of the same id", "en", "s9", 3)]
    rows += [(900, "w" * 5000, "en", "s1", 0), (901, "pad " * 9000 + "end", "en", "s2", 0), (902, ("l" * 30 + "\n") * 300, "en", "s0", 0)]
    return [(*r, *EXTRA) for r in rows]


def frame(spark, rows=None):
    rows = documents() if rows is None else rows
    return spark.createDataFrame(rows, DDL).repartition(4)
