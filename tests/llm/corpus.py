"""Small corpora with nulls, empty and very long texts, copies, repeated rows and clashing columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, part int, shard string, n long, key string, "
          "epoch string")


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" + r.choice(["", "", ",", "."]) for _ in range(n)]


PASSAGE = " ".join(words("passage", 70))


def texts():
    long = words("long", 30_000, 3000)
    changed = list(long)
    for i in range(0, 30_000, 3000):
        changed[i] = "changed"
    one = " ".join(words(1, 120))
    return [
        (1, one + " " + PASSAGE), (2, PASSAGE + "\n" + " ".join(words(2, 50))), (3, one + " " + PASSAGE),
        (4, one + " " + PASSAGE + " tail"), (5, None), (6, ""), (7, " \n\t "), (8, "same " * 80), (9, "Word"),
        (10, "two  words"), (11, "TWO words"), (12, " ".join(long)), (13, " ".join(changed)), (14, "ünï çödé – ﬁn 日本 " * 12),
        (15, "".join(chr(97 + i % 23) for i in range(300))), (16, "x" + "".join(chr(97 + i % 23) for i in range(300))),
        (17, " ".join(words(17, 34))), (18, " ".join(words(17, 35))), (19, " ".join(words(17, 36))),
        (20, "ab" * 60), (21, "ba" * 60), (22, one[:300]), (23, " ".join(words(23, 200))), (24, " ".join(words(23, 200)) + " end"),
        (2, PASSAGE + "\n" + " ".join(words(2, 50))), (None, PASSAGE),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    sources = ["src1", "src2", None, "ärc", "Src"]
    return spark.createDataFrame(
        [(i, t, ["en", "de", None][k % 3], sources[k % 5], len(t) if t else None, k, "s", k, "k", "e")
         for k, (i, t) in enumerate(rows)], SCHEMA)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
