"""Small documents tables with the awkward cases every operator must take: nulls, empty and long texts, ties, repeated
rows, clashing column names, empty tables."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, pos int, ka string, hits string"


def rows(seed: int = 0, n: int = 40, vocabulary: int = 60) -> list[tuple]:
    r = random.Random(seed)
    word = lambda: r.choice(["é", "a", "the", "naïve", "x"]) + str(r.randrange(vocabulary))
    passage = [word() for _ in range(60)]
    texts = []
    for i in range(n):
        t = [word() for _ in range(r.randrange(1, 120))]
        if i % 4 == 0:
            a = r.randrange(0, 20)
            t[3:3] = passage[a : a + r.randrange(30, 50)]
        texts.append(r.choice([" ", "  ", "\n", "\t"]).join(t))
    texts += [texts[0], texts[0].upper(), texts[1] + " tail", None, "", " \n ", "one", " ", passage[0] * 3]
    texts.append(" ".join(["same"] * 90))
    texts.append(" ".join(passage * 200))
    out = [(i, t, r.choice(["en", "de", None]), f"s{i % 3}", i, 1, 2, "k", None) for i, t in enumerate(texts)]
    return [*out, out[0], out[3], (None, texts[2], None, None, None, 1, 2, "k", None), (None, None, None, None, None, 1, 2, "k", None)]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
