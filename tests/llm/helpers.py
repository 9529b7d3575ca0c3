"""Small tables with the cases every operator must take: nulls, empty and long texts, ties, repeated rows,
extra columns whose names clash with an operator's own."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, k1 string, fp string, kept string, words string, n long, slot long, label int, llm_kept string, llm_language string, llm_k1 long, llm_digest long, found_id long, id long, hash long, root long"

SYLLABLES = {"aa": "the an in er on ti re at th".split(), "bb": "der die sch ein ung ge be lich".split()}


def prose(rnd, n, lang="aa"):
    words = ["".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n)]
    return " ".join(w.capitalize() + "." if rnd.random() < 0.1 else w for w in words)


def texts(seed=1, n=60):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        lang = "aa" if k % 3 else "bb"
        out.append((prose(rnd, rnd.choice([1, 3, 60, 120, 200]), lang), lang))
    for k in range(10):  # near copies
        t, lang = out[k * 5]
        out.append((t + " end", lang))
    out += [out[2], out[3], out[3]]  # copies
    out += [(None, "aa"), ("", "aa"), ("   \n\t ", "bb"), ("12 34 !", None), ("é漢字🎉 Σας", "aa"), ("ab " * 3000, "bb"), (out[5][0] + " " + out[7][0], None)]
    return out


def table(spark, rows=None):
    rows = texts() if rows is None else rows
    data = [(i, t, lang, f"s{i % 3}" if i % 7 else None, len(t or ""), 0.5, "k", "f", "x", "w", 1, 2, 3, "x", "y", 4, 5, 6, 7, 8, 9) for i, (t, lang) in enumerate(rows)]
    if data:
        data += [data[4], data[4], (None, *data[6][1:]), (None, *data[6][1:])]  # repeated rows, no id
    return spark.createDataFrame(data, SCHEMA).repartition(3)
