"""Odd rows that every operator must take: nulls, empty and long texts, repeated rows, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, shard string, id string, words string"


def rows(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = ["the", "of", "Alpha", "beta,", "gamma.", "été", "naïve", "x1", "Zürich", "42", "don't", "ñandú", "漢字", "—"]
    text = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    out = [(i, text(r.randint(1, 60)), r.choice(["en", "de", None]), r.choice(["a", "b", None]), None, 1, "s", "i", "w") for i in range(n)]
    copy = out[3][1]
    out += [(100 + i, copy, "en", "hot", None, 1, "s", "i", "w") for i in range(20)]
    out += [(200, None, None, None, None, None, None, None, None), (201, "", "en", "a", 0, None, None, None, None), (202, " \t\n ", "en", "a", 0, None, None, None, None)]
    out += [(203, text(6000), "en", "a", 0, 1, "s", "i", "w"), (204, "a" * 5000, None, "a", 0, 1, "s", "i", "w")]
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def save(spark, path, data=None, name="documents"):
    frame(spark, data).write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)


def thue_morse(n=2048):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))
