"""Small tables with the awkward rows every operator must cope with."""
import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, " \
       "size long, digest string, score string, rep int, label string, key string, n string"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) for _ in range(n))


def edge_rows():
    """Null ids, texts and sources, empty and very long texts, repeated rows and ids."""
    long = words(1, 30_000)
    texts = [(None, "no id here"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, long), (5, words(2, 60)),
             (5, words(2, 60)), (6, words(3, 60)), (6, words(4, 60)), (7, words(2, 60)), (8, "Ünïcode ▁ 漢字 \U0001f600 é"),
             (9, "a"), (10, "a"), (11, "b" * 5000), (12, "MIT License and the Apache License")]
    return [(i, t, None, None if k % 5 == 0 else f"s{k % 3}", None, 1, "x", "y", 2, "z", "k", "n")
            for k, (i, t) in enumerate(texts)]


def docs(spark, rows):
    """A frame of documents; short rows are (doc_id, text[, source])."""
    full = [r if len(r) == 12 else (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""),
                                    None, None, None, None, None, None, None) for r in rows]
    return spark.createDataFrame(full, DOCS)
