"""Small tables with the hard cases: nulls, blanks, ties, repeated rows, long texts, clashing columns."""

import random

WORDS = "alpha beta Gamma delta épsilon zeta, eta. theta iota! kappa lambda mu".split(" ")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed: int, n: int, most: int = 60) -> list[str]:
    """Random texts over a small vocabulary, so that repeats of every kind come up; some share passages."""
    rng = random.Random(seed)
    passages = [[rng.choice(WORDS) for _ in range(rng.randint(10, 40))] for _ in range(4)]
    out = []
    for _ in range(n):
        words = []
        while len(words) < rng.randint(0, most):
            words += rng.choice(passages) if rng.random() < 0.3 else [rng.choice(WORDS) for _ in range(rng.randint(1, 15))]
        text = words[0] if words else ""
        for word in words[1:]:
            text += rng.choice([" ", " ", " ", "\n", "  ", "\t", " \r\n"]) + word
        out.append(rng.choice(["", " ", "\n"]) + text if rng.random() < 0.2 else text)
    return out


def documents(spark, seed: int = 1, n: int = 60, most: int = 60):
    found = texts(seed, n, most)
    rows = [(i * 3, text, ("en", "de", None)[i % 3], f"s{i % 2}", len(text)) for i, text in enumerate(found)]
    rows += [(1000, None, "en", "s0", None), (1001, "", None, None, 0), (1002, " \n\t ", "en", "s0", 4)]
    rows += [rows[5], rows[5], (2, rows[7][1], "fr", "s1", 1), (1003, " ".join(found * 5), "en", "s0", 9)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5), rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
