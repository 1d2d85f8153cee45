"""Small made-up texts."""

import random

EN = "the of and to in is was for it with as his on be at by had not are but from or have an they which one you were".split()


def word(rng):
    return "".join(rng.choice(["ka", "lo", "mi", "ten", "ra", "su", "ver", "no", "pi", "dor"]) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    return " ".join(rng.choice(EN) if rng.random() < 0.4 else word(rng) for _ in range(n))


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        k, at = rng.random(), rng.randrange(len(w))
        if k < 0.5:
            w[at] = word(rng) + "x"
        elif k < 0.75 and len(w) > 2:
            del w[at]
        else:
            w.insert(at, word(rng) + "y")
    return " ".join(w)


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def seeded(n):
    return random.Random(n)
