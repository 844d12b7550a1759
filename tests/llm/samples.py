"""Small texts that the tests of the operators share."""

import random

SYLLABLES = "an be co di en fo ga he in ja ko le mi no or pa qui re sa ti un ve".split()


def sentence(rng: random.Random, words: int = 9) -> str:
    made = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(made).capitalize() + "."


def prose(rng: random.Random, sentences: int = 12) -> str:
    return " ".join(sentence(rng, rng.randint(6, 14)) for _ in range(sentences))


def documents(seed: int = 1, n: int = 30) -> list[tuple]:
    """doc_id, text: prose, copies, near copies, nulls, empty texts and a very long one."""
    rng = random.Random(seed)
    texts: list = [prose(rng) for _ in range(n)]
    words = texts[0].split()
    words[5] = "changed"
    texts += [texts[0], texts[0], " ".join(words), " ".join(texts[1].split()[:-1]), texts[2].upper()]
    texts += [None, "", "  \n\t ", "one", "one two", "ONE  two", prose(rng, 3000)]
    return [(i, t) for i, t in enumerate(texts)]


def clashing(spark, rows):
    """The rows as a table whose other columns have names that operators use themselves."""
    names = ["n", "score", "node", "_hash", "_bucket", "_key", "_text", "_base", "_row", "_found", "_word", "_q", "id", "key"]
    table = [(i, t, "en", *"x" * len(names)) for i, t in rows]
    return spark.createDataFrame(table, "doc_id long, text string, lang string, " + ", ".join(f"{n} string" for n in names))
