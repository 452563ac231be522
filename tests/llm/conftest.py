import random

import pytest

FILLER = "the of and to in is was for on with as by at from this that have not are but".split()


def sentence(rng, n):
    return " ".join(rng.choice(FILLER) if rng.random() < 0.4 else "".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Texts with nulls, empty and very long ones, copies, near copies, shared passages, periodic text."""
    rng = random.Random(3)
    passage = sentence(rng, 60)
    base = sentence(rng, 90)
    made = [None, "", "   \n\t ", "One two", "one TWO", "a b c d e", passage, base, base, base.upper()]
    for _ in range(12):
        words = base.split()
        words[rng.randrange(len(words))] = "changed"
        made.append(" ".join(words))
    made += [f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}" for _ in range(8)]
    made += [sentence(rng, rng.randint(1, 200)) for _ in range(30)]
    made += ["ab " * 300, "x" * 5000, "Éè \U0001f600 İaß. " * 40, sentence(rng, 4000), "tab\tsep\x0bv\x0cf\rr\x1cfs\x00nul " * 30]
    return [(i, text) for i, text in enumerate(made)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The texts as a table that has more columns, some with names the operators use inside."""
    more = [(i, text, "en", i % 3, 1.5, "k") for i, text in rows]
    return spark.createDataFrame(more, "doc_id long, text string, lang string, id int, n double, key string").repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
