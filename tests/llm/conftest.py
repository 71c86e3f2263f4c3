import random

import pytest

WORDS = [a + b for a in "ba ko li mu ne pa ro si tu wo".split() for b in "dan fer gul hix jom kes lun".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, changes):
    words = text.split(" ")
    for at in rng.sample(range(len(words)), changes):
        words[at] = rng.choice(WORDS) + "x"
    return " ".join(words)


@pytest.fixture(scope="session")
def texts():
    """Texts by id: prose, copies, near copies, repetitive, blank, empty, missing and very long ones."""
    rng = random.Random(5)
    base = prose(rng, 120)
    out = [prose(rng, rng.randint(1, 90)) for _ in range(30)]
    out += [base] * 3 + [edited(rng, base, rng.randint(1, 6)) for _ in range(25)]
    out += [f"{prose(rng, 40)} {base[:300]} {prose(rng, 30)}" for _ in range(3)]
    out += [None, "", " \n\t ", "a", "aa bb", "x" * 700, "ab " * 200, "Ünï çödé " * 40, prose(rng, 4000)]
    return list(enumerate(out))


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents, with columns named like results of the operators."""
    rows = [(i, t, "en" if i % 3 else "de", f"src{i % 5}", i, "x", 1) for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_words long, labels string, score int"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
