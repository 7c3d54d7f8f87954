import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n):
    return " ".join(rng.choice("ab ba cad dab ece fob gig Hut ink jam kit log mud nut".split()) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, shared passages, junk, very long and empty ones."""
    rng = random.Random(5)
    passage = words(rng, 40)
    out = [words(rng, rng.randint(1, 120)) for _ in range(60)]
    base = words(rng, 200)
    out += [base] * 4 + [base.replace("Hut", "hat", k) for k in (1, 2, 3)]
    out += [f"{words(rng, 30)}\n{passage}\n{words(rng, 25)}" for _ in range(5)]
    out += ["a line again\n" * 30, "é ñ ü " * 60, "x" * 5000, "aaaa " * 3000, "", " \t\n", "one", "# $ % < > | & * " * 5]
    out += [words(rng, 20_000), "\0" * 120]
    return out


@pytest.fixture(scope="session")
def rows(texts):
    """Document rows with different ids; the last has a NULL text, one a NULL source."""
    sources = ["s1", "s2", "", "Z", None]
    out = [(i, t, "en", sources[i % 5], len(t)) for i, t in enumerate(texts)]
    return [*out, (len(out), None, None, "s1", None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def odd(spark, rows):
    """Repeated rows and ids, NULL ids, all sources NULL, and columns named like results."""
    picked = rows[:8] + rows[60:64] + rows[-3:]
    doubled = [*picked, *picked[:3], (None, "no id here", "en", None, 1), (None, None, None, None, None), (1, "another text with this id", "en", None, 3)]
    clash = "size bigint, shard string, slot string, kept string, n_words string, spans string, row string, text_hash string"
    return spark.createDataFrame([(*r, 1, "a", "b", "c", "d", "e", "f", "g") for r in doubled], f"{SCHEMA}, {clash}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
