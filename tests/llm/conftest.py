import random

import pytest

# Columns that operators don't read, named as they name things inside.
CLASHING = ["key", "set", "size", "line", "number", "grams", "entry", "carry", "score", "length", "place", "_cell", "id", "text_key", "text_key_", "component"]
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, " + ", ".join(f"`{c}` STRING" for c in CLASHING)


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(["ba", "no", "ti", "re", "lu", "sha"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def sample_texts(seed: int = 1) -> list[str | None]:
    """Texts with exact and near copies, shared passages and lines, ties, empty, null and very long ones."""
    rng = random.Random(seed)
    texts: list[str | None] = []
    passage = " ".join(words(rng, 50))
    for k in range(40):
        lines = [" ".join(words(rng, rng.randint(1, 25))) for _ in range(rng.randint(1, 8))]
        if k % 7 == 0:
            lines.insert(len(lines) // 2, passage)
        if k % 5 == 0:
            lines.append("The same Line\tin many of them")
        texts.append("\n".join(lines))
    base = words(rng, 200)
    for k in range(12):  # copies with a word changed here and there
        copy = list(base)
        for _ in range(k % 4):
            copy[rng.randrange(200)] = "changed"
        texts.append(" ".join(copy[:100]) + "\n" + " ".join(copy[100:]))
    texts += [texts[0]] * 3 + [None, "", " \t\n ", "one", "one two three", "a\n\na\n", "é ß 日本  x"]
    texts.append(" ".join(words(rng, 30_000)))
    texts.append("same same same same same same same same " * 40)
    return texts


@pytest.fixture(scope="session")
def texts():
    return sample_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(k, t, "en", "src0", None, *["x"] * len(CLASHING)) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark, texts):
    """Repeated rows, and rows without an id."""
    rows = [(k, texts[k], None, None, None, *[None] * len(CLASHING)) for k in (0, 0, 1, 40, 41, 52)]  # 52 is a copy of 0
    rows += [(None, texts[0], None, None, None, *[None] * len(CLASHING)), (None, None, None, None, None, *[None] * len(CLASHING))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing():
    return CLASHING
