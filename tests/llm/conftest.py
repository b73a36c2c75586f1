import random

import pytest

CLASHES = "kept string, version int, data int, rest int, words int, node int, label int, score int, spans int, lang string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use too."""

    def make(rows):
        full = [(i, t, "x", 1, 2, 3, 4, 5, 6, 7, 8, "en") for i, t in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {CLASHES}")

    return make


@pytest.fixture(scope="session")
def near_copies():
    """Families of near copies of every closeness, with missing, empty, short and repeated rows."""
    random.seed(5)
    words = [f"w{i}" for i in range(2000)]
    bases = [[random.choice(words) for _ in range(random.randint(5, 150))] for _ in range(5)]
    rows = []
    for i in range(250):
        text = list(random.choice(bases))
        for _ in range(random.randint(0, max(1, len(text) // 25))):
            text[random.randrange(len(text))] = random.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(1000, None), (1001, ""), (1002, "a b"), (1003, "A  b\n"), (1004, rows[0][1])]
    return rows + [rows[-1]]


@pytest.fixture(scope="session")
def passages():
    """Texts that share passages around the length of 400 bytes, some changed in one place."""
    random.seed(2)

    def noise(n):
        return "".join(random.choice("abcdé \n") for _ in range(n))

    shared = [noise(random.choice([350, 399, 400, 401, 600, 1500])) for _ in range(6)]
    rows = []
    for i in range(40):
        text = noise(random.randint(0, 200))
        for _ in range(random.randint(0, 3)):
            part = random.choice(shared)
            if random.random() < 0.4:
                at = random.randrange(len(part))
                part = part[:at] + "#" + part[at + 1 :]
            text += part + noise(random.choice([0, 1, 5, 100]))
        rows.append((i, text))
    rows += [(100, None), (101, ""), (102, "a" * 2000), (103, "ab" * 500), (None, shared[-1] + "q")]
    return rows + [(106, rows[3][1]), (106, rows[3][1])]
