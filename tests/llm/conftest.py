import random

import pytest

WORDS = [f"w{k}{'aeiou'[k % 5]}" for k in range(400)]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source): random texts, copies, near copies, shared passages, and awkward rows."""
    rng = random.Random(5)
    passage = " ".join(rng.choices(WORDS, k=70))
    rows = []
    for i in range(60):
        words = rng.choices(WORDS, k=rng.randint(3, 120))
        rows.append([i, " ".join(words), rng.choice(["en", "de"]), rng.choice(["a", "b"])])
    for i in range(60, 90):  # near copies, some of copies
        words = rows[rng.randrange(len(rows))][1].split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        rows.append([i, " ".join(words), "en", "a"])
    for i in range(90, 100):
        rows.append([i, " ".join(rng.choices(WORDS, k=20)) + f"\n{passage}\n" + " ".join(rng.choices(WORDS, k=20)), "de", "b"])
    rows += [
        [100, None, "en", "a"], [101, "", "en", None], [102, " \n\t ", None, "a"], [103, "w0a", "en", "a"], [104, "w0a", "en", "b"],
        [105, " ".join(rng.choices(WORDS, k=30_000)), "en", "a"], [106, "x" * 50_000, None, "b"], [107, "Ünï cödé 日本語 🙂 " * 8, "de", "b"],
        [107, "Ünï cödé 日本語 🙂 " * 8, "de", "b"], [None, rows[0][1], "en", "a"], [None, None, None, None], [108, "12 34 !!", "en", "a"],
        [7, "another text under a number that is taken", "en", "a"],
    ]
    rng.shuffle(rows)
    return [tuple(r) for r in rows]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, corpus):
    """The same rows with columns named as operators name theirs."""
    more = "shard string, slot string, row string, node string, score string, key string, items string, ids string, n_lines string, block string"
    return spark.createDataFrame([r + ("x",) * 10 for r in corpus], f"{SCHEMA}, {more}")
