import os
import random

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCHEMA = ("doc_id long, text string, source string, n long, score double, spans string, kept boolean, label int, "
          "line string, copies int, text_key string, n_words int")
EMPTY = "doc_id long, text string, source string"


@pytest.fixture(scope="session", autouse=True)
def workers_find_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


def words(rng, n):
    return [rng.choice("the of and in to lorem ipsum dolor sit amet é ß naïve Ñandú".split())
            + rng.choice(["", "x", "yy", "1", "."]) for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, source): nulls, empty and long texts, repeated rows, ties, near copies."""
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randint(1, 60))) for _ in range(40)]
    base = words(rng, 120)
    for k in (0, 0, 1, 2, 3, 4, 30):
        copy = list(base)
        for _ in range(k):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(99)}"
        texts.append(" ".join(copy))
    line = "This very line stands in many documents, Over AND over."
    for k in range(7):
        texts.append(f"own {k}\n  {line if k % 2 else line.lower()} \t\nrest {k}\n{line}")
    texts += ["", " \t\n", None, "one", "ONE two", "a" * 30_000, " ".join(words(rng, 20_000)), "\U0001F600 é\nß"]
    out = [(i, t, f"src{i % 4}" if i % 9 else None) for i, t in enumerate(texts)]
    out += [out[3], out[45], (None, texts[4], "src1"), (None, None, None)]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with extra columns whose names operators use themselves."""
    full = [(i, t, s, 1, 0.5, "s", True, 3, "l", 2, "k", 7) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EMPTY)


def by_row(df, *cols):
    """Sorted rows of a result, to compare as a multiset."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
