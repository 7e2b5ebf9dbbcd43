import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ["kept", "n_lines", "row", "key", "shard", "slot", "start", "c", "score", "lang_pred", "size", "h"]


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Copies, near copies, shared passages, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(1)
    base = [words(rng, 60) for _ in range(12)]
    passage = words(rng, 50)
    texts = list(base)
    texts += [base[0]] * 5 + [base[1].replace("w1", "w2", 1)]
    texts += [" ".join(b.split()[:40] + [f"new{i}"] + b.split()[41:]) for i, b in enumerate([base[2]] * 6)]
    texts += [words(rng, 30) + " " + passage + "\n" + words(rng, 20) for _ in range(4)]
    texts += [None, "", "   \n ", "one", "one two three", "Ümlaut ñandú, don't STOP! <|endoftext|>", words(rng, 30_000, 5000), "a " * 500, "x" * 70_000]
    texts += ["l1 a b\nl2 c d\nl3 e f\nl4 g h", "z0\nl1 a b\nl2 c d\nl3 e f\nend", "same\nsame\nsame\nsame\nsame", "\n\n\n\n"]
    out = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return out + [out[3], (None, base[4], None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with further columns whose names operators use too."""
    from pyspark.sql import functions as F

    d = spark.createDataFrame(rows, SCHEMA)
    return d.withColumns({c: F.lit(7) for c in CLASH})


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.filter("false")
