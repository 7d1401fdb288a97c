"""Small documents with every awkward case, shared by the operators' tests."""

import random

import pytest

LINE = "The quick brown fox jumps over the lazy dog and then it rests under an old tree for a very long while. "
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, SHARD string, _part int"


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "Sigma", "tau", "über", "naïve"])
                    + str(rng.randint(0, 99)) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """NULLs in any column, empty, blank and very long texts, ties, repeated rows."""
    rng = random.Random(7)
    out = []
    for i in range(40):
        text = words(rng, rng.randint(5, 120))
        out.append((i, text, rng.choice(["en", "de", "fr", "es"]), f"s{i % 4}"))
    copy = out[3][1]
    out += [(50 + i, copy, "en", "hot") for i in range(12)]                     # exact copies
    out += [(70 + i, copy + f" tail{i}", "en", "hot") for i in range(3)]        # near copies
    out += [(80 + i, words(rng, 30) + "\n" + LINE + "\n" + words(rng, 30), "en", "s1") for i in range(6)]
    out += [(90, None, None, None), (91, "", "en", "s2"), (92, " \t\n ", "en", None), (93, "one", None, "s3"),
            (94, words(rng, 20_000), "en", "s1"), (95, "a" * 5000, "en", "s2"), (None, "no id here at all", "en", "s0"),
            (None, None, None, None), (96, "!!! ### $$$", "xx", "s2"), (96, "another text of one id", "en", "s2")]
    out += [out[5], out[5]]                                                     # a row repeated whole
    return [(i, t, lang, src, None if t is None else len(t), "x", 1) for i, t, lang, src in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With extra columns whose names clash with the operators' own."""
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
