import random

import pytest

EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, file string, row int, id long, tokens int, block int, bucket int"


def edge_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows; extra columns named like inner ones."""
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "Epsilon", "zeta", "eta", "theta", "iota", "kappa"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [None, "", " \t\n", "x", "one two", "one two three", say(50), say(50), say(6000), "É ñ ß 漢字 😀 İ K", "a\x1cb <|endoftext|> c"]
    out = []
    for k, text in enumerate(texts):
        extra = (0.5, True, "f", 1, 7, 3, 0, 1) if k % 2 else (None,) * 8
        out.append((k, text, "en" if k % 3 else None, "s1" if k % 4 else None, None if text is None else len(text), *extra))
    out.append(out[6])  # a repeated row
    out.append((40, texts[6], "en", "s2", 1, *(None,) * 8))  # the same text under another id
    out.append((None, "no id", "fr", "s2", 1, *(None,) * 8))
    return out


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    spark.createDataFrame(edge_rows(), EDGE_SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(3, 0), (3, 1), (4, 0), (6, 1), (7, None), (None, 1)], "doc_id long, toxic int")


def docs_of(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
