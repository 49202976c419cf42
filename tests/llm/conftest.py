import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, or from (id, text)."""

    def make(texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, tied and long texts."""
    words = random.Random(5)
    long = " ".join(words.choice("abcdefgh") * words.randint(1, 9) for _ in range(30_000))
    prose = " ".join(f"w{i}" for i in range(60))
    return [None, "", " \t\n", "one", prose, prose, f"x {prose} y", long, "é ß 字 \x00 end"]


@pytest.fixture(scope="session")
def clashing():
    """Adds columns whose names operators may want for themselves."""

    def add(rows):
        from pyspark.sql import functions as F

        names = ("key", "_key", "_spans", "_text", "spans", "id", "n", "fp", "anchor", "kept", "host", "tokens", "n_words", "_tokens")
        return rows.withColumns({name: F.lit(1) for name in names if name not in rows.columns})

    return add
