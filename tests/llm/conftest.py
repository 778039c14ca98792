import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

LONG = "word%d other " * 1 + " ".join(f"w{i % 977} x{i}" for i in range(40_000))

#: Nulls in every column, empty and long texts, ties, repeated rows.
ROWS = [
    (1, "a b c d e f g h " * 10, "en", "s1", 160),
    (2, "a b c d e f g h " * 10, "en", "s1", 160),
    (2, "a b c d e f g h " * 10, "en", "s1", 160),
    (3, None, None, None, None),
    (4, "", "de", "s2", 0),
    (5, " \n\t ", "de", "s2", 4),
    (6, "One two\nthree", "de", None, 13),
    (7, LONG, "en", "s1", len(LONG)),
    (8, LONG + " tail", "en", "s2", len(LONG) + 5),
    (None, "no id but some words here\nand a line", None, "s3", None),
    (9, "line one of the text\nline one of the text\nLINE one of the text", "en", "s3", 62),
    (10, "line one of the text and\nother é <|endoftext|> x", "fr", "s3", 40),
]
NAMES = ["_row", "key", "line", "n", "value", "component_id", "kept", "shard", "place", "size", "host", "_doc", "f", "at"]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns whose names the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)
    return spark.createDataFrame([r + ("x",) * len(NAMES) for r in ROWS], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path
