from __future__ import annotations

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, component_id string, "
    "score string, ids string, tree string, n_tokens string, text_key string, line string, start string, bucket string"
)
BASE = "The quick brown fox jumps over the lazy dog and runs away from the other animals in the wood"


def rows() -> list[tuple]:
    texts = [
        (1, BASE),
        (2, BASE),  # an exact copy
        (3, BASE.replace("lazy", "lazier")),
        (4, None),
        (5, ""),
        (6, "  \n\t "),
        (7, "word " * 30_000 + "end"),  # very long
        (8, "x" * 5_000),  # one very long word
        (9, "Ein kurzer Satz über den Wald, in dem die Tiere leben und schlafen"),
        (9, "Ein kurzer Satz über den Wald, in dem die Tiere leben und schlafen"),  # a repeated row
        (9, "another text under the same id, with enough words to be looked at by every operator"),
        (None, "a text without an id that is long enough to be compared with the other texts here"),
        (None, None),
        (10, "specials <|endoftext|> and <|startoftext|> \x1c ΑΣ İ 漢字 😀 é ﬁ   ▁  "),
        (11, "first line that is repeated in two documents\nsecond line of the first document only here\n\nshort"),
        (12, "first line that is repeated in two documents\nanother second line of the other document"),
        (13, "first line that is repeated in twoo documents\r\nfirst line that is repeated in two documents"),
        (-5, "negative ids are ids, too, and this is a text of some words"),
    ]
    extra = ["clash"] * 10
    return [(i, t, None if k % 5 == 4 else "en", None if k % 7 == 3 else f"s{k % 3}", None, *extra) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns that clash with the operators' own."""
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def texts_of(df) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
