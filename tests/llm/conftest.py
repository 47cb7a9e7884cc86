import pyarrow.dataset as ds
import pytest

from dimsmith.llm.common import tune

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, as columns of the input.
CLASHING = ("words", "found", "fp", "root", "place", "salt", "rank", "shard", "slot", "score", "ids", "x", "k", "h",
            "t", "row_itself", "component_id", "train", "cell", "n")

ENGLISH = "the quick brown fox jumps over the lazy dog and then runs away from the big bad wolf in the dark wood"


def _hard_texts():
    long = " ".join(f"w{i % 997} v{i % 89}" for i in range(30_000))
    return [
        (1, ENGLISH), (2, ENGLISH), (3, ENGLISH.replace("quick", "slow")), (4, None), (5, ""), (6, "   \n\t "),
        (7, "one"), (8, "two words"), (9, long), (10, long + " tail"), (None, ENGLISH), (None, None), (1, ENGLISH),
        (1, "another text under an id that is there already, " + ENGLISH), (11, "spam ham eggs foo bar " * 40),
        (12, "line one is here\nline one is here\nline two\n\nline two\n   \n" + ENGLISH),
        (13, "Released under the MIT License. Apache License, Version 2.0 and CC BY-NC"),
        (14, "mail John.Doe+x@mail.example.co.uk or 10.0.0.255, 10.0.0.256, 4111 1111 1111 1111 and +1 (555) 123-4567"),
        (15, "Ünïcödé ẞ 日本語 текст 😀 naïve café " * 3), (16, "#### $$$ %% && || <> " * 5 + ENGLISH),
        (17, "\x00ctl\x01 \x1c sep \x85 next line  nbsp"), (2 ** 62, "a very large id"), (-5, "a negative id"),
    ]


@pytest.fixture(scope="session")
def session(spark):
    tune(spark)
    return spark


@pytest.fixture(scope="session")
def hard(session):
    """Rows with nulls, empties, long texts, ties, repeats and clashing extra columns."""
    rows = [(d, t, "en", "src", len(t or "")) + (7,) * len(CLASHING) for d, t in _hard_texts()]
    df = session.createDataFrame(rows, SCHEMA + "".join(f", `{c}` int" for c in CLASHING))
    return df.repartition(3).checkpoint()


@pytest.fixture(scope="session")
def hard_rows(hard):
    return [(r["doc_id"], r["text"]) for r in hard.collect()]


@pytest.fixture(scope="session")
def none(hard):
    return hard.where("false")


@pytest.fixture(scope="session")
def small(session):
    return session.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def small_rows():
    return [(r["doc_id"], r["text"]) for r in ds.dataset(f"{SF}/documents.parquet").to_table().to_pylist()]


