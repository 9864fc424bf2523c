"""Small tables with every awkward row the operators must bear."""

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key double, kept string, score string, fp string, root string, `odd name` int, mark string, bucket int"
)


def rows(spark, texts):
    """Documents from (doc_id, text, lang); the other columns have names that operators use inside."""
    filled = [(i, t, lang, "s", len(t or ""), 1.5, "k", "s", "f", "r", 7, "m", 3) for i, t, lang in texts]
    return spark.createDataFrame(filled, SCHEMA)


PROSE = (
    "the river bends twice before it meets the old stone bridge and every spring the water climbs up to the "
    "third arch where children have scratched their names and the year into the soft grey sandstone blocks "
)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null and repeated ids, null, empty, blank and very long texts, repeated rows, characters of all widths."""
    texts = [
        (1, PROSE, "en"),
        (2, PROSE, "en"),
        (3, PROSE + "with an end of its own", None),
        (3, "another text under an id that is there already", "en"),
        (4, "", "en"),
        (5, "   \n\t ", "en"),
        (6, None, "en"),
        (6, None, "en"),
        (None, PROSE, "en"),
        (None, None, None),
        (7, "word " * 60_000, "en"),
        (8, "x" * 150_000, "de"),
        (9, "é𝒳漢 ß\x00\x1c\x85 ▁▁ <|endoftext|>  end", "fr"),
        (10, "12 34 !! ??", "es"),
        (-5, "a b", "es"),
        (-5, "a b", "es"),
    ]
    return rows(spark, texts)


@pytest.fixture(scope="session")
def no_documents(spark):
    return rows(spark, [])


@pytest.fixture(scope="session")
def odd_labels(spark):
    data = [(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, None, 1), (None, 1, 0), (99, 0, 1), (7, 0, None)]
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")
