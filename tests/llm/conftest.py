import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and columns with clashing names."""
    rows = [(1, "one two three four five six seven eight. Nine ten\nA line that repeats itself in other documents as well"), (2, None), (3, ""), (4, " \n\t \r\n "), (5, "long word and more " * 20_000 + "x" * 30_000), (6, "ß ü 日本 語。 <|endoftext|> a  b"), (None, "no id at all but words enough to make shingles of"), (1, "one two three four five six seven eight. Nine ten\nA line that repeats itself in other documents as well"), (7, "word"), (8, "one two three four five six seven eight. Nine ten\nA line that repeats itself in other documents as well")]
    clash = "n_tokens long, start string, score string, block string, id string, key string, component_id string, n string, first string, __source string, h1 string, position string"
    return spark.createDataFrame([(i, t, None if i == 3 else "en", None if k % 3 == 0 else f"s{k % 2}", None) + (None,) * 12 for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, " + clash)
