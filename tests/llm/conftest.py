import random

import pytest

#: Columns besides those of documents, with names that operators use.
EXTRA = "block long, key long, kept boolean, score double, gone long, row long, n_tokens long, component_id long, text_sha256 string"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA


def frame(spark, rows):
    """Documents ``(doc_id, text[, lang])`` with all columns; odd values in the others."""
    whole = [(r[0], r[1], r[2] if len(r) > 2 else None, "src0", None, 1, None, True, 0.5, 3, None, 7, -1, "x") for r in rows]
    return spark.createDataFrame(whole, SCHEMA)


def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(4)
    syllables = ["ther", "an", "in", "ed", "tion", "é", "ou", "ß", "The", "AND"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    passage = " ".join(word() for _ in range(30))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two"), (6, "one\ttwo  three"), (7, "漢字 und ﬁ 🙂\x00  x  y"), (None, "no id at all here"), (None, None)]
    rows += [(8, passage), (9, passage), (10, passage.upper()), (10, passage.upper()), (10, passage + " other"), (11, "x " + passage + " y"), (12, "the " * 400)]
    rows += [(13, " ".join(word() for _ in range(30000))), (14, "a" * 20000), (15, passage + "\n" + passage)]
    for i in range(16, 60):
        own = " ".join(word() for _ in range(rng.randint(5, 120)))
        rows.append((i, own + " " + passage if i % 5 == 0 else own))
    rows += [(60 + i, rows[-1 - i][1].replace(" ", "  ")) for i in range(3)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    rows = odd_rows()
    return rows, frame(spark, rows).coalesce(2)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, []).coalesce(1)
