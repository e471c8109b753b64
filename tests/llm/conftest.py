from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus(spark):
    """Edge cases of ``documents``: nulls, empty and blank texts, repeated rows, a long text,
    and columns whose names the operators use themselves."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b c d e f"), (5, "a b c d e f"),
        (6, f"start {passage} end"), (7, f"{passage}"), (None, f"x {passage} y z"), (None, None),
        (8, "A b C d E f"), (9, "w " * 5000), (10, " ".join(f"u{i}" for i in range(5000))),
        (11, "ÄÖ é don't <|endoftext|> 日本 mail a.b@c.de or +49 30 123456789."),
        (12, "card 4111 1111 1111 1111, 4111111111111112, ip 10.0.0.1 and 999.1.1.1"),
    ]
    return spark.createDataFrame(
        [(i, t, "en", None, 0, "k", 7, 1, 0.5) for i, t in rows],
        DOCUMENT + ", block string, part int, length int, score double").cache()
