import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def shipped(spark):
    from basketlens.session import ship_package
    ship_package(spark)
    return spark


@pytest.fixture()
def make_docs(shipped):
    """Rows (doc_id, text) as a documents table."""
    def make(rows, extra=()):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = shipped.createDataFrame(full, SCHEMA).repartition(3)
        for name in extra:  # columns whose names could clash with an operator's own
            df = df.selectExpr("*", f"concat('x', doc_id) AS `{name}`")
        return df
    return make


#: one text for each hard case
EDGE_ROWS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one two three four five six"),
    (None, None), (6, "Ünïcode wörds 中文 and\x0btabs\x0c here. " * 40), (7, "word " * 30_000), (8, "x" * 300_000),
    (9, "a\x00b ﻿   c"), (10, "one two three four five six"),
]
CLASHING = ("score", "predicted", "rest", "n", "token", "_rank", "c0", "sequence_id", "hit_spans", "n_words", "component_id")
