"""The documents table of the tests."""

from __future__ import annotations

import pytest


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text) pairs, with a column that clashes by name."""

    def build(rows, extra=()):
        schema = "doc_id long, text string, lang string, source string, n_chars long, label string"
        return spark.createDataFrame(
            [(i, t, "en", "src0", None if t is None else len(t), "x") for i, t in rows], schema
        )

    return build
