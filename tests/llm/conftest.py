from __future__ import annotations

import pytest

#: Names that the operators use inside.
CLASHING = ("size", "row", "_row", "node", "key", "score", "spans", "shard", "rate", "copies", "_text", "id", "h1", "toxic")

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, source]); further columns have the names that operators use inside."""

    def build(rows, extra=True):
        names = [n for n in CLASHING if extra]
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{n}` string" for n in names)
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *("x" for _ in names)) for r in rows]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture
def labels(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return build
