"""What the operators leave in the shared folder: only the table that their result reads."""

from pathlib import Path

import pytest

from fareloom.llm import queries
from fareloom.sources.sinks import shared_folder, staging

SF_DIR = "/root/testdata/sf0.001"


def held(spark):
    root = Path(shared_folder(spark).removeprefix("file:"))
    return {p for p in root.rglob("*") if p.is_dir() and any(f.suffix == ".parquet" for f in p.iterdir())}


@pytest.mark.parametrize("query, tables", [(queries.op11_spelling, 2), (queries.op12_decontaminate, 1), (queries.op13_treap_search, 1)])
def test_only_what_the_result_reads_is_left_and_a_scope_deletes_that(spark, query, tables):
    before = held(spark)
    with staging(spark):
        result = query(spark, SF_DIR)
        assert len(held(spark) - before) <= tables
        assert result.count() > 0
    assert held(spark) == before
