"""Joins of SimHash lists, whose rows Spark reckons too few."""

from __future__ import annotations

import pytest
from helpers import documents, prose

from ledgerlens.llm import simhash


@pytest.mark.parametrize("name", ["lists", "open"])
def test_lists_are_not_broadcast(spark, monkeypatch, name):
    """A few thousand nodes are some kilobytes; their lists are 35 times as many rows, and are not to meet in the driver."""
    plans, store = {}, simhash.materialize

    def noted(df, label="stage", **options):
        stored = store(df, label, **options)
        df.collect()
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stored

    monkeypatch.setattr(simhash, "materialize", noted)
    docs = documents(spark, [(i, " ".join(prose(i // 2, 30))) for i in range(60)])
    assert simhash.simhash_duplicates(docs).count() == 60
    assert "SortMergeJoin" in plans[name]
    assert "Broadcast" not in plans[name].split("Initial Plan")[0]
