"""Declared tests run together against the single checks."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlens.quality import checks
from ledgerlens.quality.declared import (
    Suite,
    day_present,
    distinct_above,
    foreign_key,
    holds,
    in_range,
    length_within,
    not_null,
    one_of,
    one_row,
    orphan_keys,
    unique,
    violations,
)

ROWS = [
    (1, "a", 5.0, [1, 2], date(2024, 1, 1), "p1"),
    (1, "a", None, [], date(2024, 1, 2), "p1"),
    (2, "it's", 50.0, [9, None, 9], None, "p9"),
    (None, None, -1.0, None, date(2024, 1, 2), None),
    (3, "b", 1.0, [1], date(2024, 1, 3), "p2"),
]
CHILD = "k int, name string, x double, list array<int>, day date, parent string"
TESTS = [
    *not_null("k", "x"),
    unique("k"),
    unique("k", "name"),
    unique("day", where="k IS NOT NULL"),
    distinct_above("k", 3),
    distinct_above("name", 2),
    in_range("x", 0, 10),
    one_of("name", "a", "it's"),
    length_within("list", 1, 2),
    holds("x", "x > 0"),
    one_row(),
    day_present("day", date(2024, 1, 3), 0),
    day_present("day", date(2024, 1, 3), 9),
    foreign_key("parent", {"parent": "id"}),
    foreign_key("parent", {"list": "number"}, array="list"),
    foreign_key("parent", {"parent": "id", "list": "number"}, array="list"),
    foreign_key("child", {"k": "k"}),
]


@pytest.fixture(scope="module")
def models(spark):
    parent = spark.createDataFrame([("p1", 1), ("p1", 2), ("p2", 2), (None, 9)], "id string, number bigint")
    return {"child": spark.createDataFrame(ROWS, CHILD).repartition(3), "parent": parent}


SUITES = {"child": Suite(TESTS, {"k": "int", "name": "string"}), "parent": Suite([*not_null("id"), one_row()])}


def counts(df):
    return {(row.model, row.test): row.violations for row in df.collect()}


def test_counts_equal_the_single_checks(models):
    child, parent = models["child"], models["parent"]
    got = counts(violations(models, SUITES))
    single = {
        "not_null_k": checks.not_null(child, "k"),
        "not_null_x": checks.not_null(child, "x"),
        "unique_k": checks.unique(child, ["k"]),
        "unique_k_name": checks.unique(child, ["k", "name"]),
        "unique_day": checks.unique(child, ["day"], "k IS NOT NULL"),
        "distinct_k": checks.distinct_count_above(child, "k", 3),
        "distinct_name": checks.distinct_count_above(child, "name", 2),
        "range_x": checks.accepted_range(child, "x", 0, 10),
        "values_name": checks.accepted_values(child, "name", ["a", "it's"]),
        "length_list": checks.array_length(child, "list", 1, 2, "list IS NOT NULL"),
        "holds_x": checks.expression(child, "x > 0"),
        "one_row": checks.exactly_one_row(child),
        "day_day_0": checks.date_exists(child, "day", date(2024, 1, 3), 0),
        "day_day_9": checks.date_exists(child, "day", date(2024, 1, 3), 9),
        "foreign_parent_parent": checks.relationship(child, parent, {"parent": "id"}),
        "foreign_list_parent": checks.relationship_array(child, "list", parent, "number"),
        "foreign_parent_list_parent": checks.relationship_array(child, "list", parent, "number", {"parent": "id"}),
        "foreign_k_child": checks.relationship(child, child, {"k": "k"}),
        "contract": checks.contract(child, SUITES["child"].contract),
    }
    assert {test: n for (model, test), n in got.items() if model == "child"} == {t: df.count() for t, df in single.items()}
    assert got["parent", "not_null_id"] == 1 and got["parent", "one_row"] == 1


def test_orphan_keys_are_listed_with_their_rows(models):
    got = {(row.test, tuple(row.key)): row.n_rows for row in orphan_keys(models, SUITES).collect()}
    assert got == {
        ("foreign_parent_parent", ("p9",)): 1,
        ("foreign_parent_list_parent", ("p9", "9")): 2,
        ("foreign_parent_list_parent", ("p2", "1")): 1,
    }


def test_empty_models(models):
    empty = {name: df.where("false") for name, df in models.items()}
    got = counts(violations(empty, SUITES))
    broken = {test for (model, test), n in got.items() if n and test != "contract"}
    assert broken == {"distinct_k", "distinct_name", "one_row", "day_day_0", "day_day_9"}


def test_keys_only_and_rules_only(models):
    got = counts(violations(models, {"child": Suite([foreign_key("parent", {"parent": "id"})]), "parent": Suite(not_null("id"))}))
    assert got == {("child", "foreign_parent_parent"): 1, ("parent", "not_null_id"): 1}


def test_declaration_errors(models):
    with pytest.raises(ValueError, match="one name"):
        violations(models, {"child": Suite([unique("k"), unique("k")])})
    with pytest.raises(ValueError, match="its parent"):
        orphan_keys(models, {"child": Suite([foreign_key("parent", {"name": "number"})])})


def test_one_scan_and_one_shuffle(spark, tmp_path, models):
    stored = {}
    for name, df in models.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    keys = [test for test in TESTS if test.test.startswith("foreign_")]
    plan = orphan_keys(stored, {"child": Suite(keys)})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 1
    rest = Suite([test for test in TESTS if not test.test.startswith("foreign_")])
    plan = violations(stored, {"child": rest})._jdf.queryExecution().executedPlan().toString()
    # One exchange by key, a small one by test, and the broadcast of one row per test.
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert plan.count("partial_count") >= 2


def test_hot_key_is_combined_before_the_shuffle(spark):
    child = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    parent = spark.range(0, 30000, 2).toDF("k")
    found = orphan_keys({"c": child, "p": parent}, {"c": Suite([foreign_key("p", {"k": "k"})])})
    rows = {int(row.key[0]): row.n_rows for row in found.collect()}
    assert rows[-1] == 20000 and len(rows) == 1 + 5000


def test_foreign_keys_store_only_what_they_read(spark):
    from ledgerlens import session
    from ledgerlens.workload import declared_queries, driver_tables
    from ledgerlens.workload.model_queries import MODELS

    small, before = "/root/testdata/sf0.001", len(session.scratch_folders)
    declared_queries.foreign_keys(spark, small)
    written = {path.rsplit("/", 1)[1].rsplit("-", 1)[0]: path for path in session.scratch_folders[before:]}
    for name, columns in declared_queries.KEY_COLUMNS.items():
        assert set(spark.read.parquet(written[name]).columns) == set(columns)
    assert not {"db_zap_records", "db_zap_token_transfers"} & set(written)
    # Other columns keep their place and fail when read; stored rows are those of the whole model.
    model = MODELS["product_stats"]
    narrow = driver_tables.narrow_warehouse(spark, small, model.as_of, declared_queries.KEY_COLUMNS).model(model.build)
    whole = driver_tables.warehouse(spark, small, model.as_of).model(model.build)
    assert narrow.dtypes == whole.dtypes
    kept = list(declared_queries.KEY_COLUMNS["product_stats"])
    assert narrow.select(kept).exceptAll(whole.select(kept)).count() == 0 == whole.select(kept).exceptAll(narrow.select(kept)).count()
    with pytest.raises(Exception, match="apy is not stored"):
        narrow.select("apy").collect()
