"""Physical plans: no pair-wise joins, no Python, filters and columns reach the scan."""

import re

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
UNWANTED = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
)


def plan_of(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_unwanted_nodes(spark, monkeypatch, name):
    cuts, write = [], DataFrameWriter.parquet

    def spied(self, *args, **kwargs):
        # What a query writes on its way is part of its plan.
        cuts.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spied)
    plan = "\n".join([plan_of(spark, name), *cuts])
    assert not [node for node in UNWANTED if node in plan]


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "f1_filter_files")
    assert "EqualTo(lang,en)" in plan and "GreaterThan(n_chars,300)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(spark, "l1_latest_files")).group(1)
    assert "o_totalprice" not in schema
    assert "GreaterThanOrEqual(ts," in plan_of(spark, "f3_time_range")


def test_top_rows_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(spark, "l4_preview_with_overflow")
    assert "TakeOrderedAndProject" in plan_of(spark, "l1_latest_files")


def test_bodies_that_need_no_shuffle_have_none(spark):
    for name in ("p12_flatten_document", "p13_document_cells", "p15_slide_text", "p16_form_answers_wide"):
        assert "Exchange" not in plan_of(spark, name)


def test_documents_are_rendered_with_one_shuffle(spark):
    for name in ("w3_render_markdown", "w3_render_nested_documents"):
        assert plan_of(spark, name).count("Exchange hashpartitioning(doc_id") == 1


def test_runs_are_scanned_once_per_grain(spark):
    assert plan_of(spark, "g9_execution_metrics").count("FileScan parquet") == 2


def test_responses_are_not_exploded(spark):
    assert "Generate explode(answers" not in plan_of(spark, "g13_form_response_counts")


def test_error_tokens_are_counted_without_sorting_cells(spark):
    from deskmill.operators.filters import rows_with_error_tokens

    cells = [(1, 5, 1, "#REF!"), (1, 5, 0, " #n/a "), (1, 7, 0, "#NAME?"), (1, 0, 0, "#"), (2, 0, 0, "x"), (3, 2**62, 30, "#N/A"), (3, None, 2, "#N/A"), (4, 2**40, 27, "#N/A"), (4, 2**41, 0, "#N/A"), (5, 1, None, "#N/A"), (5, 1, 3, "#N/A"), (6, None, 0, None)]
    found = rows_with_error_tokens(spark.createDataFrame(cells, "sheet_id long, row long, col int, value string"))
    want = {1: (True, 3, "A6"), 2: (False, 0, None), 3: (True, 2, None), 4: (True, 2, f"AB{2**40 + 1}"), 5: (True, 2, None), 6: (False, 0, None)}
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == want
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_order_lines_are_sorted_after_they_are_dealt_out(spark):
    from deskmill.plans import bindings

    plan = bindings.order_lines(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    # Nothing is sorted in a task of the scan: both halves of the aggregation stand above the one shuffle.
    assert plan.count("Exchange") == 1 and plan.rindex("SortAggregate") < plan.index("Exchange")
