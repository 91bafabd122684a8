"""Plan properties of every registered query (planned on sf0.001, not necessarily executed)."""

from ticketlens.plans.catalog import QUERIES, load_all
from tests.conftest import SF001

load_all()
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _nodes(node):
    """Every physical node under ``node``, looking through adaptive-plan wrappers."""
    stack = [node]
    while stack:
        n = stack.pop()
        yield n
        kind = n.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            stack.append(n.executedPlan())
        elif kind.endswith("QueryStageExec"):
            stack.append(n.plan())
        seq = n.children()
        for i in range(seq.size()):
            stack.append(seq.apply(i))


PASSED = ("WholeStageCodegenExec", "InputAdapter", "SortExec", "ShuffleExchangeExec", "ProjectExec",
          "FilterExec", "AdaptiveSparkPlanExec", "AQEShuffleReadExec", "WindowExec", "ColumnarToRowExec")


def _input(n):
    """The nearest node below that is more than a projection, filter, sort, exchange or window."""
    kind = n.getClass().getSimpleName()
    while kind in PASSED or kind.endswith("QueryStageExec"):
        n = (n.executedPlan() if kind == "AdaptiveSparkPlanExec" else n.plan() if kind.endswith("QueryStageExec")
             else n.children().apply(0))
        kind = n.getClass().getSimpleName()
    return n


def _unpartitioned_windows_over_rows(jplan) -> int:
    """Windows without PARTITION BY whose nearest input is neither an aggregate nor a limit: such a
    window pulls every row of its input into one task. Over an aggregate it sees one row per group,
    over a top-k at most k rows, over the stored domains one row per category; a join counts if
    both sides do."""
    def small(n):
        n = _input(n)
        kind = n.getClass().getSimpleName()
        if "Join" in kind:
            return all(small(n.children().apply(i)) for i in (0, 1))
        if kind == "BroadcastExchangeExec":
            return small(n.children().apply(0))
        return ("Aggregate" in kind or "Limit" in kind or kind in ("LocalTableScanExec", "TakeOrderedAndProjectExec")
                or kind == "FileSourceScanExec" and "[column_name#" in n.toString())

    bad = 0
    for n in _nodes(jplan):
        if n.getClass().getSimpleName() == "WindowExec" and n.partitionSpec().isEmpty():
            below = n.children().apply(0)
            bad += not small(below)
    return bad


def test_no_python_udfs_pair_joins_or_row_level_global_windows(spark):
    for name, fn in QUERIES.items():
        jplan = fn(spark, SF001)._jdf.queryExecution().executedPlan()
        plan = jplan.toString()
        for op in FORBIDDEN:
            assert op not in plan, f"{name}: {op}"
        assert _unpartitioned_windows_over_rows(jplan) == 0, name


def test_window_check_catches_a_row_level_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(100).withColumn("n", F.row_number().over(Window.orderBy("id")))
    assert _unpartitioned_windows_over_rows(df._jdf.queryExecution().executedPlan()) == 1


def test_window_check_sees_past_a_deep_aggregate(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    counts = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
    rows = spark.range(100).withColumn("k", F.col("id") % 3).join(counts.hint("merge"), "k")
    df = rows.withColumn("n", F.row_number().over(Window.orderBy("id")))
    assert _unpartitioned_windows_over_rows(df._jdf.queryExecution().executedPlan()) == 1


#: Scans of the tables or of a stored copy that a query's last job may have.
SCANS = {"rides": 3, "station_union_distinct": 3, "filter_options": 1, "distinct_count_per_column": 4,
         "profile_categorical": 5, "panel_revenue_refund__month": 3, "panel_top5_stations": 3, "dim_time": 2}


def test_scans_are_few(spark):
    for name, most in SCANS.items():
        jplan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan()
        scans = sum(n.getClass().getSimpleName() == "FileSourceScanExec" for n in _nodes(jplan))
        assert scans <= most, (name, scans)


def test_scans_are_column_pruned(spark):
    plan = _plan(QUERIES["panel_revenue_refund"](spark, SF001))
    # the panel needs status, refund and price; other stored columns must not be read
    assert "railcard" not in plan and "purchase_date" not in plan
    plan = _plan(QUERIES["sql_avg_price2"](spark, SF001))
    assert "o_orderpriority" not in plan and "c_mktsegment" not in plan


def test_panel_filters_are_filters_below_the_aggregate(spark):
    jplan = QUERIES["panel_revenue_refund__all_filters"](spark, SF001)._jdf.queryExecution().executedPlan()
    under = [m for n in _nodes(jplan) if n.getClass().getSimpleName() == "HashAggregateExec" for m in _nodes(n)]
    filters = " ".join(m.condition().toString() for m in under if m.getClass().getSimpleName() == "FilterExec")
    for column in ("departure_station_name", "ticket_type", "railcard", "payment_method"):
        assert column in filters
    scans = [m for m in under if m.getClass().getSimpleName() == "FileSourceScanExec"]
    assert any("month" in m.partitionFilters().toString() and "railcard" in m.dataFilters().toString() for m in scans)
