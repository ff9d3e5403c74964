"""What the plans of the full reports read, on a warehouse written as parquet."""

import importlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from fincrime.operators import code_map_lookup, code_maps, flag_keys, newest_rows
from fincrime.plans.full_reports import FULL_REPORTS
from fincrime.plans.full_oracle import full_report_sql
from fincrime.sources.derived_warehouse import materialise
from harness import duck, normalise

arrears = importlib.import_module("fincrime.plans.reports.arrears")   # the package has a function of that name


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    return materialise(spark, SF_SMALL, str(tmp_path_factory.mktemp("warehouse")))


def static_plan(spark, build) -> str:
    """The plan before adaptive execution, with whole paths."""
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.maxMetadataStringLength": "2000"}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        return build()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def scans(plan: str, relation: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line and f"/{relation}]" in line]


def test_arrears_searches_its_clients_once(spark, wh):
    plan = static_plan(spark, lambda: FULL_REPORTS["full_arrears"](wh))
    # only the search reads cards; its three readers share one exchange
    assert len(scans(plan, "dimcard")) == 1
    assert plan.count("ReusedExchange") >= 2


def test_contra_prunes_the_ledger_by_month_for_both_legs(spark, wh):
    plan = static_plan(spark, lambda: FULL_REPORTS["full_contra"](wh))
    ledger = scans(plan, "facttransaction")
    pruned = [x for x in ledger if "(postedmonth" in x and ">= 199901)" in x.split("PartitionFilters")[1].split("PushedFilters")[0]]
    assert len(ledger) == 3 and len(pruned) == 2          # flagged accounts come from all history


def test_contra_names_only_pairs_of_the_newest_time(spark, wh):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = static_plan(spark, lambda: FULL_REPORTS["full_contra"](wh))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the newest time a client is found below the joins that attach names, and no rows are dealt out by the time of day
    assert 0 < plan.index("row_number()") < plan.index(" rank(") and "hashpartitioning(timekey#" not in plan
    assert "main_last_name" not in plan[plan.index(" rank("):plan.index("Exchange", plan.index(" rank("))]


def test_arrears_sorts_loans_before_their_outcomes_fan_out(spark, wh, monkeypatch):
    plan = static_plan(spark, lambda: FULL_REPORTS["full_arrears"](wh))
    assert 0 < plan.index("Generate explode(__outcomes") < plan.index("Sort [id_number")
    monkeypatch.setattr(arrears, "PACK", 2)          # clients with more outcomes than one pack
    df = FULL_REPORTS["full_arrears"](wh)
    rel = duck(SF_SMALL).sql(full_report_sql()["full_arrears"])
    rows = [tuple(r) for r in df.collect()]
    assert normalise(df.columns, rows) == normalise(rel.columns, rel.fetchall())
    ids = [r[df.columns.index("id_number")] for r in rows]
    assert ids == sorted(ids, reverse=True) and max(ids.count(i) for i in set(ids)) > 2


def test_tollgate_reads_the_indicator_table_once(spark, wh):
    plan = static_plan(spark, lambda: FULL_REPORTS["full_tollgate"](wh))
    assert len(scans(plan, "dimcardtransactionindicators")) == 1


@pytest.mark.parametrize("name", ["full_arrears", "full_contra", "full_tollgate", "full_aml", "full_employer"])
def test_report_on_the_written_warehouse_equals_sql(spark, wh, name):
    df = FULL_REPORTS[name](wh)
    rel = duck(SF_SMALL).sql(full_report_sql()[name])
    want = normalise(rel.columns, rel.fetchall())
    assert normalise(df.columns, [tuple(r) for r in df.collect()]) == want and want[1]


@pytest.mark.parametrize("name, columns, descending", [
    ("full_arrears", ["id_number"], True), ("full_tollgate", ["tran_date"], False),
    ("full_missed_fraud", ["csi_log_date", "amount"], False)])
def test_report_rows_come_in_order(wh, name, columns, descending):
    """Nulls last both ways, as a report's reader gets them."""
    got = [tuple(r[c] for c in columns) for r in FULL_REPORTS[name](wh).select(*columns).collect()]
    held = [r for r in got if None not in r]
    assert held == sorted(held, reverse=descending) and got[:len(held)] == held


def test_newest_rows_keeps_ties_and_last_nulls(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 3, 2), ("a", 3, 3), ("a", None, 4), ("b", None, 5), (None, 2, 6)],
                               "k string, d int, i int")
    assert sorted(r["i"] for r in newest_rows(df, ["k"], "d").collect()) == [2, 3, 5, 6]


def test_loans_chosen_before_the_join_equal_loans_numbered_after_it(spark):
    """The evidence pack's loan branch on random histories with ties, unknown
    branches and accounts without deposits, against joining everything first."""
    from fincrime.operators import latest_per_key
    from fincrime.plans.reports.aml import client_accounts
    from fincrime.plans.reports.common import ties_over
    from wh import M, warehouse
    r = random.Random(4)
    accounts = [dict(accountnumber=f"A{i}", accountnumberwithcheckdigit=f"A{i}-{v}", accountstatusname="O", clientnumber=f"C{i % 4}",
                     accountopendate=None, rowiscurrent=1) for i in range(12) for v in range(1 + i % 2)]
    loans = [dict(accountnumber=f"A{r.randrange(12)}", productkey=r.randrange(3), originatingbranchkey=r.choice([1, 2, 9]),
                  coveragedatekey=r.choice([20240101, 20240102, 20240103])) for _ in range(150)]
    deposits = [dict(accountnumber=f"A{r.randrange(9)}", currentbalanceamount=M(r.randrange(50)), productkey=1, homebranchkey=9,
                     coveragedatekey=r.choice([20240101, 20240102, 20240103]), isfinalload=int(r.random() < 0.3)) for _ in range(120)]
    w = warehouse(spark, {
        "dimaccount": accounts, "factloanaccountdailycoverage": loans, "factdepositaccountdailycoverage": deposits,
        "dimproduct": [dict(productkey=k, productgroupname=f"G{k}", productname=f"P{k}") for k in range(2)],
        "dimbranch": [dict(branchkey=k, branchcode=f"B{k}", branchname=f"N{k}") for k in (1, 2)]})
    clients = spark.createDataFrame([("C0",), ("C1",), ("C3",)], "clientnumber string")
    got = client_accounts(w, clients)

    da = w["dimaccount"].join(clients, "clientnumber", "left_semi").drop("rowiscurrent")
    fd = w["factdepositaccountdailycoverage"]
    newest = fd.agg(F.max("coveragedatekey")).first()[0]
    fd = fd.filter((F.col("coveragedatekey") == newest) | (F.col("isfinalload") == 1)) \
        .select("accountnumber", "currentbalanceamount", F.col("coveragedatekey").alias("__fd_key"))
    j = da.join(w["factloanaccountdailycoverage"], "accountnumber").join(fd, "accountnumber", "left") \
        .join(w["dimproduct"], "productkey", "left") \
        .join(w["dimbranch"].withColumnRenamed("branchkey", "originatingbranchkey"), "originatingbranchkey")
    j = j.withColumn("currentbalanceamount", F.coalesce("currentbalanceamount", F.lit(0).cast("decimal(23,2)"))) \
         .select(*got.columns, "coveragedatekey", "__fd_key")
    keys = ["accountnumber", "accountnumberwithcheckdigit"]
    want = latest_per_key(j, keys, ["coveragedatekey"], ties=[F.col("__fd_key").desc_nulls_last()]
                          + ties_over(j, keys + ["coveragedatekey", "__fd_key"])).select(*got.columns)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got) == rows(want) and want.count() > 5    # no deposit has a known branch here


def test_code_maps_equal_joins_of_distinct_pairs(spark):
    dim = spark.createDataFrame([("a", "A", "x", "X", 1), ("a", "A", "y", None, 1), ("a", "A2", "x", "X", 1), ("b", "B", None, "N", 1),
                                 ("c", "old", "z", "Z", 0), ("x", "letter x", "a", "letter a", 1)],
                                "c1 string, n1 string, c2 string, n2 string, rowiscurrent int")
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "q"), (3, None, "y"), (4, "c", "z"), (5, "x", "a")], "id int, p string, q string")
    maps = code_maps(dim, {"p": ("c1", "n1"), "q": ("c2", "n2")}, current_only=True)
    out = code_map_lookup(code_map_lookup(df, maps, "p", "p", "pc", "pn"), maps, "q", "q", "qc", "qn")
    got = sorted(tuple(r) for r in out.select("id", "pc", "pn", "qc", "qn").na.fill("-").collect())
    assert got == [(1, "a", "A", "x", "X"), (1, "a", "A2", "x", "X"), (2, "b", "B", "-", "-"), (3, "-", "-", "y", "-"),
                   (4, "-", "-", "-", "-"), (5, "x", "letter x", "a", "letter a")]
    assert static_plan(spark, lambda: out).count("LocalTableScan") + static_plan(spark, lambda: out).count("Scan ExistingRDD") <= 2


def test_flag_keys_takes_lists_and_frames_and_doubles_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "key string")
    for k in (["a", "a", None, "z"], keys):
        assert sorted(tuple(r) for r in flag_keys(df, "k", k, "hit").select("id", "hit").collect()) == [(1, True), (2, False), (3, False)]


def test_employer_report_takes_numbers_of_both_kinds_from_a_frame(spark, wh):
    from fincrime.plans.reports import employer_accounts
    numbers = ["E000003", *[r[0] for r in wh["dimaccount"].filter("rowiscurrent = 1").orderBy("accountkey")
                            .select("accountnumberwithcheckdigit").limit(40).collect()], None]
    frame = spark.createDataFrame([(n,) for n in numbers * 2], "number string")
    rows = lambda df: sorted(map(str, df.collect()))
    for faithful in (False, True):
        by_list = employer_accounts(wh, numbers, faithful=faithful)
        assert rows(by_list) == rows(employer_accounts(wh, frame, faithful=faithful)) and by_list.count() > 0
        plan = by_list._jdf.queryExecution().optimizedPlan().toString()
        assert "E000003" not in plan      # keys are a relation, not literals of the plan
