from frames import got
from pyspark.sql import functions as F

from mercata.operators import quality as q
from mercata.session import scratch_folder
from mercata.sources import writers


def tables(frame):
    return {
        "customers": frame("customer_id STRING", [("a",), ("a",), ("b",), (None,), (None,)]),
        "products": frame("product_id STRING, base_price DECIMAL(18;2)", [("p", -1), ("r", None)]),
        "sessions": frame("session_id STRING, customer_id STRING", [("s", "a"), (None, "lost")]),
        "orders": frame("order_id STRING, customer_id STRING, order_total DECIMAL(18;2), "
                        "order_date DATE", [
                            ("1", "a", -1, "2020-11-01"), ("1", "lost", None, "2020-12-01"),
                            ("1", "lost", 0, None), ("2", None, 5, "2020-11-30")]),
        "order_items": frame("order_id STRING, product_id STRING, quantity INT, "
                             "unit_price DECIMAL(18;2)", [
                                 ("1", "p", 0, 1), ("9", None, 1, -1), ("9", "x", None, None)]),
        "ad_spend": frame("amount DECIMAL(18;2)", [(0,)]),
        "campaigns": frame("start_date DATE, end_date DATE", [
            ("2024-01-02", "2024-01-01"), ("2024-01-02", "2024-01-02"), (None, "2024-01-01")]),
    }


def found(df):
    return {(r.table_name, r.check_name.split(": ")[1]): (int(r.details.split()[0]), r.status)
            for r in df.collect()}


def test_every_check(frame):
    t = tables(frame)
    assert found(q.null_checks(t)) == {
        ("customers", "customer_id"): (2, "FAIL"), ("orders", "customer_id"): (1, "FAIL"),
        ("orders", "order_id"): (0, "PASS"), ("orders", "order_total"): (1, "FAIL"),
        ("order_items", "product_id"): (1, "FAIL"), ("order_items", "quantity"): (1, "FAIL"),
        ("sessions", "session_id"): (1, "FAIL"), ("sessions", "customer_id"): (0, "PASS")}
    # Keys are counted, not rows; repeated NULLs are one key.
    assert found(q.duplicate_key_checks(t)) == {
        ("customers", "customer_id"): (2, "FAIL"), ("orders", "order_id"): (1, "FAIL"),
        ("products", "product_id"): (0, "PASS"), ("sessions", "session_id"): (0, "PASS")}
    assert found(q.orphan_checks(t)) == {
        ("orders", "customer_id -> customers.customer_id"): (2, "FAIL"),
        ("order_items", "order_id -> orders.order_id"): (2, "FAIL"),
        ("order_items", "product_id -> products.product_id"): (1, "FAIL"),
        ("sessions", "customer_id -> customers.customer_id"): (1, "FAIL")}
    # A NULL is not an invalid value.
    assert found(q.invalid_value_checks(t)) == {
        ("orders", "order_total"): (1, "FAIL"), ("order_items", "quantity"): (1, "FAIL"),
        ("order_items", "unit_price"): (1, "FAIL"), ("products", "base_price"): (1, "FAIL"),
        ("ad_spend", "amount"): (0, "PASS"), ("orders", "order_date"): (1, "FAIL"),
        ("campaigns", "dates"): (1, "FAIL")}


def test_report_texts_and_summary(frame):
    t = tables(frame)
    report = q.dq_report(q.null_checks(t), q.duplicate_key_checks(t), q.orphan_checks(t),
                         q.invalid_value_checks(t))
    assert got(report.summary) == [(5, 23)]
    assert report.log.columns == ["run_timestamp", "check_name", "table_name", "status", "details"]
    rows = got(report.log.where("table_name = 'sessions'"), "check_name", "status", "details")
    assert rows == [
        ("Duplicate PK Check: session_id", "PASS", "0 duplicate keys found"),
        ("Null Check: customer_id", "PASS", "0 null values found"),
        ("Null Check: session_id", "FAIL", "1 null values found"),
        ("Orphan FK Check: customer_id -> customers.customer_id", "FAIL", "1 orphaned rows found")]


def test_nothing_at_all_passes(frame):
    t = {name: df.limit(0) for name, df in tables(frame).items()}
    checks = [q.null_checks(t), q.duplicate_key_checks(t), q.orphan_checks(t),
              q.invalid_value_checks(t)]
    assert got(q.dq_report(*checks).summary) == [(23, 23)]


def test_all_rules_in_one_pass(frame):
    t = tables(frame)
    parts = [q.null_checks(t), q.duplicate_key_checks(t), q.orphan_checks(t), q.invalid_value_checks(t)]
    apart = sorted(r for p in parts for r in got(p))
    at_once = q.all_checks(t, q.NULL_RULES, q.value_rules(), q.KEY_RULES, q.PARENT_RULES)
    assert got(at_once) == apart


def test_each_table_is_scanned_once(spark, frame):
    folder = scratch_folder(spark, "tables")
    t = {n: writers.stored(df, f"{folder}/{n}") for n, df in tables(frame).items()}
    plan = q.all_checks(t, q.NULL_RULES, q.value_rules(), q.KEY_RULES, q.PARENT_RULES)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("FileScan parquet") == len(t) and "Join" not in initial
    # Two levels of one aggregate: by key, and over all keys.
    assert initial.count("Exchange hashpartitioning") == 1 and initial.count("Exchange SinglePartition") == 1


def test_keys_of_other_types_meet(frame):
    t = {"p": frame("id INT", [(1,), (2,)]), "c": frame("fk BIGINT", [(1,), (3,), (3,), (None,)])}
    assert got(q.orphan_checks(t, [("c", "fk", "p", "id")]), "details") == [("2 orphaned rows found",)]


def gate_rows(spark):
    df = spark.range(0, 20_000, 1, 4).selectExpr(
        "id AS k", "IF(id % 3 = 0, 'hot', concat('p', id % 500)) AS fk", "IF(id % 4000 = 7, NULL, 1) AS v")
    return df.unionByName(spark.sql("SELECT * FROM VALUES (5L, 'p5', 1), (90000L, 'lost', 1), (90001L, 'lost', NULL), "
                                    "(NULL, 'p1', 1) AS t(k, fk, v)"))


def test_rows_with_good_keys_are_not_moved(spark):
    folder, names = scratch_folder(spark, "gate"), []

    def keep(name, df):
        names.append(name)
        return writers.stored(df, f"{folder}/{name}")

    df = keep("rows", gate_rows(spark))
    parents = keep("parents", spark.range(500).selectExpr("concat('p', id) AS id").unionByName(spark.sql("SELECT 'hot' AS id")))
    rules = dict(not_null=["v"], pk="k", fks=[("fk", parents, "id")])
    marked = q.mark_violations(df, **rules, keep=keep)
    assert names[-2:] == ["broken", "suspects"]
    assert marked.exceptAll(q.mark_violations(df, **rules)).count() == 0 and marked.count() == df.count()
    broken = spark.read.parquet(f"{folder}/broken")
    assert got(broken, "rule", "key") == [(0, "5"), (1, "lost")]
    clean, suspects = q.split_suspects(df, ["k", "fk"], broken)
    assert clean.count() + suspects.count() == df.count() and suspects.count() <= 4 + 20
    plan = clean._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # Only the filter's words are dealt (once for each rule); rows meet them by broadcast.
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(word") == plan.count("Exchange hashpartitioning") == 2


def test_a_full_filter_still_gives_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(q, "FILTER_WORDS", 2)
    folder = scratch_folder(spark, "gate")
    keep = lambda name, df: writers.stored(df, f"{folder}/{name}")
    df = keep("rows", gate_rows(spark).withColumn("k", F.when(F.col("k") % 2 == 0, F.col("k") % 1000).otherwise(F.col("k"))))
    parents = spark.sql("SELECT 'hot' AS id")
    rules = dict(not_null=["v"], pk="k", unique=["v"], fks=[("fk", parents, "id")])
    a, b = q.mark_violations(df, **rules, keep=keep), q.mark_violations(df, **rules)
    assert got(a.groupBy("reason").count()) == got(b.groupBy("reason").count())
    assert a.exceptAll(b).count() == 0
