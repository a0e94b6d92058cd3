"""Data-quality checks, and the same rules as a load gate.

A check is one row: check_name, table_name, status, details. Keys are grouped with
map-side combine before they are compared, so a key with much of the data costs one
row per input split.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.operators.keys import ROWS_PER_SALT, join_by_key

# The columns, keys, relations and value rules that are checked.
NULL_RULES = {
    "customers": ("customer_id",),
    "orders": ("customer_id", "order_id", "order_total"),
    "order_items": ("product_id", "quantity"),
    "sessions": ("session_id", "customer_id"),
}
KEY_RULES = {"customers": "customer_id", "orders": "order_id", "products": "product_id",
             "sessions": "session_id"}
PARENT_RULES = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("sessions", "customer_id", "customers", "customer_id"),
)


def value_rules(date_from: str = "2020-11-01", date_to: str = "2020-11-30"):
    """(table, what, SQL predicate that marks a bad row)."""
    return (
        ("orders", "order_total", "order_total < 0"),
        ("order_items", "quantity", "quantity <= 0"),
        ("order_items", "unit_price", "unit_price < 0"),
        ("products", "base_price", "base_price < 0"),
        ("ad_spend", "amount", "amount < 0"),
        ("orders", "order_date",
         f"order_date < DATE'{date_from}' OR order_date > DATE'{date_to}'"),
        ("campaigns", "dates", "end_date < start_date"),
    )


class _Check(NamedTuple):
    name: str
    table: str
    what: str


def _entry(domain: int, role: int, key: Column | None = None) -> Column:
    """What a row tells about a key: the set of keys it belongs to, 128 bits of the key, its role."""
    h, i = [F.lit(0).cast("bigint")] * 2
    if key is not None:
        h, i = F.xxhash64(key.cast("string")), F.xxhash64(F.lit(1), key.cast("string"))
    return F.struct(F.lit(domain).alias("domain"), h.alias("h"), i.alias("i"), F.lit(role).alias("role"))


def all_checks(tables: Mapping[str, DataFrame], null_rules: Mapping[str, Sequence[str]] | None = None,
               rules: Sequence[tuple[str, str, str]] = (), key_rules: Mapping[str, str] | None = None,
               parent_rules: Sequence[tuple[str, str, str, str]] = ()) -> DataFrame:
    """All rules with one scan a table and one shuffle.

    Each row gives an entry for every key it holds, as the key of its table (role 0) or as a
    reference (role 1 and up, by relation), and for every rule it breaks. One aggregate by set of
    keys and key counts the roles: a key held twice is a duplicate, references to a key that no
    row holds are orphans. Keys are told apart by 128 bits of two hashes; NULL is a key of a
    table's rows, and as a reference it refers to nothing.
    """
    checks: list[_Check] = []
    entries: dict[str, list[Column]] = {}
    results: list[Column] = []  # the number found, over the counted keys

    def add(check: _Check, found: Column) -> None:
        checks.append(check)
        results.append(found)

    def row_rule(check: _Check, broken: Column) -> None:
        domain = -1 - len(checks)
        entries.setdefault(check.table, []).append(F.when(broken, _entry(domain, 0)))
        add(check, F.sum(F.when(F.col("domain") == domain, F.col("n0"))))

    for table, columns in (null_rules or {}).items():
        for c in columns:
            row_rule(_Check(f"Null Check: {c}", table, "null values"), F.col(c).isNull())
    for table, what, predicate in rules:
        row_rule(_Check(f"Invalid Value Check: {what}", table, "invalid values"), F.expr(predicate))

    owners = list(dict.fromkeys([*(key_rules or {}).items(), *[(p, pk) for _, _, p, pk in parent_rules]]))
    for domain, (table, key) in enumerate(owners):
        entries.setdefault(table, []).append(_entry(domain, 0, F.col(key)))
    for table, key in (key_rules or {}).items():
        add(_Check(f"Duplicate PK Check: {key}", table, "duplicate keys"),
            F.count_if((F.col("domain") == owners.index((table, key))) & (F.col("n0") > 1)))
    used = [0] * len(owners)
    for child, fk, parent, pk in parent_rules:
        domain = owners.index((parent, pk))
        used[domain] += 1
        entries.setdefault(child, []).append(F.when(F.col(fk).isNotNull(), _entry(domain, used[domain], F.col(fk))))
        add(_Check(f"Orphan FK Check: {fk} -> {parent}.{pk}", child, "orphaned rows"),
            F.sum(F.when((F.col("domain") == domain) & (F.col("n0") == 0), F.col(f"n{used[domain]}"))))

    told = reduce(DataFrame.unionByName, [
        tables[t].select(F.explode(F.array(*e)).alias("e")).where("e IS NOT NULL").select("e.*") for t, e in entries.items()])
    keys = told.groupBy("domain", "h", "i").agg(*[F.count_if(F.col("role") == r).alias(f"n{r}")
                                                  for r in range(max([0, *used]) + 1)])
    found = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"), F.lit(c.what).alias("what"),
                               F.coalesce(n, F.lit(0)).cast("bigint").alias("n"))
                      for c, n in zip(checks, results, strict=True)])
    return (keys.agg(found.alias("checks")).select(F.inline("checks"))
            .select("check_name", "table_name", F.when(F.col("n") > 0, "FAIL").otherwise("PASS").alias("status"),
                    F.concat_ws(" ", F.col("n").cast("string"), "what", F.lit("found")).alias("details")))


def null_checks(tables: Mapping[str, DataFrame],
                rules: Mapping[str, Sequence[str]] = NULL_RULES) -> DataFrame:
    """Rows with a NULL in each required column."""
    return all_checks(tables, null_rules=rules)


def invalid_value_checks(tables: Mapping[str, DataFrame], rules=None) -> DataFrame:
    """Rows outside the allowed values; a NULL is not counted."""
    return all_checks(tables, rules=rules or value_rules())


def duplicate_key_checks(tables: Mapping[str, DataFrame],
                         rules: Mapping[str, str] = KEY_RULES) -> DataFrame:
    """Number of key values (not of extra rows) that occur more than once."""
    return all_checks(tables, key_rules=rules)


def orphan_checks(tables: Mapping[str, DataFrame], rules=PARENT_RULES) -> DataFrame:
    """Rows whose non-NULL reference has no parent row."""
    return all_checks(tables, parent_rules=rules)


def _key_sizes(child: DataFrame, fk: str) -> DataFrame:
    return child.where(F.col(fk).isNotNull()).groupBy(fk).count()


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Distinct child keys without a parent: ``fk``, and ``n``, the rows that hold it."""
    keys = _key_sizes(child, fk).withColumnRenamed("count", "n")
    return keys.join(parent.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


class QualityReport(NamedTuple):
    log: DataFrame
    summary: DataFrame


def summary(log: DataFrame) -> DataFrame:
    """How many checks of a log passed."""
    return log.agg(F.count_if(F.col("status") == "PASS").alias("passed"), F.count("*").alias("total"))


def dq_report(*checks: DataFrame) -> QualityReport:
    """All results with the time of the run, and how many of them passed. Who writes the log takes
    the ``summary`` of what was written, so that the checks run once."""
    rows = reduce(DataFrame.unionByName, checks)
    log = rows.select(F.current_timestamp().alias("run_timestamp"), "check_name", "table_name",
                      "status", "details")
    return QualityReport(log, summary(rows))


# --- load gate -----------------------------------------------------------

class ConstraintViolation(ValueError):
    """A table breaks one of its declared constraints."""


class _Broken(NamedTuple):
    """Keys of one rule that rows must not have: ``column``, ``count`` (their rows)."""
    column: str
    reason: str
    keys: DataFrame


def _broken(df: DataFrame, unique: Sequence[str], fks: Sequence[tuple[str, DataFrame, str]]) -> list[_Broken]:
    return [*[_Broken(c, f"duplicate {c}", _key_sizes(df, c).where("count > 1")) for c in unique],
            *[_Broken(fk, f"orphan {fk}", orphan_keys(df, fk, parent, pk).withColumnRenamed("n", "count"))
              for fk, parent, pk in fks]]


FILTER_WORDS = 1 << 18  # of 64 bits: at most so many rows are broadcast


def _place(rule: Column, key: Column) -> tuple[Column, Column]:
    """The word of a key in the filter, and its four bits there."""
    h = F.xxhash64(F.lit(7), rule, key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(4)]
    return F.pmod(F.xxhash64(rule, key), F.lit(FILTER_WORDS)), reduce(lambda a, b: a.bitwiseOR(b), bits)


def split_suspects(df: DataFrame, columns: Sequence[str], broken: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows none of whose ``columns`` holds a broken key, and the others, with few that hold none.

    ``broken`` (rule, key) numbers the columns. Its keys are put in a filter of FILTER_WORDS words
    by one aggregate; a row looks its own keys up in the broadcast words and does not move. A key
    in the filter is always found, so rows that hold a broken key are all among the suspects.
    """
    word, mask = _place(F.col("rule"), F.col("key"))
    words = broken.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))
    looked, hit = df, F.lit(False)
    for i, c in enumerate(columns):
        word, mask = _place(F.lit(i), F.col(c).cast("string"))
        looked = looked.withColumns({f"_word{i}": word, f"_mask{i}": mask}).join(
            F.broadcast(words.select(F.col("word").alias(f"_word{i}"), F.col("bits").alias(f"_bits{i}"))), f"_word{i}", "left")
        found = F.col(f"_bits{i}").bitwiseAND(F.col(f"_mask{i}")) == F.col(f"_mask{i}")
        hit = hit | F.coalesce(found & F.col(c).isNotNull(), F.lit(False))
    return looked.where(~hit).select(*df.columns), looked.where(hit).select(*df.columns)


def mark_violations(df: DataFrame, *, not_null: Sequence[str] = (), pk: str | None = None,
                    unique: Sequence[str] = (), fks: Sequence[tuple[str, DataFrame, str]] = (),
                    rows_per_salt: int = ROWS_PER_SALT,
                    keep: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows with ``reason``: NULL when valid, else the first rule each row breaks.

    Broken keys are found on grouped keys, and the rows are joined to these with hot
    keys split: neither a much repeated key nor a much used reference makes a large
    task. With ``keep``, which writes a frame and returns it as read again (``df`` has to be a
    table then), broken keys are written, and only rows that a filter of them lets through are
    moved and joined: rows with good keys stay where they are read. Without broken keys nothing is.
    """
    # A primary key implies NOT NULL.
    lacking = [F.when(F.col(c).isNull(), f"null {c}") for c in [*not_null, *([pk] if pk else [])]]
    rules = _broken(df, [*([pk] if pk else []), *unique], fks)
    if not rules:
        return df.select("*", F.coalesce(*lacking, F.lit(None).cast("string")).alias("reason"))
    reasons = [*lacking, *[F.when(F.col(f"_broken{i}"), r.reason) for i, r in enumerate(rules)]]
    if keep is None:
        marked = df
        for i, r in enumerate(rules):
            sizes = _key_sizes(df, r.column) if r.reason.startswith("duplicate") else r.keys
            marked = join_by_key(marked, r.keys.select(r.column, F.lit(True).alias(f"_broken{i}")), r.column, "left",
                                 rows_per_salt, sizes)
        return marked.select(*df.columns, F.coalesce(*reasons).alias("reason"))
    broken = keep("broken", reduce(DataFrame.unionByName, [
        r.keys.select(F.lit(i).alias("rule"), F.col(r.column).cast("string").alias("key")) for i, r in enumerate(rules)]))
    valid = F.coalesce(*lacking, F.lit(None).cast("string")).alias("reason")
    if broken.isEmpty():
        return df.select("*", valid)
    clean, suspects = split_suspects(df, [r.column for r in rules], broken)
    # Written, as each join needs them twice: for its rows, and to count the rows of each key.
    marked = found = keep("suspects", suspects.withColumns({
        f"_key{i}": F.col(r.column).cast("string") for i, r in enumerate(rules)}))
    for i in range(len(rules)):
        keys = broken.where(F.col("rule") == i).select(F.col("key").alias(f"_key{i}"), F.lit(True).alias(f"_broken{i}"))
        marked = join_by_key(marked, keys, f"_key{i}", "left", rows_per_salt, _key_sizes(found, f"_key{i}"))
    return clean.select("*", valid).unionByName(marked.select(*df.columns, F.coalesce(*reasons).alias("reason")))


def enforce(df: DataFrame, *, not_null: Sequence[str] = (), pk: str | None = None,
            fks: Sequence[tuple[str, DataFrame, str]] = (),
            on_violation: str = "fail") -> DataFrame | tuple[DataFrame, DataFrame]:
    """``fail``: raise if any row breaks a rule, else return the rows.
    ``quarantine``: return the valid rows and, with their reason, the others."""
    columns = df.columns
    marked = mark_violations(df, not_null=not_null, pk=pk, fks=fks)
    if on_violation == "quarantine":
        return (marked.where("reason IS NULL").select(*columns),
                marked.where("reason IS NOT NULL").select(*columns, "reason"))
    if on_violation != "fail":
        raise ValueError("on_violation is 'fail' or 'quarantine'")
    broken = marked.where("reason IS NOT NULL").groupBy("reason").count().orderBy("reason").collect()  # one row a rule
    if broken:
        raise ConstraintViolation("; ".join(f"{r['reason']}: {r['count']} rows" for r in broken))
    return df
