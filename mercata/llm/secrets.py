"""Secret scans over every version of every text, kept in a ledger of blobs.

A text is addressed by the SHA-256 of its content. The ledger has one row per blob and batch:
which rules (kind and version) were run on it and what they found. A scan runs only the pairs
of blob and rule version that the ledger lacks, each blob once however many paths show it, and
the findings are joined back to all paths. Only SQL functions run: matches and the gaps between
them come from one pattern, and running sums of their lengths give positions.

NULL texts are scanned as empty ones. Repeated rows each get their findings. Empty inputs give
empty results. Only the named columns are read, so other columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has at least
    ``least`` characters. A changed pattern needs a new ``version``."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules.
BASE = (
    Rule("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|"""
         r"""[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"""
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# What the method adds: credentials with a prefix of their own.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + ADDED

FINDINGS = "array<struct<start:int,ord:int,kind:string,version:int,end:int>>"
LEDGER = f"blob binary, rules array<string>, findings {FINDINGS}, batch string"


def blob(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _literal(pattern: str) -> Column:
    return F.lit(pattern)


def _prefilter(rule: Rule) -> str:
    """The same pattern, asking for the least length already: a text without such a match
    has no finding, and the search stops at the first one."""
    return rule.pattern[:-1] + "{%d,}" % rule.least if rule.kind == "hex" else rule.pattern


def _lengths(rule: Rule, text: Column) -> Column:
    """Per match: characters before it since the last match, its own, its group's."""
    def size(found: Column) -> Column:
        return F.transform(found, F.char_length)
    return F.arrays_zip(
        size(F.split(text, rule.pattern, -1)).alias("gap"),
        size(F.regexp_extract_all(text, _literal(rule.pattern), F.lit(0))).alias("size"),
        size(F.regexp_extract_all(text, _literal(rule.pattern), F.lit(rule.group))).alias("part"))


def ledger_of(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; a ledger that does not exist yet is made, empty."""
    spark.createDataFrame([], LEDGER).drop("batch").write.mode("append").parquet(f"{path}/batch=0")
    return spark.read.schema(LEDGER).parquet(path)


def _seen(ledger: DataFrame) -> DataFrame:
    return (ledger.select("blob", F.explode("rules").alias("rule"))
            .groupBy("blob").agg(F.collect_set("rule").alias("seen")))


def scan(spark: SparkSession, versions: DataFrame, path: str, batch: str,
         text: str = "text", rules: Sequence[Rule] = RULES) -> None:
    """Scan what the ledger at ``path`` lacks and commit it as ``batch``.

    A batch is one folder that is written as a whole: a repeated or retried batch of the
    same name puts the same rows in the same place. Rows of that name are not looked at, so
    a batch that broke off is done again in full.
    """
    ledger = ledger_of(spark, path).where(F.col("batch") != batch)
    wanted = F.array(*[F.lit(r.key) for r in rules])
    body = F.coalesce(F.col(text), F.lit(""))
    # A group of copies leaves a task as one row: equal blobs have equal texts.
    blobs = (versions.select(blob(F.col(text)).alias("blob"), body.alias("body"))
             .groupBy("blob").agg(F.first("body").alias("body")))
    todo = (blobs.join(_seen(ledger), "blob", "left")
            .withColumn("rules", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
            .where(F.size("rules") > 0))
    hits = [F.when(F.array_contains("rules", r.key) & F.col("body").rlike(_prefilter(r)),
                   _lengths(r, F.col("body"))).alias(f"hit{i}") for i, r in enumerate(rules)]
    found = todo.select("blob", "rules", *hits)
    every = F.filter(F.array(*[F.struct(F.lit(i).alias("ord"), F.col(f"hit{i}").alias("hits"))
                               for i in range(len(rules))]), lambda x: x["hits"].isNotNull())
    rows = (found.select("blob", "rules", F.explode_outer(every).alias("one"))
            .select("blob", "rules", "one.ord", F.posexplode_outer("one.hits").alias("nth", "hit")))
    table = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                               F.lit(r.least).alias("least")) for r in rules])
    rule = F.get(table, F.col("ord"))
    # One text's matches of one rule: the window never holds more than one text.
    upto = Window.partitionBy("blob", "ord").orderBy("nth")
    ends = rows.withColumn("end", F.sum(F.col("hit.gap") + F.col("hit.size")).over(upto).cast("int"))
    finding = F.struct((F.col("end") - F.col("hit.size")).cast("int").alias("start"), F.col("ord"),
                       rule["kind"].alias("kind"), rule["version"].alias("version"), F.col("end"))
    out = (ends.groupBy("blob").agg(
        F.first("rules").alias("rules"),
        F.array_sort(F.collect_list(F.when(F.col("hit.size").isNotNull()
                                           & (F.col("hit.part") >= rule["least"]), finding)))
        .cast(FINDINGS).alias("findings")))
    out.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def findings(spark: SparkSession, versions: DataFrame, path: str, keys: Sequence[str],
             text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``keys`` of every version with ``findings``, sorted by start and rule order.

    The ledger has a blob once per batch, so a blob with many paths is a skewed key of one
    side only. Both sides are dealt by a hash of the blob: an aggregate by the blob itself would
    stand between its shuffle and the join, and adaptive execution would not split it.
    """
    known = F.array(*[F.lit(r.key) for r in rules])
    per_blob = (spark.read.schema(LEDGER).parquet(path).groupBy("blob")
                .agg(F.flatten(F.collect_list("findings")).alias("findings"))
                .select("blob", F.array_sort(F.filter("findings", lambda x: F.array_contains(
                    known, F.concat_ws("@", x["kind"], x["version"])))).alias("findings")))
    paths = versions.select(*keys, blob(F.col(text)).alias("__blob")).withColumn("__deal", F.xxhash64("__blob"))
    per_blob = per_blob.withColumnRenamed("blob", "__blob").withColumn("__deal", F.xxhash64("__blob"))
    return (paths.join(per_blob, ["__deal", "__blob"], "left")
            .select(*keys, F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings")))


def spans(found: str | Column = "findings", kinds: Sequence[str] | None = None) -> Column:
    """kind:start:end of each finding, joined by commas."""
    column = F.col(found) if isinstance(found, str) else found
    if kinds is not None:
        column = F.filter(column, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def masked(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The text with every secret replaced by its kind, rule by rule."""
    for r in rules:
        pattern = r.pattern
        if r.least > 1:  # the last quantifier is that of the secret itself
            cut = pattern.rindex("+")
            least = r.least - (4 if r.kind == "access" else 0)
            pattern = pattern[:cut] + "{%d,}" % least + pattern[cut + 1:]
        text = F.regexp_replace(text, pattern, f"[{r.kind.upper()}]")
    return text
