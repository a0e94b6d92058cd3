"""URL filters: pattern rules found by their rarest literal token.

A rule is written as in common block lists: ``||`` at the start is the start of a host label,
``|`` an end of the address, ``*`` any characters, ``^`` a separator, the rest literal. An
address is the host in lower case, then path, query and fragment as they are. Tokens are runs of
a-z and 0-9 (A-Z lowered). A token of a rule counts if it cannot be a part of a longer one in an
address that the rule fits; so an address with the rule has the token. Each rule is filed under
the token that the fewest addresses have, counted over all of them; rules without a token are
candidates for every address. An address fetches the rules filed under its tokens, and only
those are run as regular expressions.

The rules and the counts of their tokens are as many as the rules given; as a local table Spark
knows their size, and broadcasts them only below its threshold. NULL addresses are empty ones.
Rows with the same address share one judgement; repeated rows stay. Ties between rules that fit
go to the class, then the longer rule, then the earlier one.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 32  # parts of the addresses with one token
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; of the rules that fit, the highest ``rank``, then the longest
    name, then the first decides."""
    pattern: str
    action: str
    name: str | None = None
    rank: int = 0


def site(action: str, host: str, path: str = "/") -> Rule:
    """Fits the host and its subdomains, if the path starts with this one."""
    return Rule(f"||{host}{path}", action, f"{host}{path}", 1)


# The site rules of the contract.
SITES = (site("allow", "com"), site("block", "example.com", "/en/"),
         site("allow", "www.example.com", "/en/"), site("block", "net", "/es/"),
         site("block", "net", "/fr/"))
# What the method blocks where no site rule fits.
PATTERNS = (Rule("||adult-x.", "block"), Rule("||ads.", "block"), Rule("||tracker.", "block"),
            Rule("/banners/*", "block"), Rule("^sessionid^", "block"), Rule(".exe|", "block"))
RULES = SITES + PATTERNS


def compiled(rule: Rule) -> str:
    """The regular expression of a rule over an address."""
    text = rule.pattern
    start, text = ("^(?:[^/?#]*\\.)?", text[2:]) if text.startswith("||") else (
        ("^", text[1:]) if text.startswith("|") else ("", text))
    end, text = ("$", text[:-1]) if text.endswith("|") else ("", text)
    parts = {"*": ".*", "^": "(?:[^A-Za-z0-9_.%-]|$)"}
    return "(?s)" + start + "".join(parts.get(c, re.escape(c)) for c in text) + end


def tokens_of(rule: Rule) -> list[str]:
    """Tokens that stand whole in every address the rule fits."""
    text = rule.pattern.translate(str.maketrans(UPPER, LOWER))
    text = "." + text[2:] if text.startswith("||") else ("." + text[1:] if text.startswith("|") else "*" + text)
    text = text[:-1] + "." if text.endswith("|") else text + "*"
    return [m[0] for m in re.finditer(r"[a-z0-9]+", text)
            if text[m.start() - 1] != "*" and text[m.end()] != "*"]


def lowered(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def parts(url: Column) -> dict[str, Column]:
    """host, path and address of a url; all empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise("")
    host = lowered(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return {"host": host, "path": path,
            "address": F.concat(host, F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1))}


def _tokens(address: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lowered(address), F.lit("[a-z0-9]+"), F.lit(0)))


def _salt() -> Column:
    """The part of an address, by its content."""
    return F.pmod(F.xxhash64("address"), F.lit(SALTS)).cast("int").alias("salt")


def _salted(rules: DataFrame) -> DataFrame:
    """Each row once for every part: a token that most addresses have is met in many tasks."""
    return rules.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))


def index(spark: SparkSession, addresses: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(token, nth, regex): each rule under its rarest token, "" if it has none."""
    literals = sorted({t for r in rules for t in tokens_of(r)})
    counts: dict[str, int] = {}
    if literals:
        wanted = spark.createDataFrame([(t,) for t in literals], "token string")
        counts = dict(addresses.select(F.explode(_tokens(F.col("address"))).alias("token"), _salt())
                      .join(_salted(wanted), ["token", "salt"]).groupBy("token").count().collect())  # one row a literal
    rows = [(min(tokens_of(r), key=lambda t: (counts.get(t, 0), t), default=""), i, compiled(r))
            for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "token string, nth int, regex string")


def judge(spark: SparkSession, pages: DataFrame, keys: Sequence[str] = ("page_id",), url: str = "url",
          rules: Sequence[Rule] = RULES, default: str = "allow") -> DataFrame:
    """``keys``, host, path, rule (its name), verdict, pattern (of the deciding rule) and
    candidates (rules whose expression was run)."""
    split = pages.select(*keys, F.coalesce(F.col(url), F.lit("")).alias("__url"))
    rows = split.select(*keys, *[c.alias(f"__{n}") for n, c in parts(F.col("__url")).items()])
    addresses = rows.groupBy(F.col("__address").alias("address")).agg(F.count("*").alias("rows"))
    filed = index(spark, addresses, rules)
    table = F.array(*[F.struct(F.lit(r.rank).alias("rank"), F.lit(len(r.name or "")).alias("long"),
                               F.lit(-i).alias("order"), F.lit(r.action).alias("action"),
                               F.lit(r.name).alias("name"), F.lit(r.pattern).alias("pattern"))
                      for i, r in enumerate(rules)]) if rules else None
    fetched = (addresses.select("address", F.explode(F.concat(_tokens(F.col("address")), F.array(F.lit(""))))
                                .alias("token"), _salt())
               .join(_salted(filed), ["token", "salt"]))
    fits = fetched.withColumn("fits", F.expr("address RLIKE regex"))
    best = (fits.groupBy("address").agg(
        F.count("*").alias("candidates"),
        F.max(F.when(F.col("fits"), F.get(table, F.col("nth")))).alias("best"))
        if rules else fits.groupBy("address").agg(
            F.count("*").alias("candidates"),
            F.first(F.lit(None).cast("struct<action:string,name:string,pattern:string>")).alias("best")))
    # Dealt by another key than the aggregate, so that adaptive execution splits a hot address.
    best = best.withColumnRenamed("address", "__address").withColumn("__deal", F.xxhash64("__address"))
    out = rows.withColumn("__deal", F.xxhash64("__address")).join(best, ["__deal", "__address"], "left")
    return out.select(*keys, F.col("__host").alias("host"), F.col("__path").alias("path"),
                      F.col("best.name").alias("rule"),
                      F.coalesce("best.action", F.lit(default)).alias("verdict"),
                      F.col("best.pattern").alias("pattern"),
                      F.coalesce("candidates", F.lit(0)).alias("candidates"))
