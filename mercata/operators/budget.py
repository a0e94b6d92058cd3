"""Budget recommendations and the sentences that explain them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.functions.columns import plain_number
from mercata.functions.grounding import first_unverified, mislabelled, validation_status

# Caveat and sentence, thresholds and changes.
DATA_LIMITATION = ("Single-period data - this is average ROAS, not a true marginal/incremental "
                   "ROAS estimate")
SENTENCE = ("%s spent $%s and generated $%s in attributed revenue, resulting in a ROAS of %s and "
            "a CAC of $%s. Based on this ROAS, the recommendation is to %s spend by %s%%.")
PROMPT_HEAD = "Repeat the next line word for word; change no figure and leave nothing out:\n\n'"
PROMPT_TAIL = "'\n\nAnswer with that line alone."
ROAS_HIGH, ROAS_LOW, CHANGE_UP, CHANGE_DOWN = 1.5, 0.8, 15, -20


def channel_performance(cac_roas: DataFrame, attribution: DataFrame) -> DataFrame:
    """Channels with a cost per customer, next to their linear attribution."""
    linear = (attribution.where("attribution_model = 'linear'")
              .select("channel_id", F.col("attributed_revenue").alias("attributed_revenue_linear")))
    signal = F.col("attributed_revenue_linear").cast("double") / F.nullif(
        F.col("total_spend").cast("double"), F.lit(0.0))
    return (cac_roas.where("cac IS NOT NULL").join(linear, "channel_id", "left")
            .select("channel_id", "channel_name", "total_spend", "total_revenue", "cac", "roas",
                    "attributed_revenue_linear", signal.alias("marginal_roas_signal"),
                    F.lit(DATA_LIMITATION).alias("data_limitation")))


def recommend(perf: DataFrame, hi: float = ROAS_HIGH, lo: float = ROAS_LOW,
              up: int = CHANGE_UP, down: int = CHANGE_DOWN) -> DataFrame:
    """More budget above ``hi``, less below ``lo``; the bounds and NULL stay as they are."""
    roas = F.col("roas")

    def pick(above, below, between) -> Column:
        return F.when(roas > hi, above).when(roas < lo, below).otherwise(between)

    return perf.withColumns({"recommend_direction": pick("Increase", "Decrease", "Maintain"),
                             "suggested_change_pct": pick(up, down, 0)})


def explanation() -> Column:
    """The sentence that states a recommendation, from the columns of ``recommend``."""
    return F.format_string(
        SENTENCE, F.col("channel_name"), plain_number(F.col("total_spend")),
        plain_number(F.col("attributed_revenue_linear")), plain_number(F.col("roas")),
        plain_number(F.col("cac")), F.col("recommend_direction"),
        F.col("suggested_change_pct").cast("string"))


def render_explanation(recs: DataFrame) -> DataFrame:
    """Add ``prompt`` (instruction and sentence) and ``response`` (the sentence)."""
    return (recs.withColumn("response", explanation())
            .withColumn("prompt", F.concat(F.lit(PROMPT_HEAD), F.col("response"),
                                           F.lit(PROMPT_TAIL))))


def validate_explanations(df: DataFrame) -> DataFrame:
    """Status of each response: an unverified number, a mislabelled ROAS, or passed."""
    status = validation_status(first_unverified(F.col("response"), F.col("prompt")),
                               mislabelled(F.col("response")))
    return df.select("channel_name", "recommend_direction", "suggested_change_pct",
                     F.col("response").alias("llm_explanation"),
                     status.alias("validation_status"))
