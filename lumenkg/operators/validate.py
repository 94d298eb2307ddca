"""Quality validation."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.quality import is_valid, quality_score
from ..functions.text import is_valid_url


def validate_quality(df: DataFrame, profile: str = "main", threshold: float | None = None,
                     validators: dict[str, Column] | None = None, as_of=None,
                     with_rejects: bool = False):
    """recompute the score, keep valid rows scoring >= threshold.

    ``validators`` (X2) are extra boolean Columns and-ed into validity.
    With ``with_rejects=True`` returns ``(kept, rejects)`` where rejects
    carry ``reject_reason`` in {invalid, low_quality}.
    """
    threshold = vocab.VALIDATE_THRESHOLD[profile] if threshold is None else threshold
    valid = is_valid(profile, as_of=as_of)
    for _, rule in (validators or {}).items():
        valid = valid & F.coalesce(rule, F.lit(False))
    scored = df.withColumn("quality_score", quality_score(profile)).withColumn("_valid", valid)
    kept = scored.filter(F.col("_valid") & (F.col("quality_score") >= F.lit(float(threshold)))).drop("_valid")
    if not with_rejects:
        return kept
    rejects = (scored.filter(~(F.col("_valid") & (F.col("quality_score") >= F.lit(float(threshold)))))
               .withColumn("reject_reason", F.when(~F.col("_valid"), F.lit("invalid")).otherwise(F.lit("low_quality")))
               .drop("_valid"))
    return kept, rejects


def drop_low_quality(df: DataFrame, min_score: float, inclusive: bool = False) -> DataFrame:
    """keep rows whose score is above (or at, if inclusive) ``min_score``."""
    s = F.col("quality_score")
    return df.filter(s >= min_score if inclusive else s > min_score)


def with_duplicate_flag(df: DataFrame, kept: DataFrame, order: str = "pos") -> DataFrame:
    """Rows with ``is_duplicate``: deduplication (D1, result ``kept``) dropped them."""
    return df.join(kept.select(order, F.lit(False).alias("is_duplicate")), order, "left") \
        .withColumn("is_duplicate", F.coalesce("is_duplicate", F.lit(True)))


def default_validators(as_of=None, thresholds: dict[str, int] = vocab.QUALITY_THRESHOLDS,
                       duplicates: bool = False) -> dict[str, Column]:
    """Validators that have a rule: url, date range, title length and, with
    ``duplicates`` (over rows of :func:`with_duplicate_flag`), duplicate."""
    as_of_c = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    rules = {
        "url": is_valid_url("url"),
        "date": F.col("publication_date").isNull()
        | F.year("publication_date").between(F.lit(1950), F.year(as_of_c)),
        "title": F.length(F.col("title")) >= thresholds["min_title_length"],
    }
    return rules | ({"duplicate": ~F.col("is_duplicate")} if duplicates else {})


def validation_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Pass / fail counts per validator in one pass (unpivot + groupBy)."""
    flags = df.select(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in rules.items()])
    long = flags.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("validator"), F.col(n).alias("ok")) for n in rules])).alias("r"))
    return (long.groupBy(F.col("r.validator").alias("validator"))
            .agg(F.count_if(F.col("r.ok")).alias("passed"), F.count_if(~F.col("r.ok")).alias("failed")))
