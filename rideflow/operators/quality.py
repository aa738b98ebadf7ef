"""The data-quality report over the counters of the cleaning rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.operators.clean import DUPLICATES, FINAL, INITIAL, RULES

REPORTED = [(rule.key, rule.title, rule.reason) for rule in RULES]
REPORTED.append((DUPLICATES, "Duplicates", "equal to another row in every column"))


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole * 100.0).otherwise(0.0)


def _number(count: Column) -> Column:
    return F.format_number(count, 0)


def quality_report(totals: DataFrame) -> DataFrame:
    """One row per rule: ``rule, key, title, reason, removed, pct`` of all rows read."""
    entries = [
        F.struct(
            F.lit(key[:2]).alias("rule"),
            F.lit(key).alias("key"),
            F.lit(title).alias("title"),
            F.lit(reason).alias("reason"),
            F.col(key).alias("removed"),
            _percent(F.col(key), F.col(INITIAL)).alias("pct"),
        )
        for key, title, reason in REPORTED
    ]
    return totals.select(F.inline(F.array(*entries)))


def quality_summary(totals: DataFrame) -> DataFrame:
    """One row: rows read, kept, removed, and the percentage kept."""
    initial, final = F.col(INITIAL), F.col(FINAL)
    return totals.select(
        initial.alias("rows_in"),
        final.alias("rows_kept"),
        (initial - final).alias("rows_removed"),
        _percent(final, initial).alias("retention_pct"),
    )


def report_lines(totals: DataFrame) -> DataFrame:
    """The report as Markdown, one line per row: ``line_no, value``."""
    initial, final = F.col(INITIAL), F.col(FINAL)
    lines = [
        F.lit("# Data quality report"),
        F.lit(""),
        F.concat(F.lit("- Rows read: "), _number(initial)),
        F.concat(F.lit("- Rows kept: "), _number(final)),
        F.concat(F.lit("- Rows removed: "), _number(initial - final)),
        F.concat(F.lit("- Retention: "), F.format_number(_percent(final, initial), 2), F.lit("%")),
        F.lit(""),
        F.lit("| Rule | Title | Reason | Removed | Percent |"),
        F.lit("|---|---|---|---|---|"),
    ]
    for key, title, reason in REPORTED:
        share = F.concat(F.format_number(_percent(F.col(key), initial), 2), F.lit("%"))
        cells = F.concat_ws(" | ", F.lit(key[:2]), F.lit(title), F.lit(reason), _number(F.col(key)), share)
        lines.append(F.concat(F.lit("| "), cells, F.lit(" |")))
    return totals.select(F.posexplode(F.array(*lines)).alias("line_no", "value"))
