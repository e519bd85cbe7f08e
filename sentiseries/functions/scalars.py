"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Labels:
    """Names and inclusive score thresholds of the three sentiment labels."""

    positive: str = "Positive"
    neutral: str = "Neutral"
    negative: str = "Negative"
    positive_from: float = 0.05
    negative_to: float = -0.05


def sentiment_label(score: Column, labels: Labels = Labels()) -> Column:
    """Three-way label of a score; a null score has no label."""
    return (
        F.when(score >= labels.positive_from, labels.positive)
        .when(score <= labels.negative_to, labels.negative)
        .when(score.isNotNull(), labels.neutral)
    )


def format_month(month: str = "month") -> Column:
    """Month as two digits."""
    return F.lpad(F.col(month).cast("string"), 2, "0")


def month_date(year: str = "year", month: str = "month") -> Column:
    """First day of the month; null when year or month is null or no such month exists."""
    valid = F.col(month).between(1, 12)
    return F.when(valid, F.make_date(F.col(year), F.col(month), F.lit(1)))


def period(date: Column, cut: str) -> Column:
    """'before' or 'after' the cut date (the cut itself is after); null for a null date."""
    cut_date = F.lit(cut).cast("date")
    return F.when(date < cut_date, "before").when(date >= cut_date, "after")


def period_of_month(year: Column, month: Column, cut: str) -> Column:
    """The same split for (year, month) columns."""
    cut_year, cut_month = (int(part) for part in cut.split("-")[:2])
    is_before = (year < cut_year) | ((year == cut_year) & (month < cut_month))
    is_after = (year > cut_year) | ((year == cut_year) & (month >= cut_month))
    return F.when(is_before, "before").when(is_after, "after")


def absolute_change(before: Column, after: Column) -> Column:
    return after - before


def relative_change(before: Column, after: Column) -> Column:
    """Change in percent of the size of the old value; null when that is zero."""
    return F.try_divide(after - before, F.abs(before)) * 100


def keeps_null(p_value: Column, alpha: float = 0.05) -> Column:
    """True when the null hypothesis is not rejected at ``alpha``."""
    return p_value >= F.lit(alpha)
