"""Money, rounding and boolean text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobloom.functions.text import strip, text_or_blank


def _comma_decimal(text: Column) -> Column:
    dots_removed = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(text.contains(","), dots_removed).otherwise(text).try_cast("double")


def _range(values: Column, currency: Column) -> Column:
    n = F.size(values)
    return F.struct(
        F.when(n > 0, F.array_min(values)).alias("low"),
        F.when(n > 1, F.array_max(values)).alias("high"),
        F.when(n > 0, currency).alias("currency"),
    )


def money(c: Column | str) -> Column:
    """``low, high, currency`` from free salary text; ``high`` only when two numbers are given."""
    text = text_or_blank(c)
    raw = F.regexp_extract_all(text, F.lit(r"(\d[\d.]*,\d{2}|\d+(?:[.,]\d+)?)"), 1)
    values = F.array_compact(F.transform(raw, _comma_decimal))
    return _range(values, F.when(text.contains("R$"), "BRL"))


def reais(c: Column | str) -> Column:
    """Like ``money`` but only amounts written after ``R$``; a dot is always a thousands separator."""
    raw = F.regexp_extract_all(text_or_blank(c), F.lit(r"R\$\s*([\d.]+(?:,\d{2})?)"), 1)
    values = F.array_compact(
        F.transform(raw, lambda v: F.replace(F.replace(v, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double"))
    )
    return _range(values, F.lit("BRL"))


def tolerant_number(c: Column | str) -> Column:
    """Decimal comma or point; NULL for anything else."""
    return F.replace(strip(text_or_blank(c)), F.lit(","), F.lit(".")).try_cast("double")


def visible_salary(show: Column, kind: Column, low: Column, high: Column) -> Column:
    """``low, high, currency`` of a range the applicant may see; a simple salary moves from high to low."""
    show = F.coalesce(show, F.lit(False))
    low, high = F.nullif(low, F.lit(0.0)), F.nullif(high, F.lit(0.0))
    moves = F.coalesce((kind == "simple") & low.isNull() & high.isNotNull(), F.lit(False))
    return F.struct(
        F.when(show, F.when(moves, high).otherwise(low)).alias("low"),
        F.when(show & ~moves, high).alias("high"),
        F.when(show & (low.isNotNull() | high.isNotNull()), "BRL").alias("currency"),
    )


def published_amount(c: Column) -> Column:
    """Two decimals, half to even; zero counts as not given."""
    return F.when(c != 0, F.bround(c, 2))


def round_half_up(c: Column) -> Column:
    return F.floor(c + 0.5).cast("int")


def clamp(c: Column, low: int = 0, high: int = 100) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def is_true_text(c: Column | str) -> Column:
    return F.lower(strip(text_or_blank(c))).isin("true", "1", "sim", "yes")


def _pt_number(value: Column, decimals: int) -> Column:
    plain = F.format_number(value, decimals)
    return F.translate(plain, ",.", ".,")


def salary_text(low: Column, high: Column, currency: Column) -> Column:
    """Display text in Brazilian number format: ``R$ 1.000,00 a R$ 2.000,00``, ``A partir de …``, ``Até …``."""
    code = F.coalesce(F.nullif(currency, F.lit("")), F.lit("BRL"))
    symbol = F.when(code == "BRL", "R$").when(code == "USD", "US$").when(code == "EUR", "€").otherwise(code)

    def amount(value: Column) -> Column:
        number = F.when(code == "BRL", _pt_number(value, 2)).otherwise(_pt_number(value, 0))
        return F.when(F.coalesce(value, F.lit(0.0)) != 0, F.concat(symbol, F.lit("\u00a0"), number))

    lo, hi = amount(low), amount(high)
    return (
        F.when(lo.isNotNull() & hi.isNotNull(), F.concat(lo, F.lit(" a "), hi))
        .when(lo.isNotNull(), F.concat(F.lit("A partir de "), lo))
        .when(hi.isNotNull(), F.concat(F.lit("Até "), hi))
        .otherwise("")
    )
