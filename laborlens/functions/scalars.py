"""Column helpers. Every function takes and returns columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens import schema as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- dates -------------------------------------------------------------------


def parse_date(x) -> Column:
    """Text date; placeholders ('--', empty, blank) and unreadable text are NULL."""
    return F.try_to_date(_c(x), "yyyy-MM-dd")


def date_of(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a date, parsed when it is stored as text."""
    text = dict(df.dtypes)[name] == "string"
    return (parse_date(df[name]) if text else df[name]).alias(name)


def months_since(fecha, anno, mes) -> Column:
    """Whole months from the month of ``fecha`` to (anno, mes); the day is ignored."""
    f = _c(fecha)
    return ((_c(anno) - F.year(f)) * 12 + (_c(mes) - F.month(f))).cast("int")


def month_label(anno, mes) -> Column:
    return F.concat_ws("-", _c(anno).cast("string"), F.lpad(_c(mes).cast("string"), 2, "0"))


def digits_date(text, start: int = 5) -> Column:
    """Month start from the six YYYYMM characters of a file name."""
    return F.try_to_date(F.concat(F.substring(_c(text), start, 6), F.lit("01")), "yyyyMMdd")


# --- codes -------------------------------------------------------------------


def int_code(x) -> Column:
    """Integer behind a code string that may read '17.0', rounded half away from zero; NULL when not a number."""
    return F.round(_c(x).try_cast("double")).try_cast("int")


def known_code(x, unknown: list[int]) -> Column:
    """The integer code, NULL when it is one of the 'unknown' codes."""
    code = int_code(x)
    return F.when(~code.isin(unknown), code)


def code_with_donor(x, donor, unknown: list[int], donor_unknown: list[int]) -> Column:
    """Own code when valid, else the donor's unless that one is 'unknown' too."""
    return F.coalesce(known_code(x, unknown), F.when(~_c(donor).isin(donor_unknown), _c(donor).cast("int")))


def nationality_2024(x) -> Column:
    return F.when(_c(x) == 3, F.lit(1)).otherwise(_c(x))


def nationality_2025(x) -> Column:
    return F.when(_c(x) == 2, F.lit(1)).when(_c(x) == 3, F.lit(2)).otherwise(_c(x))


def valid_sex(sexo, donor) -> Column:
    return F.when(_c(sexo).isin(1, 2), _c(sexo)).otherwise(_c(donor))


def sex_label(sexo) -> Column:
    return (
        F.when(_c(sexo) == 1, "Hombres").when(_c(sexo) == 2, "Mujeres").otherwise("Sin información")
    )


# Age labels of the external reference source.
AGE_LABELS = ["0_14", "15_24", "25_34", "35_44", "45_54", "55_64", "65_mas"]


def age_label_code(label) -> Column:
    out = F.lit(None).cast("int")
    for code, text in enumerate(AGE_LABELS):
        out = F.when(_c(label) == text, F.lit(code)).otherwise(out)
    return out


# Indicator names that differ between the two sources.
INDICATOR_NAMES = {
    "pt": "pt_cur",
    "pt_ent_12": "pt_ent",
    "pt_sal_12": "pt_sal",
    "inc_trln": "inc_rot_neta",
}


# --- bands -------------------------------------------------------------------


def band(x: str, cuts: list[int]) -> Column:
    """Number of cuts at or below column ``x``; NULL stays NULL."""
    whens = " ".join(f"WHEN `{x}` < {cut} THEN {i}" for i, cut in enumerate(cuts))
    return F.expr(f"CASE WHEN `{x}` IS NULL THEN NULL {whens} ELSE {len(cuts)} END")


def age_band_7(age_months: str) -> Column:
    return band(age_months, S.AGE_CUTS_7)


def age_band_13(age_months: str) -> Column:
    return band(age_months, S.AGE_CUTS_13)


def moving_size_band(mean) -> Column:
    out = F.lit(S.SIZE_TOP)
    for cut, name in reversed(S.SIZE_BANDS):
        out = F.when(_c(mean) < cut, F.lit(name)).otherwise(out)
    return out


def static_size_band(mean) -> Column:
    return F.when(_c(mean) == 1, F.lit(S.SINGLE_PERSON)).otherwise(moving_size_band(mean))


# --- pay and days -------------------------------------------------------------


def cap_pesos(uf: float, cap_uf: float) -> int:
    return math.trunc(uf * cap_uf)


def capped(monto, cap, missing_cap: str = "null") -> Column:
    """Pay limited to the cap. Without a cap: NULL, or unchanged with ``"keep"``."""
    m, c = _c(monto), _c(cap)
    out = F.when(m > c, c.cast("double")).when(m <= c, m)
    return F.when(c.isNull(), m).otherwise(out) if missing_cap == "keep" else out


def payment_type(tipo_pago) -> Column:
    return F.coalesce(_c(tipo_pago), F.lit(1))


def zero_on_leave(value, tipo_pago) -> Column:
    return F.when(_c(tipo_pago).isin(2, 3), F.lit(0)).otherwise(_c(value))


def at_most(x, limit: int) -> Column:
    return F.when(_c(x) > limit, F.lit(limit)).otherwise(_c(x))


def between_neighbours(before, after) -> Column:
    """Mean of two values when both are positive, else the larger (NULL counts 0)."""
    a, b = F.coalesce(_c(before), F.lit(0)), F.coalesce(_c(after), F.lit(0))
    return F.when((a > 0) & (b > 0), (a + b) / 2).otherwise(F.greatest(a, b))


def between_neighbours_days(before, after) -> Column:
    return F.bround(between_neighbours(before, after).cast("double"), 0).cast("int")


def daily_wage(monto, dias) -> Column:
    return F.when(_c(dias) > 0, _c(monto) / _c(dias))


def day_adjusted(monto, dias) -> Column:
    return _c(monto) * (_c(dias) / 30)


def ratio(num, den) -> Column:
    """Division that gives NULL on a zero denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio_if_positive(num, den) -> Column:
    return F.when(_c(den) > 0, _c(num).cast("double") / _c(den))


def growth(now, before) -> Column:
    return ratio(now, before) - 1


# Bounds of the tax credit in tax units, and its top rate.
CREDIT_LOW, CREDIT_HIGH, CREDIT_RATE = 7.8, 12, 0.15


def credit_bounds(utm) -> tuple[Column, Column]:
    return _c(utm) * CREDIT_LOW, _c(utm) * CREDIT_HIGH


def credit_rate(monto, low, high) -> Column:
    """Linear from the top rate at ``low`` to 0 at ``high``; NULL in, NULL out."""
    r = ratio(F.lit(CREDIT_RATE) * (_c(high) - _c(monto)), _c(high) - _c(low))
    return F.when(r.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(CREDIT_RATE), r)))


def deflate(x, price_index, base: int = 1) -> Column:
    return ratio(x, price_index) * base


# --- text ----------------------------------------------------------------------


def magnitude(x) -> Column:
    """1.5e9 -> '1.5 MM'; below a million, digits with thousands separators."""
    x = _c(x)

    def scaled(unit: float, suffix: str) -> Column:
        number = F.bround(x / unit, 1).cast("string")
        return F.concat(F.regexp_replace(number, r"\.0$", ""), F.lit(suffix))

    return (
        F.when(x >= 1e12, scaled(1e12, " B"))
        .when(x >= 1e9, scaled(1e9, " MM"))
        .when(x >= 1e6, scaled(1e6, " M"))
        .otherwise(F.format_number(F.bround(x, 0), 0))
    )


def percent(x, decimals: int = 1) -> Column:
    return F.concat(F.format_number(F.bround(_c(x) * 100, decimals), decimals), F.lit("%"))
