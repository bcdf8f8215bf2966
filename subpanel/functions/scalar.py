"""Scalar column functions (F1-F12). All are JVM-side expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same answers.
WILSON_Z = 1.96
RISK_BANDS = [(0.60, "High"), (0.30, "Medium")]  # else "Low"
SILHOUETTE_BANDS = [
    (0.70, "strong structure"),
    (0.50, "reasonable structure"),
    (0.25, "weak — possibly artificial"),
]  # else "no substantial structure"
STABILITY_BANDS = [
    (0.90, "stable"),
    (0.75, "mostly stable"),
]  # else the unstable verdict below
UNSTABLE_VERDICT = "unstable"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def wilson(successes, total, z: float = WILSON_Z) -> Column:
    """Wilson score interval as ``struct(low, high)``; total <= 0 gives (0, 0)."""
    k = _c(successes).cast("double")
    n = _c(total).cast("double")
    p = k / n
    z2 = F.lit(z * z)
    denom = F.lit(1.0) + z2 / n
    centre = (p + z2 / (F.lit(2.0) * n)) / denom
    spread = F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / n + z2 / (F.lit(4.0) * n * n)) / denom
    low = F.when(n <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), centre - spread))
    high = F.when(n <= 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), centre + spread))
    return F.struct(low.alias("low"), high.alias("high"))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def linear_predictor(coefficients: dict, intercept: float = 0.0) -> Column:
    """``intercept + sum(coef * column)`` with coefficients from a dict."""
    expr = F.lit(float(intercept))
    for name, coef in coefficients.items():
        expr = expr + F.lit(float(coef)) * _c(name)
    return expr


def clip(x, lo=None, hi=None) -> Column:
    out = _c(x)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def risk_band(p) -> Column:
    expr = None
    for cut, name in RISK_BANDS:
        cond = _c(p) >= F.lit(cut)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("Low"))


def _bands(x, bands, default) -> Column:
    expr = None
    for cut, name in bands:
        cond = _c(x) >= F.lit(cut)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default))


def silhouette_verdict(s) -> Column:
    return _bands(s, SILHOUETTE_BANDS, "no substantial structure")


def stability_verdict(ari) -> Column:
    return _bands(ari, STABILITY_BANDS, UNSTABLE_VERDICT)


def _base_letters() -> tuple[str, str]:
    """Accented letters and the base letters Unicode decomposes them to."""
    pairs = [(chr(p), unicodedata.normalize("NFKD", chr(p))[0]) for p in range(0xC0, 0x1F00)
             if unicodedata.normalize("NFKD", chr(p))[0].isascii()
             and unicodedata.normalize("NFKD", chr(p))[0].isalpha()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _PLAIN = _base_letters()


def slug(text) -> Column:
    """Accent-stripped lower-case key; runs of non-alphanumerics become '-'."""
    plain = F.lower(F.translate(_c(text), _ACCENTED, _PLAIN))
    dashed = F.regexp_replace(plain, r"[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, r"^-+|-+$", "")


def parse_mixed_date(text) -> Column:
    """ISO ``yyyy-MM-dd`` and day-first ``dd/MM/yyyy``, each parsed with its
    own explicit format; anything else is null."""
    t = _c(text)
    return (F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd"))
            .when(t.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date(t, "dd/MM/yyyy")))


def month_start(date_key) -> Column:
    return F.to_date(_c(date_key).cast("string"), "yyyyMM")


def blank_to_null(text) -> Column:
    return F.nullif(F.trim(_c(text)), F.lit(""))


def safe_ratio(num, den) -> Column:
    """``num / den`` with den floored at 1 (the seats guard)."""
    return _c(num) / F.greatest(_c(den), F.lit(1))
