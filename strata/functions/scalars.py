"""Scalar Column functions.

Every function maps Columns to a Column built from Catalyst expressions, so it
runs inside whole-stage codegen and never calls Python per row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_map(mapping: Mapping) -> Column:
    """A constant map literal; its size is fixed by the code, not by the data."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


# --------------------------------------------------------------------------- #
# Numeric helpers                                                             #
# --------------------------------------------------------------------------- #
def share(num, den) -> Column:
    """``num / den`` as double, 0.0 when the denominator is 0 or null."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(0.0))


def half_even(c, digits: int = 0) -> Column:
    """Numpy-style half-to-even rounding (``bround``)."""
    return F.bround(_c(c), digits)


def rint_int(c) -> Column:
    """Half-even round to a whole number, as bigint."""
    return F.rint(_c(c)).cast("bigint")


# Coefficients of AS 241 (PPND16), published by Wichura (1988).
# (names a-f are the six polynomials of the central and two tail regions)
a = [3.387132872796366608, 133.14166789178437745, 1971.5909503065514427,
     13731.693765509461125, 45921.953931549871457, 67265.770927008700853,
     33430.575583588128105, 2509.0809287301226727]
b = [1.0, 42.313330701600911252, 687.1870074920579083, 5394.1960214247511077,
     21213.794301586595867, 39307.89580009271061, 28729.085735721942674,
     5226.495278852545925]
c = [1.42343711074968357734, 4.6303378461565452959, 5.7694972214606914055,
     3.64784832476320460504, 1.27045825245236838258, 0.24178072517745061177,
     0.0227238449892691845833, 7.7454501427834140764e-4]
d = [1.0, 2.05319162663775882187, 1.6763848301838038494, 0.68976733498510000455,
     0.14810397642748007459, 0.0151986665636164571966, 5.475938084995344946e-4,
     1.05075007164441684324e-9]
e = [6.6579046435011037772, 5.4637849111641143699, 1.7848265399172913358,
     0.29656057182850489123, 0.026532189526576123093, 0.0012426609473880784386,
     2.71155556874348757815e-5, 2.01033439929228813265e-7]
f = [1.0, 0.59983220655588793769, 0.13692988092273580531, 0.0148753612908506148525,
     7.868691311456132591e-4, 1.8463183175100546818e-5, 1.4215117583164458887e-7,
     2.04426310338993978564e-15]
AS241 = (a, b, c, d, e, f)
del a, b, c, d, e, f


def inv_norm_cdf(p) -> Column:
    """Inverse standard normal CDF (Wichura's AS 241, double precision).

    Built as a plain Column expression so it stays in codegen.  ``p`` outside
    (0, 1) yields null.
    """
    p = _c(p).cast("double")
    q = p - F.lit(0.5)

    def poly(coefs, x):
        acc = F.lit(coefs[-1])
        for a in reversed(coefs[:-1]):
            acc = acc * x + F.lit(a)
        return acc

    a, b, c, d, e, f = AS241

    r_central = F.lit(0.180625) - q * q
    central = q * poly(a, r_central) / poly(b, r_central)
    r_tail = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    r1 = r_tail - F.lit(1.6)
    r2 = r_tail - F.lit(5.0)
    tail_near = poly(c, r1) / poly(d, r1)
    tail_far = poly(e, r2) / poly(f, r2)
    tail_val = F.when(r_tail <= F.lit(5.0), tail_near).otherwise(tail_far)
    tail = F.when(q < 0, -tail_val).otherwise(tail_val)
    return (F.when((p <= 0) | (p >= 1) | p.isNull(), F.lit(None).cast("double"))
            .when(F.abs(q) <= F.lit(0.425), central)
            .otherwise(tail))


def normal_pdf(x, mu, sigma) -> Column:
    """Normal density."""
    x, mu, sigma = _c(x), _c(mu), _c(sigma)
    return F.exp(-F.pow(x - mu, 2) / (F.lit(2.0) * sigma * sigma)) / (sigma * F.lit(math.sqrt(2 * math.pi)))


def qq_grade(r2) -> Column:
    """QQ goodness label."""
    r2 = _c(r2)
    return F.when(r2 >= 0.98, "Excellent").when(r2 >= 0.95, "Good").otherwise("Poor")


# --------------------------------------------------------------------------- #
# Text helpers                                                                #
# --------------------------------------------------------------------------- #
def contains_any(text, keywords: Iterable[str]) -> Column:
    """N4/rule 17: case-insensitive substring test against keywords."""
    low = F.lower(_c(text))
    cond = F.lit(False)
    for k in keywords:
        cond = cond | F.contains(low, F.lit(k.lower()))
    return F.coalesce(cond, F.lit(False))


def strip_quotes_lower(c) -> Column:
    """``x.lower().strip("'\\"")``."""
    return F.regexp_replace(F.lower(_c(c)), r"^['\"]+|['\"]+$", "")


def digits_int(c) -> Column:
    """Integer value of an all-digit string, else null."""
    c = _c(c).cast("string")
    return F.when(c.rlike(r"^[0-9]+$"), c.try_cast("bigint"))


def norm_text(c) -> Column:
    """Trim, lower, collapse whitespace; null -> ''."""
    s = F.regexp_replace(F.coalesce(_c(c).cast("string"), F.lit("")), r"^\s+|\s+$", "")
    return F.regexp_replace(F.lower(s), r"\s+", " ")


def contains_either(a, b) -> Column:
    """Bidirectional containment on normalised text; false when b is null."""
    a_n, b_n = norm_text(a), norm_text(b)
    return F.when(_c(b).isNull(), F.lit(False)).otherwise(
        F.contains(a_n, b_n) | F.contains(b_n, a_n))


def slug(c) -> Column:
    """Lower, non-alphanumerics to '-', trim '-', empty -> 'unknown'."""
    raw = _c(c).cast("string")
    s = F.regexp_replace(F.lower(raw), r"[^a-z0-9]+", "-")
    s = F.regexp_replace(s, r"^-+|-+$", "")
    bad = raw.isNull() | (raw == "") | (raw == "Not Reported")
    return F.when(bad, F.lit("unknown")).otherwise(s)


def record_id(*cols) -> Column:
    """X11: md5 of the given values joined by a vertical bar; nulls as ''."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def document_id(text) -> Column:
    """Id from ``**Document ID:** `...` ``; '' when absent."""
    return F.regexp_extract(_c(text), r"\*\*Document ID:\*\*\s*`([^`]+)`", 1)


def year_in_text(c) -> Column:
    """X13: '20YY-YY' if present, else '20YY', else null."""
    c = _c(c)
    span = F.regexp_extract(c, r"(20\d{2}-\d{2})", 1)
    year = F.regexp_extract(c, r"(20\d{2})", 1)
    return F.when(span != "", span).when(year != "", year)


def safe_folder(c) -> Column:
    """Folder name: keep word characters, spaces and '-', runs of '-' or
    spaces to '_', lower case, no leading/trailing '_'."""
    s = F.regexp_replace(_c(c), r"[^\p{L}\p{N}_\s-]", "")
    s = F.regexp_replace(s, r"[-\s]+", "_")
    return F.regexp_replace(F.lower(s), r"^_+|_+$", "")


def safe_filename(c) -> Column:
    """File name sanitising: each of <>:"/\\|?* becomes '_'."""
    return F.regexp_replace(_c(c), r'[<>:"/\\|?*]', "_")


def url_filename(c) -> Column:
    """URL -> file name: scheme dropped, '/' -> '_', ':' removed."""
    s = F.replace(F.replace(_c(c), F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    return F.replace(F.replace(s, F.lit("/"), F.lit("_")), F.lit(":"), F.lit(""))


def url_basename(c) -> Column:
    """Last path segment of a URL."""
    path = F.regexp_extract(_c(c), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_extract(path, r"([^/]+)$", 1)


def url_extension_ok(c, exts=("csv", "xls", "xlsx", "zip")) -> Column:
    """Does the URL path end with one of the extensions."""
    ext = F.lower(F.regexp_extract(url_basename(c), r"\.([A-Za-z0-9]+)$", 1))
    return ext.isin(*exts)


def percent_to_fraction(c) -> Column:
    """Percent to fraction."""
    return _c(c).cast("double") / F.lit(100.0)


def ratio_value(c) -> Column:
    """X16: '18:1' -> 18.0; '0:1', non-digit or null -> null."""
    c = _c(c)
    ok = c.rlike(r"^\d+:") & (c != "0:1")
    return F.when(ok, F.split(c, ":").getItem(0).cast("double"))


def strip(c) -> Column:
    """Text without white space (tabs and line ends, too) at either end."""
    return F.regexp_replace(_c(c).cast("string"), r"^\s+|\s+$", "")


def display(c, default: str = "Not Reported") -> Column:
    """Display text of a scalar: null / '' / blank -> default, yes/no
    words -> Yes/No, anything else as trimmed text (use ``display_bool`` and
    ``display_list`` for boolean and array columns)."""
    s = _c(c).cast("string")
    low = F.lower(s)
    text = strip(s)
    return (F.when(s.isNull() | (text == ""), F.lit(default))
            .when(low.isin("true", "yes", "y"), F.lit("Yes"))
            .when(low.isin("false", "no", "n"), F.lit("No"))
            .otherwise(text))


def display_bool(c, default: str = "Not Reported") -> Column:
    c_ = _c(c)
    return F.when(c_.isNull(), F.lit(default)).when(c_, F.lit("Yes")).otherwise(F.lit("No"))


def display_list(c, default: str = "Not Reported") -> Column:
    c_ = _c(c)
    return F.when(F.coalesce(F.size(c_), F.lit(0)) == 0, F.lit(default)).otherwise(F.array_join(c_, ", "))


def with_prefix(c, prefix: str = "", suffix: str = "", default: str = "Not Reported") -> Column:
    """X22: '$'-prefix / '%'-suffix only when the value is reported."""
    v = display(c, default)
    return F.when(v == F.lit(default), v).otherwise(F.concat(F.lit(prefix), v, F.lit(suffix)))


def preview(c, n: int = 200) -> Column:
    """First n characters plus '...' when longer."""
    c = _c(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def table_cell(c, width: int = 97) -> Column:
    """Markdown table cell: escape '|', '[' and ']'; longer than
    width + 3 characters -> first ``width`` characters + '...'."""
    s = _c(c).cast("string")
    for ch in ("|", "[", "]"):
        s = F.replace(s, F.lit(ch), F.lit("\\" + ch))
    return F.when(F.length(s) > width + 3, F.concat(F.substring(s, 1, width), F.lit("..."))).otherwise(s)


# --------------------------------------------------------------------------- #
# Lookups (X1-X6)                                                             #
# --------------------------------------------------------------------------- #
def standard_grade(c) -> Column:
    """Grade-level standardisation."""
    raw = _c(c).cast("string")
    t = strip(raw)
    u = F.upper(t)
    # int(float(x)): parse as double, truncate toward zero, keep 1..12
    num_int = t.try_cast("double").try_cast("bigint")
    return (F.when(raw.isNull(), F.lit(None).cast("string"))
            .when(u.isin(*K.GRADE_K), F.lit("K"))
            .when(u.isin(*K.GRADE_PK), F.lit("PK"))
            .when(u.isin(*K.GRADE_HS), F.lit("HS"))
            .when(num_int.between(1, 12), num_int.cast("string"))
            .otherwise(t))


def reason_group(c, kind: str) -> Column:
    """Reason description -> group; 'Unclassified' when unknown."""
    groups = {"withdrawal": K.WITHDRAWAL_GROUPS, "enrollment": K.ENROLLMENT_GROUPS}[kind]
    return F.coalesce(F.try_element_at(lit_map(groups), _c(c)), F.lit("Unclassified"))


def state_name(c) -> Column:
    """State code -> state name; unmapped values are kept."""
    return F.coalesce(F.try_element_at(lit_map(K.STATE_NAMES), _c(c)), _c(c))


def region_of(state) -> Column:
    """State name (or code) -> census region, default 'Other'."""
    return F.coalesce(F.try_element_at(lit_map(K.CENSUS_REGIONS), _c(state)), F.lit("Other"))


def gifted(c) -> Column:
    """Keep Y/D, anything else N."""
    c = _c(c)
    return F.when(c.isin("Y", "D"), c).otherwise(F.lit("N"))


def segment_label(flags: Mapping[str, Column], empty: str | None = None) -> Column:
    """X6: '+'-joined names of the true flags, in the given order."""
    parts = [F.when(_c(v), F.lit(k)) for k, v in flags.items()]
    lab = F.concat_ws("+", *parts)
    out = F.when(lab == "", F.lit(empty)).otherwise(lab)
    return out


def has_data(c) -> Column:
    """Not null, not '', not 'nan'."""
    s = _c(c).cast("string")
    return s.isNotNull() & ~s.isin("", "nan")
