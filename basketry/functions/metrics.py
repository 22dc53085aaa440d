"""Rule metrics as column expressions over integer counts.

``n``, ``n_a``, ``n_c`` are the orders holding the whole rule, its antecedent, its consequent;
``n_baskets`` all orders of the country. Each metric divides in a fixed order, all in doubles, since
a threshold met exactly must not depend on who computes it. Each takes another count in the place of ``n_c``.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F


def _share(count: Column) -> Column:
    return count / F.col("n_baskets")


def support(n_c: Column | None = None) -> Column:
    return _share(F.col("n"))


def antecedent_support(n_c: Column | None = None) -> Column:
    return _share(F.col("n_a"))


def consequent_support(n_c: Column | None = None) -> Column:
    return _share(F.col("n_c") if n_c is None else n_c)


def confidence(n_c: Column | None = None) -> Column:
    return support() / antecedent_support()


def lift(n_c: Column | None = None) -> Column:
    return confidence() / consequent_support(n_c)


def leverage(n_c: Column | None = None) -> Column:
    return support() - antecedent_support() * consequent_support(n_c)


def conviction(n_c: Column | None = None) -> Column:
    """Infinite for a rule that always holds."""
    return F.when(
        confidence() < 1.0, (F.lit(1.0) - consequent_support(n_c)) / (F.lit(1.0) - confidence())
    ).otherwise(F.lit(float("inf")))


METRICS = {
    "antecedent_support": antecedent_support,
    "consequent_support": consequent_support,
    "support": support,
    "confidence": confidence,
    "lift": lift,
    "leverage": leverage,
    "conviction": conviction,
}


def _whole(value: Column, digits: int = 12) -> Column:
    return value.cast(f"decimal({digits},0)")


def _exactly(metric: str, threshold: Fraction, n_c: Column) -> Column:
    """``metric >= threshold`` with both sides multiplied out to whole numbers; counts of up to 12 digits."""
    n, n_a, n_baskets, n_c = (_whole(c) for c in (F.col("n"), F.col("n_a"), F.col("n_baskets"), n_c))
    over, under = F.lit(threshold.numerator).cast("decimal(12,0)"), F.lit(threshold.denominator).cast("decimal(12,0)")
    above, below = {
        "antecedent_support": (n_a, n_baskets),
        "consequent_support": (n_c, n_baskets),
        "support": (n, n_baskets),
        "confidence": (n, n_a),
        "lift": (n * n_baskets, n_a * n_c),
        "leverage": (n * n_baskets - n_a * n_c, n_baskets * n_baskets),
        "conviction": ((n_baskets - n_c) * n_a, n_baskets * (n_a - n)),
    }[metric]
    holds = above * under >= below * over
    return holds | (n_a == n) if metric == "conviction" else holds


def reaches(metric: str, threshold: float, exact: bool = False, bound: bool = False) -> Column:
    """Whether the metric is at least ``threshold``.

    ``bound``: whether it can be for a rule of the same itemset with a part of the left side moved to the right, whose
    n_a is no less, and whose n_c is no less than ``n_least``. ``exact`` compares whole numbers, with the threshold as
    it is written in decimals.
    """
    if bound and metric == "antecedent_support":
        return F.lit(True)  # grows as items move
    # The right side's own support is largest now; all other metrics fall as n_c grows.
    n_c = F.col("n_least") if bound and metric != "consequent_support" else F.col("n_c")
    if exact:
        return _exactly(metric, Fraction(str(threshold)), n_c)
    return METRICS[metric](n_c) >= F.lit(float(threshold))


def number_text(value: Column) -> Column:
    """A double as the shortest plain decimal text that reads back as it: ``2``, ``1.5``, ``0.0005``."""
    text = value.cast("string")
    part = lambda group: F.regexp_extract(text, r"^(-?)(\d)\.(\d+)E(-?\d+)$", group)
    digits = F.concat(part(2), F.regexp_replace(part(3), "^0$", ""))
    exponent = part(4).cast("int")
    after = F.length(digits) - 1 - exponent  # digits right of the point
    small = F.concat(part(1), F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    large = F.when(after <= 0, F.concat(part(1), digits, F.repeat(F.lit("0"), -after))).otherwise(
        F.concat(part(1), F.substr(digits, F.lit(1), exponent + 1), F.lit("."), F.substr(digits, exponent + 2))
    )
    plain = F.regexp_replace(text, r"\.0$", "")
    return F.when(~text.contains("E"), plain).when(exponent < 0, small).otherwise(large)
