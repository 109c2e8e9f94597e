"""Exact tests as column expressions.

Arguments are SQL texts, usually column names. The expressions are built as SQL because
they nest lambdas deeply; Spark evaluates them as built-in functions all the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

#: A tail is summed until Hoeffding's bound on the rest is below exp(-2 * 24) (about 1e-21).
TAIL_EXPONENT = 24


def ln_factorial(n: str) -> str:
    """SQL of ln(n!) for any n >= 0: exact up to 20, Stirling's series (error < 1e-14) above.

    No lookup table, so the depth of a locus is not limited by an array's length.
    """
    half_ln_2pi = repr(0.5 * math.log(2 * math.pi))
    series = f"(1D/12 - (1D/360 - (1D/1260 - 1D/1680/{n}/{n})/{n}/{n})/{n}/{n})/{n}"
    stirling = f"({n} + 0.5D) * ln({n}) - {n} + {half_ln_2pi}D + {series}"
    return f"(case when {n} <= 20 then ln(factorial(cast(least({n}, 20) as int))) else {stirling} end)"


def hypergeometric_tail(alt: str, depth: str, alt_total: str, total: str) -> Column:
    """P(X >= alt) when ``depth`` draws come from ``total`` reads holding ``alt_total`` alternates.

    Meant for ``alt`` at or above its expectation, where terms fall. The first term comes
    from factorials, each further one from the ratio of neighbours. Terms past
    expectation + sqrt(TAIL_EXPONENT * depth) add less than double precision can hold
    (Hoeffding's inequality holds for draws without replacement), so the number of terms
    grows with the square root of the depth.

    The counts are bound once, as a lambda's variable ``c``, so the expression stays small
    whatever the arguments are.
    """
    signed = [("k", 1), ("n - c.k", 1), ("d", 1), ("n - c.d", 1),
              ("x", -1), ("k - c.x", -1), ("d - c.x", -1), ("n - c.k - c.d + c.x", -1), ("n", -1)]
    terms = ", ".join(f"struct(c.{v} as v, {s}D as s)" for v, s in signed)
    ln_first = f"aggregate(array({terms}), 0D, (acc, t) -> acc + t.s * {ln_factorial('t.v')})"
    last = f"least(c.k, c.d, cast(ceil(c.d * 1D * c.k / c.n + sqrt({TAIL_EXPONENT}D * c.d)) as bigint))"
    steps = f"if({last} > c.x, sequence(c.x, {last} - 1), cast(array() as array<bigint>))"
    term = "acc.term * ((c.k - i) * (c.d - i)) / ((i + 1) * (c.n - c.k - c.d + i + 1))"
    ratio_sum = (f"aggregate({steps}, struct(1D as term, 1D as sum), "
                 f"(acc, i) -> struct({term} as term, acc.sum + {term} as sum), acc -> acc.sum)")
    counts = f"array(struct({alt} as x, {depth} as d, {alt_total} as k, {total} as n))"
    return F.expr(f"transform({counts}, c -> least(1D, exp({ln_first}) * {ratio_sum}))[0]")


def fisher_one_tailed(a_ref: str, a_alt: str, b_ref: str, b_alt: str) -> Column:
    """One-tailed Fisher p of [[a_ref, a_alt], [b_ref, b_alt]] in the direction of b's shift.

    Counts are ``bigint``. A fall of alternates in b is a rise of its reference reads, so
    both directions use the upper tail.
    """
    rises = f"{b_alt} * ({a_ref} + {a_alt}) >= {a_alt} * ({b_ref} + {b_alt})"
    return hypergeometric_tail(
        f"if({rises}, {b_alt}, {b_ref})", f"{b_ref} + {b_alt}",
        f"if({rises}, {a_alt} + {b_alt}, {a_ref} + {b_ref})", f"{a_ref} + {a_alt} + {b_ref} + {b_alt}")
