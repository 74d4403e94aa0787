"""SQL-text twins of the exact helpers, for the DuckDB oracle."""

from __future__ import annotations


def rr(num: str, den: str, digits: int) -> str:
    """round(num/den, digits) half away from zero, exact; NULL when den <= 0."""
    s = 10 ** digits
    mag = f"((abs({num}) * {2 * s} + ({den})) // (2 * ({den})))"
    return (f"CASE WHEN ({den}) > 0 THEN CAST(CASE WHEN ({num}) < 0 THEN -{mag} ELSE {mag} END AS DOUBLE)"
            f" / CAST({s} AS DOUBLE) END")


def pct(num: str, den: str, digits: int = 2) -> str:
    return rr(f"(({num}) * 100)", den, digits)


def count_if(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def rate_pct(flag: str, cond: str | None = None, digits: int = 2) -> str:
    f = f" FILTER (WHERE {cond})" if cond else ""
    return pct(f"sum(CAST({flag} AS INTEGER)){f}", f"count(CAST({flag} AS INTEGER)){f}", digits)


def avg_exact(col: str, cond: str | None, digits: int, money: bool = False) -> str:
    f = f" FILTER (WHERE {cond})" if cond else ""
    if money:
        v = f"CAST({col} * 100 AS BIGINT)"
        return rr(f"sum({v}){f}", f"(count({v}){f} * 100)", digits)
    v = f"CAST({col} AS BIGINT)"
    return rr(f"sum({v}){f}", f"count({v}){f}", digits)


def avg_days(col: str, digits: int) -> str:
    return rr_wide(f"sum(CAST(round({col} * 86400000000) AS HUGEINT))", f"count({col}) * 86400000000", digits)


def money_sum(col: str, cond: str | None = None) -> str:
    f = f" FILTER (WHERE {cond})" if cond else ""
    return f"CAST(sum({col}){f} AS DECIMAL(38,2))"


def rrs(num: str, den: str, digits: int) -> str:
    """Scaled integer of round(num/den, digits) (HUGEINT); NULL when den <= 0."""
    s = 10 ** digits
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    mag = f"((abs({n}) * {2 * s} + {d}) // (2 * {d}))"
    return f"CASE WHEN ({den}) > 0 THEN CASE WHEN ({num}) < 0 THEN -{mag} ELSE {mag} END END"


def rr_wide(num: str, den: str, digits: int) -> str:
    return f"CAST({rrs(num, den, digits)} AS DOUBLE) / CAST({10 ** digits} AS DOUBLE)"


def band_ord(value: str, band) -> str:
    parts = []
    for i, e in enumerate(band.edges):
        op = "<=" if band.is_inclusive(i) else "<"
        parts.append(f"WHEN {value} {op} {e} THEN {i + 1}")
    return "CASE " + " ".join(parts) + f" ELSE {len(band.labels)} END"


def band_ord_ratio(num: str, den: str, band) -> str:
    parts = []
    for i, e in enumerate(band.edges):
        op = "<=" if band.is_inclusive(i) else "<"
        parts.append(f"WHEN {num} {op} {den} * {e} THEN {i + 1}")
    return "CASE " + " ".join(parts) + f" ELSE {len(band.labels)} END"


def band_label(ord_col: str, band) -> str:
    return "CASE " + " ".join(f"WHEN {ord_col} = {i + 1} THEN '{lab}'" for i, lab in enumerate(band.labels)) + " END"


def percentile_select(src: str, value: str, key: str, fractions, unit: int, digits: int,
                      extra: tuple[str, ...] = (), names: tuple[str, ...] | None = None) -> str:
    """Exact percentile_cont(a/b) of an integral value over ``src`` (one row)."""
    picks = []
    outs = ["n"] if names is None else []
    for i, (a, b) in enumerate(fractions):
        pos = f"(CAST(n AS HUGEINT) - 1) * {a}"
        lo = f"({pos} // {b} + 1)"
        picks += [f"max(CASE WHEN rn = {lo} THEN v END) AS lo{i}",
                  f"max(CASE WHEN rn = LEAST({lo} + 1, n) THEN v END) AS hi{i}",
                  f"max({pos} % {b}) AS f{i}"]
        label = names[i] if names else f"p{i}"
        outs.append(f"{rr_wide(f'(lo{i} * {b} + (hi{i} - lo{i}) * f{i})', str(b * unit), digits)} AS {label}")
    ranked = (f"SELECT *, CAST({value} AS HUGEINT) AS v, row_number() OVER (ORDER BY {value}, {key}) AS rn, "
              f"count(*) OVER () AS n FROM ({src})")
    inner = f"SELECT count(*) AS n, {', '.join(picks + list(extra))} FROM ({ranked})"
    extra_names = [e.rsplit(" AS ", 1)[1] for e in extra]
    return f"SELECT {', '.join(outs + extra_names)} FROM ({inner})"
