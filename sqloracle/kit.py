"""SQL-text helpers for exact decimal results in DuckDB.

DuckDB turns every decimal division (and AVG of decimals) into DOUBLE, so a ratio cast to
DECIMAL(10,4) can land on the other side of a rounding tie than Spark's exact decimal
division.  ``xdiv`` divides scaled integers (HUGEINT) and rounds half away from zero, which is
what Spark's decimal division + cast does.
"""
from __future__ import annotations


def _scaled(expr: str, scale: int) -> str:
    if scale == 0:
        return f"CAST(({expr}) AS HUGEINT)"
    return f"CAST(CAST(({expr}) AS DECIMAL(38,{scale})) * {10 ** scale} AS HUGEINT)"


def xdiv(num: str, den: str, scale: int, ns: int = 0, ds: int = 0, prec: int = 38) -> str:
    """Exact ``num / den`` rounded HALF_UP to ``scale`` digits, typed DECIMAL(prec, scale).

    ``ns``/``ds`` are the decimal scales of ``num``/``den`` (0 for integers).
    """
    n, dd = _scaled(num, ns), _scaled(den, ds)
    k = ds + scale - ns  # result*10^scale = n*10^(ds+scale-ns) / dd
    if k >= 0:
        nn, dn = f"(abs({n}) * {10 ** k})", f"abs({dd})"
    else:
        nn, dn = f"abs({n})", f"(abs({dd}) * {10 ** (-k)})"
    q = f"(sign({n}) * sign({dd}) * ((2 * {nn} + {dn}) // (2 * {dn})))"
    unit = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST({unit} AS DECIMAL({scale + 1},{scale})) AS DECIMAL({prec},{scale}))"


def ratio(num: str, den: str, scale: int, prec: int, ns: int = 0, ds: int = 0, guard: str | None = None,
          default: str = "0") -> str:
    """``CASE WHEN den > 0 THEN CAST(num/den AS DECIMAL(prec,scale)) ELSE default END`` (exact)."""
    g = guard or f"({den}) > 0"
    return (f"CAST(CASE WHEN {g} THEN {xdiv(num, den, scale, ns, ds, prec)} ELSE {default} END "
            f"AS DECIMAL({prec},{scale}))")


def change_pct(cur: str, prev: str, s: int = 0) -> str:
    """(cur-prev)*100/prev when prev > 0 else NULL, DECIMAL(10,2); ``s`` = operand scale."""
    return ratio(f"(({cur}) - ({prev})) * 100", prev, 2, 10, ns=s, ds=s, guard=f"({prev}) > 0", default="NULL")


def xavg(expr: str, s: int, over: str = "", prec: int = 38) -> str:
    """Exact AVG of a decimal column of scale ``s`` with Spark's result scale ``s + 4``
    (Spark: avg(decimal(p,s)) -> decimal(p+4, s+4), exact HALF_UP)."""
    o = f" OVER {over}" if over else ""
    return xdiv(f"SUM({expr}){o}", f"NULLIF(COUNT({expr}){o}, 0)", s + 4, ns=s, ds=0, prec=prec)


def date_key(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


def pick(key: str, labels: list) -> str:
    items = ", ".join("NULL" if x is None else "'" + str(x) + "'" for x in labels)
    return f"([{items}])[(({key}) % {len(labels)}) + 1]"
