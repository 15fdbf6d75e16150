"""SQL fragments for the DuckDB side of the checks."""

from __future__ import annotations

from collections.abc import Sequence

from workload.views import duck

CATALOG: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the equivalent statement on the given tables."""

    def add(fn):
        CATALOG[name] = (fn, sql)
        return fn

    return add


def using(*views: str, ctes: str = "") -> str:
    return "with " + duck(*views) + (",\n" + ctes if ctes else "") + "\n"


def sep(a1: str, d1: str, a2: str, d2: str, decimals: int = 6) -> str:
    """Separation in arcsec."""
    return (
        f"round(2*asin(least(1e0,sqrt(pow(sin(radians(({d2})-({d1}))/2),2)"
        f"+cos(radians({d1}))*cos(radians({d2}))*pow(sin(radians(({a2})-({a1}))/2),2))))*206264.80624709636,{decimals})"
    )


def match(
    name: str, left: str, right: str, radius: float, rid: str, rcols: Sequence[str] = (), lid: str = "number",
    lpos: tuple[str, str] = ("alpha_j2000", "delta_j2000"), rpos: tuple[str, str] = ("raj2000", "dej2000"),
    keys: Sequence[str] = (), strict: str = "<", hidden: str = "rn, raw",
) -> str:
    """CTE: nearest right row within ``radius`` arcsec, ties to the smaller id (fields near declination -30)."""
    pad = radius / 3600 * 1.001 + 1e-9
    a, d = (f"l.{c}" for c in lpos)
    b, e = (f"r.{c}" for c in rpos)
    on = "".join(f"l.{k}=r.{k} and " for k in keys)
    cols = "".join(f", r.{c} as {c if c.startswith('ref_') else 'ref_' + c}" for c in rcols)
    out = rid if rid.startswith("ref_") else "ref_" + rid
    return f"""{name} as materialized (
 select * exclude ({hidden}) from (
  select *, row_number() over (partition by {lid} order by sep, {out}) as rn from (
   select l.*, r.{rid} as {out}{cols}, {sep(a, d, b, e)} as sep, {sep(a, d, b, e, 9)} as raw
   from {left} l join {right} r on {on}{e} between {d}-{pad} and {d}+{pad}
    and {b} between {a}-{pad * 1.3} and {a}+{pad * 1.3}) where raw {strict} {radius}) where rn=1)"""


def clip(name: str, source: str, keys: Sequence[str], col: str, sigma: float, passes: int = 25) -> str:
    """CTE chain: rows of ``source`` with ``v``, after ``passes`` clipping passes in ``name``."""
    k = ",".join(keys)
    on = f"using ({k})" if keys else "on true"
    group = f"group by {k}" if keys else ""
    head = (k + ",") if keys else ""
    steps = [f"{name}_0 as materialized (select *, cast({col} as double) as v from {source} where {col} is not null)"]
    for i in range(1, passes + 1):
        steps.append(
            f"{name}_b{i} as materialized (select {head} median(v) as m, stddev_pop(v) as s from {name}_{i - 1} {group})"
        )
        steps.append(
            f"{name}_{i} as materialized (select c.* from {name}_{i - 1} c join {name}_b{i} {on} where abs(v-m)<={sigma}*s)"
        )
    steps.append(f"{name} as materialized (select * from {name}_{passes})")
    return ",\n".join(steps)


ZONE = 0.4 / 3600
