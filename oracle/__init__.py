"""Independent DuckDB SQL for every registered query.

Each entry is one named SELECT; a statement is built by putting the SELECTs it
mentions in front of it as common table expressions.
"""

from __future__ import annotations

import re
from datetime import date, timedelta

from oracle.base import VIEWS
from oracle.uneven import UNEVEN, UNEVEN_VIEWS


def _bodies() -> dict[str, str]:
    from oracle import cards, clusters, facts, geo, people, reports, rules, snapshots

    bodies = dict(VIEWS)
    for module in (rules, snapshots, people, clusters, reports, facts, geo, cards):
        bodies.update(module.SQL)
    uneven = _derived(bodies | UNEVEN_VIEWS)
    found = _derived(bodies)
    return found | {f"uneven_{name}": f"SELECT * FROM ({statement(name, uneven, [])})" for name in UNEVEN}


def _derived(bodies: dict[str, str]) -> dict[str, str]:
    """The bodies with those that repeat others for other dates."""
    bodies = dict(bodies)
    report = statement("par_report_from_fact", bodies, [])
    months = [_at_month(report, *m) for m in (("2000-03-31", "200003"), ("2000-04-30", "200004"), ("2000-05-31", "200005"))]
    earlier = "".join(f"\nUNION ALL SELECT 1, * FROM ({month})" for month in months)
    bodies["v_fact_reports"] = f"SELECT 1 AS run, * FROM par_report_from_fact{earlier}"
    for name, source in (("v_fact_two_months", "fact_keys"), ("v_step2_two_months", "v_step2")):
        bodies[name] = f"SELECT * FROM {source}\nUNION ALL SELECT * FROM ({_at_month(statement(source, bodies, []), '2000-05-31', '200005')})"
    snapshot = statement("as_of_snapshot", bodies, [])
    ends = [date(2000 + (n - 12) // 12, n % 12 + 1, 1) - timedelta(days=1) for n in range(7, 19)]  # twelve month ends, the last 2000-06-30
    bodies["snapshot_months"] = "\nUNION ALL ".join(f"SELECT * FROM ({snapshot.replace('2000-06-30', str(end))})" for end in ends)
    return bodies


def _at_month(sql: str, end: str, yyyymm: str) -> str:
    """A statement of the run's month as one of another month."""
    return sql.replace("2000-06-30", end).replace("200006", yyyymm).replace("2000-06-01", f"{end[:8]}01")


def _money() -> dict[str, list[str]]:
    from oracle import cards, clusters, facts, geo, people, reports, rules, snapshots

    out: dict[str, list[str]] = {}
    for module in (rules, snapshots, people, clusters, reports, facts, geo, cards):
        out.update(module.MONEY)
    return out | {f"uneven_{name}": out[name] for name in UNEVEN if name in out}


def _needs(body: str, names: set[str]) -> list[str]:
    return [w for w in dict.fromkeys(re.findall(r"[a-z_0-9]+", body)) if w in names]


def statement(name: str, bodies: dict[str, str], money: list[str]) -> str:
    order: list[str] = []
    names = set(bodies)

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in _needs(bodies[n], names - {n}):
            visit(dep)
        order.append(n)

    visit(name)
    ctes = ",\n".join(f"{n} AS (\n{bodies[n]}\n)" for n in order)
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money)
    star = f"* REPLACE ({casts})" if money else "*"
    return f"WITH {ctes}\nSELECT {star} FROM {name}"


def oracle_statements(names) -> dict[str, str]:
    bodies, money = _bodies(), _money()
    return {n: statement(n, bodies, money.get(n, [])) for n in names if n in bodies}
