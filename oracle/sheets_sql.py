"""Reference sheets as SQL: rule CASE, block-list test, tax and zone VALUES.

The fixed sheet values come from ``retentio.sources.lookups``; the SQL that
applies them is written here independently.
"""

from __future__ import annotations

from retentio.sources import lookups as L


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rules():
    per: dict[str, dict[str, str]] = {}
    for f, s, v in L.RULES_FIXTURE:
        per.setdefault(f, {})[s] = v  # dict semantics: first position, last value
    return per


def classify_sql(expr: str, filt: str, benefit: str | None = None) -> str:
    rules = _rules().get(filt)
    if not rules:
        return "'No Existe Filtro'"
    name = f"coalesce(CAST({expr} AS VARCHAR), 'None')"
    whens = []
    for s, v in rules.items():
        cond = "TRUE" if s == "" else f"strpos({name}, {q(s)}) > 0"
        whens.append(f"WHEN {cond} THEN {q(v)}")
    last = list(rules.values())[-1]
    case = f"(CASE {' '.join(whens)} ELSE {q(last)} END)"
    if benefit:
        case = f"(CASE WHEN {benefit} = 'WALLET' THEN 'WALLET' ELSE {case} END)"
    return case


def blocked_sql(expr: str) -> str:
    toks = [t.upper() for t in L.BLOCK_FIXTURE]
    ors = " OR ".join(f"strpos({expr}, {q(t)}) > 0" for t in toks)
    return f"(CASE WHEN {ors} THEN 'Si' ELSE 'No' END)"


def not_like_sql(expr: str) -> str:
    return " AND ".join(f"upper({expr}) NOT LIKE {q(p)}" for p in L.EXCLUDE_LIKE_FIXTURE)


def tax_cte() -> str:
    vals = ", ".join(f"({q(c)}, {q(i)}, {q(e)})" for c, i, e in L.TAX_FIXTURE)
    ren = ", ".join(f"({q(a)}, {q(b)})" for a, b in L.COUNTRY_RENAME_FIXTURE)
    return f"""
        SELECT coalesce(r.dst, upper(t.c)) AS Country,
               CAST(CASE WHEN trim(t.i) = '' THEN '0' ELSE t.i END AS DOUBLE) AS IVA,
               CAST(CASE WHEN trim(t.e) = '' THEN '0' ELSE t.e END AS DOUBLE) AS Extra
        FROM (VALUES {vals}) AS t(c, i, e)
        LEFT JOIN (VALUES {ren}) AS r(src, dst) ON r.src = upper(t.c)"""


def zones_cte() -> str:
    vals = ", ".join(f"({q(a)}, {q(b)}, {q(c)}, {q(d)})" for a, b, c, d in L.ZONES_FIXTURE)
    return f"SELECT * FROM (VALUES {vals}) AS z(Country, Tipo, \"Union\", Competencia)"
