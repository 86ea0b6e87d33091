"""Pieces of DuckDB SQL shared by the oracle queries."""

from rosterloom.plans import PEOPLE_CONTRACT

#: orders with the order date and its month
ORDERS = (
    "o AS (SELECT *, o_orderdate::DATE AS d, date_trunc('month', o_orderdate)::DATE AS m FROM orders)"
)
_TYPES = {
    "text": "VARCHAR",
    "integer": "BIGINT",
    "decimal": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def months(start: str, end: str) -> str:
    """Complete months between two dates."""
    return (
        f"((year({end}) - year({start})) * 12 + month({end}) - month({start})"
        f" - CASE WHEN day({end}) < day({start}) THEN 1 ELSE 0 END)::BIGINT"
    )


def contract_columns(known: dict[str, str] | tuple[str, ...], published: bool = False) -> str:
    """Select list of the whole contract: the known columns, typed nulls for the others."""
    if isinstance(known, tuple):
        known = {k: k for k in known}
    return ", ".join(
        f"({known.get(c.name, 'NULL')})::{_TYPES[c.kind]}"
        f' AS "{c.published_name if published else c.name}"'
        for c in PEOPLE_CONTRACT.columns
    )


def _snapshot(with_files: bool) -> str:
    newest = "WHERE monthly = newest" if with_files else ""
    return f"""
    s0 AS (SELECT m AS period, o_custkey::VARCHAR AS person_id, 'Pessoa ' || o_custkey AS full_name,
        lpad((o_custkey * 7919)::VARCHAR, 11, '0') AS tax_id,
        (DATE '1990-01-01' + (o_custkey % 1500)::INTEGER)::DATE AS hire_date,
        'CC' || (o_custkey % 50) AS cost_center, o_orderstatus AS status,
        o_orderpriority AS job_title,
        CASE WHEN o_orderkey % 5 <> 0 THEN 'Gestor ' || (o_orderkey % 7) END AS manager,
        o_orderkey % 2 = 0 AS monthly, max(o_orderkey % 2 = 0) OVER (PARTITION BY m) AS newest
      FROM o),
    s1 AS (SELECT *, row_number() OVER (PARTITION BY period, person_id
        ORDER BY job_title DESC NULLS LAST, manager DESC NULLS LAST, status DESC NULLS LAST) AS rn
      FROM s0 {newest}),
    snap AS (SELECT period, person_id, full_name, tax_id, hire_date, cost_center, status, job_title,
        manager, strftime(period, '%d/%m/%Y') || '_' || person_id AS month_key,
        {months("hire_date", "last_day(period)")} AS tenure_months
      FROM s1 WHERE rn = 1)"""


def people(with_files: bool = True) -> str:
    """CTEs snap, hire, leave, move, terc and budg: the six flows in contract names."""
    return f"""{ORDERS}, {_snapshot(with_files)},
    h0 AS (SELECT o_custkey::VARCHAR AS person_id, min(d) AS hire_date,
        date_trunc('month', min(d))::DATE AS period,
        CASE WHEN o_custkey % 3 <> 0 THEN 'Nome ' || o_custkey END AS full_name,
        CASE WHEN o_custkey % 7 <> 0 THEN 'CC' || (o_custkey % 50) END AS cost_center
      FROM o GROUP BY o_custkey),
    hire AS (SELECT h.period, h.person_id, h.hire_date,
        strftime(h.period, '%d/%m/%Y') || '_' || h.person_id AS month_key,
        coalesce(h.full_name, s.full_name) AS full_name,
        coalesce(h.cost_center, s.cost_center) AS cost_center,
        s.tax_id, s.status, s.job_title, s.manager, s.person_id IS NOT NULL AS found
      FROM h0 h LEFT JOIN snap s ON s.person_id = h.person_id AND s.period = h.period),
    l0 AS (SELECT o_custkey::VARCHAR AS person_id, (max(d) + INTERVAL 1 MONTH)::DATE AS leave_date,
        date_trunc('month', max(d) + INTERVAL 1 MONTH)::DATE AS period,
        date_trunc('month', max(d))::DATE AS prev_period
      FROM o GROUP BY o_custkey),
    leave AS (SELECT l.period, l.person_id, l.leave_date, 'Pedido' AS leave_type,
        strftime(l.period, '%d/%m/%Y') || '_' || l.person_id AS month_key,
        strftime(l.prev_period, '%d/%m/%Y') || '_' || l.person_id AS prev_month_key,
        s.full_name, s.cost_center, s.tax_id, s.status, s.job_title, s.manager, s.hire_date,
        {months("s.hire_date", "l.leave_date")} AS tenure_months, s.person_id IS NOT NULL AS found
      FROM l0 l LEFT JOIN snap s ON s.person_id = l.person_id AND s.period = l.prev_period),
    m0 AS (SELECT l_suppkey::VARCHAR AS person_id, l_shipdate::DATE AS movement_date,
        date_trunc('month', l_shipdate)::DATE AS period, l_returnflag AS movement_type,
        CASE WHEN l_linenumber <> 1 THEN 'CC' || l_linenumber END AS cost_center,
        'CC' || l_linestatus AS prev_cost_center
      FROM lineitem),
    move AS (SELECT v.period, v.person_id, v.movement_date, v.movement_type, v.prev_cost_center,
        strftime(v.period, '%d/%m/%Y') || '_' || v.person_id AS month_key,
        coalesce(v.cost_center, s.cost_center) AS cost_center, s.full_name, s.tax_id, s.status,
        s.job_title, s.manager, s.hire_date, s.person_id IS NOT NULL AS found
      FROM m0 v LEFT JOIN snap s ON s.person_id = v.person_id AND s.period = v.period),
    terc AS (SELECT DATE '2002-03-01' AS period, lpad((s_suppkey * 104729)::VARCHAR, 11, '0') AS tax_id,
        s_name AS full_name, 'Fornecedor ' || s_nationkey AS supplier,
        CASE s_nationkey % 4 WHEN 0 THEN 'QUADRO-TERCEIROS' WHEN 1 THEN 'ADMITIDOS-TERCEIROS'
          WHEN 2 THEN 'DEMITIDOS-TERCEIROS' END AS label
      FROM supplier),
    budg AS (SELECT (DATE '2002-01-01' + INTERVAL (p_partkey % 12) MONTH)::DATE AS period,
        'V' || p_partkey AS slot_id, 'CC' || p_size AS cost_center
      FROM part)"""


#: Columns each flow fills.
FILLED = {
    "snap": (
        "period", "person_id", "month_key", "full_name", "tax_id", "cost_center", "job_title",
        "manager", "status", "hire_date", "tenure_months",
    ),
    "hire": (
        "period", "person_id", "month_key", "full_name", "tax_id", "cost_center", "job_title",
        "manager", "status", "hire_date",
    ),
    "leave": (
        "period", "person_id", "month_key", "prev_month_key", "full_name", "tax_id",
        "cost_center", "job_title", "manager", "status", "hire_date", "leave_date", "leave_type",
        "tenure_months",
    ),
    "move": (
        "period", "person_id", "month_key", "full_name", "tax_id", "cost_center", "job_title",
        "manager", "status", "hire_date", "movement_date", "movement_type", "prev_cost_center",
    ),
    "terc": ("period", "full_name", "tax_id", "supplier"),
    "budg": ("period", "slot_id", "cost_center"),
}
LABEL_OF = {
    "snap": "'QUADRO'",
    "hire": "'ADMITIDOS'",
    "leave": "'DEMITIDOS'",
    "move": "'MOVIMENTACOES'",
    "terc": "label",
    "budg": "'ORCADO'",
}


_MARKS = {
    **dict.fromkeys(("hire", "leave", "move"), ', found AS "_found_in_reference"'),
    "terc": ', label AS "_row_label"',
}


def flow(name: str) -> str:
    """One flow in contract order, with its marks."""
    return f"WITH {people()} SELECT {contract_columns(FILLED[name])}{_MARKS.get(name, '')} FROM {name}"


def stacked(with_files: bool = True, published: bool = False) -> str:
    """All flows with their labels."""
    parts = [
        f'SELECT {label} AS "BASE", {contract_columns(FILLED[name], published)} FROM {name}'
        for name, label in LABEL_OF.items()
    ]
    return f"WITH {people(with_files)} " + " UNION ALL ".join(parts)


def report(flows: dict[str, str]) -> str:
    """Outcomes of all rules of an unforced first run over all flows."""
    passed = [(rule, flow) for flow in flows for rule in ("no_rows", "required")]
    passed += [("unique_key", flow) for flow in flows if flow not in ("movements", "contractors")]
    passed += [
        ("unique_key", f"contractors/{label}-TERCEIROS") for label in ("QUADRO", "ADMITIDOS", "DEMITIDOS")
    ]
    passed += [("budget_periods", "budget"), ("output_contract", "consolidated")]
    fine = ", ".join(f"('{rule}', '{scope}')" for rule, scope in passed)
    return f"""WITH {people(with_files=False)},
    event AS (
      SELECT 'hires' AS scope, found, EXISTS (SELECT 1 FROM leave
        WHERE leave.person_id = hire.person_id AND leave.period = hire.period) AS excluded FROM hire
      UNION ALL SELECT 'leavers', found, coalesce(date_trunc('month', hire_date) = period, FALSE)
        OR EXISTS (SELECT 1 FROM hire WHERE hire.person_id = leave.person_id
          AND hire.period = leave.period) FROM leave
      UNION ALL SELECT 'movements', found, FALSE FROM move),
    covered AS (SELECT scope, count(*) AS n, count(*) FILTER (NOT found) AS lost
      FROM event WHERE NOT excluded GROUP BY scope),
    heads AS (SELECT period, count(DISTINCT person_id) AS headcount FROM snap GROUP BY period),
    came AS (SELECT period, count(DISTINCT person_id) AS n FROM hire GROUP BY period),
    went AS (SELECT period, count(DISTINCT person_id) AS n FROM leave GROUP BY period),
    step AS (SELECT headcount, lag(headcount) OVER (ORDER BY period) + coalesce(came.n, 0)
        - coalesce(went.n, 0) AS expected
      FROM heads LEFT JOIN came USING (period) LEFT JOIN went USING (period)),
    off AS (SELECT count(*) FILTER (headcount <> expected) AS n FROM step)
    SELECT *, FALSE AS published FROM (
      SELECT rule, scope, 'OK' AS severity, 0::BIGINT AS occurrences
        FROM (VALUES {fine}) AS fine(rule, scope)
      UNION ALL SELECT 'unclassified', 'contractors', 'ERROR', count(*) FROM terc WHERE label IS NULL
      UNION ALL SELECT 'reference_coverage', scope,
        CASE WHEN (n - lost) / n::DOUBLE >= 0.95 THEN 'OK' ELSE 'WARN' END, lost FROM covered
      UNION ALL SELECT 'reconciliation', 'consolidated', CASE WHEN n = 0 THEN 'OK' ELSE 'WARN' END, n FROM off
      UNION ALL SELECT 'volume_change', 'consolidated', 'INFO', 0)"""
