"""The same results in SQL for an independent engine (DuckDB), query by query."""

from __future__ import annotations

from snapfold.functions.cleaning import WHITESPACE
from snapfold.plans import inputs
from snapfold.schemas import NA_TOKENS, SILVER_EMPLOYEES, SNAPSHOT_COLUMNS, names


def _ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# -- inputs ----------------------------------------------------------------------

RAW = f"""raw AS (
  SELECT {", ".join(f"{inputs.RAW_ROSTER[c]} AS {c}" for c in SNAPSHOT_COLUMNS)}
  FROM (
    SELECT *, cast(o_orderdate AS date) AS day, cast(floor(o_totalprice) AS bigint) AS whole
    FROM orders JOIN customer ON o_custkey = c_custkey
  )
)"""

_NA = ", ".join(f"'{t}'" for t in NA_TOKENS)

READ = f"""snapshot AS (
  SELECT {", ".join(f"CASE WHEN {c} NOT IN ({_NA}) THEN {c} END AS {c}" for c in SNAPSHOT_COLUMNS)}
  FROM raw
)"""

LIFECYCLE = """first_ship AS (
  SELECT l_orderkey, min(cast(l_shipdate AS date)) AS shipped FROM lineitem GROUP BY l_orderkey
),
dated AS (
  SELECT o_orderkey AS employee_id, o_orderpriority AS department,
         CASE o_orderstatus WHEN 'F' THEN 'Terminated' WHEN 'O' THEN 'Active' ELSE 'Leave' END
           AS status,
         cast(floor(o_totalprice) AS integer) AS salary,
         cast(o_orderdate AS date) AS ordered, shipped
  FROM orders LEFT JOIN first_ship ON o_orderkey = l_orderkey
),
life AS (
  SELECT employee_id, department, status, salary,
         CASE WHEN shipped < ordered THEN NULL ELSE ordered END AS joining_date,
         CASE WHEN shipped < ordered THEN NULL ELSE shipped END AS termination_date,
         coalesce(shipped < ordered, false)
           OR (status = 'Terminated' AND ordered IS NULL AND shipped IS NULL) AS status_flag
  FROM dated
)"""


def _snapshot(name: str, as_of: str, units: str = inputs.HUNDREDS) -> str:
    """Snapshot rows (``<name>_raw``) and typed state (``<name>``) of a day."""
    day = f"DATE '{as_of}'"
    lines = ", ".join(f"{e.format(day=day)} AS {c}" for c, e in inputs.LINES_AS_OF.items())
    rows = ", ".join(f"{e} AS {c}" for c, e in inputs.snapshot_columns(as_of, units).items())
    wiped = "termination_date < joining_date"
    return f"""{name}_raw AS (
  SELECT {rows}
  FROM orders
  LEFT JOIN (SELECT l_orderkey, {lines} FROM lineitem GROUP BY l_orderkey)
    ON o_orderkey = l_orderkey
  WHERE {inputs.known_on(as_of)}
),
{name} AS (
  SELECT employee_id, first_name, last_name, department, email, phone, status, salary,
         CASE WHEN {wiped} THEN NULL ELSE joining_date END AS joining_date,
         CASE WHEN {wiped} THEN NULL ELSE termination_date END AS termination_date,
         coalesce({wiped}, false) AS status_flag, address, {day} AS updated_at
  FROM {name}_raw
)"""


PAIR = ",\n".join((_snapshot("cur", inputs.EARLIER), _snapshot("inc", inputs.LATER)))


# -- cleaning rules --------------------------------------------------------------


def _strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def _title(t: str) -> str:
    return f"""array_to_string(list_transform(regexp_extract_all({t}, '\\p{{L}}+|\\P{{L}}+'),
      lambda p: CASE p[1] WHEN 'ß' THEN 'Ss' WHEN 'ﬁ' THEN 'Fi' ELSE upper(p[1]) END
                || lower(p[2:])), '')"""


def _email(x: str) -> str:
    mail = f"lower({_strip(x)})"
    domains = " ".join(
        f"WHEN suffix({mail}, '{d}') AND length({mail}) > {len(d)} "
        f"THEN left({mail}, length({mail}) - {len(d)}) || '@{d}'"
        for d in ("example.com", "example.net", "example.org")
    )
    return f"""CASE WHEN {mail} IN ('', 'user_no_domain') THEN NULL
      WHEN contains({mail}, '@') THEN {mail} {domains} END"""


def _digits(x: str) -> str:
    return f"nullif(regexp_replace({x}, '[^\\p{{Nd}}]', '', 'g'), '')"


def _date(x: str) -> str:
    t = _strip(x)
    return f"""CASE WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')
      THEN cast(try_strptime({t}, '%Y-%m-%d') AS date) END"""


def _address(x: str) -> str:
    line = _strip(f"replace({x}, chr(10), ' ')")
    return f"CASE WHEN lower({line}) IN ('', 'unknown') THEN NULL ELSE {line} END"


def _conformed(source: str, as_of: str) -> str:
    """Cleaned rows of a raw table, as a subquery."""
    return f"""(
  SELECT cast(employee_id AS integer) AS employee_id,
         {_title(_strip("first_name"))} AS first_name,
         {_title(_strip("last_name"))} AS last_name,
         department, {_email("email")} AS email, {_digits("phone")} AS phone, status,
         cast({_digits("salary")} AS integer) AS salary,
         CASE WHEN t < j THEN NULL ELSE j END AS joining_date,
         CASE WHEN t < j THEN NULL ELSE t END AS termination_date,
         coalesce(t < j, false) OR (status IS NOT DISTINCT FROM 'Terminated'
           AND joining_date IS NULL AND termination_date IS NULL) AS status_flag,
         {_address("address")} AS address, DATE '{as_of}' AS updated_at
  FROM (SELECT *, {_date("joining_date")} AS j, {_date("termination_date")} AS t FROM {source})
)"""


# -- change capture --------------------------------------------------------------

_COMPARED = ("first_name", "last_name", "salary", "department", "status")
_VALUES = tuple(c for c in names(SILVER_EMPLOYEES) if c not in ("employee_id", "updated_at"))


def _changes(incoming: str, current: str) -> str:
    """Action and incoming values per key, as a subquery."""
    differs = " OR ".join(f"n.{c} IS DISTINCT FROM o.{c}" for c in _COMPARED)
    return f"""(
  SELECT coalesce(n.employee_id, o.employee_id) AS employee_id,
         CASE WHEN o.employee_id IS NULL THEN 'INSERT'
              WHEN n.employee_id IS NULL THEN 'DELETE'
              WHEN {differs} THEN 'UPDATE' ELSE 'NO_CHANGE' END AS cdc_action,
         {", ".join(f"n.{c}" for c in _VALUES)}
  FROM {incoming} n FULL OUTER JOIN {current} o ON n.employee_id = o.employee_id
)"""


def _inserted(changes: str, as_of: str) -> str:
    return f"""SELECT employee_id, first_name, last_name, department, email, phone, status, salary,
       DATE '{as_of}' AS joining_date, cast(NULL AS date) AS termination_date, status_flag,
       address, DATE '{as_of}' AS updated_at
FROM {changes} WHERE cdc_action = 'INSERT'"""


def _updated(changes: str, current: str, as_of: str, salary: str = "o") -> str:
    return f"""SELECT o.employee_id, v.first_name, v.last_name, v.department, v.email, v.phone,
       v.status, {salary}.salary, o.joining_date,
       CASE WHEN v.status = 'Terminated' AND o.status <> 'Terminated' THEN DATE '{as_of}'
            WHEN v.status = 'Active' THEN NULL ELSE o.termination_date END AS termination_date,
       v.status_flag, v.address, DATE '{as_of}' AS updated_at
FROM {current} o JOIN {changes} v ON o.employee_id = v.employee_id
WHERE v.cdc_action = 'UPDATE'"""


def _applied(changes: str, current: str, as_of: str, salary: str = "o") -> str:
    """The next state, statement by statement, as a subquery."""
    kept = f"""SELECT o.* FROM {current} o
WHERE o.employee_id IN (SELECT employee_id FROM {changes} WHERE cdc_action = 'NO_CHANGE')"""
    parts = (_inserted(changes, as_of), _updated(changes, current, as_of, salary), kept)
    return "(" + "\nUNION ALL BY NAME\n".join(f"({part})" for part in parts) + ")"


def _shown_state(source: str) -> str:
    return f"""SELECT * REPLACE (cast(joining_date AS varchar) AS joining_date,
  cast(termination_date AS varchar) AS termination_date, cast(updated_at AS varchar) AS updated_at)
FROM {source}"""


CHANGES = f"changes AS {_changes('inc', 'cur')}"
APPLIED = f"applied AS {_applied('changes', 'cur', inputs.LATER)}"


# -- aggregates ------------------------------------------------------------------


def _mean(total: str, n: str, digits: int = 0) -> str:
    """total / n rounded once, half away from zero; NULL if n is 0."""
    k = 2 * 10**digits
    units = f"sign({total}) * (({k} * abs({total}) + {n}) // nullif(2 * {n}, 0))"
    return f"cast({units} AS double) / {10**digits}.0"


def _tenure(as_of: str) -> str:
    return f"""CASE WHEN status = 'Terminated' AND termination_date IS NOT NULL
      THEN termination_date - joining_date ELSE DATE '{as_of}' - joining_date END"""


def _kpi(source: str, as_of: str, total_type: str, count_type: str = "integer") -> str:
    return f"""SELECT department, cast(n AS {count_type}) AS total_employees,
       cast(n_active AS {count_type}) AS active_employees,
       {_mean("paid", "n_paid", 2)} AS avg_salary,
       cast(cost AS {total_type}) AS total_salary_cost,
       cast({_mean("days", "n_days")} AS integer) AS avg_tenure_days,
       '{as_of}' AS last_updated
FROM (
  SELECT department, count(*) AS n, count(CASE WHEN status = 'Active' THEN 1 END) AS n_active,
         cast(sum(salary) AS bigint) AS paid, count(salary) AS n_paid,
         sum(CASE WHEN status = 'Active' THEN salary ELSE 0 END) AS cost,
         cast(sum({_tenure(as_of)}) AS bigint) AS days, count(joining_date) AS n_days
  FROM {source} WHERE status_flag = false GROUP BY department
)"""


def _trends(source: str, as_of: str) -> str:
    return f"""SELECT cast(hiring_year AS integer) AS hiring_year,
       cast(total_hires AS integer) AS total_hires,
       {_mean("paid", "n_paid", 2)} AS avg_starting_salary,
       department AS most_hired_dept, '{as_of}' AS last_updated
FROM (
  SELECT coalesce(year(joining_date), -1) AS hiring_year, count(*) AS total_hires,
         cast(sum(salary) AS bigint) AS paid, count(salary) AS n_paid
  FROM {source} GROUP BY 1
)
LEFT JOIN (
  SELECT coalesce(year(joining_date), -1) AS hiring_year, department,
         row_number() OVER (PARTITION BY coalesce(year(joining_date), -1)
                            ORDER BY count(*) DESC, department) AS place
  FROM {source} WHERE department IS NOT NULL GROUP BY 1, 2
) USING (hiring_year)
WHERE coalesce(place, 1) = 1"""


# -- whole cycles: files know no empty text, and the first state is only cleaned ---


def _cycle_ctes(units: str = inputs.HUNDREDS) -> str:
    def read(name: str) -> str:
        columns = ", ".join(f"nullif(cast({c} AS varchar), '') AS {c}" for c in SNAPSHOT_COLUMNS)
        return f"(SELECT {columns} FROM {name}_raw)"

    return _ctes(
        _snapshot("cur", inputs.EARLIER, units),
        _snapshot("inc", inputs.LATER, units),
        f"first_state AS {_conformed(read('cur'), inputs.EARLIER)}",
        f"arrived AS {_conformed(read('inc'), inputs.LATER)}",
        f"arrived_changes AS {_changes('arrived', 'first_state')}",
        f"state AS {_applied('arrived_changes', 'first_state', inputs.LATER)}",
    )


_SNAPSHOT = _ctes(RAW, READ) + "SELECT * FROM snapshot"

_CLEAN_DATES = f"""{_ctes(RAW)}
SELECT employee_id, cast(CASE WHEN t < j THEN NULL ELSE j END AS varchar) AS joining_date,
       cast(CASE WHEN t < j THEN NULL ELSE t END AS varchar) AS termination_date,
       coalesce(t < j, false) OR (status IS NOT DISTINCT FROM 'Terminated'
         AND joining_date IS NULL AND termination_date IS NULL) AS status_flag
FROM (SELECT *, {_date("joining_date")} AS j, {_date("termination_date")} AS t FROM raw)"""

_ROW_TEXT = "'(' || " + " || ',' || ".join(
    f"""coalesce(CASE WHEN {c} = '' OR regexp_matches({c}, '["(),\\\\\\s\\v]')
      THEN '"' || replace(replace({c}, '\\', '\\\\'), '"', '""') || '"' ELSE {c} END, '')"""
    for c in ("first_name", "last_name", "pay", "department", "status")
) + " || ')'"

_CLASSIFIED = """SELECT * REPLACE (cast(joining_date AS varchar) AS joining_date,
  cast(termination_date AS varchar) AS termination_date)
FROM changes"""

ORACLES: dict[str, str] = {
    "csv_snapshot": _SNAPSHOT,
    "csv_snapshot_in_splits": _SNAPSHOT,
    "na_tokens": _SNAPSHOT,
    "bronze_staging": _ctes(RAW, READ)
    + "SELECT * REPLACE (cast(employee_id AS integer) AS employee_id) FROM snapshot",
    "clean_names": f"""{_ctes(RAW)}
SELECT employee_id, {_title(_strip("first_name"))} AS first_name,
       {_title(_strip("last_name"))} AS last_name FROM raw""",
    "clean_names_text": f"SELECT doc_id, {_title(_strip('text'))} AS title FROM documents",
    "clean_email": _ctes(RAW) + f"SELECT employee_id, {_email('email')} AS email FROM raw",
    "clean_email_hosts": f"""SELECT page_id, {_email("host")} AS email
FROM (SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages)""",
    "clean_phone": _ctes(RAW) + f"SELECT employee_id, {_digits('phone')} AS phone FROM raw",
    "clean_phone_text": f"SELECT doc_id, {_digits('text')} AS phone FROM documents",
    "clean_salary": _ctes(RAW)
    + f"SELECT employee_id, cast({_digits('salary')} AS integer) AS salary FROM raw",
    "clean_dates": _CLEAN_DATES,
    "clean_address": _ctes(RAW) + f"SELECT employee_id, {_address('address')} AS address FROM raw",
    "clean_address_text": f"SELECT doc_id, {_address('text')} AS address FROM documents",
    "conform": _ctes(RAW) + _shown_state(_conformed("raw", inputs.GOLD_AS_OF)),
    "key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "cdc_classify": _ctes(PAIR, CHANGES) + _CLASSIFIED,
    "cdc_counts": _ctes(PAIR, CHANGES)
    + "SELECT cdc_action, count(*) AS n_rows FROM changes GROUP BY cdc_action",
    "cdc_fingerprint": f"""{_ctes(PAIR)}
SELECT day, employee_id, {_ROW_TEXT} AS row_text, md5({_ROW_TEXT}) AS fingerprint
FROM (SELECT *, cast(salary AS varchar) AS pay, '{inputs.LATER}' AS day FROM inc
      UNION ALL BY NAME SELECT *, cast(salary AS varchar) AS pay, '{inputs.EARLIER}' AS day FROM cur)""",
    "cdc_insert": _ctes(PAIR, CHANGES)
    + _shown_state(f"({_inserted('changes', inputs.LATER)})"),
    "cdc_update": _ctes(PAIR, CHANGES)
    + _shown_state(f"({_updated('changes', 'cur', inputs.LATER)})"),
    "cdc_delete": _ctes(PAIR)
    + _shown_state("(SELECT * FROM cur WHERE employee_id IN (SELECT employee_id FROM inc))"),
    "cdc_apply": _ctes(PAIR, CHANGES, APPLIED) + _shown_state("applied"),
    "cdc_apply_converging": _ctes(PAIR, CHANGES)
    + _shown_state(_applied("changes", "cur", inputs.LATER, salary="v")),
    "cdc_redetect": _ctes(PAIR, CHANGES, APPLIED)
    + f"SELECT employee_id, cdc_action FROM {_changes('inc', 'applied')}",
    "cond_count": f"""{_ctes(LIFECYCLE)}
SELECT department, count(*) AS total_employees,
       count(*) FILTER (status = 'Active') AS active_employees
FROM life WHERE status_flag = false GROUP BY department""",
    "cond_sum": f"""{_ctes(LIFECYCLE)}
SELECT department,
       cast(sum(CASE WHEN status = 'Active' THEN salary ELSE 0 END) AS bigint)
         AS total_salary_cost
FROM life WHERE status_flag = false GROUP BY department""",
    "avg_rounded": f"""{_ctes(LIFECYCLE)}
SELECT status, {_mean("paid", "n", 2)} AS avg_salary
FROM (SELECT status, cast(sum(salary) AS bigint) AS paid, count(salary) AS n
      FROM life GROUP BY status)""",
    "avg_tenure": f"""{_ctes(LIFECYCLE)}
SELECT department, cast({_mean("days", "n")} AS integer) AS avg_tenure_days
FROM (SELECT department, cast(sum({_tenure(inputs.GOLD_AS_OF)}) AS bigint) AS days,
             count(joining_date) AS n
      FROM life WHERE status_flag = false GROUP BY department)""",
    "mode_by_year": f"""{_ctes(LIFECYCLE)}
SELECT hiring_year, most_hired_dept FROM ({_trends("life", inputs.GOLD_AS_OF)})""",
    "department_kpi": _ctes(LIFECYCLE) + _kpi("life", inputs.GOLD_AS_OF, "bigint"),
    "hiring_trends": _ctes(LIFECYCLE) + _trends("life", inputs.GOLD_AS_OF),
    "gold_after_cdc": _ctes(PAIR, CHANGES, APPLIED) + _kpi("applied", inputs.LATER, "integer"),
    "gold_incremental": _ctes(PAIR, CHANGES, APPLIED) + _kpi("applied", inputs.LATER, "bigint"),
    "trends_incremental": _ctes(PAIR, CHANGES, APPLIED) + _trends("applied", inputs.LATER),
    "initial_silver": _ctes(RAW, READ) + _shown_state(_conformed("snapshot", inputs.GOLD_AS_OF)),
    "cycle_silver": _cycle_ctes() + _shown_state("state"),
    "cycle_department_kpi": _cycle_ctes() + _kpi("state", inputs.LATER, "integer"),
    "cycle_wide_kpi": _cycle_ctes(inputs.CENTS) + _kpi("state", inputs.LATER, "bigint", "bigint"),
    "cycle_hiring_trends": _cycle_ctes() + _trends("state", inputs.LATER),
}
