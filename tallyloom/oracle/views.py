"""The test views as DuckDB text, and helpers to put them in front of a statement."""

from __future__ import annotations

import re

VIEWS = {
    "countries": "SELECT n_nationkey AS id, n_name AS name FROM nation",
    "conferences": """SELECT p_partkey AS id, CASE p_partkey WHEN 3 THEN NULL WHEN 4 THEN 'Joint Meeting' WHEN 6 THEN 'JOINT Mééting'
  WHEN 8 THEN 'joint meeting' ELSE p_name END AS name FROM part""",
    "users": """SELECT c_custkey AS id,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE substr(c_name,1,8) END AS first_name,
  substr(c_name,10) AS last_name,
  CASE WHEN c_custkey % 7 = 0 THEN concat('  ', upper(replace(c_name,'#','.')), '@EX.ORG ')
       ELSE concat(lower(replace(c_name,'#','.')), '@ex.org') END AS email,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '   '
       ELSE concat(c_mktsegment, ' Lab ', CAST(c_custkey % 40 AS VARCHAR(10))) END AS affiliation,
  CASE WHEN c_custkey % 5 = 0 THEN NULL
       ELSE DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INT) END AS date_of_birth,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_nationkey END AS country_id,
  DATE '1995-01-01' + CAST((c_custkey * 13) % 2400 AS INT) AS created_at
FROM customer""",
    "abstract_submissions": """SELECT o_orderkey AS id, o_custkey AS user_id,
  CASE WHEN o_orderkey % 12 >= 10 THEN -(o_orderkey % 12) ELSE o_orderkey % 12 END AS event_id,
  CAST(o_orderdate AS DATE) AS statusdate, CAST(o_orderdate AS DATE) AS created_at
FROM orders""",
    "registrations": """SELECT o_orderkey AS id, o_custkey AS user_id,
  CASE WHEN k >= 10 THEN -k ELSE k END AS event_id,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS total_price,
  CASE WHEN o_orderkey % 4 = 0 THEN 'USD' ELSE 'EUR' END AS currency_type,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS status,
  CAST(o_orderkey % 2 AS INT) AS sendinvoice,
  CAST(o_orderdate AS DATE) AS created_at,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INT) AS updated_at
FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey + 1) % 12 ELSE o_orderkey % 12 END AS k FROM orders)""",
    "mailers": """SELECT e.event_id AS id, e.event_id % 6 AS mailer_no,
  concat(' Dr <', trim(u.email), '> ') AS to_address, u.last_name AS p1,
  CASE WHEN e.event_id % 4 = 0 THEN '  ' ELSE u.affiliation END AS p2, e.props AS p3,
  CASE WHEN e.event_id % 9 = 0 THEN '' WHEN e.event_id % 10 = 1 THEN upper(e.event_type) ELSE e.event_type END AS p4,
  CASE WHEN e.event_id % 5 = 0 THEN ' ' ELSE concat('batch ', CAST(e.event_id % 7 AS VARCHAR)) END AS p5,
  e.event_type AS subject, concat('template_', e.event_type) AS template_name,
  CASE WHEN e.event_id % 3 = 0 THEN NULL ELSE e.ts - INTERVAL 9000 DAY END AS date_sent,
  e.ts - INTERVAL 9001 DAY AS date_added
FROM events e JOIN users u ON u.id = e.user_id""",
    "yes_no_form": """SELECT e.event_id AS id,
  CASE WHEN e.event_id % 8 = 0 THEN 'no-address'
       ELSE concat('Dr ', u.last_name, ' <', trim(u.email), '>') END AS email,
  CASE e.event_type WHEN 'signup' THEN ' YES ' WHEN 'click' THEN 'yes'
       WHEN 'error' THEN 'No' ELSE 'maybe' END AS response,
  CASE WHEN e.event_id % 6 = 0 THEN '  ' ELSE u.last_name END AS full_name,
  e.ts - INTERVAL 9000 DAY AS created_at
FROM events e JOIN users u ON u.id = e.user_id""",
    "stg_awards": """SELECT o.o_orderkey AS id, CAST(o.o_orderkey % 1000 AS INT) AS s_no,
  concat('A', CAST(o.o_orderkey % 9 AS VARCHAR(10)), ' AMC') AS assembly_number,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE CAST(year(o.o_orderdate) AS INT) END AS award_year,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'Prof.' ELSE 'Dr.' END AS title,
  CASE WHEN o.o_orderkey % 41 = 0 THEN '  ' WHEN o.o_orderkey % 10 = 3 THEN upper(c.c_name) ELSE c.c_name END AS name,
  CASE WHEN c.c_custkey % 5 = 0 THEN NULL WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE WHEN o.o_orderkey % 10 = 7 THEN upper(u.affiliation) ELSE u.affiliation END AS affiliation,
  CASE WHEN o.o_orderkey % 43 = 0 THEN ' ' WHEN c.c_custkey % 4 = 0 THEN concat(lower(n.n_name), '  ') ELSE n.n_name END AS country,
  CASE WHEN o.o_orderkey % 31 = 0 THEN NULL WHEN c.c_custkey % 6 = 0 THEN NULL
       WHEN c.c_custkey % 10 = 1 THEN 'n/a' ELSE u.email END AS email,
  CASE WHEN o.o_orderstatus = 'P' THEN ' ' ELSE concat(o.o_orderstatus, ' talk') END AS presentation_type,
  CASE WHEN o.o_orderkey % 29 = 0 THEN NULL ELSE concat(' ', o.o_orderpriority, ' ') END AS award_certificate_type,
  concat('C', CAST(o.o_orderkey AS VARCHAR(20))) AS certificate_number,
  concat(' Session ', CAST(o.o_orderkey % 4 AS VARCHAR)) AS session,
  CASE WHEN o.o_orderkey % 6 = 0 THEN '' WHEN o.o_orderkey % 10 = 1 THEN lower(c.c_mktsegment)
       ELSE c.c_mktsegment END AS session_topic,
  concat('On ', c.c_mktsegment) AS paper_title
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN users u ON u.id = c.c_custkey""",
}


def statement(body: str, steps: dict[str, str] | None = None) -> str:
    """``body`` with the views and steps it names, directly or through others, as CTEs in front.

    ``steps`` are further named selects; they may build on the views and on earlier steps.
    """
    known = {**VIEWS, **(steps or {})}
    used: set[str] = set()

    def mark(text: str) -> None:
        for name in known:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                mark(known[name])

    mark(body)
    parts = [f"{name} AS (\n{known[name].strip()}\n)" for name in known if name in used]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


def pct(part: str, whole: str) -> str:
    """``100 * part / whole``, half up to two places, in whole numbers; NULL over zero."""
    return (f"CAST((20000 * CAST({part} AS HUGEINT) + ({whole})) // nullif(2 * ({whole}), 0) AS DOUBLE) / 100.0")


def avg2(total: str, count: str) -> str:
    """Mean of money, half up to two places, computed in cents."""
    return (f"CAST(CAST((2 * CAST(({total}) * 100 AS HUGEINT) + ({count})) // nullif(2 * ({count}), 0) AS DOUBLE)"
            " / 100.0 AS DECIMAL(18,2))")


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def instant(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
