"""DuckDB statements for the conversion reports and insight tables."""

from __future__ import annotations

from tallyloom.oracle.views import avg2, day, pct, statement

_MONEY_ZERO = "CAST(0 AS DECIMAL(18,2))"


def _steps(start: str, end: str) -> dict[str, str]:
    return {
        "subs": f"""SELECT user_id, event_id FROM abstract_submissions
WHERE statusdate >= DATE '{start}' AND statusdate < DATE '{end}' GROUP BY ALL""",
        "paid": """SELECT r.user_id, r.event_id, r.total_price FROM registrations r
WHERE r.status = 1 AND r.currency_type = 'EUR' AND r.total_price IS NOT NULL
  AND EXISTS (SELECT 1 FROM subs s WHERE s.user_id = r.user_id AND s.event_id = r.event_id)""",
        "home": """SELECT u.id AS user_id, coalesce(c.name, 'Unknown') AS country_name, u.affiliation,
  coalesce(nullif(trim(u.affiliation), ''), 'Unknown') AS known_affiliation
FROM users u LEFT JOIN countries c ON c.id = u.country_id""",
        "titled": "SELECT id AS event_id, coalesce(name, 'Event#' || id) AS event_name FROM conferences",
        "spent": "SELECT user_id, count(*) AS n, sum(total_price) AS total FROM paid GROUP BY user_id",
    }


def _age(end: str) -> str:
    return (f"CAST(year(DATE '{end}') - year(u.date_of_birth) - CASE WHEN (month(DATE '{end}'), day(DATE '{end}')) "
            "< (month(u.date_of_birth), day(u.date_of_birth)) THEN 1 ELSE 0 END AS BIGINT)")


def _person(end: str) -> str:
    return (f"u.id AS user_id, concat_ws(' ', u.first_name, u.last_name) AS name, u.email, u.affiliation, "
            f"{_age(end)} AS age_as_of_end")


def _money(rows: str = "p.total_price") -> str:
    """Revenue and mean of a possibly empty group."""
    return (f"CAST(coalesce(sum({rows}), 0) AS DOUBLE) AS revenue_EUR, "
            f"CAST(coalesce({avg2(f'sum({rows})', f'count({rows})')}, {_MONEY_ZERO}) AS DOUBLE) AS avg_ticket_EUR")


def reports(start: str, end: str, invoices: tuple[str, str]) -> dict[str, str]:
    steps = _steps(start, end)
    within = f">= DATE '{start}' AND {{0}} < DATE '{end}'"

    def inside(column: str) -> str:
        return f"{column} {within.format(column)}"

    site = "h.affiliation, h.country_name"
    site_totals = f"""SELECT {site}, count(DISTINCT p.user_id) AS paid_users_total,
  CAST(sum(p.total_price) AS DOUBLE) AS revenue_total_EUR,
  CAST({avg2('sum(p.total_price)', 'count(*)')} AS DOUBLE) AS avg_ticket_total_EUR
FROM paid p JOIN home h USING (user_id) GROUP BY ALL"""
    site_events = f"""SELECT {site}, e.id AS event_id, e.name AS event_name,
  count(DISTINCT p.user_id) AS paid_users, {_money()}
FROM paid p JOIN home h USING (user_id) JOIN conferences e ON e.id = p.event_id GROUP BY ALL"""
    whole_country = f"""SELECT h.country_name, count(DISTINCT p.user_id) AS paid_users_country,
  CAST(sum(p.total_price) AS DOUBLE) AS revenue_country_EUR,
  CAST({avg2('sum(p.total_price)', 'count(*)')} AS DOUBLE) AS avg_ticket_country_EUR
FROM paid p JOIN home h USING (user_id) GROUP BY ALL"""
    rolled = {**steps, "site_totals": site_totals, "site_events": site_events, "whole_country": whole_country}

    def names(pairs: str, flag: str) -> str:
        return f"""SELECT user_id, string_agg(event_name, ',' ORDER BY first_id) AS {flag}_event_names FROM (
  SELECT x.user_id, min(t.event_name) AS event_name, min(t.event_id) AS first_id
  FROM {pairs} x JOIN titled t USING (event_id) GROUP BY x.user_id, lower(strip_accents(t.event_name))) GROUP BY user_id"""

    def ids(pairs: str, flag: str) -> str:
        return f"""SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS {flag}_event_ids
FROM (SELECT DISTINCT user_id, event_id FROM {pairs}) GROUP BY user_id"""

    queries = {
        "mkt_submission_rate": f"""
SELECT n_users AS total_users_in_window, n_subs AS users_who_submitted_in_window,
  n_abs AS total_abstracts_in_window, {pct('n_subs', 'n_users')} AS user_submission_rate_percent
FROM (SELECT (SELECT count(*) FROM users WHERE {inside('created_at')}) AS n_users,
  (SELECT count(DISTINCT user_id) FROM abstract_submissions WHERE {inside('statusdate')}) AS n_subs,
  (SELECT count(*) FROM abstract_submissions WHERE {inside('statusdate')}) AS n_abs)""",
        "mkt_submitter_detail": f"""
SELECT {_person(end)}, {day('u.created_at')} AS created_at,
  w.n AS abstracts_in_window, e.n AS total_abstracts_all_time,
  {day('w.lo')} AS first_submission, {day('w.hi')} AS last_submission,
  {day('e.lo')} AS first_submission_ever, {day('e.hi')} AS last_submission_ever
FROM users u
JOIN (SELECT user_id, count(*) n, min(statusdate) lo, max(statusdate) hi FROM abstract_submissions
      WHERE {inside('statusdate')} GROUP BY 1) w ON w.user_id = u.id
LEFT JOIN (SELECT user_id, count(*) n, min(statusdate) lo, max(statusdate) hi FROM abstract_submissions GROUP BY 1) e
  ON e.user_id = u.id
WHERE {inside('u.created_at')}""",
        "mkt_conversion": f"""
SELECT s AS submitter_users, p AS paid_users, {pct('p', 's')} AS submitter_to_paid_rate_pct,
  CAST(coalesce(r, 0) AS DOUBLE) AS "total_revenue_EUR"
FROM (SELECT (SELECT count(DISTINCT user_id) FROM subs) AS s, (SELECT count(DISTINCT user_id) FROM paid) AS p,
  (SELECT sum(total_price) FROM paid) AS r)""",
        "mkt_paid_unpaid": f"""
SELECT {_person(end)}, coalesce(m.n, 0) AS paid_registrations, CAST(coalesce(m.total, 0) AS DOUBLE) AS eur_revenue,
  CAST(m.user_id IS NOT NULL AS BIGINT) AS is_paid
FROM users u JOIN (SELECT DISTINCT user_id FROM subs) s ON s.user_id = u.id LEFT JOIN spent m ON m.user_id = u.id""",
        "mkt_paid_users": f"""
SELECT {_person(end)}, m.n AS paid_registrations, CAST(m.total AS DOUBLE) AS eur_revenue
FROM spent m JOIN users u ON u.id = m.user_id""",
        "mkt_unpaid_invoices": f"""
SELECT r.id AS registration_id, r.user_id, concat_ws(' ', u.first_name, u.last_name) AS name, u.email, u.affiliation,
  r.event_id, CAST(r.total_price AS DOUBLE) AS total_price, r.currency_type, CAST(r.sendinvoice AS BIGINT) AS sendinvoice,
  CAST(r.status AS BIGINT) AS status, {day('r.created_at')} AS created_at, {day('r.updated_at')} AS updated_at
FROM registrations r JOIN users u ON u.id = r.user_id
JOIN (SELECT DISTINCT user_id, event_id FROM abstract_submissions
      WHERE statusdate >= DATE '{invoices[0]}' AND statusdate < DATE '{invoices[1]}') s
  ON s.user_id = r.user_id AND s.event_id = r.event_id
WHERE r.sendinvoice = 1 AND r.status = 0""",
        "mkt_paid_unpaid_events": f"""
SELECT {_person(end)}, c.name AS country, coalesce(m.n, 0) AS paid_registrations,
  CAST(coalesce(m.total, 0) AS DOUBLE) AS eur_revenue, CAST(m.user_id IS NOT NULL AS BIGINT) AS is_paid,
  si.submitted_event_ids, sn.submitted_event_names, pi.paid_event_ids, pn.paid_event_names
FROM users u JOIN (SELECT DISTINCT user_id FROM subs) s ON s.user_id = u.id
LEFT JOIN countries c ON c.id = u.country_id
LEFT JOIN spent m ON m.user_id = u.id
LEFT JOIN ({ids('subs', 'submitted')}) si ON si.user_id = u.id
LEFT JOIN ({names('subs', 'submitted')}) sn ON sn.user_id = u.id
LEFT JOIN ({ids('paid', 'paid')}) pi ON pi.user_id = u.id
LEFT JOIN ({names('paid', 'paid')}) pn ON pn.user_id = u.id""",
        "mkt_country_conversion": f"""
SELECT h.country_name, count(DISTINCT s.user_id) AS submitter_users, count(DISTINCT p.user_id) AS paid_users,
  {pct('count(DISTINCT p.user_id)', 'count(DISTINCT s.user_id)')} AS conversion_pct, {_money()}
FROM home h LEFT JOIN (SELECT DISTINCT user_id FROM subs) s USING (user_id) LEFT JOIN paid p USING (user_id)
GROUP BY h.country_name HAVING count(DISTINCT s.user_id) > 0""",
        "mkt_country_event": f"""
SELECT h.country_name, e.id AS event_id, e.name AS event_name, count(DISTINCT s.user_id) AS submitter_users,
  count(DISTINCT p.user_id) AS paid_users,
  {pct('count(DISTINCT p.user_id)', 'count(DISTINCT s.user_id)')} AS conversion_pct, {_money()}
FROM subs s JOIN home h USING (user_id) JOIN conferences e ON e.id = s.event_id
LEFT JOIN paid p ON p.user_id = s.user_id AND p.event_id = s.event_id
GROUP BY ALL HAVING count(DISTINCT s.user_id) > 0""",
        "mkt_affiliation": f"""
SELECT {site}, count(DISTINCT p.user_id) AS paid_users, CAST(sum(p.total_price) AS DOUBLE) AS "revenue_EUR"
FROM paid p JOIN home h USING (user_id) GROUP BY ALL""",
        "mkt_affiliation_event": "SELECT * FROM site_events",
        "mkt_affiliation_rollup2": """
SELECT d.*, t.paid_users_total, t.revenue_total_EUR, t.avg_ticket_total_EUR
FROM site_events d JOIN site_totals t ON t.affiliation = d.affiliation AND t.country_name = d.country_name""",
        "mkt_rollup3": """
SELECT d.*, t.paid_users_total, t.revenue_total_EUR, t.avg_ticket_total_EUR,
  c.paid_users_country, c.revenue_country_EUR, c.avg_ticket_country_EUR
FROM site_events d JOIN site_totals t ON t.affiliation = d.affiliation AND t.country_name = d.country_name
JOIN whole_country c ON c.country_name = d.country_name""",
        "mkt_grand_total": f"""
SELECT 'ALL COUNTRIES' AS country_name, s AS submitter_users, n AS paid_users, {pct('n', 's')} AS conversion_pct,
  CAST(r AS DOUBLE) AS "revenue_EUR", CAST({avg2('r', 'k')} AS DOUBLE) AS "avg_ticket_EUR"
FROM (SELECT count(DISTINCT user_id) AS s FROM subs)
CROSS JOIN (SELECT count(DISTINCT user_id) AS n, sum(total_price) AS r, count(*) AS k FROM paid)
UNION ALL
SELECT h.country_name, count(DISTINCT s.user_id), count(DISTINCT p.user_id),
  {pct('count(DISTINCT p.user_id)', 'count(DISTINCT s.user_id)')}, {_money()}
FROM (SELECT DISTINCT user_id FROM subs) s JOIN home h USING (user_id) LEFT JOIN paid p ON p.user_id = s.user_id
GROUP BY h.country_name""",
    }
    return {name: statement(body, rolled) for name, body in queries.items()}


def _figures(keys: str, extra_subs: str = "", extra_paid: str = "") -> dict[str, str]:
    """Submitter side, payment side and cohort side per key."""
    key_list = ", ".join(keys.split())
    return {
        "sub_side": f"SELECT {key_list}, count(DISTINCT user_id) AS submitter_users {extra_subs} FROM sub_rows GROUP BY ALL",
        "pay_side": f"""SELECT {key_list}, count(*) AS paid_registration_rows, count(DISTINCT user_id) AS paid_users,
  sum(total_price) AS revenue, {avg2('sum(total_price)', 'count(*)')} AS mean,
  CAST(min(total_price) AS DECIMAL(18,2)) AS lowest, CAST(max(total_price) AS DECIMAL(18,2)) AS highest,
  CAST(round(sqrt(CAST(count(*) * sum(cents * cents) - sum(cents) * sum(cents) AS DOUBLE)) / count(*)) / 100
    AS DECIMAL(18,2)) AS spread {extra_paid}
FROM paid_rows GROUP BY ALL""",
        "cohort_side": f"""SELECT {key_list}, CAST(count(*) FILTER (first_date < start_date) AS BIGINT) AS returning_paid_users,
  CAST(count(*) FILTER (first_date >= start_date) AS BIGINT) AS new_paid_users
FROM paid_rows JOIN first_ever USING (user_id) GROUP BY ALL""",
    }


def _top(keys: str, item: str, plural: str, condition: str = "true", ident: str = "") -> dict[str, str]:
    """Top three items of a key, by payers and by revenue."""
    key_list, ident = ", ".join(keys.split()), ident or item
    stats = f"""SELECT {key_list}, {ident}, {item} AS item, count(DISTINCT user_id) AS n, sum(total_price) AS total
FROM paid_rows WHERE {condition} GROUP BY ALL"""
    ranked = f"""SELECT *, row_number() OVER (PARTITION BY {key_list} ORDER BY n DESC, total DESC, item, {ident}) AS by_n,
  row_number() OVER (PARTITION BY {key_list} ORDER BY total DESC, n DESC, item, {ident}) AS by_total
FROM {plural}_stats"""
    euro = "item || ' (€' || format('{:,}', CAST(round(total) AS BIGINT)) || ')'"
    return {
        f"{plural}_stats": stats,
        f"{plural}_ranked": ranked,
        f"{plural}_top": f"""SELECT {key_list},
  string_agg(item || ' (' || n || ')', ' | ' ORDER BY by_n) FILTER (by_n <= 3) AS top_{plural}_by_paid,
  string_agg({euro}, ' | ' ORDER BY by_total) FILTER (by_total <= 3) AS top_{plural}_by_revenue
FROM {plural}_ranked GROUP BY ALL""",
    }


_SHOWN = f"""coalesce(paid_users, 0) AS paid_users,
  coalesce({pct('coalesce(paid_users, 0)', 'submitter_users')}, 0) AS conversion_pct,
  coalesce(paid_registration_rows, 0) AS paid_registration_rows,
  CAST(coalesce(revenue, 0) AS DOUBLE) AS "revenue_EUR", CAST(coalesce(mean, 0) AS DOUBLE) AS "avg_ticket_EUR",
  CAST(coalesce(lowest, 0) AS DOUBLE) AS "min_ticket_EUR", CAST(coalesce(highest, 0) AS DOUBLE) AS "max_ticket_EUR",
  CAST(coalesce(spread, 0) AS DOUBLE) AS "stddev_ticket_EUR",
  CAST(round(greatest(coalesce(mean, 0) - 0.50 * coalesce(spread, 0), coalesce(lowest, 0)), 2) AS DOUBLE)
    AS "suggested_price_floor_EUR",
  CAST(coalesce(mean, 0) AS DOUBLE) AS "suggested_price_target_EUR",
  CAST(round(coalesce(mean, 0) + 0.75 * coalesce(spread, 0), 2) AS DOUBLE) AS "suggested_price_premium_EUR",
  coalesce(returning_paid_users, 0) AS returning_paid_users, coalesce(new_paid_users, 0) AS new_paid_users"""


def _labels(*plurals: str) -> str:
    return ", ".join(
        f"coalesce(top_{p}_by_{m}, '') AS top_{p}_by_{m}" for p in plurals for m in ("paid", "revenue")
    )


def _insight_steps(start: str, end: str, affiliation: str) -> dict[str, str]:
    return {
        **_steps(start, end),
        "first_ever": f"""SELECT user_id, min(statusdate) AS first_date, DATE '{start}' AS start_date
FROM abstract_submissions GROUP BY user_id""",
        "placed": f"SELECT user_id, country_name, {affiliation} AS affiliation FROM home",
        "sub_rows": "SELECT * FROM subs JOIN placed USING (user_id)",
        "paid_rows": "SELECT *, CAST(total_price * 100 AS HUGEINT) AS cents FROM paid JOIN placed USING (user_id) LEFT JOIN titled USING (event_id)",
    }


def geo_event(start: str, end: str, as_typed: bool) -> str:
    affiliation = "coalesce(affiliation, '')" if as_typed else "known_affiliation"
    blank = "" if as_typed else "Unknown"
    steps = {
        **_insight_steps(start, end, affiliation),
        **_figures("country_name event_id"),
        **_top("country_name event_id", "affiliation", "affiliations", f"affiliation <> '{blank}'"),
    }
    return statement(f"""
SELECT country_name, t.event_id, t.event_name, submitter_users, {_SHOWN}, {_labels('affiliations')}
FROM sub_side LEFT JOIN pay_side USING (country_name, event_id) LEFT JOIN cohort_side USING (country_name, event_id)
LEFT JOIN affiliations_top USING (country_name, event_id) LEFT JOIN titled t USING (event_id)""", steps)


def country(start: str, end: str, top_affiliations: bool) -> str:
    steps = {
        **_insight_steps(start, end, "known_affiliation"),
        **_figures("country_name", ", count(DISTINCT event_id) AS events_submitted",
                   ", count(DISTINCT event_id) AS events_paid"),
        **_top("country_name", "event_name", "events", "event_name IS NOT NULL", "event_id"),
        **_top("country_name", "affiliation", "affiliations", "affiliation <> 'Unknown'"),
    }
    plurals = ("events", "affiliations") if top_affiliations else ("events",)
    joins = " ".join(f"LEFT JOIN {p}_top USING (country_name)" for p in plurals)
    return statement(f"""
SELECT country_name, submitter_users, events_submitted, coalesce(events_paid, 0) AS events_paid, {_SHOWN},
  {_labels(*plurals)}
FROM sub_side LEFT JOIN pay_side USING (country_name) LEFT JOIN cohort_side USING (country_name) {joins}""", steps)


def affiliation(start: str, end: str) -> str:
    steps = {
        **_insight_steps(start, end, "known_affiliation"),
        **_figures(
            "affiliation",
            ", count(DISTINCT event_id) AS events_submitted, count(DISTINCT country_name) AS countries_represented",
            ", count(DISTINCT event_id) AS events_paid, count(DISTINCT country_name) AS countries_paid",
        ),
        **_top("affiliation", "country_name", "countries"),
        **_top("affiliation", "event_name", "events", "event_name IS NOT NULL", "event_id"),
    }
    return statement(f"""
SELECT affiliation, submitter_users, events_submitted, countries_represented,
  coalesce(events_paid, 0) AS events_paid, coalesce(countries_paid, 0) AS countries_paid, {_SHOWN},
  {_labels('countries', 'events')}
FROM sub_side LEFT JOIN pay_side USING (affiliation) LEFT JOIN cohort_side USING (affiliation)
LEFT JOIN countries_top USING (affiliation) LEFT JOIN events_top USING (affiliation)""", steps)


def unconverted(start: str, end: str) -> str:
    steps = {
        **_insight_steps(start, end, "coalesce(nullif(trim(affiliation), ''), '(No affiliation)')"),
        "idle_rows": """SELECT s.* FROM sub_rows s
WHERE NOT EXISTS (SELECT 1 FROM paid p WHERE p.user_id = s.user_id AND p.event_id = s.event_id)""",
        "idle_sites": """SELECT *, row_number() OVER (PARTITION BY country_name, event_id ORDER BY n DESC, affiliation) AS place
FROM (SELECT country_name, event_id, affiliation, count(DISTINCT user_id) AS n FROM idle_rows GROUP BY ALL)""",
        "idle_side": "SELECT country_name, event_id, count(DISTINCT user_id) AS idle FROM idle_rows GROUP BY ALL",
        "idle_top": """SELECT country_name, event_id, string_agg(affiliation || ' (' || n || ')', ' | ' ORDER BY place) AS label
FROM idle_sites WHERE place <= 3 GROUP BY ALL""",
        **_figures("country_name event_id"),
    }
    return statement(f"""
SELECT country_name, t.event_id, t.event_name, submitter_users, coalesce(idle, 0) AS unregistered_users,
  coalesce({pct('coalesce(idle, 0)', 'submitter_users')}, 0) AS dropoff_pct,
  CAST(coalesce(mean, 0) AS DOUBLE) AS "avg_ticket_EUR",
  CAST(round(CAST(coalesce(idle, 0) AS DECIMAL(9,0)) * coalesce(mean, {_MONEY_ZERO}), 2) AS DOUBLE)
    AS "est_missed_revenue_EUR",
  coalesce(label, '') AS top_unregistered_affiliations
FROM sub_side LEFT JOIN idle_side USING (country_name, event_id) LEFT JOIN pay_side USING (country_name, event_id)
LEFT JOIN idle_top USING (country_name, event_id) LEFT JOIN titled t USING (event_id)""", steps)


def insights(window: tuple[str, str], last_12m: tuple[str, str]) -> dict[str, str]:
    return {
        "ins_geo_event": geo_event(*window, as_typed=False),
        "ins_country": country(*window, top_affiliations=False),
        "ins_affiliation": affiliation(*window),
        "ins_geo_event_12m": geo_event(*last_12m, as_typed=True),
        "ins_country_12m": country(*last_12m, top_affiliations=True),
        "ins_affiliation_12m": affiliation(*last_12m),
        "ins_unconverted_12m": unconverted(*last_12m),
    }
