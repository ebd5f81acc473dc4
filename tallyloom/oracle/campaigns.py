"""DuckDB statements for the campaign reports."""

from __future__ import annotations

from tallyloom.functions.text import EMAIL_PATTERN
from tallyloom.oracle.views import day, instant, pct, statement


def address(text: str) -> str:
    return f"lower(trim(coalesce(nullif(regexp_extract({text}, '{EMAIL_PATTERN}'), ''), {text}), ' '))"


def plain(text: str) -> str:
    return f"lower(trim({text}, ' '))"


def _touch_steps(window: tuple[str, str], key) -> dict[str, str]:
    return {
        "payments": f"""SELECT id, user_id, total_price, CAST(updated_at AS TIMESTAMP) AS paid_at FROM registrations
WHERE status = 1 AND currency_type = 'EUR' AND updated_at >= DATE '{window[0]}' AND updated_at < DATE '{window[1]}'""",
        "touches": f"""SELECT {key('to_address')} AS addr, p4 AS category, coalesce(date_sent, date_added) AS sent_at
FROM mailers WHERE mailer_no IN (0, 1) AND p4 <> ''""",
        "owner": """SELECT u.id AS user_id, lower(trim(u.email, ' ')) AS addr, c.name AS country_name
FROM users u LEFT JOIN countries c ON c.id = u.country_id""",
        "reached": "SELECT o.user_id, o.country_name, t.category, t.sent_at FROM touches t JOIN owner o USING (addr)",
        "credited": """SELECT p.id, p.total_price, r.category, r.country_name
FROM payments p LEFT JOIN reached r ON r.user_id = p.user_id AND r.sent_at <= p.paid_at
QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY r.sent_at DESC NULLS LAST, lower(r.category) DESC NULLS LAST,
  r.category DESC NULLS LAST) = 1""",
    }


def _last_touch(window: tuple[str, str], key) -> str:
    return statement("""
SELECT coalesce(min(category), 'UNKNOWN') AS award_category, count(*) AS paid_registrations,
  CAST(sum(total_price) AS DOUBLE) AS eur_revenue
FROM credited GROUP BY lower(category)""", _touch_steps(window, key))


def _country_funnel(window: tuple[str, str]) -> str:
    return statement(f"""
SELECT coalesce(p.country_name, e.country_name) AS country_name, least(p.category, e.category) AS award_category,
  coalesce(e.n, 0) AS emails_sent_lifetime, coalesce(p.n, 0) AS paid_registrations_window,
  CAST(coalesce(p.total, 0) AS DOUBLE) AS eur_revenue_window,
  {pct('coalesce(p.n, 0)', 'e.n')} AS conversion_pct_window_over_lifetime
FROM (SELECT country_name, lower(category) AS k, min(category) AS category, count(*) AS n FROM reached GROUP BY 1, 2) e
FULL JOIN (SELECT coalesce(country_name, 'UNKNOWN') AS country_name, coalesce(lower(category), 'UNKNOWN') AS k,
    coalesce(min(category), 'UNKNOWN') AS category, count(*) AS n, sum(total_price) AS total FROM credited GROUP BY 1, 2) p
  ON p.country_name = e.country_name AND p.k = e.k""", _touch_steps(window, address))


_RAW_FIELDS = ("subject", "template_name")


def _follow_up(window: tuple[str, str], mailer_ids: dict[str, int], mailers: list[str], names: dict[str, str]) -> str:
    """``names``: mailing field to output column."""
    numbers = ", ".join(str(mailer_ids[m]) for m in mailers)
    sources = " ".join(f"WHEN {mailer_ids[m]} THEN '{m}'" for m in mailers)
    fields = ", ".join(f if f in _RAW_FIELDS else f"nullif(trim({f}, ' '), '') AS {f}" for f in names)
    shown = ", ".join(f"c.{field} AS {name}" for field, name in names.items())
    steps = {
        "agreed": f"""SELECT {address('email')} AS addr, max(created_at) AS yes_at FROM yes_no_form
WHERE lower(trim(response, ' ')) = 'yes' AND created_at >= DATE '{window[0]}' AND created_at < DATE '{window[1]}'
GROUP BY 1""",
        "wrote": f"""SELECT DISTINCT user_id FROM abstract_submissions
WHERE created_at >= DATE '{window[0]}' AND created_at < DATE '{window[1]}'""",
        "contact": f"""SELECT {address('to_address')} AS addr, {fields} FROM mailers WHERE mailer_no IN ({numbers})
QUALIFY row_number() OVER (PARTITION BY {address('to_address')} ORDER BY coalesce(date_sent, date_added) DESC NULLS LAST,
  CASE mailer_no {sources} END DESC, id DESC) = 1""",
    }
    return statement(f"""
SELECT y.addr AS email, {shown}, {instant('y.yes_at')} AS yes_created_at
FROM agreed y LEFT JOIN users u ON lower(trim(u.email, ' ')) = y.addr
LEFT JOIN wrote w ON w.user_id = u.id LEFT JOIN contact c ON c.addr = y.addr
WHERE w.user_id IS NULL""", steps)


def campaigns(
    window: tuple[str, str],
    yes: tuple[str, str],
    since: tuple[str, str],
    open_since: tuple[str, str],
    later: tuple[str, str],
    mailer_ids: dict[str, int],
    follow_ups: dict[str, tuple[list[str], list[str]]],
    extended: list[str],
    contact_names: dict[str, str],
) -> dict[str, str]:
    said_yes = "lower(trim(response, ' ')) = 'yes'"
    queries = {
        "cmp_last_touch_revenue": _last_touch(window, address),
        "cmp_last_touch_revenue_plain": _last_touch(window, plain),
        "cmp_award_country_funnel": _country_funnel(window),
        "cmp_yes_pull": statement(f"""
SELECT id, email, response, full_name, {instant('created_at')} AS created_at FROM yes_no_form
WHERE {said_yes} AND nullif(trim(full_name, ' '), '') IS NOT NULL
  AND created_at >= DATE '{since[0]}' AND created_at < DATE '{since[1]}'"""),
        "cmp_response_hist": statement(f"""
SELECT lower(trim(response, ' ')) AS resp_norm, count(*) AS cnt FROM yes_no_form
WHERE created_at >= DATE '{since[0]}' GROUP BY 1"""),
        "cmp_name_completeness": statement(f"""
SELECT count(*) AS yes_total, count(*) FILTER (regexp_matches(full_name, '[^[:space:]]')) AS yes_with_name,
  count(*) FILTER (NOT regexp_matches(full_name, '[^[:space:]]')) AS yes_missing_name
FROM yes_no_form WHERE {said_yes} AND created_at >= DATE '{since[0]}'"""),
        "cmp_yes_to_abstract": statement(f"""
SELECT u.id AS user_id, concat_ws(' ', u.first_name, u.last_name) AS name, u.email AS user_email,
  {instant('y.created_at')} AS yes_created_at, a.id AS abstract_id, {day('a.created_at')} AS abstract_created_at
FROM yes_no_form y JOIN users u ON lower(trim(u.email, ' ')) = {address('y.email')}
JOIN abstract_submissions a ON a.user_id = u.id
WHERE lower(trim(y.response, ' ')) = 'yes'
  AND y.created_at >= DATE '{open_since[0]}' AND y.created_at < DATE '{open_since[1]}'
  AND a.created_at >= DATE '{later[0]}' AND a.created_at < DATE '{later[1]}'"""),
    }

    queries["cmp_yes_before_abstract"] = statement(f"""
SELECT u.id AS user_id, a.id AS abstract_id, {day('a.created_at')} AS abstract_created_at, count(*) AS yes_count,
  {instant('min(y.created_at)')} AS first_yes_at, {instant('max(y.created_at)')} AS last_yes_at
FROM yes_no_form y JOIN users u ON lower(trim(u.email, ' ')) = {address('y.email')}
JOIN abstract_submissions a ON a.user_id = u.id AND a.created_at >= y.created_at
WHERE lower(trim(y.response, ' ')) = 'yes'
  AND y.created_at >= DATE '{open_since[0]}' AND y.created_at < DATE '{open_since[1]}'
  AND a.created_at >= DATE '{later[0]}' AND a.created_at < DATE '{later[1]}'
GROUP BY u.id, a.id, a.created_at""")

    def named(fields: list[str]) -> dict[str, str]:
        return {f: contact_names.get(f, f) for f in fields}

    for name, (mailers, fields) in follow_ups.items():
        queries[name] = _follow_up(yes, mailer_ids, mailers, named(fields))
    queries["cmp_reminder_load"] = _follow_up(yes, mailer_ids, list(mailer_ids), named(extended))
    return queries
