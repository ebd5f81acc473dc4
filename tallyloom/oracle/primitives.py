"""DuckDB statements for the basic operators."""

from __future__ import annotations

from tallyloom.oracle.campaigns import address
from tallyloom.oracle.marketing import _steps as funnel_steps
from tallyloom.oracle.views import avg2, day, instant, pct, statement
from tallyloom.oracle.warehouse import norm

_START, _END = "1999-07-01", "2000-10-01"
_YEAR_START, _YEAR_END = "1999-09-30", "2000-10-01"
_INSIDE = f"statusdate >= DATE '{_START}' AND statusdate < DATE '{_END}'"
_EUR = "status = 1 AND currency_type = 'EUR' AND total_price IS NOT NULL"


#: The name of a mailer by its number.
_SOURCE = """CASE mailer_no WHEN 0 THEN 'emails2' WHEN 1 THEN 'emails2_' WHEN 2 THEN 'emails3'
  WHEN 3 THEN 'reminders' WHEN 4 THEN 'campaign_aml' ELSE 'campaign_amf' END"""


def _age(at: str) -> str:
    born = "date_of_birth"
    return (f"CAST(year(DATE '{at}') - year({born}) - CASE WHEN (month(DATE '{at}'), day(DATE '{at}')) "
            f"< (month({born}), day({born})) THEN 1 ELSE 0 END AS BIGINT)")


def _best(order: str) -> str:
    return f"""SELECT country_name, affiliation, n AS payers, CAST(s AS DOUBLE) AS total, place AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY country_name ORDER BY {order}) AS place FROM sites) WHERE place <= 3"""


def _tickets(price: str = "total_price") -> str:
    return f"""count(*) AS paid_rows, sum({price}) AS s, {avg2(f'sum({price})', f'count({price})')} AS mean,
  CAST(min({price}) AS DECIMAL(18,2)) AS lo, CAST(max({price}) AS DECIMAL(18,2)) AS hi,
  CAST(round(sqrt(CAST(count({price}) * sum(CAST({price} * 100 AS HUGEINT) * CAST({price} * 100 AS HUGEINT))
    - sum(CAST({price} * 100 AS HUGEINT)) * sum(CAST({price} * 100 AS HUGEINT)) AS DOUBLE)) / count({price})) / 100
    AS DECIMAL(18,2)) AS sd"""


def primitives() -> dict[str, str]:
    steps = {
        **funnel_steps(_START, _END),
        "sites": """SELECT h.country_name, h.known_affiliation AS affiliation, count(DISTINCT p.user_id) AS n,
  sum(p.total_price) AS s FROM paid p JOIN home h USING (user_id) GROUP BY ALL""",
        "touches": f"""SELECT id, mailer_no, {address('to_address')} AS addr, p4 AS category,
  coalesce(date_sent, date_added) AS sent_at FROM mailers WHERE p4 <> ''""",
        "member_rows": f"""SELECT {norm('affiliation')} AS member, {norm('country')} AS place FROM stg_awards
WHERE trim(affiliation, ' ') <> ''""",
    }
    queries = {
        "io01_scan": f"""SELECT id, first_name, last_name, email, affiliation, {day('date_of_birth')} AS date_of_birth,
  CAST(country_id AS BIGINT) AS country_id, {day('created_at')} AS created_at FROM users""",
        "io02_union_sources": f"""SELECT {_SOURCE} AS source,
  count(*) AS mailings, max(id) AS last_id FROM mailers GROUP BY 1""",
        "io04_temp_view": """SELECT CAST(country_id AS BIGINT) AS country_id, count(*) AS users FROM users
WHERE created_at >= DATE '1999-07-01' GROUP BY 1""",
        "io05_insert_select": f"""SELECT event_id, count(*) AS "rows" FROM (
  SELECT DISTINCT user_id, event_id FROM abstract_submissions
  WHERE statusdate >= DATE '1998-09-30' AND statusdate < DATE '{_YEAR_START}'
  UNION ALL SELECT DISTINCT user_id, event_id FROM abstract_submissions
  WHERE statusdate >= DATE '{_YEAR_START}' AND statusdate < DATE '{_YEAR_END}') GROUP BY 1""",
        "io06_insert_ignore": """SELECT member, coalesce(min(place) FILTER (place < 'nation_2'), min(place)) AS place
FROM member_rows GROUP BY 1""",
        "io07_truncate_reload": f"""SELECT DISTINCT user_id, event_id FROM abstract_submissions
WHERE statusdate >= DATE '{_YEAR_START}' AND statusdate < DATE '{_YEAR_END}'""",
        "io08_create_if_not_exists": "SELECT id, email FROM users",
        "io09_delete_where": """SELECT id, CAST(country_id AS BIGINT) AS country_id FROM users
WHERE country_id <= 12 OR country_id IS NULL""",
        "io12_update_join": """SELECT u.id AS user_id, coalesce(l.p2, u.affiliation) AS affiliation FROM users u LEFT JOIN (
  SELECT """ + address("to_address") + """ AS addr, nullif(trim(p2, ' '), '') AS p2 FROM mailers
  QUALIFY row_number() OVER (PARTITION BY addr ORDER BY coalesce(date_sent, date_added) DESC NULLS LAST,
    """ + _SOURCE + """ DESC, id DESC) = 1) l ON l.addr = lower(trim(u.email, ' '))""",
        "io14_column_defaults": """SELECT id, email, '2000-09-30 12:00:00.000000' AS created_at,
  CAST(0 AS BIGINT) AS email_is_pseudo FROM users""",
        "p01_projection": f"""SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_acctbal < 0 THEN 'owes'
  WHEN s_acctbal < 1000 THEN 'low' ELSE 'fine' END AS state, 'PENDING' AS code, '{_START}' AS start_date FROM supplier""",
        "p03_half_open_window": f"""SELECT id, user_id, event_id, {day('statusdate')} AS statusdate,
  {day('created_at')} AS created_at FROM abstract_submissions WHERE {_INSIDE}""",
        "p04_rolling_year": f"""SELECT id, user_id FROM abstract_submissions
WHERE statusdate >= DATE '{_YEAR_START}' AND statusdate < DATE '{_YEAR_END}'""",
        "p07_paid_in_window": f"""SELECT id, user_id, event_id, CAST(total_price AS DOUBLE) AS total_price, currency_type,
  CAST(status AS BIGINT) AS status, CAST(sendinvoice AS BIGINT) AS sendinvoice, {day('created_at')} AS created_at,
  {day('updated_at')} AS updated_at FROM registrations
WHERE status = 1 AND currency_type = 'EUR' AND updated_at >= DATE '{_START}' AND updated_at < DATE '{_END}'""",
        "p09_not_blank": """SELECT id, affiliation FROM stg_awards
WHERE affiliation IS NOT NULL AND trim(affiliation, ' ') <> ''""",
        "p10_like_patterns": """SELECT email LIKE '%@%' AS has_at, email NOT LIKE '%@%' AS lacks_at,
  email LIKE '%@ex.org' AS ends, email IS NULL AS missing, count(*) AS "rows" FROM stg_awards GROUP BY ALL""",
        "p14_having": 'SELECT user_id, count(*) AS "rows" FROM registrations GROUP BY 1 HAVING count(*) > 14',
        "p15_having_on_alias": """SELECT coalesce(affiliation, '') AS affiliation, count(*) AS users FROM users
GROUP BY 1 HAVING coalesce(affiliation, '') <> ''""",
        "j02_composite_key": """SELECT r.id, r.user_id, r.event_id FROM registrations r
JOIN subs s ON s.user_id = r.user_id AND s.event_id = r.event_id""",
        "j03_normalised_join": """SELECT CAST(c.id AS BIGINT) AS id, c.name, count(*) AS "rows" FROM stg_awards s
JOIN countries c ON lower(c.name) = lower(trim(s.country, ' ')) GROUP BY ALL""",
        "j05_left_chain": f"""SELECT u.id AS user_id, c.name AS country, {day('min(a.statusdate)')} AS first_submission
FROM users u LEFT JOIN countries c ON c.id = u.country_id LEFT JOIN abstract_submissions a ON a.user_id = u.id
GROUP BY u.id, c.name""",
        "j07_anti_join": """SELECT u.id, u.email FROM users u LEFT JOIN abstract_submissions a ON a.user_id = u.id
WHERE a.user_id IS NULL""",
        "j09_semi_join": """SELECT id, CAST(total_price AS DOUBLE) AS total_price FROM registrations r
WHERE EXISTS (SELECT 1 FROM subs s WHERE s.user_id = r.user_id AND s.event_id = r.event_id)""",
        "j11_totals_side_by_side": f"""SELECT (SELECT count(*) FROM users) AS users,
  (SELECT count(*) FROM abstract_submissions) AS abstracts,
  (SELECT CAST(sum(total_price) AS DOUBLE) FROM registrations WHERE {_EUR}) AS revenue""",
        "j13_latest_touch": f"""SELECT f.id, f.addr AS email_norm, {instant('f.created_at')} AS answered_at,
  t.category AS award_category
FROM (SELECT id, created_at, {address('email')} AS addr FROM yes_no_form) f
ASOF LEFT JOIN (SELECT addr, sent_at, max(category) AS category FROM touches GROUP BY ALL) t
  ON t.addr = f.addr AND f.created_at >= t.sent_at""",
        "j18_densify": """SELECT k.event_id, coalesce(s.n, 0) AS submitted, coalesce(i.n, 0) AS invoices,
  CAST(c.id IS NOT NULL AS BIGINT) AS is_known
FROM (SELECT event_id FROM subs UNION SELECT event_id FROM registrations WHERE sendinvoice = 1
      UNION SELECT id FROM conferences) k
LEFT JOIN (SELECT event_id, count(*) AS n FROM subs GROUP BY 1) s USING (event_id)
LEFT JOIN (SELECT event_id, count(*) AS n FROM registrations WHERE sendinvoice = 1 GROUP BY 1) i
  USING (event_id)
LEFT JOIN conferences c ON c.id = k.event_id""",
        "g01_g09_aggregates": f"""SELECT event_id, count(*) AS "rows", count(total_price) AS priced,
  count(DISTINCT user_id) AS users, CAST(sum(total_price) AS DOUBLE) AS total, CAST(min(total_price) AS DOUBLE) AS lowest,
  CAST(max(total_price) AS DOUBLE) AS highest, {day('min(created_at)')} AS first_day, max(currency_type) AS last_currency
FROM registrations GROUP BY 1""",
        "g08_g10_ticket_stats": f"""SELECT event_id, paid_rows, CAST(s AS DOUBLE) AS "revenue_EUR",
  CAST(mean AS DOUBLE) AS "avg_ticket_EUR", CAST(lo AS DOUBLE) AS "min_ticket_EUR", CAST(hi AS DOUBLE) AS "max_ticket_EUR",
  CAST(sd AS DOUBLE) AS "stddev_ticket_EUR"
FROM (SELECT event_id, {_tickets()} FROM registrations WHERE {_EUR} GROUP BY 1)""",
        "g05_several_distincts": """SELECT event_id, count(DISTINCT user_id) AS users,
  count(DISTINCT currency_type) AS currencies,
  count(DISTINCT CASE WHEN currency_type = 'EUR' THEN user_id END) AS euro_users, count(*) AS "rows"
FROM registrations GROUP BY 1""",
        "g11_g14_conditional": """SELECT event_id, CAST(sum(CASE WHEN currency_type = 'EUR' THEN 1 ELSE 0 END) AS BIGINT)
  AS euro_rows, count(*) FILTER (total_price IS NULL) AS unpriced, max(CAST(status = 1 AS INT)) = 1 AS any_paid,
  max(CASE WHEN status = 0 THEN user_id END) AS last_unpaid_user FROM registrations GROUP BY 1""",
        "g15_distinct_list": """SELECT event_id, string_agg(DISTINCT currency_type, ', ' ORDER BY currency_type) AS currencies,
  count(*) AS "rows" FROM registrations GROUP BY 1""",
        "g16_list_with_repeats": """SELECT user_id, string_agg(currency_type, ', ' ORDER BY currency_type) AS currencies
FROM registrations GROUP BY 1""",
        "g19_group_by_expression": """SELECT year(statusdate) AS year, event_id % 3 AS series, count(*) AS "rows"
FROM abstract_submissions GROUP BY ALL""",
        "g26_latest_date_per_key": f"""SELECT {address('email')} AS email_norm, {instant('max(created_at)')} AS yes_created_at
FROM yes_no_form WHERE lower(trim(response, ' ')) = 'yes' AND created_at >= DATE '1999-05-15'
  AND created_at < DATE '1999-06-06' GROUP BY 1""",
        "w01_rank_by_count": _best("n DESC, s DESC, affiliation"),
        "w02_rank_by_revenue": _best("s DESC, n DESC, affiliation"),
        "w03_rank_label": """SELECT country_name, string_agg(affiliation || ' (' || n || ')', ' | ' ORDER BY place) AS best FROM (
  SELECT *, row_number() OVER (PARTITION BY country_name ORDER BY n DESC, affiliation) AS place FROM sites)
WHERE place <= 3 GROUP BY 1""",
        "t07_sorted_layout": "SELECT id, event_id, user_id FROM registrations",
        "u01_union_of_keys": """SELECT user_id, event_id FROM abstract_submissions
UNION SELECT user_id, event_id FROM registrations""",
        "s01_s12_text": """SELECT id, trim(country, ' ') AS trimmed, lower(name) AS lowered, replace(name, '#', ' no ') AS replaced,
  name || '/' || affiliation AS joined_or_null, concat_ws('/', name, affiliation) AS joined, substr(name, 1, 5) AS start,
  'AWD' || CASE WHEN length(CAST(id AS VARCHAR)) >= 3 THEN CAST(id AS VARCHAR) ELSE lpad(CAST(id AS VARCHAR), 3, '0') END
    AS code,
  'AWD_' || substr(md5(name), 1, 8) AS hash_code, regexp_replace(country, '\\s+', '_', 'g') AS squeezed,
  nullif(trim(affiliation, ' '), '') AS no_blank, lower(trim(email, ' ')) AS address FROM stg_awards""",
        "s10_s11_address": f"""SELECT id, {address('to_address')} AS address, {address('p1')} AS no_address,
  regexp_matches(p3, '[5-9]') AS matches FROM mailers""",
        "s16_s21_dates": f"""SELECT id, {_age(_END)} AS age, {_age('2001-02-28')} AS age_end_of_february,
  {instant('CAST(date_of_birth AS TIMESTAMP)')} AS born_at, '{_START}' AS start_date, '{_YEAR_START}' AS year_start,
  '{_YEAR_END}' AS year_end FROM users""",
        "s22_norm_key": """SELECT c_custkey, 'e ' || lower(c_mktsegment) || ' lab' AS key,
  chr(160) || ' e' || chr(9) || lower(c_mktsegment) || chr(160) || chr(160) || 'lab ' AS raw_key FROM customer""",
        "s23_s28_numbers": f"""SELECT event_id, CAST(status AS BIGINT) AS status,
  {pct('status * paid_rows', 'paid_rows + status')} AS pct, {pct('paid_rows', 'status')} AS pct_or_null,
  coalesce({pct('paid_rows', 'status')}, 0) AS pct_or_zero, format('{{:,}}', CAST(round(s) AS BIGINT)) AS shown,
  'Event#' || event_id AS event_name,
  CAST(round(greatest(mean - 0.50 * sd, lo), 2) AS DOUBLE) AS "suggested_price_floor_EUR",
  CAST(mean AS DOUBLE) AS "suggested_price_target_EUR",
  CAST(round(mean + 0.75 * sd, 2) AS DOUBLE) AS "suggested_price_premium_EUR"
FROM (SELECT event_id, status, {_tickets()} FROM registrations WHERE total_price IS NOT NULL GROUP BY ALL)""",
        "f03_paid_registrations": f"""SELECT r.id, r.user_id, r.event_id, CAST(r.total_price AS DOUBLE) AS total_price
FROM registrations r JOIN subs s ON s.user_id = r.user_id AND s.event_id = r.event_id WHERE {_EUR}""",
        "f04_user_dim": """SELECT user_id, country_name, known_affiliation AS affiliation,
  lower(known_affiliation) AS affiliation_key FROM home""",
        "f08_first_activity": f"""SELECT user_id, {day('min(statusdate)')} AS first_abs_date
FROM abstract_submissions GROUP BY 1""",
        "f09_cohorts": f"""SELECT s.event_id,
  count(p.user_id) FILTER (f.first_date < DATE '{_START}') AS returning_paid_users,
  count(p.user_id) FILTER (f.first_date >= DATE '{_START}') AS new_paid_users
FROM subs s JOIN (SELECT user_id, min(statusdate) AS first_date FROM abstract_submissions GROUP BY 1) f USING (user_id)
LEFT JOIN paid p ON p.user_id = s.user_id AND p.event_id = s.event_id GROUP BY 1""",
        "f13_lifetime_vs_window": f"""SELECT user_id, count(*) FILTER ({_INSIDE}) AS abstracts_in_window,
  count(*) AS total_abstracts_all_time, {day(f'min(statusdate) FILTER ({_INSIDE})')} AS first_submission,
  {day(f'max(statusdate) FILTER ({_INSIDE})')} AS last_submission, {day('min(statusdate)')} AS first_submission_ever,
  {day('max(statusdate)')} AS last_submission_ever
FROM abstract_submissions GROUP BY 1 HAVING count(*) FILTER ({_INSIDE}) > 0""",
        "f16_dropoff": """SELECT s.user_id, s.event_id FROM subs s
LEFT JOIN paid p ON p.user_id = s.user_id AND p.event_id = s.event_id WHERE p.user_id IS NULL""",
        "c01_mail_touches": f"""SELECT addr AS email_norm, category AS award_category, {instant('sent_at')} AS sent_at
FROM touches""",
        "c03_emails_sent": """SELECT c.name AS country_name, min(t.category) AS award_category, count(*) AS emails_sent
FROM touches t JOIN users u ON lower(trim(u.email, ' ')) = t.addr LEFT JOIN countries c ON c.id = u.country_id
WHERE t.mailer_no IN (0, 1) GROUP BY c.name, lower(t.category)""",
        "c06_latest_contact": """SELECT addr AS email_norm, p1, p2, subject, template_name FROM (
  SELECT """ + address("to_address") + """ AS addr, nullif(trim(p1, ' '), '') AS p1, nullif(trim(p2, ' '), '') AS p2,
    subject, template_name FROM mailers
  QUALIFY row_number() OVER (PARTITION BY addr ORDER BY coalesce(date_sent, date_added) DESC NULLS LAST,
    """ + _SOURCE + """ DESC, id DESC) = 1)""",
        "d06_members_within_country": f"""SELECT {norm('country')} AS country_key, {norm('affiliation')} AS affiliation_key,
  min(trim(affiliation, ' ')) AS affiliation_name FROM stg_awards WHERE {norm('affiliation')} <> '' GROUP BY ALL""",
    }
    return {name: statement(body, steps) for name, body in queries.items()}
