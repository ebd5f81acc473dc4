"""DuckDB statements for the warehouse load, its checks and the award reports."""

from __future__ import annotations

from tallyloom.operators.warehouse import LOAD_STEP
from tallyloom.oracle.views import statement


def norm(text: str) -> str:
    return f"strip_accents(lower(trim(regexp_replace({text}, '[\\s\\x{{00A0}}]+', ' ', 'g'), ' ')))"


def _number(text: str, order: str) -> str:
    """Position in the order of the key's three-digit hash bucket, then the key."""
    return f"row_number() OVER (ORDER BY substr(md5({text}), 1, 3), {order})"


_REAL = "(email IS NOT NULL AND trim(email, ' ') <> '' AND email LIKE '%@%')"


def _pseudo(name: str, place: str) -> str:
    """``place``: the text hashed after the name. ``||`` is NULL when a part is."""
    return f"lower(replace({name}, ' ', '')) || '|' || substr(md5(lower({name}) || '|' || {place}), 1, 10) || '@pseudo'"


def _part(column: str) -> str:
    return f"coalesce(nullif(trim({column}, ' '), ''), 'unknown')"


_STRICT = _pseudo("trim(name, ' ')", "lower(trim(affiliation, ' ')) || '|' || lower(trim(country, ' '))")
_LENIENT = _pseudo(_part("name"), f"lower({_part('affiliation')}) || '|' || lower({_part('country')})")
_STORED = _pseudo(_part("full_name"), "'unknown_affiliation|unknown_country'")


def _identity(pseudo: str) -> str:
    return f"CASE WHEN {_REAL} THEN lower(trim(email, ' ')) ELSE {pseudo} END"


def _fact(rows: str, authors: str, author_key: str, person: str, load_no: int = 0) -> str:
    return f"""SELECT s.id + {load_no * LOAD_STEP} AS award_id, a.author_id, f.affiliation_id, c.country_id, t.award_type_id,
  trim(s.assembly_number, ' ') AS assembly_number, s.award_year,
  nullif(trim(s.session, ' '), '') AS session, nullif(trim(s.session_topic, ' '), '') AS session_topic,
  nullif(trim(s.presentation_type, ' '), '') AS presentation_type,
  nullif(trim(s.certificate_number, ' '), '') AS certificate_number
FROM {rows} s JOIN country_dim c ON c.country_key = s.country_key
JOIN affiliation_dim f ON f.affiliation_key = s.affiliation_key AND f.country_id = c.country_id
JOIN award_dim t ON t.award_key = s.award_key
JOIN {authors} a ON a.{author_key} = s.{person}"""


def _not_loaded(rows: str, fact: str) -> str:
    return f"""NOT EXISTS (SELECT 1 FROM {fact} g WHERE g.author_id = {rows}.author_id
  AND g.affiliation_id = {rows}.affiliation_id AND g.country_id = {rows}.country_id
  AND g.award_type_id = {rows}.award_type_id
  AND coalesce(g.certificate_number, '') = coalesce(trim({rows}.certificate_number, ' '), ''))"""


def _steps(years: dict[str, int], country: str) -> dict[str, str]:
    cases = " ".join(f"WHEN assembly_number = '{name}' THEN {year}" for name, year in years.items())
    bucketed = "concat_ws(chr(31), affiliation_key, CAST(country_id AS VARCHAR))"
    return {
        "staged": f"SELECT * REPLACE (CAST(CASE {cases} ELSE award_year END AS BIGINT) AS award_year) FROM stg_awards",
        "keyed": f"""SELECT *, {norm('country')} AS country_key, {norm('affiliation')} AS affiliation_key,
  {norm('award_certificate_type')} AS award_key, lower(trim(email, ' ')) AS email_key,
  {_identity(_STRICT)} AS strict_key, {_identity(_LENIENT)} AS person_key
FROM staged""",
        "country_dim": f"""SELECT {_number('country_key', 'country_key')} AS country_id, country_key, country_name FROM (
  SELECT country_key, min(trim(country, ' ')) AS country_name FROM keyed WHERE country_key <> '' GROUP BY 1)""",
        "affiliation_dim": f"""SELECT {_number(bucketed, 'affiliation_key, country_id')} AS affiliation_id, * FROM (
  SELECT k.affiliation_key, min(trim(k.affiliation, ' ')) AS affiliation_name, c.country_id
  FROM keyed k JOIN country_dim c USING (country_key) WHERE k.affiliation_key <> '' GROUP BY ALL)""",
        "award_dim": f"""SELECT *, 'AWD' || lpad(CAST(award_type_id AS VARCHAR), CAST(greatest(3, length(CAST(award_type_id AS VARCHAR))) AS INTEGER), '0') AS award_code FROM (
  SELECT {_number('award_key', 'award_key')} AS award_type_id, award_key, award_name FROM (
    SELECT award_key, min(trim(award_certificate_type, ' ')) AS award_name FROM keyed WHERE award_key <> '' GROUP BY 1))""",
        "author_v1": f"""SELECT {_number('email', 'email')} AS author_id, full_name, email FROM (
  SELECT email_key AS email, min(trim(name, ' ')) AS full_name FROM keyed WHERE email_key <> '' GROUP BY 1)""",
        "strict_people": """SELECT strict_key AS email, min(trim(name, ' ')) AS full_name FROM keyed
WHERE strict_key IS NOT NULL GROUP BY 1""",
        "author_v2": f"""SELECT * FROM author_v1 UNION ALL
SELECT (SELECT max(author_id) FROM author_v1) + {_number('email', 'email')}, full_name, email
FROM strict_people p WHERE NOT EXISTS (SELECT 1 FROM author_v1 v WHERE v.email = p.email)""",
        "author_split": f"""SELECT author_id, full_name, nullif(trim(email, ' '), '') AS email_raw,
  {_identity(_STORED)} AS email_norm, CAST(NOT {_REAL} AS BIGINT) AS email_is_pseudo FROM author_v2""",
        "person_rows": f"SELECT *, {_REAL} AS is_real FROM keyed",
        "people": """SELECT person_key AS email_norm, min(coalesce(nullif(trim(name, ' '), ''), 'Unknown')) AS full_name,
  max(CASE WHEN is_real THEN email_key END) AS email_raw, CAST(1 - max(CAST(is_real AS INT)) AS BIGINT) AS email_is_pseudo
FROM person_rows WHERE person_key <> '' GROUP BY 1""",
        "author_dim": f"""SELECT a.author_id, coalesce(p.full_name, a.full_name) AS full_name,
  coalesce(p.email_raw, a.email_raw) AS email_raw, a.email_norm,
  coalesce(p.email_is_pseudo, a.email_is_pseudo) AS email_is_pseudo
FROM author_split a LEFT JOIN people p USING (email_norm)
UNION ALL
SELECT (SELECT max(author_id) FROM author_split) + {_number('email_norm', 'email_norm')},
  full_name, email_raw, email_norm, email_is_pseudo
FROM people p WHERE NOT EXISTS (SELECT 1 FROM author_split a WHERE a.email_norm = p.email_norm)""",
        "fact_v1": _fact("keyed", "author_v1", "email", "email_key"),
        "fact_v2": _fact("keyed", "author_v2", "email", "strict_key"),
        "fact_ready": _fact("keyed", "author_dim", "email_norm", "person_key", 1),
        "fact_award": f"""SELECT * FROM fact_v2 UNION ALL
SELECT * FROM fact_ready r WHERE {_not_loaded('r', 'fact_v2')}""",
        "located": """SELECT k.*, c.country_id, f.affiliation_id, t.award_type_id, a.author_id
FROM keyed k LEFT JOIN country_dim c ON c.country_key = k.country_key
LEFT JOIN affiliation_dim f ON f.affiliation_key = k.affiliation_key AND f.country_id = c.country_id
LEFT JOIN award_dim t ON t.award_key = k.award_key
LEFT JOIN author_dim a ON a.email_norm = k.person_key""",
        "unloaded": f"SELECT * FROM located l WHERE {_not_loaded('l', 'fact_award')}",
        "star": """SELECT * FROM fact_award JOIN author_dim USING (author_id) JOIN country_dim USING (country_id)
JOIN affiliation_dim USING (affiliation_id) JOIN award_dim USING (award_type_id)""",
        "star_of": f"SELECT * FROM star WHERE country_name = '{country}'",
    }


def _list(column: str, name: str, distinct: str = "DISTINCT ") -> str:
    return f"string_agg({distinct}{column}, ', ' ORDER BY {column}) AS {name}"


def _folded(table: str, key: str, *columns: str) -> str:
    """Rows of a table with the smallest spelling of each listed text within its group."""
    shown = ", ".join(f"min({c}) OVER (PARTITION BY {key}, strip_accents(lower({c}))) AS {c}" for c in columns)
    return f"(SELECT * REPLACE ({shown}) FROM {table})"


def _missing(prefix: str) -> str:
    return f"""count(*) AS {prefix}, count(*) FILTER (country_id IS NULL) AS missing_country,
  count(*) FILTER (affiliation_id IS NULL) AS missing_affiliation,
  count(*) FILTER (award_type_id IS NULL) AS missing_award_type, count(*) FILTER (author_id IS NULL) AS missing_author"""


def _key_check(table: str, name: str, key: str) -> str:
    return f"""SELECT '{name}' AS "table", CAST(sum(n) AS BIGINT) AS "rows",
  CAST(coalesce(sum(n) FILTER (k IS NULL OR trim(k) = ''), 0) AS BIGINT) AS blank_keys,
  count(*) FILTER (n > 1 AND trim(k) <> '') AS repeated_keys
FROM (SELECT {key} AS k, count(*) AS n FROM {table} GROUP BY 1)"""


def _orphans(name: str, table: str, column: str) -> str:
    return f"""SELECT 'dim_{name}' AS "table", count(*) AS orphan_rows FROM fact_award
WHERE {column} NOT IN (SELECT {column} FROM {table})"""


def _lists(distinct: str) -> str:
    return ", ".join([
        _list("full_name", "authors", distinct), _list("email_norm", "emails", distinct),
        _list("session_topic", "research_areas", distinct), _list("award_name", "award_names", distinct),
    ])


_PEOPLE = {"authors": "full_name", "emails": "email_norm", "research_areas": "session_topic"}


def _long_lists(table: str, key: str, shown: str, lists: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT {key} AS {shown}, '{name}' AS list, min({column}) AS value, count(*) AS n FROM {table}
GROUP BY {key}, strip_accents(lower({column}))""" for name, column in lists.items()
    )


def warehouse(years: dict[str, int], country: str, affiliation: str) -> dict[str, str]:
    detail = """affiliation_name, award_name, session_topic AS research_area, full_name AS author_name,
  coalesce(email_norm, '') AS email, award_year, presentation_type"""
    staging = ("id, CAST(s_no AS BIGINT) AS s_no, assembly_number, award_year, title, name, gender, affiliation, country, "
               "email, presentation_type, award_certificate_type, certificate_number, session, session_topic, paper_title")
    queries = {
        "dwh_dim_country": "SELECT * FROM country_dim",
        "dwh_dim_affiliation": "SELECT * FROM affiliation_dim",
        "dwh_dim_author": "SELECT * FROM author_v1",
        "dwh_dim_award_type": "SELECT * FROM award_dim",
        "dwh_award_type_missing": """SELECT 'AWD_' || substr(md5(award_name), 1, 8) AS award_code, award_name, award_key
FROM award_dim WHERE award_type_id <> 1""",
        "dwh_people_strict": "SELECT * FROM strict_people",
        "dwh_people": "SELECT * FROM people",
        "dwh_author_with_people": "SELECT * FROM author_v2",
        "dwh_author_backfill": "SELECT * FROM author_split",
        "dwh_author_upsert": "SELECT * FROM author_dim",
        "dwh_fact_v1": "SELECT * FROM fact_v1",
        "dwh_fact_v2": "SELECT * FROM fact_v2",
        "dwh_fact_incremental": f"SELECT * FROM fact_ready r WHERE {_not_loaded('r', 'fact_v1')}",
        "dwh_year_overrides": "SELECT id, assembly_number, award_year FROM staged",
        "qa_row_parity": """SELECT (SELECT count(*) FROM staged WHERE trim(award_certificate_type) <> '') AS stg_rows,
  (SELECT count(*) FROM fact_award) AS fact_rows""",
        "qa_award_parity": "SELECT award_name, count(*) AS fact_cnt FROM fact_award JOIN award_dim USING (award_type_id) GROUP BY 1",
        "qa_pseudo": "SELECT count(*) AS pseudo_authors FROM author_v2 WHERE email LIKE '%@pseudo'",
        "qa_authors": """SELECT (SELECT count(DISTINCT strict_key) FROM keyed) AS authors_in_staging,
  (SELECT count(*) FROM author_v2) AS authors_in_dim_author""",
        "qa_identity_profile": """SELECT count(*) AS rows_total, count(DISTINCT email_key) AS distinct_real_emails,
  count(DISTINCT strict_key) AS distinct_people_norm FROM keyed""",
        "qa_top_identities": """SELECT strict_key AS email_norm, min(name) AS sample_name,
  min(affiliation) AS sample_affiliation, min(country) AS sample_country, count(*) AS rows_for_person
FROM keyed GROUP BY 1 ORDER BY rows_for_person DESC, email_norm ASC NULLS FIRST LIMIT 20""",
        "qa_constraints": "\nUNION ALL\n".join([
            _key_check("country_dim", "dim_country", "country_key"),
            _key_check("affiliation_dim", "dim_affiliation", "affiliation_key || '|' || country_id"),
            _key_check("award_dim", "dim_award_type", "award_key"),
            _key_check("author_dim", "dim_author", "email_norm"),
            _key_check("fact_award", "fact_award", "CAST(award_id AS VARCHAR)"),
        ]),
        "qa_foreign_keys": "\nUNION ALL\n".join([
            _orphans("country", "country_dim", "country_id"), _orphans("affiliation", "affiliation_dim", "affiliation_id"),
            _orphans("award_type", "award_dim", "award_type_id"), _orphans("author", "author_dim", "author_id"),
        ]),
        "qa_fact_counts": "SELECT count(*) AS fact_rows, count(DISTINCT author_id) AS authors_in_fact FROM fact_award",
        "qa_load_readiness": f"""SELECT {_missing('total_staging_rows')}, count(*) FILTER (country_id IS NOT NULL
  AND affiliation_id IS NOT NULL AND award_type_id IS NOT NULL AND author_id IS NOT NULL) AS rows_ready_for_fact
FROM located""",
        "qa_unloaded": f"SELECT {staging} FROM unloaded",
        "qa_unloaded_keys": """SELECT id AS stg_id, name, email, affiliation, country, award_certificate_type,
  certificate_number, person_key AS email_norm, country_key AS country_norm, affiliation_key AS affiliation_norm,
  award_key AS award_norm FROM unloaded""",
        "qa_unloaded_reasons": f"SELECT {_missing('total_missing')} FROM unloaded",
        "qa_unmatched_award": """SELECT DISTINCT award_key AS missing_award FROM unloaded u
WHERE NOT EXISTS (SELECT 1 FROM award_dim t WHERE t.award_key = u.award_key)""",
        "qa_unmatched_country": """SELECT DISTINCT country_key AS missing_country FROM unloaded u
WHERE NOT EXISTS (SELECT 1 FROM country_dim c WHERE c.country_key = u.country_key)""",
        "qa_unmatched_affiliation": """SELECT DISTINCT country_key AS country_norm, affiliation_key AS missing_affiliation
FROM unloaded WHERE affiliation_id IS NULL""",
        "rpt_awardees_country_affiliation": """SELECT country_name AS country, affiliation_name AS affiliation,
  count(DISTINCT author_id) AS unique_awardees FROM star GROUP BY ALL""",
        "rpt_awardees_country_affiliation_by_count": """SELECT country_name AS country, affiliation_name AS affiliation,
  count(DISTINCT author_id) AS total_awardees FROM star GROUP BY ALL""",
        "rpt_country_totals": """SELECT country_name AS country, count(award_id) AS total_awards,
  count(DISTINCT author_id) AS unique_awardees FROM star GROUP BY ALL""",
        "rpt_award_detail": """SELECT award_id, full_name AS author_name, email_norm AS email,
  affiliation_name AS affiliation, country_name AS country, award_name AS award_type, session_topic AS research_area,
  assembly_number, award_year, presentation_type FROM star""",
        "rpt_country_lists": f"""SELECT country_name AS country, count(DISTINCT award_id) AS total_awards,
  {_list('full_name', 'authors')}, {_list('email_norm', 'emails')}, {_list('session_topic', 'research_areas')}
FROM {_folded('star', 'country_name', 'full_name', 'email_norm', 'session_topic')} GROUP BY country_name""",
        "rpt_country_list_values": _long_lists("star", "country_name", "country", _PEOPLE),
        "rpt_affiliation_list_values": _long_lists(
            "star_of", "affiliation_name", "affiliation_name", {**_PEOPLE, "award_names": "award_name"}
        ),
        "rpt_author_lists": f"""SELECT country_name AS country, full_name AS author_name, email_norm AS email,
  {_list('session_topic', 'research_areas')}, count(DISTINCT award_id) AS total_awards
FROM {_folded('star', 'country_name, full_name, email_norm', 'session_topic')} GROUP BY country_name, full_name, email_norm""",
        "rpt_country_affiliation_rank": f"""SELECT affiliation_name, count(DISTINCT author_id) AS awardees,
  count(DISTINCT award_id) AS awards, min(award_year) AS first_year, max(award_year) AS last_year,
  {_list('session_topic', 'research_areas')}, {_list('award_name', 'award_names')}
FROM {_folded('star_of', 'affiliation_id', 'session_topic', 'award_name')} GROUP BY affiliation_id, affiliation_name""",
        "rpt_country_award_detail": f"SELECT {detail} FROM star_of",
        "rpt_affiliation_award_detail": f"SELECT {detail} FROM star_of WHERE affiliation_name = '{affiliation}'",
        "rpt_affiliation_lists_distinct": f"""SELECT affiliation_name, count(DISTINCT award_name) AS total_awards,
  {_lists('DISTINCT ')}
FROM {_folded('star_of', 'affiliation_name', 'full_name', 'email_norm', 'session_topic', 'award_name')} GROUP BY affiliation_name""",
        "rpt_affiliation_lists_all": f"""SELECT affiliation_name, count(award_name) AS total_awards,
  {_lists('')} FROM star_of GROUP BY affiliation_name""",
    }
    steps = _steps(years, country)
    return {name: statement(body, steps) for name, body in queries.items()}
