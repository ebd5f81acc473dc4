"""The library's input tables as views over the given test tables.

``customer`` stands for users, ``orders`` for abstract submissions, registrations
and awards, the click ``events`` for mailings and form answers. Every view keeps
all rows of the table it is made from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Mailer tables by number; the names are those the campaign reports use.
MAILERS = {
    "emails2": 0,
    "emails2_": 1,
    "emails3": 2,
    "reminders": 3,
    "campaign_aml": 4,
    "campaign_amf": 5,
}


def _conference(number: str) -> str:
    """One of twelve conferences; two of them, -10 and -11, are not in the table of conferences."""
    return f"if({number} % 12 >= 10, -({number} % 12), {number} % 12)"


class TestTables:
    """Views over one scale-factor folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def countries(self) -> DataFrame:
        return self.raw("nation").selectExpr("n_nationkey AS id", "n_name AS name")

    def conferences(self) -> DataFrame:
        """Number 3 has no name; 4, 6 and 8 have one name in three spellings."""
        return self.raw("part").selectExpr(
            "p_partkey AS id",
            "CASE p_partkey WHEN 3 THEN NULL WHEN 4 THEN 'Joint Meeting' WHEN 6 THEN 'JOINT Mééting' WHEN 8 THEN 'joint meeting' "
            "ELSE p_name END AS name",
        )

    def users(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS id",
            "if(c_custkey % 23 = 0, NULL, substring(c_name, 1, 8)) AS first_name",
            "substring(c_name, 10) AS last_name",
            "if(c_custkey % 7 = 0, concat('  ', upper(replace(c_name, '#', '.')), '@EX.ORG '), "
            "concat(lower(replace(c_name, '#', '.')), '@ex.org')) AS email",
            "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '   ' "
            "ELSE concat(c_mktsegment, ' Lab ', c_custkey % 40) END AS affiliation",
            "if(c_custkey % 5 = 0, NULL, date_add(DATE'1950-01-01', CAST(c_custkey * 37 % 18000 AS int))) "
            "AS date_of_birth",
            "if(c_custkey % 17 = 0, NULL, c_nationkey) AS country_id",
            "date_add(DATE'1995-01-01', CAST(c_custkey * 13 % 2400 AS int)) AS created_at",
        )

    def abstracts(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS id",
            "o_custkey AS user_id",
            f"{_conference('o_orderkey')} AS event_id",
            "CAST(o_orderdate AS date) AS statusdate",
            "CAST(o_orderdate AS date) AS created_at",
        )

    def registrations(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS id",
            "o_custkey AS user_id",
            f"if(o_orderkey % 5 = 0, {_conference('(o_orderkey + 1)')}, {_conference('o_orderkey')}) AS event_id",
            "if(o_orderkey % 19 = 0, NULL, CAST(o_totalprice AS decimal(12,2))) AS total_price",
            "if(o_orderkey % 4 = 0, 'USD', 'EUR') AS currency_type",
            "if(o_orderstatus = 'F', 1, 0) AS status",
            "CAST(o_orderkey % 2 AS int) AS sendinvoice",
            "CAST(o_orderdate AS date) AS created_at",
            "date_add(CAST(o_orderdate AS date), CAST(o_orderkey % 30 AS int)) AS updated_at",
        )

    def _clicks_with_users(self) -> DataFrame:
        users = self.users().selectExpr("id AS user_id", "trim(email) AS address", "last_name", "affiliation")
        return self.raw("events").join(users, "user_id")

    def mailings(self) -> DataFrame:
        return self._clicks_with_users().selectExpr(
            "event_id AS id",
            "event_id % 6 AS mailer_no",
            "concat(' Dr <', address, '> ') AS to_address",
            "last_name AS p1",
            "if(event_id % 4 = 0, '  ', affiliation) AS p2",
            "props AS p3",
            "CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 10 = 1 THEN upper(event_type) ELSE event_type END AS p4",
            "if(event_id % 5 = 0, ' ', concat('batch ', event_id % 7)) AS p5",
            "event_type AS subject",
            "concat('template_', event_type) AS template_name",
            "if(event_id % 3 = 0, NULL, ts - INTERVAL 9000 DAY) AS date_sent",
            "ts - INTERVAL 9001 DAY AS date_added",
        )

    def mailed(self, *names: str) -> DataFrame:
        """The union of some mailer tables in one pass, each row tagged with its source."""
        source = F.create_map(*(F.lit(x) for name in names for x in (MAILERS[name], name)))[F.col("mailer_no").cast("int")]
        return self.mailings().filter(F.col("mailer_no").isin([MAILERS[n] for n in names])).withColumn("source", source).drop("mailer_no")

    def yes_no_form(self) -> DataFrame:
        return self._clicks_with_users().selectExpr(
            "event_id AS id",
            "if(event_id % 8 = 0, 'no-address', concat('Dr ', last_name, ' <', address, '>')) AS email",
            "CASE event_type WHEN 'signup' THEN ' YES ' WHEN 'click' THEN 'yes' WHEN 'error' THEN 'No' "
            "ELSE 'maybe' END AS response",
            "if(event_id % 6 = 0, '  ', last_name) AS full_name",
            "ts - INTERVAL 9000 DAY AS created_at",
        )

    def staging(self) -> DataFrame:
        """Award staging rows: padded names, odd cases, missing and unusable e-mails."""
        users = self.users().selectExpr("id AS c_custkey", "email AS user_email", "affiliation")
        people = self.raw("customer").join(users, "c_custkey").withColumnRenamed("c_nationkey", "n_nationkey")
        rows = self.raw("orders").withColumnRenamed("o_custkey", "c_custkey").join(people, "c_custkey").join(
            self.raw("nation"), "n_nationkey"
        )
        return rows.selectExpr(
            "o_orderkey AS id",
            "CAST(o_orderkey % 1000 AS int) AS s_no",
            "concat('A', o_orderkey % 9, ' AMC') AS assembly_number",
            "if(o_orderkey % 3 = 0, NULL, year(o_orderdate)) AS award_year",
            "if(c_custkey % 2 = 0, 'Prof.', 'Dr.') AS title",
            "if(o_orderkey % 41 = 0, '  ', if(o_orderkey % 10 = 3, upper(c_name), c_name)) AS name",
            "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
            "if(o_orderkey % 10 = 7, upper(affiliation), affiliation) AS affiliation",
            "CASE WHEN o_orderkey % 43 = 0 THEN ' ' WHEN c_custkey % 4 = 0 THEN concat(lower(n_name), '  ') ELSE n_name END "
            "AS country",
            "CASE WHEN o_orderkey % 31 = 0 OR c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 'n/a' "
            "ELSE user_email END AS email",
            "if(o_orderstatus = 'P', ' ', concat(o_orderstatus, ' talk')) AS presentation_type",
            "if(o_orderkey % 29 = 0, NULL, concat(' ', o_orderpriority, ' ')) AS award_certificate_type",
            "concat('C', o_orderkey) AS certificate_number",
            "concat(' Session ', o_orderkey % 4) AS session",
            "if(o_orderkey % 6 = 0, '', if(o_orderkey % 10 = 1, lower(c_mktsegment), c_mktsegment)) AS session_topic",
            "concat('On ', c_mktsegment) AS paper_title",
        )
