"""From a dirty staging table to dimensions with surrogate keys and a fact table.

Names are matched by ``norm_key`` and identities by ``person_key``. Dimensions
store the key they are matched by next to the shown name. No join is forced to
broadcast: Spark does so where the size of a side allows it, and otherwise sorts
both sides and splits an outsized key on the staging side, which is always the
left one.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import (
    blank_to_null,
    ci_key,
    code_from_hash,
    code_from_id,
    has_address,
    norm_key,
    not_blank,
    person_key,
    person_key_without_context,
    plain_address,
)
from tallyloom.operators.keys import assign_surrogate_keys, number_missing
from tallyloom.sources.tables import delete_where, stage

# Meetings whose year is set by hand.
ASSEMBLY_YEARS = {
    "57th AMC": 2023,
    "64th AMC": 2025,
    "Ningbo conference": 2025,
    "Advanced Materials Lecture Series": 2025,
}


@dataclass(frozen=True)
class Dimensions:
    country: DataFrame
    affiliation: DataFrame
    award_type: DataFrame
    author: DataFrame
    # The column of ``author`` that holds the identity.
    author_key: str = "email_norm"

    def with_author(self, author: DataFrame, author_key: str) -> "Dimensions":
        return replace(self, author=author, author_key=author_key)


def with_year_overrides(staging: DataFrame, years: dict[str, int] = ASSEMBLY_YEARS) -> DataFrame:
    """Set the year of the listed meetings; ``years`` is a short hand-kept map."""
    year, meeting = F.col("award_year"), ci_key(F.col("assembly_number"))
    for name, value in years.items():
        year = F.when(meeting == ci_key(F.lit(name)), F.lit(value)).otherwise(year)
    return staging.withColumn("award_year", year)


def build_dimension(rows: DataFrame, text: str, member: str, within: list[str] | None = None) -> DataFrame:
    """Distinct non-blank values of a text column, one per matching key.

    ``within`` names columns a value is distinct within (a country, for example).
    """
    within = within or []
    keyed = rows.select(*within, norm_key(F.col(text)).alias(f"{member}_key"), F.trim(text).alias("shown"))
    # Distinct first: texts repeat, and a minimum of texts would sort every row.
    return keyed.filter(F.col(f"{member}_key") != "").distinct().groupBy(*within, f"{member}_key").agg(
        F.min("shown").alias(f"{member}_name")
    )


def dim_country(staging: DataFrame) -> DataFrame:
    return assign_surrogate_keys(build_dimension(staging, "country", "country"), ["country_key"], "country_id")


def dim_affiliation(staging: DataFrame, country: DataFrame) -> DataFrame:
    """Affiliations within countries."""
    rows = staging.withColumn("country_key", norm_key(F.col("country")))
    members = build_dimension(rows, "affiliation", "affiliation", ["country_key"])
    placed = members.join(country.select("country_id", "country_key"), "country_key").drop("country_key")
    return assign_surrogate_keys(placed, ["affiliation_key", "country_id"], "affiliation_id")


def dim_author(staging: DataFrame) -> DataFrame:
    """Authors by e-mail as given, whether or not it is a usable address."""
    given = staging.filter(not_blank(F.col("email")))
    pairs = given.select(plain_address(F.col("email")).alias("email"), F.trim("name").alias("name")).distinct()
    members = pairs.groupBy("email").agg(F.min("name").alias("full_name"))
    return assign_surrogate_keys(members.select("full_name", "email"), ["email"], "author_id")


def dim_award_type(staging: DataFrame) -> DataFrame:
    """Award types with codes ``AWD001``, ``AWD002`` ..."""
    members = build_dimension(staging, "award_certificate_type", "award")
    numbered = assign_surrogate_keys(members, ["award_key"], "award_type_id")
    return numbered.withColumn("award_code", code_from_id("AWD", F.col("award_type_id")))


def missing_award_types(staging: DataFrame, award_type: DataFrame) -> DataFrame:
    """Award names not in the dimension, with a code from the name's hash."""
    members = build_dimension(staging, "award_certificate_type", "award")
    return members.join(award_type.select("award_key"), "award_key", "left_anti").select(
        code_from_hash("AWD_", F.col("award_name")).alias("award_code"), "award_name", "award_key"
    )


def _person(null_as: str | None) -> Column:
    return person_key(F.col("email"), F.col("name"), F.col("affiliation"), F.col("country"), null_as)


def people_strict(staging: DataFrame) -> DataFrame:
    """One row per identity; rows with a missing part and no address have none."""
    rows = staging.select(F.trim("name").alias("full_name"), _person(None).alias("email"))
    return rows.filter("email IS NOT NULL").distinct().groupBy("email").agg(F.min("full_name").alias("full_name"))


def build_people(staging: DataFrame) -> DataFrame:
    """One row per identity: smallest name, a real e-mail if there is any, and a pseudo flag."""
    real = has_address(F.col("email"))
    rows = staging.select(
        _person("unknown").alias("email_norm"),
        F.coalesce(blank_to_null(F.col("name")), F.lit("Unknown")).alias("full_name"),
        F.when(real, plain_address(F.col("email"))).alias("email_raw"),
        real.alias("is_real"),
    )
    people = rows.distinct().groupBy("email_norm").agg(
        F.min("full_name").alias("full_name"),
        F.max("email_raw").alias("email_raw"),
        F.when(F.bool_or("is_real"), 0).otherwise(1).alias("email_is_pseudo"),
    )
    return delete_where(people, F.col("email_norm").isNull() | (F.col("email_norm") == ""))


def add_people(author: DataFrame, staging: DataFrame) -> DataFrame:
    """The author dimension with the strict identities it lacks."""
    people = people_strict(staging).select("full_name", "email")
    return assign_surrogate_keys(people, ["email"], "author_id", author)


def split_email_columns(author: DataFrame) -> DataFrame:
    """Replace ``email`` by the raw address, the identity and a pseudo flag."""
    email = F.col("email")
    return author.select(
        "author_id",
        "full_name",
        blank_to_null(email).alias("email_raw"),
        person_key_without_context(email, F.col("full_name")).alias("email_norm"),
        F.when(has_address(email), 0).otherwise(1).alias("email_is_pseudo"),
    )


def merged_members(dim: DataFrame, new: DataFrame, key: str, id_name: str) -> DataFrame:
    """Known and new members side by side in one full outer join; new ones have no id yet.

    Known members take the new attributes where there are any. ``key`` is unique on both sides.
    """
    attributes = [c for c in dim.columns if c not in (key, id_name)]
    update = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in attributes])
    return dim.join(update, key, "full_outer").select(
        id_name, key, *[F.coalesce(f"_new_{c}", c).alias(c) for c in attributes]
    )


def upsert_dimension(dim: DataFrame, new: DataFrame, key: str, id_name: str) -> DataFrame:
    """Known members take the new attributes where there are any; others are added and numbered.

    Both sides are read once (``merged_members``).
    """
    return number_missing(merged_members(dim, new, key, id_name), [key], id_name).select(*dim.columns)


def with_match_keys(staging: DataFrame, person: Column) -> DataFrame:
    """Staging rows with the keys their dimension members are matched by."""
    return staging.withColumns({
        "country_key": norm_key(F.col("country")),
        "affiliation_key": norm_key(F.col("affiliation")),
        "award_key": norm_key(F.col("award_certificate_type")),
        "person_key": person,
    })


def with_dimension_ids(rows: DataFrame, dims: Dimensions) -> DataFrame:
    """Look up the four ids by match key; an id is NULL where no member matches."""
    homes = dims.country.select("country_id", "country_key")
    places = dims.affiliation.join(homes, "country_id").select("affiliation_key", "country_key", "affiliation_id")
    awards = dims.award_type.select("award_type_id", "award_key")
    authors = dims.author.select("author_id", F.col(dims.author_key).alias("person_key"))
    found = rows.join(places, ["affiliation_key", "country_key"], "left").join(homes, "country_key", "left")
    return found.join(awards, "award_key", "left").join(authors, "person_key", "left")


FACT_COLUMNS = [
    "award_id", "author_id", "affiliation_id", "country_id", "award_type_id", "assembly_number",
    "award_year", "session", "session_topic", "presentation_type", "certificate_number",
]


#: Fact ids of one load are the staging ids plus so many times its number; staging ids are smaller.
LOAD_STEP = 1 << 40


#: The identities an author can be looked up by.
IDENTITIES = {"by_email": lambda: plain_address(F.col("email")), "strict": lambda: _person(None), "lenient": lambda: _person("unknown")}


def located(staging: DataFrame, dims: Dimensions) -> DataFrame:
    """Staging rows with a country, an affiliation and an award type: all of a fact row but its author.

    The author's possible identities come along, so several loads can share one look-up of the rest.
    """
    keyed = with_match_keys(staging, F.lit(None).cast("string")).withColumns({f"_{n}": key() for n, key in IDENTITIES.items()})
    homes = dims.country.select("country_id", "country_key")
    places = dims.affiliation.join(homes, "country_id").select("affiliation_key", "country_key", "affiliation_id", "country_id")
    awards = dims.award_type.select("award_type_id", "award_key")
    found = keyed.join(places, ["affiliation_key", "country_key"]).join(awards, "award_key")
    return found.select(
        "id", "affiliation_id", "country_id", "award_type_id", *(f"_{n}" for n in IDENTITIES), *_shown()
    )


#: The texts a row's place and identity are made from.
PERSON_TEXTS = ["name", "email", "affiliation", "country"]


def person_texts(staging: DataFrame) -> DataFrame:
    """The distinct combinations of ``PERSON_TEXTS``: a person's many rows as a few."""
    return staging.select(*PERSON_TEXTS).distinct()


def award_texts(staging: DataFrame) -> DataFrame:
    return staging.select("award_certificate_type").distinct()


def identified(persons: DataFrame, dims: Dimensions, first: Dimensions, identity: str) -> DataFrame:
    """``person_texts`` that have a place, with its ids and those of their authors.

    ``author_id`` is the author in ``first`` under ``identity``, whose key is unique there, or NULL. ``_lenient`` is kept
    where ``dims`` may name another author under it, and is NULL where it names that very one or none.
    """
    homes = dims.country.select("country_id", "country_key")
    places = dims.affiliation.join(homes, "country_id").select("affiliation_key", "country_key", "affiliation_id", "country_id")
    authors = first.author.select("author_id", F.col(first.author_key).alias("_identity"))
    # An identity may have several authors; one row per identity here, so no row comes twice.
    named = dims.author.groupBy(F.col(dims.author_key).alias("_lenient")).agg(
        F.count("*").alias("_authors"), F.min("author_id").alias("_author")
    )
    # Keys are made where they are first needed: the code of one stage with all of them is too long to be compiled.
    placed = persons.withColumns({
        "country_key": norm_key(F.col("country")), "affiliation_key": norm_key(F.col("affiliation")),
    }).join(places, ["affiliation_key", "country_key"])
    known = placed.withColumn("_identity", IDENTITIES[identity]()).join(authors, "_identity", "left")
    found = known.withColumn("_lenient", IDENTITIES["lenient"]()).join(named, "_lenient", "left")
    same = (F.col("_authors") == 1) & F.col("author_id").eqNullSafe(F.col("_author"))
    open_ = F.col("_authors").isNotNull() & ~same
    return found.select(
        *PERSON_TEXTS, "affiliation_id", "country_id", "author_id", F.when(open_, F.col("_lenient")).alias("_lenient")
    )


def place_texts(staging: DataFrame, dims: Dimensions) -> DataFrame:
    """The combinations of affiliation and country, as given, that have a place, with its ids.

    The country is looked up first, then the affiliation in it: both are stored dimensions, whose sizes the planner
    knows; of a table of places joined here it would know none, and deal the texts out for it.
    """
    homes = dims.country.select("country_id", "country_key")
    places = dims.affiliation.select("affiliation_key", "country_id", "affiliation_id")
    texts = staging.select("affiliation", "country").distinct()
    at_home = texts.withColumn("country_key", norm_key(F.col("country"))).join(homes, "country_key")
    at_place = at_home.withColumn("affiliation_key", norm_key(F.col("affiliation"))).join(places, ["affiliation_key", "country_id"])
    return at_place.select("affiliation", "country", "affiliation_id", "country_id")


def known_identities(dims: Dimensions, first: Dimensions) -> DataFrame:
    """One row per identity that ``first`` or ``dims`` has an author of.

    ``author_id`` is the one in ``first``, whose key is unique there. ``_lenient`` is the identity where ``dims`` names
    anyone by it, ``_other`` where it may name another than that author.
    """
    authors = first.author.select(F.col(first.author_key).alias("_identity"), "author_id")
    # An identity may have several authors; one row per identity here, so no row comes twice.
    named = dims.author.groupBy(F.col(dims.author_key).alias("_identity")).agg(
        F.count("*").alias("_authors"), F.min("author_id").alias("_author")
    )
    same = (F.col("_authors") == 1) & F.col("author_id").eqNullSafe(F.col("_author"))
    there = F.col("_authors").isNotNull()
    return authors.join(named, "_identity", "full_outer").select(
        "_identity", "author_id", there.alias("_there"), (there & ~same).alias("_other")
    )


def _has_identity(identity: str) -> Column:
    """Whether the identity is there, without making it: making two in one stage is code too long to be compiled."""
    if identity == "strict":
        parts = F.col("name").isNotNull() & F.col("affiliation").isNotNull() & F.col("country").isNotNull()
        return has_address(F.col("email")) | parts
    return F.col("email").isNotNull() if identity == "by_email" else F.lit(True)


def _has_two(identity: str) -> Column:
    """True, never NULL, where the identity is there and may be another than the lenient one."""
    if identity == "strict":
        blank = [F.coalesce(F.trim(c) == "", F.lit(False)) for c in ("name", "affiliation", "country")]
        return ~has_address(F.col("email")) & (blank[0] | blank[1] | blank[2])
    return F.col("email").isNotNull() & ~has_address(F.col("email")) if identity == "by_email" else F.lit(False)


def located_once(staging: DataFrame, persons: DataFrame, dims: Dimensions, first: Dimensions, identity: str) -> DataFrame:
    """What two loads need of the staging rows: one by ``identity`` into ``first``, and the incremental one after it.

    Nearly every row has the same identity for both loads, or none for the first: such rows are dealt out once, by that
    identity and without the texts it is made from. The others are looked up per combination of texts (``identified``,
    from ``person_texts``). A row with an ``author_id`` is a row of the first load; one with ``_lenient`` is open to the
    second. The rest would meet their own fact row there.
    """
    own, two = _has_identity(identity), _has_two(identity)
    # The stored dimension has a size the planner knows; a table of award texts made here would be sorted with all rows.
    awards = dims.award_type.select("award_type_id", "award_key")
    named = staging.filter(not_blank(F.col("country")) & not_blank(F.col("affiliation"))).withColumn(
        "award_key", norm_key(F.col("award_certificate_type"))
    ).join(awards, "award_key")
    # Stored, so that a table of many identities is shuffled by itself and an outsized one split on the rows' side.
    known = stage(known_identities(dims, first), "identities")
    places = stage(place_texts(staging, dims), "places")
    keyed = named.filter(~two).join(places, ["affiliation", "country"]).withColumns({
        "_identity": IDENTITIES["lenient"](), "_own": own,
    })
    open_ = F.when(F.col("_own"), F.col("_other")).otherwise(F.col("_there"))
    by_identity = keyed.join(known, "_identity").withColumns({
        "author_id": F.when(F.col("_own"), F.col("author_id")), "_lenient": F.when(open_, F.col("_identity")),
    })
    texts = identified(persons.filter(two), dims, first, identity).withColumnsRenamed({c: f"_{c}" for c in PERSON_TEXTS})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PERSON_TEXTS]
    columns = ["id", "author_id", "_lenient", "affiliation_id", "country_id", "award_type_id", *_shown()]
    found = by_identity.select(*columns).unionByName(named.filter(two).join(texts, same).select(*columns))
    return found.filter("author_id IS NOT NULL OR _lenient IS NOT NULL")


def _shown() -> list[Column]:
    """The columns of a fact row that are not looked up."""
    texts = ("session", "session_topic", "presentation_type", "certificate_number")
    return [F.trim("assembly_number").alias("assembly_number"), F.col("award_year"), *[blank_to_null(F.col(c)).alias(c) for c in texts]]


def first_facts(rows: DataFrame) -> DataFrame:
    """Fact rows of the first load, from ``located_once``."""
    return rows.filter("author_id IS NOT NULL").withColumn("award_id", _fact_id(0)).select(*FACT_COLUMNS)


def later_facts(rows: DataFrame, dims: Dimensions, fact: DataFrame) -> DataFrame:
    """Fact rows of the incremental load after the first one, from ``located_once``; ``fact`` has the first one's."""
    return add_to_fact(rows.filter("_lenient IS NOT NULL").drop("author_id"), dims, fact)


def _fact_id(load_no: int) -> Column:
    """Made of the load's number and the staging row's id."""
    # Beyond the step, ids of one load would be those of another.
    outside = F.raise_error(F.concat(F.lit(f"staging ids must lie below {LOAD_STEP}: "), F.col("id").cast("string")))
    checked = F.when((F.col("id") >= 0) & (F.col("id") < LOAD_STEP), F.col("id")).otherwise(outside.cast("long"))
    return checked + load_no * LOAD_STEP


def with_authors(rows: DataFrame, dims: Dimensions, identity: str, load_no: int = 0) -> DataFrame:
    """Fact rows: ``located`` rows whose identity is in the author dimension.

    A fact row's id is made of the load's number and the staging row's id: the same whenever the load is
    repeated, and different where a later load takes a staging row again under another identity.
    """
    authors = dims.author.select("author_id", F.col(dims.author_key).alias(f"_{identity}"))
    found = rows.join(authors, f"_{identity}").withColumn("award_id", _fact_id(load_no))
    return found.select(*FACT_COLUMNS)


def load_fact_by_email(staging: DataFrame, dims: Dimensions) -> DataFrame:
    return with_authors(located(staging, dims), dims, "by_email")


def load_fact_by_person(staging: DataFrame, dims: Dimensions) -> DataFrame:
    return with_authors(located(staging, dims), dims, "strict")


_COMBINATION = ["author_id", "affiliation_id", "country_id", "award_type_id"]


def without_loaded(rows: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows whose ids and certificate are in no fact row; a missing certificate equals an empty one.

    ``rows`` are read twice, and best stored. First the fact rows they meet are taken, so that a batch of a size to be
    broadcast moves none of the fact table.
    """
    certificate = F.coalesce(blank_to_null(F.col("certificate_number")), F.lit("")).alias("_certificate")
    keys = [*_COMBINATION, "_certificate"]
    met = fact.select(*_COMBINATION, certificate).join(rows.select(*_COMBINATION, certificate), keys, "left_semi")
    return rows.withColumn("_certificate", certificate).join(met, keys, "left_anti").select(*rows.columns)


def load_fact_incremental(staging: DataFrame, dims: Dimensions, fact: DataFrame, load_no: int = 1) -> DataFrame:
    """Fact rows for the combinations ``fact`` lacks. Rows equal within the batch all come through.

    ``load_no`` differs from that of every earlier load.
    """
    return add_to_fact(located(staging, dims), dims, fact, load_no)


def add_to_fact(rows: DataFrame, dims: Dimensions, fact: DataFrame, load_no: int = 1) -> DataFrame:
    """``load_fact_incremental`` from rows already ``located``."""
    return without_loaded(stage(with_authors(rows, dims, "lenient", load_no), "batch"), fact)
