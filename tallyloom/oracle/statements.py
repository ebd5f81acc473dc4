"""All check statements, with the parameters of the registered queries."""

from __future__ import annotations

from tallyloom.operators.campaign import CONTACT_NAMES
from tallyloom.oracle.campaigns import campaigns
from tallyloom.oracle.marketing import insights, reports
from tallyloom.oracle.primitives import primitives
from tallyloom.oracle.warehouse import warehouse
from tallyloom.params import DateWindow
from tallyloom.plans import registry as r
from tallyloom.sources.testdata import MAILERS


def _text(window: DateWindow) -> tuple[str, str]:
    return window.start.isoformat(), window.end.isoformat()


def statements() -> dict[str, str]:
    conversion = reports(*_text(r.ABSTRACTS), _text(r.INVOICES))
    return {
        **conversion,
        **insights(_text(r.ABSTRACTS), _text(r.LAST_12M)),
        **warehouse(r.ASSEMBLY_YEARS, r.COUNTRY, r.AFFILIATION),
        **campaigns(
            _text(r.ABSTRACTS), _text(r.YES), _text(r.YES_SINCE), _text(r.YES_OPEN), _text(r.LATER_ABSTRACTS),
            MAILERS, r.FOLLOW_UPS, r.EXTENDED_FIELDS, CONTACT_NAMES,
        ),
        **primitives(),
        "io03_create_table_as": conversion["mkt_country_event"],
    }
