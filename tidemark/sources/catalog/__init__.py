"""Table definitions of the known services, by service and table name."""

from __future__ import annotations

from tidemark.model import TableDef
from tidemark.sources.catalog import code_host, crm, example, payments, support

CATALOG: dict[str, dict[str, TableDef]] = {
    "example": example.TABLES,
    "github": code_host.TABLES,
    "hubspot": crm.TABLES,
    "stripe": payments.TABLES,
    "zendesk": support.TABLES,
}
