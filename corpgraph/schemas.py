"""Schemas of input tables, and the check that a table has the columns that a plan needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType


def strings(names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names.split()])


#: The committee master's fifteen fields, in file order.
COMMITTEE = strings("CMTE_ID CMTE_NM TRES_NM CMTE_ST1 CMTE_ST2 CMTE_CITY CMTE_ST CMTE_ZIP CMTE_DSGN CMTE_TP CMTE_PTY_AFFILIATION CMTE_FILING_FREQ ORG_TP CONNECTED_ORG_NM CAND_ID")
FILINGS = strings("company_name sec_filing_type raw_text")
ACTIVITY = strings("COMMITTEE_NAME TOTAL_AMOUNT HAS_DONATED FIRST_CYCLE LAST_CYCLE")
CROSSWALK = strings("TICKER COMPANY_NAME")
RECEIPTS = strings("TICKER ELECTION_CYCLE COMMITTEE_NAME COMMITTEE_TYPE_FULL PARTY_NAME_FULL RECEIPT_AMOUNT")
MESSAGES = strings("message_id internal_date_ms payload_json")
EVENT_FIELDS = "message_id email_date email_subject company industry subsidiary_of section_type event_type executive_name old_position new_position effective_date posted_date raw_event_text".split()


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def find_column(df: DataFrame, candidates: Sequence[str]) -> str:
    """The first candidate that the table has, whatever its case."""
    have = {c.lower(): c for c in df.columns}
    for c in candidates:
        if c.lower() in have:
            return have[c.lower()]
    raise ValueError(f"none of {', '.join(candidates)} in {', '.join(df.columns)}")
