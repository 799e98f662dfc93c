"""Brokerage warehouse building blocks for Spark: sources, operators, rules and load plans."""

from ledgerloom.functions.cleanse import gender, low_grade, phone
from ledgerloom.functions.rules import nameplate, register_sql_functions
from ledgerloom.operators.changelog import cascade, collapse_changes, replay, route
from ledgerloom.operators.lookup import (
    code_lookup,
    date_time_keys,
    derived_key,
    enrich_on,
    id_or_name_lookup,
    lookup_default,
    merge_join,
    semi_join,
    star_lookup,
    temporal_lookup,
)
from ledgerloom.operators.ordered import ordered_scan, sort_position, surrogate_key, version_number
from ledgerloom.operators.quality import check, reconcile, status_message
from ledgerloom.operators.scd import latest_per, scd2
from ledgerloom.operators.upsert import open_close, second_sighting, update_from, upsert
from ledgerloom.sources.readers import (
    delimited,
    fixed_width,
    read_delimited,
    read_fixed_width,
    read_xml_records,
    read_xml_rows,
    sort_text_file,
    xml_rows,
)

__all__ = [
    "cascade", "check", "code_lookup", "collapse_changes", "date_time_keys", "delimited", "derived_key", "enrich_on",
    "fixed_width", "gender", "id_or_name_lookup", "latest_per", "lookup_default", "low_grade", "merge_join", "nameplate",
    "open_close", "ordered_scan", "phone", "read_delimited", "read_fixed_width", "read_xml_records", "read_xml_rows",
    "reconcile", "register_sql_functions", "replay", "route", "scd2", "second_sighting", "semi_join", "sort_position",
    "sort_text_file", "star_lookup", "status_message", "surrogate_key", "temporal_lookup", "update_from", "upsert",
    "version_number", "xml_rows",
]
