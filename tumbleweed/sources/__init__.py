from tumbleweed.sources.records import decode_records, read_records
from tumbleweed.sources.events import parse_events, EVENT_COLUMNS
from tumbleweed.sources.specs import SPEC_SCHEMA, specs_from_json, read_specs

__all__ = [
    "decode_records", "read_records", "parse_events", "EVENT_COLUMNS",
    "SPEC_SCHEMA", "specs_from_json", "read_specs",
]
