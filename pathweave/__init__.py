"""Nested JSON and CSV messages on Spark: validate, page, flatten, transform, rebuild."""

from .operators.csv_lines import decode_csv, encode_csv
from .operators.dead_letters import accepted, dead_letters, encode_dlq
from .operators.flatten import EXCLUDE, INCLUDE, REPLACE_EMPTY_STRING, explode_leaves, flatten_json, flatten_pages
from .operators.mapping import map_fields, project_entries
from .operators.paginate import PageNames, paginate, split_to_json
from .operators.parse import parse_messages
from .operators.transform import observe_fields, transform_fields
from .operators.unflatten import unflatten
from .operators.validate import validate_items, validate_messages, validate_required
from .plans.flow import FlowConfig, chained, outcomes, run_flow, validate_split_flatten
from .session import prepare
from .sources.messages import read_messages, to_envelope
