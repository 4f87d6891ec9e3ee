"""Column-level helpers (JVM-side built-ins only, no Python UDFs)."""

from tidemark.functions.lists import key_list, split_list, parse_json_map  # noqa: F401
from tidemark.functions.watermark import watermark_bound, parse_run_date  # noqa: F401
from tidemark.functions.typemap import map_types  # noqa: F401
