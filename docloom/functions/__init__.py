"""Column-level helpers: JSON/VARIANT access, dates and seasons, stat text."""

from docloom.functions.json import (  # noqa: F401
    parse_doc, vpath, vstr, vlong, vdouble, vbool, varr, truthy, key_present, top_keys,
)
from docloom.functions.dates import (  # noqa: F401
    compact_date, date_range, season_end_year, season_bounds, parse_iso_instant, parse_user_date,
)
from docloom.functions.stats import (  # noqa: F401
    clock_seconds, signed_int, made_attempted,
)
