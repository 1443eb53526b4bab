"""Where documents come from: driver tables, landed JSON, fixture builders."""

from docloom.sources.tables import load_table, load_tables  # noqa: F401
from docloom.sources.landing import read_landed, write_landed  # noqa: F401
