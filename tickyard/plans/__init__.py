"""Registered query plans.  Importing this package fills the registry."""

from . import catalog  # noqa: F401
from . import q_bars  # noqa: F401
from . import q_columns  # noqa: F401
from . import q_quality  # noqa: F401
from . import q_tables  # noqa: F401
from . import q_reads  # noqa: F401
from . import q_stream  # noqa: F401
from . import q_health  # noqa: F401

QUERIES = catalog.QUERIES
ORACLE = catalog.ORACLE
