"""The operators applied to the driver's tables, each with SQL that gives the same rows."""

from .archive import ARCHIVE
from .claims import CLAIMS
from .logs import LOGS
from .texts import TEXTS

REGISTRIES = [ARCHIVE, TEXTS, LOGS, CLAIMS]
