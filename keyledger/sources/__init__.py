"""Readers: table registry, event logs, text and message read-back."""

from keyledger.sources.tables import *  # noqa: F401,F403
from keyledger.sources.eventlog import *  # noqa: F401,F403
