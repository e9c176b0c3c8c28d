"""Writers: tables, text, versioned upserts, message outboxes."""

from keyledger.sinks.writers import *  # noqa: F401,F403
