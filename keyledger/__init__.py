"""keyledger: identity-event analytics as Spark DataFrame plans.

Append-only user event logs are folded into the identifiers each user holds
now, turned into a key-to-owner index and its reverse lookup, audited against
existing indexes, upserted, reported, and cut into message batches.  Every
operator is a DataFrame transformation that Catalyst can see end to end.
"""

__version__ = "0.1.0"
