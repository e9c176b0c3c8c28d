"""Pure column functions (no actions, no Python on rows)."""

from keyledger.functions.columns import *  # noqa: F401,F403
from keyledger.functions.constants import *  # noqa: F401,F403
