"""Fixed values.  These must equal the values the original jobs use, or the
keys, report lines and message sizes produced here would not match theirs."""

# --- fixed values: index key prefixes (field -> prefix) ---------------------
OTHER_ID_KEY = "__U:core:1:otherId"
USERNAME_KEY = "__U:core:1:username"
PHONE_KEY = "__U:contact:1:phone"

# --- fixed values: audit status texts ---------------------------------------
PASS = "Pass"
MISSING = "Missing"
QUERY_EXCEPTION = "Query Exception"
CONFLICT_FORMAT = "Conflict: existing [%s] populated [%s]"

# --- fixed values: message batching -----------------------------------------
IDS_PER_MESSAGE = 50
MESSAGES_PER_REQUEST = 10

# --- fixed values: version-1 time uuid epoch (1582-10-15) in 100 ns ticks ----
UUID_EPOCH_OFFSET = 122192928000000000

# --- fixed values: mock value makers and object-key prefix ------------------
MOCK_ID = "mock:id:"
MOCK_OTHER_ID = "mock:otherId:"
MOCK_USERNAME = "mock:username:"
MOCK_PHONE = "mock:verifiedPhone:"
OBJECT_KEY_PREFIX = "output/id/"

# Fields tracked by the fold, the family that carries them, the name of the
# property inside `$set`, and the index key prefix.
FIELDS = {
    "otherId": ("core", "otherId", OTHER_ID_KEY),
    "username": ("core", "username", USERNAME_KEY),
    "verifiedPhone": ("contact", "phone", PHONE_KEY),
}
FIELD_ORDER = ["otherId", "username", "verifiedPhone"]
