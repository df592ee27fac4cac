from egoline.functions.columns import (  # noqa: F401
    follows_from_json, follows_from_structs, follows_until_bad, login_from_json, name_from_json,
    owner_slash_name, parse_created_at, strip_first,
)
