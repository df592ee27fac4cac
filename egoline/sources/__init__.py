from egoline.sources.readers import (  # noqa: F401
    read_edges, read_table, read_timeline, read_topic, read_user_dumps,
)
from egoline.sources.sinks import (  # noqa: F401
    RejectedRows, enforce_rejects, to_messages, upsert, write_edges, write_messages,
    write_snapshot,
)
from egoline.sources.keyed import lookup, upsert_table  # noqa: F401
from egoline.sources.snapshots import Conflict, commit, current, expire, read_current  # noqa: F401
