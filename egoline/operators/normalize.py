"""Timeline normalisation: every schema variant to clean user-repository edges.

V1 (Dec 2011, 2015): ``actor`` and ``repo`` are objects.
V2 (2012): ``actor`` is a string holding JSON; ``repo`` an object.
V3 (2013, 2014): ``actor`` is the login itself; ``repository`` has owner and name.

Read with the all-string schema, objects arrive as raw JSON text and strings
unquoted, so V1 and V2 share one field picker and V3 has its own. Rows whose
user or repository cannot be found go to a rejects table with a reason
instead of failing the job or leaving a null key in a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from egoline import schemas
from egoline.functions import columns as C
from egoline.functions.constants import (
    ACTIVITY_TYPES, REJECT_BAD_TIME, REJECT_CORRUPT, REJECT_NULL_REPO, REJECT_NULL_USER,
)

VARIANTS = ("v1", "v2", "v3")


def keep_types(df: DataFrame, types=ACTIVITY_TYPES, keep_corrupt: bool = True) -> DataFrame:
    """Keep the given event types (one ``IN`` filter, pushed into the scan).

    This replaces three filtered copies of the input glued with UNION ALL,
    which Catalyst would scan three times. Corrupt lines have no type; they are
    kept (when present) so they can be reported as rejects.
    """
    cond = F.col("type").isin(list(types))
    if keep_corrupt and schemas.CORRUPT_COL in df.columns:
        cond = cond | F.col(schemas.CORRUPT_COL).isNotNull()
    return df.filter(cond)


def _fields(variant: str) -> tuple[Column, Column]:
    if variant in ("v1", "v2"):
        return C.login_from_json("actor"), C.name_from_json("repo")
    if variant == "v3":
        return (F.col("actor"),
                C.owner_slash_name(F.get_json_object("repository", "$.owner"),
                                   F.get_json_object("repository", "$.name")))
    raise ValueError(f"unknown timeline variant {variant!r}; expected one of {VARIANTS}")


def normalize(df: DataFrame, variant: str, part=None, types=ACTIVITY_TYPES,
              keep=()) -> DataFrame:
    """Timeline rows of one variant -> ``(username, repo, type, ts, part, reason, raw)``.

    ``reason`` is null for good rows, else ``corrupt`` / ``null_user`` / ``null_repo`` /
    ``bad_time`` (a creation time in no known format; an absent one is none);
    ``raw`` is the original line for rejects. ``part`` names the per-year table
    (a string or a Column). ``keep`` lists extra input columns to carry along.
    Use :func:`edges_and_rejects` to separate the two outputs.
    """
    user, repo = _fields(variant)
    has_corrupt = schemas.CORRUPT_COL in df.columns
    corrupt = F.col(schemas.CORRUPT_COL) if has_corrupt else F.lit(None).cast("string")
    if types is not None:
        df = keep_types(df, types)
    part_col = part if isinstance(part, Column) else F.lit(part).cast("string")
    reason = (F.when(corrupt.isNotNull(), F.lit(REJECT_CORRUPT))
              .when(user.isNull(), F.lit(REJECT_NULL_USER))
              .when(repo.isNull(), F.lit(REJECT_NULL_REPO)))
    created = F.col("created_at") if "created_at" in df.columns else F.lit(None).cast("string")
    ts = C.parse_created_at(created)
    reason = reason.when(created.isNotNull() & ts.isNull(), F.lit(REJECT_BAD_TIME))
    raw_fields = [F.col(c) for c in ("type", "actor", "repo", "repository", "created_at") if c in df.columns]
    raw = F.coalesce(corrupt, F.to_json(F.struct(*raw_fields)))
    return df.select(
        *[F.col(k) for k in keep],
        user.alias("username"),
        repo.alias("repo"),
        F.col("type"),
        ts.alias("ts"),
        part_col.alias("part"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), raw).alias("raw"),
    )


def edges_and_rejects(df: DataFrame, variant: str, part=None, types=ACTIVITY_TYPES, keep=()):
    """normalize + split: ``(edges[username, repo, type, ts, part], rejects[reason, raw, part])``."""
    n = normalize(df, variant, part, types, keep)
    edges = n.filter(F.col("reason").isNull()).drop("reason", "raw")
    rejects = n.filter(F.col("reason").isNotNull()).select(*keep, "reason", "raw", "part")
    return edges, rejects


def union_variants(frames) -> DataFrame:
    """Union normalised frames of several variants / years by column name."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
