"""User id table and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.functions.constants import MSG_NOT_IN_DB


def id_range(df: DataFrame, col: str = "id", lo=None, hi=None) -> DataFrame:
    """Inclusive id-range shard filter (pushed into the scan)."""
    if lo is not None:
        df = df.filter(F.col(col) >= lo)
    if hi is not None:
        df = df.filter(F.col(col) <= hi)
    return df


def user_ids(df: DataFrame, login: str = "login", id_col: str = "id", lo=None, hi=None) -> DataFrame:
    """``(username, userid)`` from wide user records: two columns projected, so a
    columnar scan reads only those."""
    return id_range(df, id_col, lo, hi).select(F.col(login).alias("username"),
                                               F.col(id_col).cast("long").alias("userid"))


def lookup_ids(requests: DataFrame, ids: DataFrame) -> DataFrame:
    """``(username, userid, message)`` per requested name; ``message`` says the
    name is not in the database when there is no id.

    The id table is first cut to the requested names with a semi join: a
    small request batch is broadcast and the (large) id table is only
    scanned, never shuffled; the outer join then runs on the matches.
    """
    r = requests.select(F.col(requests.columns[0]).alias("username"))
    hits = ids.select("username", "userid").join(r.distinct(), "username", "left_semi")
    j = r.join(hits, "username", "left")
    msg = F.when(F.col("userid").isNull(),
                 F.format_string(MSG_NOT_IN_DB.replace("{user}", "%s"), "username"))
    return j.select("username", "userid", msg.alias("message"))
