"""Paged follow responses and stored follow pages.

Stitching: a user's pages are concatenated in page order until the first
empty page or the first missing page number. A page number that was fetched
more than once counts once, the newest fetch. The API crawler kept pages 1 to 9
only: pass ``max_pages`` for its results; the default stitches every page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from egoline.functions import columns as C
from egoline.operators.markup import extract_follow_links, with_follow_links  # noqa: F401
from egoline.operators.ordered import preceded, stored


def stitch_pages(pages: DataFrame, max_pages: int | None = None, login: str = "login",
                 page: str = "page", response: str = "response", users: DataFrame | None = None,
                 fetched: str | None = None, keep=()) -> DataFrame:
    """``(login, page, response array)`` -> ``(login, *keep, following, n_following)``.

    Every user present in ``pages`` is kept; a user whose first page is empty
    or missing gets ``[]``. With ``users`` (first column: logins), users that
    have no page rows at all are added with ``[]`` too. Of several rows of one
    page the one with the greatest ``fetched`` counts (then, or without that
    column, the greatest response). A null response is a failed call and ends
    the list like a missing page. ``keep`` names columns of the user, such as
    the id, that the stitched record carries on.
    """
    in_range = F.col(page) >= 1 if max_pages is None else F.col(page).between(1, max_pages)
    newest = F.struct(*([F.col(fetched).alias("at")] if fetched else []), F.col(response).alias("r"))
    kept = [F.max(c).alias(c) for c in keep]
    one = pages.groupBy(F.col(login).alias("login"), F.when(in_range, F.col(page)).alias("p")).agg(F.max(newest)["r"].alias("r"), *kept)
    entry = F.when(F.col("p").isNotNull(), F.struct("p", "r"))
    g = one.groupBy("login").agg(F.array_sort(F.collect_list(entry)).alias("ps"), *kept)
    ok = F.transform("ps", lambda x, i: (x["p"] == i + 1) & (F.coalesce(F.size(x["r"]), F.lit(0)) > 0))
    first_bad = F.array_position(ok, False)
    k = F.when(first_bad == 0, F.size("ps")).otherwise(first_bad - 1)
    following = F.flatten(F.transform(F.slice("ps", 1, k), lambda x: x["r"]))
    following = F.coalesce(following, F.array().cast("array<string>"))
    out = g.select("login", *keep, following.alias("following"))
    if users is not None:
        u = users.select(F.col(users.columns[0]).alias("login")).distinct()
        out = u.join(out, "login", "left").select(
            "login", *keep, F.coalesce("following", F.array().cast("array<string>")).alias("following"))
    return out.select("login", *keep, "following", F.size("following").alias("n_following"))


def stitch_pages_long(pages: DataFrame, max_pages: int | None = None, login: str = "login", page: str = "page",
                      response: str = "response", fetched: str | None = None) -> DataFrame:
    """``(login, pos, followee)``: the lists of :func:`stitch_pages`, one row per entry, ``pos`` from 1.

    No user's pages are gathered. The first gap is the least page that is good (or
    zero, before the first) with no good page after it: an anti join on page + 1
    and a minimum that combines map-side. Positions are sums of the pages' sizes in
    a range sort.
    """
    in_range = F.col(page) >= 1 if max_pages is None else F.col(page).between(1, max_pages)
    newest = F.struct(*([F.col(fetched).alias("at")] if fetched else []), F.col(response).alias("r"))
    one = (pages.filter(in_range).groupBy(F.col(login).alias("login"), F.col(page).cast("long").alias("p"))
           .agg(F.max(newest)["r"].alias("r")).withColumn("size", F.coalesce(F.size("r"), F.lit(0))))
    good = stored(one.filter("size > 0"), "good-pages")
    ends = good.select("login", "p").unionByName(good.select("login", F.lit(0).cast("long").alias("p")).distinct())
    after = good.select("login", (F.col("p") - 1).alias("p"))
    gap = stored(ends.join(after, ["login", "p"], "left_anti").groupBy("login").agg((F.min("p") + 1).alias("gap")), "gaps")
    kept = good.join(gap, "login").filter("p < gap").select("login", "p", "r", "size")
    placed = preceded(kept, ["login"], ["p"], "size")
    return placed.select("login", "before", F.posexplode("r").alias("i", "followee")).select(
        "login", (F.col("before") + F.col("i") + 1).alias("pos"), "followee")


def extract_links(pages: DataFrame, pattern: str, key: str = "url", html: str = "html",
                  strip: int = 1) -> DataFrame:
    """``(key, pos, slug, text)`` for every link matched by ``pattern`` in a page.

    ``pattern`` has two groups: the link target and the link text. The slug is
    the target without its first ``strip`` characters (the leading ``/``).
    """
    hrefs = F.regexp_extract_all(F.col(html), F.lit(pattern), 1)
    texts = F.regexp_extract_all(F.col(html), F.lit(pattern), 2)
    z = pages.select(F.col(key), F.posexplode(F.arrays_zip(hrefs.alias("h"), texts.alias("t"))).alias("pos", "z"))
    slug = F.col("z.h")
    for _ in range(strip):
        slug = C.strip_first(slug)
    return z.select(key, (F.col("pos") + 1).alias("pos"), slug.alias("slug"), F.col("z.t").alias("text"))


def follow_pages_from_html(pages: DataFrame, pattern: str | None = None, login: str = "login", page: str = "page",
                           html: str = "html", max_pages: int | None = None) -> DataFrame:
    """Stored follow pages ``(login, page, html)`` -> stitched follow lists: the
    follow links of each page become its response (those matched by ``pattern``
    where one is given), then :func:`stitch_pages` applies the empty-page and
    page-gap rules. The scraper followed pages until an empty one, so there is
    no page cap by default."""
    if pattern is None:
        rows = with_follow_links(pages.select(login, page, html), html)
        rows = rows.select(login, page, F.transform("links", lambda x: x["slug"]).alias("response"))
    else:
        resp = F.transform(F.regexp_extract_all(F.col(html), F.lit(pattern), 1), lambda h: C.strip_first(h))
        rows = pages.select(login, page, resp.alias("response"))
    return stitch_pages(rows, max_pages, login, page, "response")
