"""Command line: the batch jobs and the serving queries, for spark-submit.

    egoline edges   --src 'hdfs:///timeline/2015-*' --variant v1 --part 2015 --edges /tables/edges
    egoline expire  --table /tables/edges
    egoline follows --topics-root /landed --topic scrap-following-3:f1 \
                    --topic scrap-following-7:f2 --userfollow /tables/userfollow
    egoline userids --users /landed --topic users --ids /tables/getuserid
    egoline trends  --edges /tables/edges --trends /tables/weeklytrends --top /tables/top10
    egoline land    --src /incoming --out /landed --checkpoint /ckpt/land --allow '^scrap-'
    egoline ego     --edges /tables/edges --userfollow /tables/userfollow \
                    --year 2014 [--user alice --user bob] --out /answers/ego
    egoline trending --top /tables/top10 --out /answers/trending
    egoline userid  --ids /tables/getuserid --user alice --out /answers/ids

where ``egoline`` stands for ``spark-submit --py-files egoline.zip egoline/__main__.py``
on a cluster, or ``python -m egoline`` on a local session. Answers are written as
JSON lines (one row per seed / request), never collected.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from egoline import schemas
from egoline.operators import follows as FL
from egoline.operators import graph as G
from egoline.operators import lookup as L
from egoline.operators import trends as TR
from egoline.plans import jobs, serving
from egoline.session import DEFAULT_CONF, ensure_checkpoint_dir, release_scratch
from egoline.sources import readers as R
from egoline.sources.snapshots import expire
from egoline.streaming import land_topics, topic_stream
from egoline.streaming.landing import TASK_BYTES


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="egoline")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("edges", help="normalise one year's timeline into the edge table")
    p.add_argument("--src", required=True)
    p.add_argument("--variant", required=True, choices=["v1", "v2", "v3"])
    p.add_argument("--part", required=True)
    p.add_argument("--edges", required=True, help="root of the edge tables; rejects are committed beside the edges")
    p.add_argument("--on-reject", default="skip", choices=["skip", "fail"])
    p.add_argument("--repartition", type=int)

    p = sub.add_parser("follows", help="landed follow topics -> userfollow (upsert)")
    p.add_argument("--topics-root", required=True)
    p.add_argument("--topic", action="append", required=True, help="name:f1|f2, in precedence order")
    p.add_argument("--userfollow", required=True, help="its committed version is read, the next one committed")

    p = sub.add_parser("userids", help="landed user records -> getuserid (upsert)")
    p.add_argument("--users", required=True, help="landed topic root")
    p.add_argument("--topic", required=True)
    p.add_argument("--ids", required=True, help="its committed version is read, the next one committed")
    p.add_argument("--lo", type=int)
    p.add_argument("--hi", type=int)

    p = sub.add_parser("trends", help="weekly trends and top 10 from the edge table")
    p.add_argument("--edges", required=True)
    p.add_argument("--trends", required=True)
    p.add_argument("--top", required=True)
    p.add_argument("--as-of")
    p.add_argument("--days", type=int, default=7)

    p = sub.add_parser("land", help="land topic messages into hourly folders")
    p.add_argument("--src", help="folder of a file source")
    p.add_argument("--format", default="json")
    p.add_argument("--option", action="append", default=[], help="key=value for the source, such as kafka.bootstrap.servers=host:9092")
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--allow")
    p.add_argument("--deny", action="append", default=[])
    p.add_argument("--task-bytes", type=int, default=TASK_BYTES, help="bytes that one task writes at most")

    p = sub.add_parser("ego", help="ego-graph answers as JSON lines")
    p.add_argument("--edges", required=True)
    p.add_argument("--userfollow", required=True)
    p.add_argument("--year", required=True)
    p.add_argument("--user", action="append", help="seed user (repeatable); all users when absent")
    p.add_argument("--form", default="api", choices=["api", "tree"])
    p.add_argument("--out", required=True)

    p = sub.add_parser("trending", help="trending answer as one JSON line")
    p.add_argument("--top", required=True)
    p.add_argument("--out", required=True)

    p = sub.add_parser("expire", help="drop old commits and the files only they name")
    p.add_argument("--table", required=True)
    p.add_argument("--keep", type=int, default=2)

    p = sub.add_parser("userid", help="id lookups as JSON lines")
    p.add_argument("--ids", required=True)
    p.add_argument("--user", action="append", required=True)
    p.add_argument("--out", required=True)

    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"egoline-{a.cmd}").getOrCreate()
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)

    if a.cmd == "edges":
        jobs.yearly_edges_job(spark, a.src, a.variant, a.part, a.edges,
                              repartition=a.repartition, on_reject=a.on_reject)
    elif a.cmd == "follows":
        topics = [tuple(t.split(":", 1)) for t in a.topic]
        jobs.follows_job(spark, a.topics_root, topics, a.userfollow)
    elif a.cmd == "userids":
        users = R.read_topic(spark, a.users, topic=a.topic, schema=schemas.USER)
        jobs.user_ids_job(spark, users, a.ids, lo=a.lo, hi=a.hi)
    elif a.cmd == "trends":
        jobs.trends_job(spark, a.edges, a.trends, a.top, as_of=a.as_of, days=a.days)
    elif a.cmd == "land":
        options = dict(o.split("=", 1) for o in a.option)
        land_topics(topic_stream(spark, a.format, a.src, options), a.out, a.checkpoint, allow=a.allow,
                    deny=a.deny, task_bytes=a.task_bytes).awaitTermination()
    elif a.cmd == "ego":
        if a.user:
            answers = serving.ego_answers(spark, a.userfollow, a.edges, a.user, a.year, form=a.form)
        else:
            follows = FL.follow_edges(R.read_table(spark, a.userfollow))
            answers = G.ego_json(follows, R.read_edges(spark, a.edges), label=a.year, form=a.form)
        answers.write.mode("overwrite").json(a.out)
    elif a.cmd == "expire":
        expire(spark, a.table, keep=a.keep)
    elif a.cmd == "trending":
        TR.trending_json(R.read_table(spark, a.top)).write.mode("overwrite").json(a.out)
    elif a.cmd == "userid":
        L.lookup_ids(serving.named(spark, a.user), serving.rows_of(spark, a.ids, serving.named(spark, a.user))).write.mode("overwrite").json(a.out)
    release_scratch(spark)


if __name__ == "__main__":
    main()
