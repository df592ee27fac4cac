"""Spelling variants by permuterm rotations.

Each word is closed by a terminator and rotated to every place. A rotation ``v$uc``
of the word ``ucv`` is what comes after an edited character ``c`` and around to
it, so the words that differ from ``ucv`` in that one character are the rotations
that begin with ``v$u`` and have one character more, and the word that lacks it
is the rotation ``v$u`` itself. Every rotation is therefore filed twice: under
its prefix without the last character, and whole. The rows are dealt and sorted
by that prefix; a group is a scan over neighbours in the sort order.

A group holds at most one whole rotation and one word per letter of the
alphabet, so no group grows with the corpus. No pairs are written: a group tells
each of its members how many others are near and which is the most frequent.
A pair is met once. Words of one length differ in one place only, and of the
places whose removal gives the same shorter word (a run of one letter) only the
last is filed as a removal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from egoline.llm.common import id_text, written

#: Letters of a word; the class is fixed by the task.
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "$"
#: Of so many words on average one loses a letter, as the task has it.
TYPO = 31


def words(docs: DataFrame, least_length: int = 7, least_count: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: runs of letters of all texts, A-Z lower-cased, a letter removed where the hash of id and run says so."""
    run = F.explode(F.regexp_extract_all("text", F.lit(f"({RUN}{{{least_length},}})"), F.lit(1)))
    runs = id_text(docs, id_col, text_col).select("doc_id", run.alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % TYPO == 0, cut).otherwise(F.col("run"))
    return (runs.withColumn("h", h).select(word.alias("word")).filter(F.length("word") >= least_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count))


def rotations(counted: DataFrame) -> DataFrame:
    """``key, whole, last_of_run, word, n``: every rotation under itself (``whole``) and under itself without its last character."""
    closed = F.concat(F.col("word"), F.lit(END))
    size = F.length("word")

    def filed(i):  # the rotation that ends with character i (from 1); the last one ends with the terminator and has no edited character
        turned = F.concat(F.substr(closed, i + 1), F.substr(closed, F.lit(1), i))
        letter = F.substr(closed, i, F.lit(1))
        return F.when(i <= size, F.array(
            F.struct(F.substr(turned, F.lit(1), size).alias("key"), F.lit(False).alias("whole"),
                     (letter != F.substr(closed, i + 1, F.lit(1))).alias("last_of_run")),
            F.struct(turned.alias("key"), F.lit(True).alias("whole"), F.lit(False).alias("last_of_run")),
        )).otherwise(F.array(F.struct(turned.alias("key"), F.lit(True).alias("whole"), F.lit(False).alias("last_of_run"))))
    each = F.explode(F.flatten(F.transform(F.sequence(F.lit(1), size + 1), filed)))
    return counted.select(each.alias("r"), "word", "n").select("r.key", "r.whole", "r.last_of_run", "word", "n")


def near_words(counted: DataFrame) -> DataFrame:
    """``word, n_near, best`` for every word with a near one; ``best`` has ``minus_n`` and ``word`` of the most frequent."""
    group = Window.partitionBy("key")
    member = F.struct((-F.col("n")).alias("minus_n"), "word", "last_of_run", "whole")
    groups = (rotations(counted).withColumn("size", F.count(F.lit(1)).over(group)).filter("size > 1")
              .groupBy("key").agg(F.sort_array(F.collect_list(member)).alias("g")))  # bounded by the alphabet
    groups = groups.select(F.filter("g", lambda m: ~m["whole"]).alias("g"), F.get(F.filter("g", lambda m: m["whole"]), F.lit(0)).alias("shorter"))
    groups = groups.withColumn("longer", F.filter("g", lambda m: m["last_of_run"]))
    name = lambda m: F.struct(m["minus_n"].alias("minus_n"), m["word"].alias("word"))
    other = lambda m: F.when(F.get("g", F.lit(0))["word"] == m["word"], F.get("g", F.lit(1))).otherwise(F.get("g", F.lit(0)))
    indel = lambda m: F.when(m["last_of_run"] & F.col("shorter").isNotNull(), F.col("shorter"))
    told = F.transform("g", lambda m: F.struct(
        m["word"].alias("word"), (F.size("g") - 1 + indel(m).isNotNull().cast("int")).cast("long").alias("n_near"),
        F.array_min(F.filter(F.array(name(other(m)), name(indel(m))), lambda x: x["word"].isNotNull())).alias("best")))
    short = F.struct(F.col("shorter.word").alias("word"), F.size("longer").cast("long").alias("n_near"), name(F.get("longer", F.lit(0))).alias("best"))
    rows = groups.select(F.explode(F.concat(told, F.filter(F.array(short), lambda m: m["word"].isNotNull()))).alias("r")).select("r.*")
    return rows.filter("n_near > 0").groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def variants(docs: DataFrame, factor: int = 10, least_length: int = 7, least_count: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the table.

    A word is near another one that differs in exactly one inserted, deleted or
    replaced code point. ``form`` is the most frequent near word (ties: the
    smallest), if it is ``factor`` times as frequent as the word; ``root`` is
    where following the forms ends. Null and empty texts have no words; a run of
    letters of any length is one word; a document without an id loses no letters;
    repeated rows count each. An empty table gives an empty result. Columns other
    than the id and the text are ignored.
    """
    counted = written(words(docs, least_length, least_count, id_col, text_col), "words")
    near = near_words(counted).select(F.col("word").alias("of"), "n_near", F.col("best.word").alias("best"), (-F.col("best.minus_n")).alias("best_n"))
    known = counted.join(near, F.col("word") == F.col("of"), "left")
    is_form = F.col("best_n") >= factor * F.col("n")
    known = written(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
                                 F.when(is_form, F.col("best_n")).alias("form_n")), "variants")
    return known.join(roots(known), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(known: DataFrame) -> DataFrame:
    """``word, root`` for every word with a form. Chains climb in frequency, so they end; each round doubles the steps."""
    at = written(known.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        nxt = at.join(at.select(F.col("word").alias("root"), F.col("root").alias("beyond")), "root", "left")
        new = written(nxt.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if not new.filter("moved").limit(1).count():
            return new.select("word", "root")
        at = new.select("word", "root")
