"""Operator 2: removal of repeated runs of lines, found as content-defined chunks. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from signmine.llm.common import cut

#: One line in so many ends a chunk, on average.
DIVISOR = 3
#: Lines whose hashes the rolling hash spans.
WINDOW = 2
#: The rolling hash's base and modulus.
BASE, MODULUS = 31, 1_000_003


def _line_hashes(lines: Column) -> Column:
    """28 bits of each line's md5."""
    return F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long"))


def chunks(text: Column, divisor: int = DIVISOR, window: int = WINDOW) -> Column:
    """The text's chunks, as an array of structs (chunk int, n_lines int, body string). Lines end at \\n only; null text has no chunks.

    After a line whose rolling hash over the hashes of the last `window` lines (fewer at the start) is 0 modulo `divisor`, a chunk ends; so
    boundaries depend on the lines about them alone, and lines put in or left out shift no boundary further on.
    """
    lines = F.split(text, "\n", -1)
    plain = F.struct(lines.alias("lines"), _line_hashes(lines).alias("hashes"))

    def ends(x: Column) -> Column:
        h = lambda i, back: F.coalesce(F.get(x["hashes"], i - back), F.lit(0))
        rolled = lambda i: sum((h(i, back) * (BASE**back) for back in range(1, window)), h(i, 0)) % MODULUS
        places = F.sequence(F.lit(0), F.size(x["lines"]) - 1)
        return F.filter(places, lambda i: (rolled(i) % divisor == 0) | (i == F.size(x["lines"]) - 1))

    def cut(x: Column) -> Column:
        def chunk(k: Column) -> Column:
            start = F.when(k == 0, F.lit(0)).otherwise(F.get(x["ends"], k - 1) + 1)
            n = F.get(x["ends"], k) - start + 1
            return F.struct(k.alias("chunk"), n.alias("n_lines"), F.concat_ws("\n", F.slice(x["lines"], start + 1, n)).alias("body"))

        return F.transform(F.sequence(F.lit(0), F.size(x["ends"]) - 1), chunk)

    # Each array(...) of one binds a value, so that it is computed once and not wherever it is used.
    with_ends = F.transform(F.array(plain), lambda x: F.struct(x["lines"].alias("lines"), ends(x).alias("ends")))
    return F.when(text.isNotNull(), F.get(F.transform(with_ends, cut), 0))


def _place(at: str) -> Column:
    """Where a chunk or a run stands, in order of documents (those without an id last, by their text) and of places in them."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.when(F.col("doc_id").isNull(), F.col("t")).alias("t"), at)


def repeated(docs: DataFrame, least_lines: int = 2, divisor: int = DIVISOR, window: int = WINDOW) -> DataFrame:
    """Chunks of least_lines or more lines that stand in more than one place: key, n (their number), first (the place).

    Grouping by the body itself is the byte comparison. Should two bodies share an md5, neither is removed.
    """
    found = (
        docs.select("doc_id", F.xxhash64("text").alias("t"), F.explode(chunks(F.col("text"), divisor, window)).alias("c"))
        .where(F.col("c.n_lines") >= least_lines)
        .select("doc_id", "t", "c.chunk", F.col("c.body").alias("body"))
    )
    bodies = found.groupBy("body").agg(F.count("*").alias("n"), F.min(_place("chunk")).alias("first"))
    keys = bodies.select(F.md5("body").alias("key"), "n", "first").groupBy("key").agg(F.count("*").alias("bodies"), F.sum("n").alias("n"), F.min("first").alias("first"))
    return keys.where("bodies = 1 and n > 1").select("key", "n", "first")


def _apply(docs: DataFrame, gone: DataFrame, stays: Column) -> DataFrame:
    """docs with the text that `stays`, of column text and __gone, leaves of those that gone (doc_id, t, some, all) names. Rows of an id lose what is in some; of rows without one and with the same text, one does, and the others what is in all."""

    def renewed(joined: DataFrame) -> DataFrame:
        rest = F.when(F.col("__gone").isNull() | (F.size("__gone") == 0), F.col("text")).otherwise(stays)
        new = {"text": F.col("__rest"), "n_chars": F.length("__rest").cast("long")}
        return joined.withColumn("__rest", F.when(F.col("text").isNotNull(), rest)).select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])

    gone = gone.select(F.col("doc_id").alias("__doc"), F.col("t").alias("__t"), F.col("some").alias("__some"), F.col("all").alias("__all"))
    with_id = docs.where("doc_id is not null").withColumn("__hash", F.xxhash64("text"))
    with_id = with_id.join(gone.where("__doc is not null"), (F.col("doc_id") == F.col("__doc")) & (F.col("__hash") == F.col("__t")), "left").withColumn("__gone", F.col("__some"))
    # Few as a rule, and none read where a file's statistics say so. The window numbers rows of the same text.
    without = docs.where("doc_id is null").withColumn("__hash", F.xxhash64("text"))
    without = without.withColumn("__no", F.row_number().over(Window.partitionBy("__hash").orderBy("__hash")))
    without = without.join(gone.where("__doc is null"), F.col("__hash") == F.col("__t"), "left").withColumn("__gone", F.when(F.col("__no") == 1, F.col("__some")).otherwise(F.col("__all")))
    return renewed(with_id).unionByName(renewed(without))


def dedup_lines(docs: DataFrame, least_lines: int = 2, divisor: int = DIVISOR, window: int = WINDOW) -> DataFrame:
    """docs with repeated multi-line chunks removed from `text` and, if docs has it, `n_chars` renewed; other columns stay.

    A chunk stays where doc_id (null last) and then its place are the least, and goes everywhere else. What is left is joined by \\n.
    Rows of one doc_id are one document: a row repeated with its doc_id keeps what the first keeps. Each row without a doc_id is a document of its own, and of several with
    the same text one comes first. Null text stays null, and a text whose chunks all go becomes empty. Single-line chunks stay. An empty table gives no rows.
    """
    ours = docs.select("doc_id", "text")
    # Written, so that the join below has an exchange of its own, whose large partitions adaptive execution splits: a chunk may stand in very many documents.
    again = cut(repeated(ours, least_lines, divisor, window))
    places = (
        ours.select("doc_id", F.xxhash64("text").alias("t"), F.explode(chunks(F.col("text"), divisor, window)).alias("c"))
        .where(F.col("c.n_lines") >= least_lines)
        .select("doc_id", "t", "c.chunk", F.md5("c.body").alias("key"))
    )
    one = F.struct("chunk", "key")
    gone = places.join(again, "key").withColumn("later", ~_place("chunk").eqNullSafe(F.col("first")))
    gone = gone.where(F.col("later") | F.col("doc_id").isNull()).groupBy("doc_id", "t").agg(F.collect_set(F.when(F.col("later"), one)).alias("some"), F.collect_set(F.when(F.col("doc_id").isNull(), one)).alias("all"))
    left = F.filter(chunks(F.col("text"), divisor, window), lambda c: (c["n_lines"] < least_lines) | ~F.array_contains("__gone", F.struct(c["chunk"].alias("chunk"), F.md5(c["body"]).alias("key"))))
    return _apply(docs, gone, F.array_join(F.transform(left, lambda c: c["body"]), "\n"))


def dedup_blocks(docs: DataFrame, least_lines: int = 2) -> DataFrame:
    """docs without any line that lies in a run of least_lines lines which stands, word for word, in an earlier place too; other columns as with dedup_lines().

    Chunks end where hashes say, and a short block that two documents share mostly has no whole chunk in it. Here every run of least_lines lines counts, wherever it stands: so
    shared blocks of that length or longer go wherever they stand again (places are in order of doc_id, null last, then of lines). All that dedup_lines() removes goes as well.
    A line always stays where its text stands first, whatever run it lies in there. Runs are compared by their SHA-256: the runs themselves,
    each line in two of them, would take more disk than there is.
    """
    lines = F.split(F.col("text"), "\n", -1)
    n = F.size(lines)
    places = F.when(n >= least_lines, F.sequence(F.lit(0), n - least_lines))
    run = lambda x, i: F.struct(i.alias("at"), F.unhex(F.sha2(F.concat_ws("\n", F.slice(x, i + 1, least_lines)), 256)).alias("key"))
    # array(...) of one binds the lines, so that they are split once.
    runs = F.flatten(F.transform(F.array(lines), lambda x: F.transform(places, lambda i: run(x, i))))
    found = docs.select("doc_id", F.xxhash64("text").alias("t"), F.explode(runs).alias("r")).select("doc_id", "t", "r.*")
    first = cut(found.groupBy("key").agg(F.count("*").alias("n"), F.min(_place("at")).alias("first")).where("n > 1").select("key", "first"))  # written as in dedup_lines()
    gone = found.join(first, "key").withColumn("later", ~_place("at").eqNullSafe(F.col("first")))
    gone = gone.where(F.col("later") | F.col("doc_id").isNull()).groupBy("doc_id", "t").agg(F.collect_set(F.when(F.col("later"), F.col("at"))).alias("some"), F.collect_set(F.when(F.col("doc_id").isNull(), F.col("at"))).alias("all"))
    out = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(least_lines - 1)), lambda k: F.transform("__gone", lambda i: i + k)))
    stays = F.array_except(F.sequence(F.lit(0), n - 1), out)
    return _apply(docs, gone, F.get(F.transform(F.array(lines), lambda x: F.array_join(F.transform(stays, lambda i: F.get(x, i)), "\n")), 0))
