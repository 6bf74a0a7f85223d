"""Chat formatting of messages that quote each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparecost.llm.common import Scratch

_RUN = 8
_MARK = r"'^((?:[ \\t]*>)+)[ \\t]?'"


def _normal(text: str) -> str:
    """SQL: lower case, runs of white space as one space, ends trimmed."""
    return rf"trim(regexp_replace(lower({text}), '\\s+', ' '))"


def quoted_lines(messages: DataFrame) -> DataFrame:
    """Lines of messages that quote: key columns, line number, quote level (0 for own words) and the line without marks."""
    lines = messages.filter(F.col("text").rlike(r"(?m)^[ \t]*>")).select(
        "conv_id", "turn", "__row", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    return lines.select(
        "conv_id", "turn", "__row", "line",
        F.expr(rf"length(translate(regexp_extract(raw, {_MARK}, 1), ' \t', ''))").alias("level"),
        F.expr(f"regexp_replace(raw, {_MARK}, '')").alias("words"),
    )


def _lines(text: str) -> str:
    """SQL: the lines of a text in normal form, blank ones left out."""
    return f"filter(transform(split({text}, '\\n'), l -> {_normal('l')}), l -> l <> '')"


def render_quotes(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every message as a mail that quotes the two turns before it, nested: conv_id, turn, role, text, own (its own words).

    The turn before it stands behind >, the one before that behind > >. Each third turn quotes only the first line of the turn before it.
    A turn is looked up by its number, so a long conversation is not brought together.
    """
    given = messages.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("own"))
    said = given.filter("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min("own").alias("said"))
    mails = given
    for back in (1, 2):
        mails = mails.join(said.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("said").alias(f"said{back}")), ["conv_id", "turn"], "left")
    first = F.when(F.col("turn") % 3 == 2, F.expr("split_part(said1, '\n', 1)")).otherwise(F.col("said1"))

    def marked(said, marks):
        return F.regexp_replace(said, "(?m)^", marks)

    quotes = F.concat_ws("\n", marked(F.col("said2"), "> > "), marked(first, "> "), F.col("own"))
    return mails.select("conv_id", "turn", "role", quotes.alias("text"), "own")


def _longer_runs(plain: DataFrame, quotes: DataFrame, key: list[str]) -> DataFrame:
    """Runs of more than _RUN lines that may be a quoted passage: conv_id, turn, part.

    They begin where the first _RUN lines of such a passage of the conversation stand, and have its number of lines. Only
    numbers are joined; a message then cuts its own runs.
    """
    wanted = quotes.filter(f"long > {_RUN}").select("conv_id", F.col("head").alias("h"), "long").distinct()
    messages = plain.filter("conv_id is not null and turn is not null").select(*key, F.expr(_lines("body")).alias("ls")).filter(f"size(ls) > {_RUN}")
    heads = messages.dropDuplicates(key).select(*key, F.size("ls").alias("size"), F.posexplode(F.expr(
        f"transform(sequence(0, size(ls) - {_RUN}), i -> xxhash64(array_join(slice(ls, i + 1, {_RUN}), ' ')))")).alias("at", "h"))
    found = heads.join(wanted, ["conv_id", "h"]).filter("at + long <= size").groupBy(*key).agg(F.collect_set(F.struct("at", "long")).alias("runs"))
    return messages.join(found, key).select("conv_id", "turn", F.explode(F.expr("transform(runs, r -> array_join(slice(ls, r.at + 1, r.long), ' '))")).alias("part"))


def link_quotes(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Reply structure of conversations, and each message without its quotes.

    Lines that begin with > are quotes; the number of marks is their level. Consecutive lines of one level make a passage.
    Passages, and all runs of up to 8 lines of the own words of every message, are normalised (lower case, single spaces,
    blank lines left out) and hashed; so a passage may be any lines of a message that follow each other. A passage is
    joined to the earliest message of its conversation that says it, if that comes before the quoting turn. For a longer one the
    runs of its length are hashed where its first 8 lines stand, so all its lines decide. A message answers the latest message that its first-level passages are linked to; where none is linked, the
    latest one that deeper passages are. A thread is a message without such a link and all that answer it, directly or not.

    Returns per message: conv_id, turn, role, n_quotes (passages), n_linked, max_level, reply_to (turn), thread (turn that
    opens it), body (own words) and body_sha256. Sorted by conv_id, thread and turn this is the conversation in order of
    replies. A null text has an empty body. A null conversation or turn is never linked. Rows that share conversation and
    turn are one message for links; each row is returned. Texts may be of any length. Other columns are not read, so their
    names cannot clash. No rows give no rows. Copies of a text collapse to one row per conversation before the join, with
    partial sums, and no conversation is collected into one row.
    """
    given = messages.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("__row", F.xxhash64("role", "text"))
    scratch = Scratch(messages.sparkSession, "chat")
    key = ["conv_id", "turn", "__row"]
    # passages of messages that quote: a new one begins where the level changes
    order = Window.partitionBy(*key).orderBy("line")
    lines = quoted_lines(given.dropDuplicates(key))
    runs = lines.withColumn("new", (F.col("level") != F.lag("level", 1, -1).over(order)).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(order))
    passages = scratch.keep(runs.groupBy(*key, "run", "level").agg(
        F.sort_array(F.collect_list(F.struct("line", "words"))).alias("lines")
    ).select(*key, "run", "level", F.expr("array_join(transform(lines, l -> l.words), '\n')").alias("passage")), "passages")
    own = passages.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.when(F.col("level") == 0, F.struct("run", "passage")))).alias("own"),
        F.count(F.when(F.col("level") > 0, 1)).alias("n_quotes"), F.max("level").alias("max_level"),
    ).select(*key, F.expr("trim(array_join(transform(own, o -> o.passage), '\n'))").alias("own"), "n_quotes", "max_level")
    matched = [given[k].eqNullSafe(own[k]) for k in key]
    plain = given.join(own, matched[0] & matched[1] & matched[2], "left").select(
        given["*"], F.coalesce("own", F.col("text")).alias("body"), F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("max_level", F.lit(0)).cast("long").alias("max_level"))
    plain = scratch.keep(plain, "plain")
    # hashes of runs, of which a line begins at most _RUN
    said = plain.filter("conv_id is not null and turn is not null").select("conv_id", "turn", F.expr(_lines("body")).alias("ls"))
    said = said.select("conv_id", "turn", F.explode(F.expr(
        f"flatten(transform(ls, (l, i) -> transform(sequence(1, least({_RUN}, size(ls) - i)), n -> array_join(slice(ls, i + 1, n), ' '))))")).alias("part"))
    quotes = passages.filter("level > 0").select(*key, "level", F.expr(_lines("passage")).alias("ls"))
    quotes = scratch.keep(quotes.filter("size(ls) > 0").select(
        *key, "level", F.size("ls").alias("long"), F.expr(f"xxhash64(array_join(slice(ls, 1, {_RUN}), ' '))").alias("head"),
        F.expr("array_join(ls, ' ')").alias("part")).select(*key, "level", "long", "head", F.xxhash64("part").alias("h"), F.length("part").alias("n")), "quotes")
    said = said.unionByName(_longer_runs(plain, quotes, key))
    origins = said.groupBy("conv_id", F.xxhash64("part").alias("h"), F.length("part").alias("n")).agg(F.min("turn").alias("origin"))
    links = scratch.keep(quotes.join(origins, ["conv_id", "h", "n"]).filter("origin < turn").groupBy("conv_id", "turn").agg(
        F.coalesce(F.max(F.when(F.col("level") == 1, F.col("origin"))), F.max("origin")).alias("reply_to"),
        F.count(F.lit(1)).alias("n_linked")), "links")
    # follow replies to the message that opens the thread; each round doubles the distance
    roots, used = links.select("conv_id", "turn", F.col("reply_to").alias("thread")), ["passages", "plain", "quotes", "links"]
    while True:
        further = roots.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"))
        moved = roots.join(further, ["conv_id", "thread"], "left")
        used.append(f"roots{len(used)}")
        stepped = scratch.keep(moved.select("conv_id", "turn", F.coalesce("next", "thread").alias("thread"), F.col("next").isNotNull().alias("moved")), used[-1])
        roots = stepped.drop("moved")
        if stepped.filter("moved").isEmpty():
            break
    told = links.join(roots, ["conv_id", "turn"])
    result = plain.join(told, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "n_quotes", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "max_level", "reply_to",
        F.coalesce("thread", F.col("turn")).alias("thread"), "body", F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256"))
    return scratch.done(result, *used)
