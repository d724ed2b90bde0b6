"""Quotation linking: which earlier message does a quoted passage come from?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import broadcast_if_small, written

_MARKS = r"^(?:[ \t]?>)+[ \t]?"
_HAS_QUOTE = r"(?:^|\n)[ \t]?>"
#: A line of an interactive session: three marks side by side. It is a quote only if its passage is found.
_PROMPT = r"^>>>(?: |$)"
#: The line before a quotation that says whose words follow, in the languages of the corpus.
_ATTRIBUTION = r"^[ \t]*\S.*(?i:\bwrote|\bsaid|\bschrieb.*|\ba écrit|\bescribió)[ \t]?:[ \t]*$"
#: Turns and conversations that a window looks at together; beyond that, windows see one row for each so many.
_TURNS, _CONVERSATIONS = 256, 10


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.lower(F.regexp_replace(text, r"\s+", " ")))


def _lines(messages: DataFrame) -> DataFrame:
    """``(row, conv_id, turn, at, level, prompt, line)``: quote level is the number of leading ``>``."""
    lines = messages.select("row", "conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    marks = F.regexp_extract("raw", _MARKS, 0)
    return lines.select("row", "conv_id", "turn", "at", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.col("raw").rlike(_PROMPT).alias("prompt"), F.regexp_replace("raw", _MARKS, "").alias("line"))


def _passages(lines: DataFrame) -> DataFrame:
    """Neighbouring lines of one level and message, cut at blank lines -> ``(row, conv_id, turn, at, last, level, prompt, lines, hash)``."""
    order = W.partitionBy("row").orderBy("at")
    blank = F.trim("line") == ""
    before = F.lag(F.struct(F.col("level"), blank.alias("blank"))).over(order)
    starts = F.when(before.isNull() | (before["level"] != F.col("level")) | (before["blank"] != blank), 1).otherwise(0)
    blocks = lines.withColumn("starts", starts).withColumn("block", F.sum("starts").over(order)).filter(~blank)
    own = F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: normalised(x["line"]))
    blocks = blocks.groupBy("row", "conv_id", "turn", "block", "level").agg(F.min("at").alias("at"), F.max("at").alias("last"), F.every("prompt").alias("prompt"), own.alias("lines"))
    return blocks.select("row", "conv_id", "turn", "at", "last", "level", "prompt", "lines", F.md5(normalised(F.array_join("lines", " "))).alias("hash"))


def _excerpts(runs: DataFrame, quoted: DataFrame) -> DataFrame:
    """``(conv_id, turn, hash)`` of neighbouring lines of ``runs (conv_id, turn, lines)`` that may be a quoted passage of several lines.

    A passage asks by its first two lines and its number of lines; of an original, only as many lines from such a pair on are hashed.
    """
    asked = quoted.filter(F.size("lines") > 1).select(F.xxhash64(F.col("lines")[0], F.col("lines")[1]).alias("pair"), F.size("lines").alias("k")).distinct()
    pairs = F.transform(F.sequence(F.lit(0), F.size("lines") - 2), lambda i: F.xxhash64(F.get("lines", i), F.get("lines", i + 1)))
    found = runs.filter(F.size("lines") > 1).select("conv_id", "turn", "lines", F.posexplode(pairs).alias("i", "pair")).join(asked, "pair").filter(F.col("i") + F.col("k") <= F.size("lines"))
    return found.select("conv_id", "turn", F.md5(normalised(F.array_join(F.slice("lines", F.col("i") + 1, F.col("k")), " "))).alias("hash"))


def _latest_before(quoted: DataFrame, originals: DataFrame) -> DataFrame:
    """``(row, at, level, in_turn)``: the last earlier turn of the same conversation that has the passage, for those that have one.

    Turns are looked at in spans of ``_TURNS``, and of earlier spans only their last turn, so that a line that a long
    conversation repeats all the time is neither joined with itself nor sorted in one task as a whole.
    """
    key = ["hash", "conv_id"]
    span = F.floor(F.col("turn") / _TURNS)
    both = originals.select(*key, "turn", F.col("turn").alias("has"), F.lit(None).cast("long").alias("row"), F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("level"))
    both = both.unionByName(quoted.select(*key, "turn", F.lit(None).cast(originals.schema["turn"].dataType).alias("has"), "row", "at", "level")).withColumn("span", span)
    inside = F.max("has").over(W.partitionBy(*key, "span").orderBy("turn").rangeBetween(W.unboundedPreceding, -1))
    near = both.withColumn("near", inside).filter("row IS NOT NULL").drop("has")
    spans = both.groupBy(*key, "span").agg(F.max("has").alias("has"))
    before = spans.withColumn("before", F.max("has").over(W.partitionBy(*key).orderBy("span").rowsBetween(W.unboundedPreceding, -1))).drop("has")
    out = near.join(before, [*key, "span"]).select("row", "at", "level", F.coalesce("near", "before").alias("in_turn"))
    return out.filter("in_turn IS NOT NULL")


def _replies(keys: DataFrame) -> DataFrame:
    """``(row, reply)``, written, of the rows that are not the first of their thread: the place by depth, conversation and turn.

    ``keys`` is ``(row, conv_id, turn, thread_conv, thread_turn, depth)``, without texts. Rows are ranked in parts of a depth, the parts by their sizes.
    """
    alone = F.when(F.col("conv_id").isNull() | F.col("turn").isNull(), F.col("row"))
    keys = keys.withColumn("alone", F.coalesce(alone, F.lit(-1))).withColumn("part", F.shiftright("conv_id", _CONVERSATIONS))
    thread = ["thread_conv", "thread_turn", "alone"]
    key = [*thread, "depth", "part"]
    ranked = keys.withColumn("rank", F.row_number().over(W.partitionBy(*key).orderBy("conv_id", "turn", "row")))
    sizes = keys.groupBy(*key).agg(F.count("*").alias("n"))
    before = (F.sum("n").over(W.partitionBy(*thread).orderBy("depth", "part")) - F.col("n")).alias("before")
    offsets = sizes.select(*[F.col(k).alias(f"o_{k}") for k in key], before)
    joined = ranked.join(offsets, [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in key])
    return written(joined.select("row", (F.col("before") + F.col("rank") - 1).cast("long").alias("reply")).filter("reply > 0"), "replies")


def _climb(up: DataFrame) -> tuple[DataFrame, int]:
    """Follow ``up (conv_id, turn, to_conv, to_turn)`` to the ends of the chains, doubling the step each round.

    Adds ``steps``, ``on`` (the end is not reached: the chain runs into a cycle) and ``least``, the smallest message on the
    way; also returns how many rows are ``on``. Then ``to`` lies on the cycle, and each message of a cycle is one's ``to``.
    """
    here = F.struct("conv_id", "turn")
    at = up.withColumn("steps", F.lit(1).cast("long")).withColumn("least", F.least(here, F.struct(F.col("to_conv").alias("conv_id"), F.col("to_turn").alias("turn")))).withColumn("on", F.lit(True))
    size = left = up.count()
    rounds = 0
    while left and 1 << rounds <= 2 * size:
        then = at.select(F.col("conv_id").alias("c2"), F.col("turn").alias("t2"), F.col("to_conv").alias("to_conv2"), F.col("to_turn").alias("to_turn2"), F.col("least").alias("least2"), F.col("steps").alias("steps2"))
        step = at.join(then, (F.col("to_conv") == F.col("c2")) & (F.col("to_turn") == F.col("t2")), "left")
        at = written(step.select(
            "conv_id", "turn", F.coalesce("to_conv2", "to_conv").alias("to_conv"), F.coalesce("to_turn2", "to_turn").alias("to_turn"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"),
            F.least("least", F.coalesce("least2", "least")).alias("least"), F.col("c2").isNotNull().alias("on"),
        ), "up")
        left, rounds = at.filter("on").count(), rounds + 1
    return at, left


def link_quotes(df: DataFrame) -> DataFrame:
    """Messages ``(conv_id, turn, role, text)`` with their thread and without quotes.

    A quoted passage (neighbouring lines of one quote level up to a blank line) is looked up by
    the hash of its normalised text among whole bodies, blocks, lines and neighbouring lines of unquoted text: first
    in earlier turns of the same conversation (the latest wins), else in other
    conversations (the smallest id and turn win). A message's parent is what its first linked
    passage of level 1 comes from. ``thread_conv, thread_turn`` is the end of the chain of parents and ``depth`` the
    number of parents up to it. A thread ordered by ``reply`` (0, 1, ...: by depth, conversation and turn) is the
    reply-ordered conversation: each parent comes before its replies.

    Returns ``conv_id, turn, role, body, n_quotes, n_linked, n_unlinked, parent_conv, parent_turn, thread_conv, thread_turn, depth, reply``,
    one row for each row. Null text: null body, no quotes. Null id or turn: never linked, its own
    thread. Repeated rows link alike; an empty table gives no rows. Lines with ``>`` that link to nothing may be no quotes (a comparison, a shell's
    redirection, an interactive session's ``>>>``), and no other message holds their words: they stay, but for deeper levels of a message that has a link, and for those that
    a line like "X wrote:" introduces; such a line goes with its quotation. ``n_unlinked`` counts passages without a link. Other columns play no part. Ids and turns are whole numbers.
    """
    messages = df.select("conv_id", "turn", "role", "text").withColumn("row", F.monotonically_increasing_id())
    messages = written(messages, "messages")
    named = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL")
    quoting = named.filter(F.col("text").rlike(_HAS_QUOTE))
    lines = _lines(quoting)
    passages = written(_passages(lines), "passages")
    quoted, answers = passages.filter("level > 0"), passages.filter("level = 0")

    # What can be quoted: only hashes that some passage asks for go on, so the join back is small.
    plain = named.filter(~F.col("text").rlike(_HAS_QUOTE)).select("conv_id", "turn", "text")
    own = plain.unionByName(
        lines.filter("level = 0").groupBy("row", "conv_id", "turn").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("text")).select("conv_id", "turn", "text")
    )
    units = F.array_distinct(F.concat(F.array(F.col("text")), F.split("text", r"\n[ \t]*\n"), F.split("text", "\n")))
    originals = own.select("conv_id", "turn", F.explode(units).alias("unit")).select("conv_id", "turn", normalised(F.col("unit")).alias("unit")).filter("unit <> ''")
    runs = plain.select("conv_id", "turn", F.explode(F.split("text", r"\n[ \t]*\n")).alias("run")).select("conv_id", "turn", F.transform(F.split("run", "\n"), normalised).alias("lines"))
    originals = originals.select("conv_id", "turn", F.md5("unit").alias("hash")).unionByName(answers.select("conv_id", "turn", "hash"))
    originals = originals.unionByName(_excerpts(runs.unionByName(answers.select("conv_id", "turn", "lines")), quoted))
    originals = originals.join(quoted.select("hash").distinct(), "hash", "left_semi").distinct()
    originals = written(originals, "originals")

    first = originals.groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    linked = quoted.join(_latest_before(quoted, originals), ["row", "at", "level"], "left").join(first, "hash", "left")
    elsewhere = F.when(F.col("first.conv_id") != F.col("conv_id"), F.col("first"))
    parent = F.when(F.col("in_turn").isNotNull(), F.struct("conv_id", F.col("in_turn").alias("turn"))).otherwise(elsewhere)
    linked = linked.select("row", "at", "last", "level", "prompt", parent.alias("parent"))
    code = F.col("prompt") & F.col("parent").isNull()
    per = linked.groupBy("row").agg(
        F.count_if(~code).alias("n_quotes"), F.count("parent").alias("n_linked"), F.min(F.when((F.col("level") == 1) & F.col("parent").isNotNull(), F.struct("at", "parent"))).alias("up"),
        F.collect_list(F.when(F.col("parent").isNull(), F.struct("at", "last", "level", "prompt"))).alias("code"),
    )
    per = written(per.select("row", "n_quotes", "n_linked", F.col("up.parent.conv_id").alias("parent_conv"), F.col("up.parent.turn").alias("parent_turn"), "code"), "parents")

    # A cycle through other conversations is cut at its smallest message, whose parent then plays no part in threads.
    up = quoting.select("row", "conv_id", "turn").join(per.filter("parent_conv IS NOT NULL").drop("code"), "row")
    up = written(up.groupBy("conv_id", "turn").agg(F.min(F.struct("parent_conv", "parent_turn")).alias("p")).select("conv_id", "turn", F.col("p.parent_conv").alias("to_conv"), F.col("p.parent_turn").alias("to_turn")), "up")
    at, left = _climb(up)
    if left:
        around = at.filter("on").select(F.col("to_conv").alias("c2"), F.col("to_turn").alias("t2")).distinct()
        cut = at.join(around, (F.col("conv_id") == F.col("c2")) & (F.col("turn") == F.col("t2")), "left_semi").filter(F.col("least") == F.struct("conv_id", "turn"))
        at, _ = _climb(written(up.join(cut.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti"), "up"))
    ends = at.select(F.col("conv_id").alias("e_conv"), F.col("turn").alias("e_turn"), "to_conv", "to_turn", "steps")

    placed = (F.col("conv_id") == F.col("e_conv")) & (F.col("turn") == F.col("e_turn"))
    thread = [F.coalesce("to_conv", "conv_id").alias("thread_conv"), F.coalesce("to_turn", "turn").alias("thread_turn"), F.coalesce("steps", F.lit(0)).cast("long").alias("depth")]
    replies = _replies(messages.select("row", "conv_id", "turn").join(ends, placed, "left").select("row", "conv_id", "turn", *thread))
    out = messages.join(per, "row", "left").join(ends, placed, "left").join(broadcast_if_small(replies), "row", "left")
    lines = F.split("text", "\n")

    def quote(line: Column) -> Column:
        return F.coalesce(line.rlike(_MARKS), F.lit(False))

    def attributes(line: Column, i: Column) -> Column:
        after = F.get(lines, i + 1)
        then = quote(after) | (F.coalesce(F.trim(after) == "", F.lit(False)) & quote(F.get(lines, i + 2)))
        return line.rlike(_ATTRIBUTION) & then & (F.coalesce("n_quotes", F.lit(0)) > 0)

    loose = F.coalesce("code", F.array().cast("array<struct<at:int,last:int,level:int,prompt:boolean>>"))

    def introduced(at: Column) -> Column:
        before = F.get(lines, at - 1)
        return F.coalesce(before.rlike(_ATTRIBUTION) | ((F.trim(before) == "") & F.get(lines, at - 2).rlike(_ATTRIBUTION)), F.lit(False))

    def stays(line: Column, i: Column) -> Column:
        kept = F.exists(loose, lambda c: (i >= c["at"]) & (i <= c["last"]) & (c["prompt"] | (((c["level"] == 1) | (F.col("n_linked") == 0)) & ~introduced(c["at"]))))
        return kept | ~(quote(line) | attributes(line, i))

    body = F.when(F.col("text").rlike(_HAS_QUOTE), F.array_join(F.filter(lines, stays), "\n")).otherwise(F.col("text"))
    return out.select(
        "conv_id", "turn", "role", body.alias("body"), F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.size(loose).cast("long").alias("n_unlinked"),
        "parent_conv", "parent_turn", *thread, F.coalesce("reply", F.lit(0)).cast("long").alias("reply"),
    )


def op6_quotes(spark, sf_dir: str) -> DataFrame:
    """The result of :func:`link_quotes` for every message of ``conversations``."""
    return link_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
