"""Chat formatting by quotation linking, in DataFrame operations only.

Lines of a message begin with as many ``>`` as they are quoted levels deep.
Runs of lines of one level are passages.  Quoted passages, their paragraphs and
their lines are normalised and hashed; each is joined to the latest earlier
message of the conversation that says the same in its own words.  The message
whose nearest quotes hold most words is the one replied to; without a linked
quote a message replies to the one before it.  Quotes are left out of the text.

Messages are numbered within their conversation by a range partitioning, so
a conversation of any size is dealt over many tasks.  A reply's place is its
distance from the first message along the replies.  Only messages that reply to
another than the one before them take part in the doubling that finds it.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.session import cut

BLOCK = 64  # messages of a conversation that are ordered in one group
_MARKS = r"^(?:[ \t]*>)+[ \t]?"
_SAYS = r"(?i)(?:^|\n)[^\n]*\b(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$"
_RUN, _BODY = "\x01", "\x02"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), r"[^>]", ""))


def _runs(text: Column) -> Column:
    """Passages of a message in order: ``array<struct<level, body>>``."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x01\x02]", " ")
    lines = F.transform(F.split(plain, r"\r\n|\n|\r"), lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, _MARKS, "").alias("body")))

    def marked(rows: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            new = (i == 0) | (F.element_at(rows, F.greatest(i, F.lit(1))).getField("level") != x.getField("level"))
            head = F.concat(F.when(i > 0, F.lit(_RUN)).otherwise(F.lit("")), x.getField("level").cast("string"), F.lit(_BODY))
            return F.concat(F.when(new, head).otherwise(F.lit("\n")), x.getField("body"))

        return F.array_join(F.transform(rows, one), "")

    parts = F.split(marked(lines), _RUN)
    return F.transform(
        parts,
        lambda p: F.struct(F.substring_index(p, _BODY, 1).cast("int").alias("level"), F.substring_index(p, _BODY, -1).alias("body")),
    )


def _own(runs: Column) -> Column:
    """Unquoted text; a line such as "… wrote:" right above a quote belongs to the quote."""

    def kept(run: Column, i: Column) -> Column:
        quoted_next = F.coalesce(F.get(runs, i + 1).getField("level") > 0, F.lit(False))
        body = F.when(quoted_next, F.regexp_replace(run.getField("body"), _SAYS, "")).otherwise(run.getField("body"))
        return F.when(run.getField("level") == 0, F.regexp_replace(body, r"^\s+|\s+$", ""))

    return F.array_join(F.filter(F.transform(runs, kept), lambda x: x.isNotNull() & (x != "")), "\n")


def _normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _pieces(text: Column) -> Column:
    """Normalised forms by which a passage can be met: whole, by paragraph, by line."""
    forms = F.concat(F.array(text), F.split(text, r"\n[ \t]*\n"), F.split(text, r"\n"))
    return F.array_distinct(F.filter(F.transform(forms, _normalised), lambda x: x != ""))


def _numbered(rows: DataFrame, order: list[Column], tell: list[Column]) -> DataFrame:
    """Written rows with ``seq``, their number from 0 within ``conv`` in the given order; ``tell`` are the columns kept.

    Ranges of all rows are sorted, wherever a conversation's bounds fall; one
    row per range and conversation then tells how many came before.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal rows are told apart by where they were read, so that none of their number is too many for a range
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    sorted_ = rows.repartitionByRange(parts, "conv", *order, "_tie").sortWithinPartitions("conv", *order, "_tie")
    written = cut(sorted_.select(*tell, F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_nth")))
    per = written.groupBy("_pid", "conv").agg(F.min("_nth").alias("_first"), F.count("*").alias("_n"))
    ahead = Window.partitionBy("conv").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("_pid").alias("_p"), F.col("conv").alias("_c"), "_first", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    met = (F.col("_pid") == F.col("_p")) & F.col("conv").eqNullSafe(F.col("_c"))
    return written.join(per, met).withColumn("seq", F.col("_ahead") + F.col("_nth") - F.col("_first")).drop("_pid", "_nth", "_p", "_c", "_first", "_ahead")


def _latest(rows: DataFrame, keys: list[str], value: str, own: bool) -> DataFrame:
    """Adds ``last``: the greatest ``value`` of the rows before (or up to, if ``own``) a row's ``seq`` under the same keys.

    By a window within a block of messages, and from one row per block across blocks.
    """
    rows = rows.withColumn("_block", F.floor(F.col("seq") / BLOCK))
    within = Window.partitionBy(*keys, "_block").orderBy("seq").rangeBetween(Window.unboundedPreceding, 0 if own else -1)
    near = rows.withColumn("_near", F.max(value).over(within))
    per = rows.groupBy(*keys, "_block").agg(F.max(value).alias("_most"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_far", F.max("_most").over(before)).drop("_most")
    per = per.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*keys, "_block"])], "_far")
    met = functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*keys, "_block"])])
    joined = near.join(per, met).withColumn("last", F.greatest("_near", "_far"))
    return joined.drop("_block", "_near", "_far", *[f"_k{i}" for i in range(len(keys) + 1)])


def _depths(parents: DataFrame) -> DataFrame:
    """``conv, seq, depth``: replies between a message and one that answers nothing; ``parents`` has ``conv, seq, parent``.

    A head answers another message than the one before it, or none.  The
    messages up to the next head follow it one by one, so only heads are doubled.
    """
    heads = parents.withColumn("_head", F.when(F.col("parent").isNull() | (F.col("parent") != F.col("seq") - 1), F.col("seq")))
    placed = cut(_latest(heads, ["conv"], "_head", own=True).select("conv", "seq", "parent", F.col("last").alias("head")))
    joints = placed.where("seq = head").select("conv", "seq", "parent")
    of = placed.select(F.col("conv").alias("_conv"), F.col("seq").alias("_seq"), F.col("head").alias("up"))
    met = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("parent") == F.col("_seq"))
    steps = joints.join(of, met, "left").select("conv", "seq", "up", F.coalesce(F.col("parent") - F.col("up") + 1, F.lit(0)).alias("far"))
    steps = cut(steps)
    while not steps.where("up is not null").isEmpty():
        further = steps.select(F.col("conv").alias("_conv"), F.col("seq").alias("_seq"), F.col("up").alias("_up"), F.col("far").alias("_far"))
        met = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("up") == F.col("_seq"))
        steps = cut(steps.join(further, met, "left").select("conv", "seq", F.col("_up").alias("up"), (F.col("far") + F.coalesce("_far", F.lit(0))).alias("far")))
    ends = steps.select(F.col("conv").alias("_conv"), F.col("seq").alias("_seq"), "far")
    met = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("head") == F.col("_seq"))
    return placed.join(ends, met).select("conv", "seq", (F.col("far") + F.col("seq") - F.col("head")).alias("depth"))


def link_replies(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per message, to be read in ascending ``position`` within its conversation.

    Columns: ``conversation``, ``position`` (1, 2, … in reply order: by the number of replies between a message and
    the start, then by turn, so a reply always comes after what it answers), ``turn``, ``role``,
    ``reply_to`` (turn of the message answered, null if none), ``quoted`` (the link comes from a
    quotation), ``n_quotes`` (quoted passages), ``n_linked`` (of these, found in an earlier message)
    and ``body`` (the message without quotes).

    Quotes of any length are linked, single words too.  A null text is empty; a message with only
    quotes has an empty body.  Rows with a null conversation form one conversation;
    a null turn comes before all others, answers nothing and is not answered.  Messages of the same turn
    are ordered by role and text; equal rows are repeated messages.  Other columns are not read.
    An empty table gives no row.
    """
    read = messages.select(
        F.col(f"`{conversation}`").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.col(f"`{role}`").alias("role"),
        F.xxhash64(f"`{text}`").alias("print"),
        F.col(f"`{text}`").alias("text"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("print")]
    rows = _numbered(read, order, [F.col("conv"), F.col("turn"), F.col("role"), _runs(F.col("text")).alias("runs")])
    rows = cut(rows.select("conv", "seq", "turn", "role", "runs", _own(F.col("runs")).alias("body")))
    ident = ["conv", "seq"]

    quotes = rows.where("turn is not null").select(*ident, F.posexplode("runs").alias("run", "r")).where("r.level > 0")
    quotes = quotes.select(*ident, "run", "r.level", F.explode(_pieces(F.col("r.body"))).alias("said")).distinct()
    quotes = cut(quotes.select("*", F.md5(F.col("said").cast("binary")).alias("key"), F.size(F.split("said", " ")).alias("words")).drop("said"))
    wanted = quotes.select(F.col("conv").alias("_conv"), F.col("key").alias("_key")).distinct()
    sources = rows.where("turn is not null").select(*ident, F.explode(_pieces(F.col("body"))).alias("said"))
    sources = sources.select(*ident, F.md5(F.col("said").cast("binary")).alias("key"))
    sources = sources.join(wanted, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key")), "left_semi").distinct()

    # The latest earlier source of each quote.
    none = [F.lit(None).cast(quotes.schema[c].dataType).alias(c) for c in ("run", "level", "words")]
    both = quotes.select(*ident, "key", "run", "level", "words", F.lit(None).cast("long").alias("source"))
    both = both.union(sources.select(*ident, "key", *none, F.col("seq").alias("source")))
    found = _latest(both, ["conv", "key"], "source", own=False).where("run is not null and last is not null")
    found = found.select(*ident, "run", "level", "words", F.col("last").alias("source"))

    # One source per passage, then the nearest level's source with most words; the later one on ties.
    per_run = found.groupBy(*ident, "run", "level", "source").agg(F.max("words").alias("words"))
    per_run = per_run.groupBy(*ident, "run", "level").agg(F.max(F.struct("words", "source")).alias("best"))
    votes = per_run.groupBy(*ident, "level", F.col("best.source").alias("source")).agg(F.sum("best.words").alias("words"), F.count("*").alias("n"))
    chosen = votes.groupBy(*ident).agg(F.max(F.struct((-F.col("level")).alias("near"), "words", "source")).alias("best"), F.sum("n").alias("n_linked"))
    chosen = cut(chosen.select(F.col("conv").alias("_conv"), F.col("seq").alias("_seq"), F.col("best.source").alias("linked"), "n_linked"))

    own = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("seq") == F.col("_seq"))
    linked = rows.join(chosen, own, "left").drop("_conv", "_seq")
    # What a message answers: the linked one, or the one before it; both by number.
    at = F.coalesce("linked", F.col("seq") - 1)
    turns = rows.where("turn is not null").select(F.col("conv").alias("_conv"), F.col("seq").alias("_seq"), F.col("turn").alias("reply_to"))
    linked = linked.withColumn("_at", F.when(F.col("turn").isNotNull(), at))
    linked = linked.join(turns, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("_at") == F.col("_seq")), "left").drop("_conv", "_seq")
    n_quotes = F.size(F.filter("runs", lambda r: r.getField("level") > 0)).cast("long")
    told = [
        F.col("conv"),
        F.col("seq"),
        F.col("turn"),
        F.col("role"),
        F.col("reply_to"),
        F.col("linked").isNotNull().alias("quoted"),
        n_quotes.alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.col("body"),
    ]
    if chosen.isEmpty():
        placed = linked.select(*told)  # every message answers the one before it, so the numbers are the positions
    else:
        linked = cut(linked.select(*told, F.when(F.col("reply_to").isNotNull(), F.col("_at")).alias("parent")))
        depths = _depths(linked.select("conv", "seq", "parent")).select(F.col("conv").alias("_conv"), F.col("seq").alias("_seq"), "depth")
        rows = linked.join(depths, own).drop("_conv", "_seq", "parent").withColumnRenamed("seq", "_first")
        kept = [F.col(c) for c in rows.columns if c not in ("_first", "depth")]
        placed = _numbered(rows, [F.col("depth"), F.col("_first")], kept)
    return placed.select(
        F.col("conv").alias(conversation),
        (F.col("seq") + 1).cast("long").alias("position"),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        "reply_to",
        "quoted",
        "n_quotes",
        "n_linked",
        "body",
    )
