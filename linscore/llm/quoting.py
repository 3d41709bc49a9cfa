"""Chats from messages that quote each other: quotes are parsed, joined to what they quote, and taken out.

A line's quote level is the number of ``>`` before it. Runs of lines of one level, ended by blank lines, are passages. Passages,
single lines and a level's whole text are units, known by a hash of their lower-cased words. A quoted unit of any level belongs
to the latest earlier message of the conversation that has the unit among its own, unquoted ones. A message replies to the one
that most of its quoted characters of level 1 belong to (ties: the later one); where none of these has an original, the next
deeper level that has one decides. ``root`` and ``depth`` follow the replies up; a conversation sorted by ``root, depth, turn`` has every
message after what it replies to.

DataFrame operations only. "Latest earlier" is a running maximum over spans of ``SPAN`` turns, carried over spans by one row
per span, so that neither a conversation nor a phrase that everybody quotes has to be sorted as a whole, and
no message is paired with another that it does not answer. Replies are followed by doubling: the rounds are the
logarithm of the depth.

Defined cases: null or blank text quotes nothing and is ``text`` "" without own lines; rows without conversation or turn are
roots; rows that repeat conversation and turn are one message with the lines of all, and a row each; an attribution
(``On ... wrote:``) right before a quote goes with it; messages of any length are read whole; an empty table gives an empty one;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Store

SPAN = 4096
PREFIX = r"^((?:[ \t]*>)+)"
ATTRIBUTION = r"^On .{0,200} wrote:[ \t]*$"
START, LEVEL = "\u0001", "\u0002"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def parsed(text: Column) -> Column:
    """Lines as ``level`` and ``body``; attributions take the level of the quote they announce."""
    clean = F.translate(F.coalesce(text, F.lit("")), START + LEVEL, "  ")
    lines = F.transform(
        F.split(clean, r"\r?\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, PREFIX, 1), r"[^>]", "")).alias("level"),
            F.regexp_replace(line, PREFIX + " ?", "").alias("body"),
        ),
    )
    return lines


def _announced(lines: Column) -> Column:
    return F.transform(
        lines,
        lambda line, i: F.struct(
            F.when(
                line["body"].rlike(ATTRIBUTION) & (F.get(lines, i + 1)["level"] > line["level"]), line["level"] + 1
            ).otherwise(line["level"]).alias("level"),
            (line["body"].rlike(ATTRIBUTION) & (F.get(lines, i + 1)["level"] > line["level"])).alias("said"),
            line["body"].alias("body"),
        ),
    )


def _units(lines: Column, quotes: bool) -> Column:
    """Distinct normalised passages, lines and whole text of level 0 or of each quote level, as ``level`` and ``unit``."""
    held = lambda level: (level > 0) if quotes else (level == 0)
    unit = lambda level, text: F.struct(level.alias("level"), _normal(text).alias("unit"))
    blank = lambda line: F.trim(line["body"]) == ""
    marked = F.transform(
        lines,
        lambda line, i: F.concat(
            F.when(
                (i == 0) | (F.get(lines, i - 1)["level"] != line["level"]) | blank(line) | blank(F.get(lines, i - 1)),
                F.concat(F.lit(START), line["level"].cast("string"), F.lit(LEVEL)),
            ).otherwise(F.lit(" ")),
            F.when(line["said"], "").otherwise(line["body"]),
        ),
    )
    passages = F.transform(
        F.filter(F.split(F.array_join(marked, ""), START), lambda p: p != ""),
        lambda p: unit(F.substring_index(p, LEVEL, 1).cast("int"), F.substring_index(p, LEVEL, -1)),
    )
    passages = F.filter(passages, lambda u: held(u["level"]))
    kept = F.filter(lines, lambda line: held(line["level"]) & ~line["said"])
    single = F.transform(kept, lambda line: unit(line["level"], line["body"]))
    whole = F.transform(
        F.array_distinct(F.transform(kept, lambda line: line["level"])),
        lambda level: unit(
            level, F.array_join(F.transform(F.filter(kept, lambda line: line["level"] == level), lambda line: line["body"]), " ")
        ),
    )
    return F.array_distinct(F.filter(F.concat(passages, single, whole), lambda u: u["unit"] != ""))


def conversations(messages: DataFrame) -> DataFrame:
    """One row per message: ``conv_id, turn, role, reply_to, root, depth, text`` (without quotes)."""
    store = Store(messages.sparkSession, "quotes")
    read = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"), parsed(F.col("text").cast("string")).alias("lines"),
    ).withColumn("lines", _announced(F.col("lines")))
    own = F.filter("lines", lambda line: line["level"] == 0)
    read = store.write(
        "read",
        read.select(
            "conv_id", "turn", "role", F.array_join(F.transform(own, lambda line: line["body"]), "\n").alias("text"),
            _units(F.col("lines"), False).alias("own"), _units(F.col("lines"), True).alias("quoted"),
        ),
    )
    placed = read.where("conv_id is not null and turn is not null")

    def units(column: str, quotes: bool) -> DataFrame:
        found = placed.select("conv_id", "turn", F.explode(column).alias("found"))
        return found.select(
            "conv_id", "turn", "found.level", F.xxhash64("found.unit").alias("hash"),
            F.length("found.unit").cast("bigint").alias("size"), F.lit(quotes).alias("quotes"),
        ).distinct()

    # only units that are quoted at all in a conversation go on
    quotes = store.write("quoted", units("quoted", True))
    sources = units("own", False).join(quotes.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    both = store.write("units", quotes.unionByName(sources).withColumn("span", F.floor(F.col("turn") / SPAN)))
    source_turn = "case when not quotes then turn end"
    spans = both.groupBy("conv_id", "hash", "span").agg(F.max(F.expr(source_turn)).alias("last")).selectExpr(
        "conv_id", "hash", "span",
        "max(last) over (partition by conv_id, hash order by span rows between unbounded preceding and 1 preceding) as before",
    )
    latest = both.selectExpr(
        "*",
        f"max({source_turn}) over (partition by conv_id, hash, span order by turn range between unbounded preceding and 1 preceding) as inner_source",
    ).where("quotes").join(spans, ["conv_id", "hash", "span"]).selectExpr(
        "conv_id", "turn", "level", "size", "coalesce(inner_source, before) as source"
    ).where("source is not null")
    weighed = latest.groupBy("conv_id", "turn", "level", "source").agg(F.sum("size").alias("weight"))
    # the outermost level that has an original decides
    replies = weighed.groupBy("conv_id", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("outer"), "weight", "source")).alias("best")
    ).select(
        "conv_id", "turn", F.col("best.source").alias("reply_to")
    )
    # follow the replies up, twice as far in each round
    known = placed.select("conv_id", "turn").distinct().join(replies, ["conv_id", "turn"], "left")
    known = store.write(
        "up-0",
        known.select(
            "conv_id", "turn", "reply_to", F.col("reply_to").alias("up"), F.coalesce("reply_to", "turn").alias("root"),
            F.when(F.col("reply_to").isNotNull(), 1).otherwise(0).cast("bigint").alias("depth"),
        ),
    )
    step = 0
    while not known.where("up is not null").isEmpty():
        step += 1
        above = known.select(
            "conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("root").alias("top"), F.col("depth").alias("more")
        )
        known = store.write(
            f"up-{step}",
            # messages whose conversation's start is found take no further part
            known.where("up is not null").join(above, ["conv_id", "up"], "left").select(
                "conv_id", "turn", "reply_to", F.col("next").alias("up"), F.coalesce("top", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ).unionByName(known.where("up is null")),
        )
    return read.select("conv_id", "turn", "role", "text").join(known.drop("up"), ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "reply_to", F.coalesce("root", "turn").alias("root"), F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"), "text"
    )
