"""Quotation linking: reply-ordered conversations without their quotes; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialize

# The mark of quoted lines: any number of ">" with blanks around each.
MARK = r"^(?:[ \t]{0,3}>[ \t]?)+"
# Lines such as "On Monday X wrote:" stand before a quotation and go with it.
INTRO = r"(?i)^.*\b(?:wrote|writes|said|schrieb|écrit|escribió)[ ]?:[ \t]*$"
# Passages of so many words are looked up by shingles of that size; shorter ones must be a whole line or message.
SHINGLE = 5


def normal(c: Column) -> Column:
    """What a quotation keeps of a line: letters and digits in lower case, one space between words."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def lines_of(text: Column) -> Column:
    """array<struct<level, body>> of the lines of a text."""
    lines = F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n", -1)

    def parse(line):
        mark = F.regexp_extract(line, MARK, 0)
        return F.struct(
            (F.length(mark) - F.length(F.replace(mark, F.lit(">"), F.lit("")))).alias("level"),
            F.regexp_replace(line, MARK, "").alias("body"),
        )

    return F.transform(lines, parse)


def passages(lines: Column) -> Column:
    """array<struct<level, lines>>: runs of neighbouring quoted lines of one level, normalised.

    Blank lines belong to the run around them; an introduction ends one, and neither is among its lines.
    """

    def sealed(x):
        level = x["level"].cast("string")
        words = F.when((x["level"] > 0) & ~x["intro"], normal(x["body"])).otherwise("")
        return F.concat(F.lit("\x01"), level, F.lit("\x02"), words, F.lit("\x01"), level, F.lit("\x03"))

    # Normalised words hold no control characters, so the seals between lines of one level can be taken out of the text.
    joined = F.regexp_replace(F.array_join(F.transform(lines, sealed), ""), r"\x01(\d+)\x03\x01\1\x02", "\n")
    runs = F.filter(F.split(joined, r"\x01\d+\x03"), lambda r: r != "")

    def parse(run):
        own = F.split(F.regexp_replace(run, r"^\x01\d+\x02", ""), "\n")
        return F.struct(F.regexp_extract(run, r"^\x01(\d+)", 1).cast("int").alias("level"), F.filter(own, lambda x: x != "").alias("lines"))

    return F.filter(F.transform(runs, parse), lambda p: (p["level"] > 0) & (F.size(p["lines"]) > 0))


def shingled(text: Column) -> Column:
    """Hashes of the different runs of SHINGLE words; of a shorter text, of all its words."""

    def runs(words):
        last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(SHINGLE))))

    # In an array of one, the text is split once and not anew for each run.
    return F.array_distinct(F.get(F.transform(F.array(F.split(text, " ")), runs), F.lit(0)))


def origins(asked: DataFrame, said: DataFrame) -> DataFrame:
    """conv_id, name, origin: the first turn of the conversation that has the words of a unit.

    ``asked`` has the units (conv_id, name, unit), once each; ``said`` has conv_id, turn, own (all
    words of a message), lines. A unit of SHINGLE words or more is looked for in the words, wherever
    lines end: its shingle that the fewest messages have finds them, and the words themselves decide.
    """
    size = F.size(F.split("unit", " "))
    short = asked.where(size < SHINGLE)
    lines = said.select("conv_id", "turn", F.explode(F.array_distinct(F.array_append("lines", F.col("own")))).alias("unit"))
    by_line = lines.join(short, ["conv_id", "unit"]).groupBy("conv_id", "name").agg(F.min("turn").alias("origin"))

    wanted = asked.where(size >= SHINGLE).select("conv_id", "name", F.explode(shingled(F.col("unit"))).alias("h"))
    met = said.select("conv_id", "turn", F.explode(shingled(F.col("own"))).alias("h")).distinct()
    met = materialize(met.join(wanted.select("conv_id", "h").distinct(), ["conv_id", "h"], "left_semi"), "said-shingles")
    counts = met.groupBy("conv_id", "h").agg(F.count("*").alias("c"))
    rarest = wanted.join(counts, ["conv_id", "h"], "left").groupBy("conv_id", "name")
    rarest = rarest.agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "h")).alias("r")).where("r.c > 0")
    pairs = rarest.select("conv_id", "name", "r.h").join(met, ["conv_id", "h"]).select("conv_id", "name", "turn")
    both = pairs.join(asked, ["conv_id", "name"]).join(said.select("conv_id", "turn", "own"), ["conv_id", "turn"])
    space = F.lit(" ")
    held = both.where(F.contains(F.concat(space, "own", space), F.concat(space, "unit", space)))
    return by_line.unionByName(held.groupBy("conv_id", "name").agg(F.min("turn").alias("origin")))


def conversations(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per message: conv_id, turn, role, content, n_quoted, n_linked, reply_to, thread, depth.

    Lines that begin with ">" are quoted, at the level of their marks. An introduction
    right before a deeper level belongs to the marks. ``content`` is the rest, its outer
    blanks trimmed. Neighbouring quoted lines of one level are a passage. It is linked to
    the earliest message of the conversation, before this one, whose own words hold the
    passage's words in a row (case, signs, blanks and line ends aside); one of fewer than
    five words only to a message that has it as a line or as all its words. Of a passage
    that no message holds, the lines are linked one by one in the same way.
    ``n_quoted`` and ``n_linked`` count quoted lines that are not blank. ``reply_to``
    is the turn that most lines of the least nested linked level come from (ties: the latest
    turn); a message that links nothing begins a thread. ``thread`` is the turn of the
    message that a chain of replies leads back to, ``depth`` its length; ordered by
    (conv_id, thread, depth, turn) the rows are conversations in reply order. A null
    text is empty; a message without conversation or turn stands alone; rows repeated in
    conversation and turn are parts of one message; other columns are ignored.
    """
    rows = messages.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"), lines_of(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("lines"),
    )
    after = F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1)))
    zipped = F.transform(
        F.arrays_zip(F.col("lines").alias("l"), after.alias("n")),
        lambda z: F.struct(
            z["l"]["level"].alias("level"), z["l"]["body"].alias("body"),
            ((F.coalesce(z["n"]["level"], F.lit(0)) > z["l"]["level"]) & F.rlike(z["l"]["body"], F.lit(INTRO))).alias("intro"),
        ),
    )
    rows = rows.withColumn("lines", zipped)
    own = F.filter("lines", lambda x: (x["level"] == 0) & ~x["intro"])
    placed = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    quoted = placed.where(F.exists("lines", lambda x: x["level"] > 0)).select("conv_id", "turn", F.explode(passages(F.col("lines"))).alias("p"))
    quoted = materialize(quoted.select("conv_id", "turn", "p.level", "p.lines", F.array_join("p.lines", " ").alias("unit")), "quoted")
    # Only conversations that quote are read again, and only units that some message quotes are looked for.
    said = placed.join(quoted.select("conv_id").distinct(), "conv_id", "left_semi")
    said = said.select("conv_id", "turn", F.filter(F.transform(own, lambda x: normal(x["body"])), lambda x: x != "").alias("lines"))
    said = said.where(F.size("lines") > 0).withColumn("own", F.array_join("lines", " "))
    asked = quoted.select("conv_id", F.explode(F.array_append("lines", F.col("unit"))).alias("unit")).distinct()
    found = materialize(origins(materialize(asked.withColumn("name", F.md5("unit")), "asked"), said), "origins")

    def linked(units: DataFrame) -> DataFrame:
        return units.withColumn("name", F.md5("unit")).join(found, ["conv_id", "name"], "left").withColumn("origin", F.expr("IF(origin < turn, origin, NULL)"))

    whole = linked(quoted)
    single = linked(whole.where("origin IS NULL").select("conv_id", "turn", "level", F.explode("lines").alias("unit")))
    votes = whole.select("conv_id", "turn", "level", "origin", F.size("lines").alias("n"))
    votes = votes.unionByName(single.select("conv_id", "turn", "level", "origin", F.lit(1).alias("n"))).where("origin IS NOT NULL")
    votes = votes.groupBy("conv_id", "turn", "level", "origin").agg(F.sum("n").alias("n"))
    best = votes.groupBy("conv_id", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("l"), "n", "origin")).alias("best"), F.sum("n").alias("n_linked")
    )
    replies = materialize(best.select("conv_id", "turn", F.col("best.origin").alias("reply_to"), "n_linked"), "replies")
    chains = chains_of(replies)
    content = F.regexp_replace(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), r"^\s+|\s+$", "")
    n_quoted = F.size(F.filter("lines", lambda x: (x["level"] > 0) & ~x["intro"] & (normal(x["body"]) != "")))
    rows = rows.select("conv_id", "turn", "role", content.alias("content"), n_quoted.cast("long").alias("n_quoted"))
    out = rows.join(replies, ["conv_id", "turn"], "left").join(chains, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "content", "n_quoted",
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "reply_to",
        F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )


def chains_of(replies: DataFrame) -> DataFrame:
    """conv_id, turn, thread, depth of the messages that reply, by doubling the length of the jumps each round."""
    jumps = replies.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth"))
    while True:
        ahead = jumps.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"), F.col("depth").alias("more"))
        jumps = jumps.join(ahead, ["conv_id", "thread"], "left").select(
            "conv_id", "turn", F.coalesce("further", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("further").isNotNull().alias("moved"),
        )
        seen = Observation()
        jumps = materialize(jumps.observe(seen, F.count_if("moved").alias("n")), "reply-chains")
        if not seen.get["n"]:
            return jumps.drop("moved")
        jumps = jumps.drop("moved")


QUOTES_SQL = r"""
WITH RECURSIVE lines AS (
  SELECT msg, conv_id, turn, role, i, len(m) - len(replace(m, '>', '')) AS level, regexp_replace(line, '^(?:[ \t]{0,3}>[ \t]?)+', '') AS body
  FROM (
    SELECT msg, conv_id, turn, role, i, line, regexp_extract(line, '^(?:[ \t]{0,3}>[ \t]?)+') AS m FROM (
      SELECT msg, conv_id, turn, role, UNNEST(l) AS line, UNNEST(range(1, len(l) + 1)) AS i FROM (
        SELECT row_number() OVER () AS msg, conv_id, turn, role,
          string_split(regexp_replace(COALESCE(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS l FROM conversations)))
), marked AS (
  SELECT *, COALESCE(LEAD(level) OVER (PARTITION BY msg ORDER BY i), 0) > level
    AND regexp_matches(body, '(?i)^.*\b(?:wrote|writes|said|schrieb|écrit|escribió)[ ]?:[ \t]*$') AS intro,
    i - row_number() OVER (PARTITION BY msg, level ORDER BY i) AS run,
    trim(regexp_replace(lower(body), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm FROM lines
), message AS (
  SELECT msg, any_value(conv_id) AS conv_id, any_value(turn) AS turn, any_value(role) AS role,
    regexp_replace(COALESCE(string_agg(body, chr(10) ORDER BY i) FILTER (level = 0 AND NOT intro), ''), '^\s+|\s+$', '', 'g') AS content,
    COUNT(*) FILTER (level > 0 AND NOT intro AND norm <> '') AS n_quoted FROM marked GROUP BY msg
), passage AS (
  SELECT any_value(conv_id) AS conv_id, any_value(turn) AS turn, level, string_agg(norm, ' ' ORDER BY i) AS unit, list(norm ORDER BY i) AS parts
  FROM marked WHERE level > 0 AND NOT intro AND norm <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY msg, level, run
), own AS (
  SELECT any_value(conv_id) AS conv_id, any_value(turn) AS turn, string_agg(norm, ' ' ORDER BY i) AS own, list(norm) AS parts
  FROM marked WHERE level = 0 AND NOT intro AND norm <> '' AND turn IS NOT NULL AND conv_id IN (SELECT conv_id FROM passage) GROUP BY msg
), asked AS (
  SELECT conv_id, unit FROM passage UNION SELECT conv_id, UNNEST(parts) FROM passage
), origin AS (
  SELECT a.conv_id, a.unit, MIN(o.turn) AS origin FROM asked a JOIN own o ON a.conv_id = o.conv_id AND CASE WHEN len(string_split(a.unit, ' ')) >= 5
    THEN contains(' ' || o.own || ' ', ' ' || a.unit || ' ') ELSE a.unit = o.own OR list_contains(o.parts, a.unit) END GROUP BY ALL
), whole AS (
  SELECT p.*, o.origin FROM passage p LEFT JOIN origin o ON p.conv_id = o.conv_id AND p.unit = o.unit AND o.origin < p.turn
), single AS (
  SELECT conv_id, turn, level, UNNEST(parts) AS unit FROM whole WHERE origin IS NULL
), votes AS (
  SELECT conv_id, turn, level, origin, SUM(n) AS n FROM (
    SELECT conv_id, turn, level, origin, len(parts) AS n FROM whole WHERE origin IS NOT NULL
    UNION ALL SELECT s.conv_id, s.turn, s.level, o.origin, 1 FROM single s JOIN origin o ON s.conv_id = o.conv_id AND s.unit = o.unit AND o.origin < s.turn
  ) GROUP BY ALL
), replies AS (
  SELECT conv_id, turn, arg_max(origin, row(-level, n, origin)) AS reply_to, SUM(n) AS n_linked FROM votes GROUP BY ALL
), chain AS (
  SELECT conv_id, turn, reply_to AS root, 1 AS depth FROM replies
  UNION ALL SELECT c.conv_id, c.turn, r.reply_to, c.depth + 1 FROM chain c JOIN replies r ON c.conv_id = r.conv_id AND c.root = r.turn
), thread AS (SELECT conv_id, turn, arg_max(root, depth) AS thread, MAX(depth) AS depth FROM chain GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role, m.content, CAST(m.n_quoted AS BIGINT) AS n_quoted, CAST(COALESCE(r.n_linked, 0) AS BIGINT) AS n_linked,
  r.reply_to, COALESCE(t.thread, m.turn) AS thread, CAST(COALESCE(t.depth, 0) AS BIGINT) AS depth
FROM message m LEFT JOIN replies r ON m.conv_id = r.conv_id AND m.turn = r.turn LEFT JOIN thread t ON m.conv_id = t.conv_id AND m.turn = t.turn
"""
