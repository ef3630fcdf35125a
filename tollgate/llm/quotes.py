"""Chat formatting by quotation linking, with DataFrame operations only.

A line that begins with marks ``>`` is quoted; the number of marks is its level.  Lines of
one level in a row, up to a blank one, are a passage.  A quoted passage, its lines joined,
lower-cased with single spaces and without marks, is hashed and joined to the latest message
before it in the conversation that has it as a passage of its own, however either is wrapped.
Only where a passage has no such message, a part of one was quoted: then its lines are hashed
and joined alike.  The message that most words of a message's first-level quotes are from, the
later of two with as many, is the one it replies to; deeper levels add to the messages
quoted.  Messages without a link follow one another by turn, replies stand under what they
reply to, and what is left of a text is its lines of level 0.

The join goes by a running last value within (conversation, hash), so a passage that a whole
conversation shares costs a sorted pass, not pairs.

Cases: a null text is empty; passages without a letter or digit are never linked; a null turn
comes first and is never a reply's target; turns are counted from 0; repeated rows for a turn
keep a row each and count as one message; a message is read whole, however long; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.tables import kept

MARKS = r"^(?:[ \t]*>)+[ \t]?"
DIGITS = 20  # as many as the largest turn can have


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"\s+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, line, level, passage (number of the run of lines of one level without a blank one), body (the line without marks), norm."""
    lines = messages.select("conv_id", "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "raw"))
    marks = F.regexp_extract("raw", MARKS, 0)
    out = lines.withColumns({"level": F.length(F.regexp_replace(marks, "[^>]", "")), "body": F.regexp_replace("raw", MARKS, "")}).withColumn("norm", normal(F.col("body")))
    by = Window.partitionBy("conv_id", "turn").orderBy("line")
    same = (F.col("level") == F.lag("level").over(by)) & ((F.col("norm") == "") == (F.lag("norm").over(by) == ""))
    return out.withColumn("passage", F.sum(F.coalesce((~same).cast("int"), F.lit(1))).over(by)).drop("raw")


def links(lines: DataFrame) -> DataFrame:
    """conv_id, turn, level, source, words: the latest earlier message with each quoted passage, or with each line of one that no message has, and its number of words."""
    some = lines.where(F.col("turn").isNotNull() & (F.col("norm") != ""))
    # a message's own lines only: as many as it has
    whole = some.groupBy("conv_id", "turn", "level", "passage").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "norm"))), lambda x: x["norm"]), " ").alias("norm"))
    both = whole.select("*", F.lit("passage").alias("kind")).unionByName(some.select("conv_id", "turn", "level", "passage", "norm", F.lit("line").alias("kind")))
    both = both.where(F.col("norm").rlike(r"[\p{L}\p{N}]"))
    keyed = both.select("conv_id", "turn", "level", "passage", "kind", F.sha2("norm", 256).alias("hash"), F.size(F.split("norm", " ")).alias("words"))
    # hot passages: one row of a message's own, so that a frame holds a row a message
    own = keyed.where("level = 0").select("conv_id", "turn", F.lit(0).alias("level"), F.lit(0).cast("long").alias("passage"), "kind", "hash", F.lit(0).alias("words")).distinct()
    before = Window.partitionBy("conv_id", "kind", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    source = F.max(F.when(F.col("level") == 0, F.col("turn"))).over(before)
    found = own.union(keyed.where("level > 0")).withColumn("source", source).where("level > 0 and source is not null")
    # a passage's own source before those of its lines
    at = F.struct("source", "words")
    each = found.groupBy("conv_id", "turn", "level", "passage").agg(F.max(F.when(F.col("kind") == "passage", at)).alias("whole"), F.collect_list(F.when(F.col("kind") == "line", at)).alias("lines"))
    return each.select("conv_id", "turn", "level", F.explode(F.when(F.col("whole").isNotNull(), F.array("whole")).otherwise(F.col("lines"))).alias("s")).select("conv_id", "turn", "level", "s.source", "s.words")


def format_chats(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, content, n_quoted, parent_turn (null for no reply), quoted_turns, path (order by it for replies under what they reply to)."""
    messages = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    lines = parsed(messages.select("conv_id", "turn", "text").distinct().groupBy("conv_id", "turn").agg(F.min("text").alias("text")))
    content = F.array_join(F.transform(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.regexp_extract(x, MARKS, 0) == ""), lambda x: x), "\n")
    quoted = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.regexp_extract(x, MARKS, 0) != ""))
    found = kept(links(lines), "quotes")
    votes = found.groupBy("conv_id", "turn", "source").agg(F.sum(F.when(F.col("level") == 1, F.col("words")).otherwise(0)).alias("n"))
    chosen = votes.groupBy("conv_id", "turn").agg(F.max(F.when(F.col("n") > 0, F.struct("n", "source"))).alias("best"), F.array_join(F.transform(F.sort_array(F.collect_set("source")), lambda x: x.cast("string")), ",").alias("quoted_turns"))
    replies = kept(chosen.select("conv_id", "turn", F.col("best.source").alias("parent_turn"), "quoted_turns"), "replies")
    # paths of replies only: others are roots; every round doubles how far up a path reaches
    pad = lambda c: F.lpad(c.cast("string"), DIGITS, "0")
    paths = replies.where("parent_turn is not null").select("conv_id", "turn", F.col("parent_turn").alias("top"), pad(F.col("turn")).alias("path"))
    while True:
        paths = kept(paths, "paths")
        up = paths.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("above"), F.col("path").alias("head"))
        joined = paths.join(up, ["conv_id", "top"], "left")
        if joined.where("above is not null").isEmpty():
            break
        paths = joined.select("conv_id", "turn", F.coalesce("above", "top").alias("top"), F.when(F.col("above").isNotNull(), F.concat("head", F.lit("/"), "path")).otherwise(F.col("path")).alias("path"))
    whole = paths.select("conv_id", "turn", F.concat(pad(F.col("top")), F.lit("/"), "path").alias("path"))
    out = messages.join(replies, ["conv_id", "turn"], "left").join(whole, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", content.alias("content"), quoted.cast("long").alias("n_quoted"), "parent_turn", F.coalesce("quoted_turns", F.lit("")).alias("quoted_turns"), F.coalesce("path", pad(F.col("turn")), F.lit("")).alias("path"))


ORACLE = r"""
WITH RECURSIVE msg AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS text FROM conversations),
one AS (SELECT conv_id, turn, min(text) AS text FROM msg GROUP BY conv_id, turn),
raw AS (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM one WHERE turn IS NOT NULL),
ln AS (SELECT conv_id, turn, line, length(regexp_replace(regexp_extract(l[line], '^(?:[ \t]*>)+[ \t]?'), '[^>]', '', 'g')) AS level,
    trim(regexp_replace(lower(regexp_replace(l[line], '^(?:[ \t]*>)+[ \t]?', '')), '\s+', ' ', 'g')) AS norm FROM (SELECT *, unnest(range(1, len(l) + 1)) AS line FROM raw) t),
marked AS (SELECT *, CASE WHEN level = lag(level) OVER w AND (norm = '') = (lag(norm) OVER w = '') THEN 0 ELSE 1 END AS begins FROM ln WINDOW w AS (PARTITION BY conv_id, turn ORDER BY line)),
placed AS (SELECT *, sum(begins) OVER (PARTITION BY conv_id, turn ORDER BY line) AS passage FROM marked),
units AS (SELECT conv_id, turn, level, passage, 'passage' AS kind, string_agg(norm, ' ' ORDER BY line) AS norm FROM placed WHERE norm <> '' GROUP BY conv_id, turn, level, passage
    UNION ALL SELECT conv_id, turn, level, passage, 'line', norm FROM placed WHERE norm <> ''),
ok AS (SELECT * FROM units WHERE regexp_matches(norm, '[\p{L}\p{N}]')),
src AS (SELECT q.*, len(string_split(q.norm, ' ')) AS words, (SELECT max(o.turn) FROM ok o WHERE o.level = 0 AND o.kind = q.kind AND o.conv_id = q.conv_id AND o.norm = q.norm AND o.turn < q.turn) AS source
    FROM ok q WHERE q.level > 0),
used AS (SELECT s.* FROM src s WHERE source IS NOT NULL AND (kind = 'passage' OR NOT EXISTS (SELECT 1 FROM src p WHERE p.kind = 'passage' AND p.source IS NOT NULL AND p.conv_id = s.conv_id AND p.turn = s.turn AND p.passage = s.passage))),
votes AS (SELECT conv_id, turn, source, coalesce(sum(words) FILTER (WHERE level = 1), 0) AS n FROM used GROUP BY conv_id, turn, source),
best AS (SELECT conv_id, turn, source AS parent_turn FROM votes WHERE n > 0
    QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY n DESC, source DESC) = 1),
quoted AS (SELECT conv_id, turn, string_agg(CAST(source AS VARCHAR), ',' ORDER BY source) AS quoted_turns FROM votes GROUP BY conv_id, turn),
paths AS (SELECT o.conv_id, o.turn, lpad(CAST(o.turn AS VARCHAR), 20, '0') AS path FROM one o ANTI JOIN best b ON o.conv_id = b.conv_id AND o.turn = b.turn WHERE o.turn IS NOT NULL
    UNION ALL SELECT b.conv_id, b.turn, p.path || '/' || lpad(CAST(b.turn AS VARCHAR), 20, '0') FROM best b JOIN paths p ON p.conv_id = b.conv_id AND p.turn = b.parent_turn)
SELECT m.conv_id, m.turn, m.role,
    array_to_string(list_filter(string_split(m.text, chr(10)), lambda x: NOT regexp_matches(x, '^(?:[ \t]*>)+[ \t]?')), chr(10)) AS content,
    CAST(length(list_filter(string_split(m.text, chr(10)), lambda x: regexp_matches(x, '^(?:[ \t]*>)+[ \t]?'))) AS BIGINT) AS n_quoted,
    b.parent_turn, coalesce(q.quoted_turns, '') AS quoted_turns, coalesce(p.path, '') AS path
FROM msg m LEFT JOIN best b ON m.conv_id = b.conv_id AND m.turn = b.turn
LEFT JOIN quoted q ON m.conv_id = q.conv_id AND m.turn = q.turn
LEFT JOIN paths p ON m.conv_id = p.conv_id AND m.turn = p.turn
"""
