"""Chat formatting by quotation linking, in DataFrame functions only.

A line that starts with n marks `>` (each may follow a space) is quoted at level n.  A passage is a
run of lines of one level without a blank one, normalised (one space for white space, lower case) and
hashed.  A quoted passage is joined to the latest earlier turn of its conversation that holds it
unquoted; so each passage gives one link at most, however often it occurs.  A message's parent is the
turn that most of its linked passages of the least linked level point to; ties go to the later turn.

The result has one row for each message: its text without quotes, parent, the root of its thread, its
depth below it and its reply order in the thread: depth first, replies of one message by turn, the root 0.
Ordering a conversation by root_turn, reply_order gives it in reply order, every answer below what it answers.  Nulls are empty texts; messages without conv_id or turn are linked to nothing;
rows of one conv_id and turn share their links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.llm.shared import cut, drop

SPAN = 1024
MARKS = r"^( ?>)+"
SPACES = r"[ \t\n\r\f\x0B]+"


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, hash) of each distinct passage of messages (conv_id, turn, text)."""
    mark = F.regexp_extract("line", MARKS, 0)
    lines = (
        messages.select("conv_id", "turn", F.xxhash64("text").alias("id"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
        .distinct()
        .select("conv_id", "turn", "id", "at", F.length(F.translate(mark, " ", "")).alias("level"), F.regexp_replace("line", MARKS, "").alias("body"))
    )
    blank = F.regexp_replace("body", SPACES, "") == ""
    w = Window.partitionBy("conv_id", "turn", "id").orderBy("at")
    starts = F.when(blank, 0).when((F.lag("level").over(w) == F.col("level")) & ~F.lag(blank).over(w), 0).otherwise(1)
    runs = lines.withColumn("run", F.sum(starts).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter(~blank)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]), " ")
    joined = runs.groupBy("conv_id", "turn", "id", "run", "level").agg(text.alias("passage"))
    normal = F.lower(F.trim(F.regexp_replace("passage", SPACES, " ")))
    return joined.select("conv_id", "turn", "level", F.sha2(normal, 256).alias("hash")).distinct()


def links(found: DataFrame) -> DataFrame:
    """(conv_id, turn, level, hash, source): the latest earlier turn that holds a quoted passage unquoted."""
    quoted = found.filter("level > 0")
    own = found.filter("level = 0").join(quoted.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi").select("conv_id", "hash", "turn")
    bucket = F.floor(F.col("turn") / SPAN)
    # the latest turn of each range of turns, and of the ranges before it
    ranges = own.groupBy("conv_id", "hash", bucket.alias("bucket")).agg(F.max("turn").alias("last"))
    asked = quoted.select("conv_id", "hash", bucket.alias("bucket")).distinct()
    w = Window.partitionBy("conv_id", "hash").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = asked.join(ranges, ["conv_id", "hash", "bucket"], "full").withColumn("earlier", F.max("last").over(w)).select("conv_id", "hash", "bucket", "earlier")
    events = own.select("conv_id", "hash", "turn", F.lit(None).cast("int").alias("level"), F.col("turn").alias("own")).unionByName(quoted.select("conv_id", "hash", "turn", "level", F.lit(None).cast(own.schema["turn"].dataType).alias("own")))
    w = Window.partitionBy("conv_id", "hash", bucket).orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    within = events.withColumn("within", F.max("own").over(w)).filter("level is not null").withColumn("bucket", bucket)
    return within.join(before, ["conv_id", "hash", "bucket"], "left").select("conv_id", "turn", "level", "hash", F.coalesce("within", "earlier").alias("source")).filter("source is not null")


def parents(linked: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, n_linked)."""
    votes = linked.groupBy("conv_id", "turn", "level", "source").agg(F.count("*").alias("n"))
    return votes.groupBy("conv_id", "turn").agg(
        F.min(F.struct("level", (-F.col("n")).alias("n"), (-F.col("source")).alias("source"))).alias("best"),
        F.sum("n").alias("n_linked"),
    ).select("conv_id", "turn", (-F.col("best.source")).alias("parent_turn"), "n_linked")


def threads(edges: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth, reply_order) of messages with a parent, by doubling: each round follows twice as many steps."""
    # size: the message and those below it within the steps of the round
    state = cut(edges.select("conv_id", "turn", "parent_turn", F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth"), F.lit(1).cast("long").alias("size")), "threads")
    held, step = state, 1
    while True:
        above = state.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"), F.col("depth").alias("more"))
        below = state.filter(F.col("depth") == step).groupBy("conv_id", F.col("root_turn").alias("turn")).agg(F.sum("size").alias("lower"))
        moved = cut(state.join(above, ["conv_id", "root_turn"], "left").join(below, ["conv_id", "turn"], "left"), "threads")
        if moved.filter("next is not null").isEmpty():
            break
        drop(held)
        held, step = moved, 2 * step
        state = moved.select("conv_id", "turn", "parent_turn", F.coalesce("next", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), (F.col("size") + F.coalesce("lower", F.lit(0))).alias("size"))
    return state.select("conv_id", "turn", "root_turn", "depth").join(_reply_order(state), ["conv_id", "turn"])


def _reply_order(sized: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_order) of (conv_id, turn, parent_turn, size): a message stands one place after its parent
    and the earlier replies to it with all below them; these distances are added up to the root, again by doubling.
    Replies of one message are summed by ranges of turns first."""
    earlier = lambda keys, order: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    replies = sized.select("conv_id", "turn", "parent_turn", F.floor(F.col("turn") / SPAN).alias("bucket"), "size")
    sums = replies.groupBy("conv_id", "parent_turn", "bucket").agg(F.sum("size").alias("sum")).withColumn("base", F.sum("sum").over(earlier(["conv_id", "parent_turn"], "bucket"))).drop("sum")
    within = replies.withColumn("within", F.sum("size").over(earlier(["conv_id", "parent_turn", "bucket"], "turn")))
    distance = F.lit(1) + F.coalesce("base", F.lit(0)) + F.coalesce("within", F.lit(0))
    state = cut(within.join(sums, ["conv_id", "parent_turn", "bucket"]).select("conv_id", "turn", F.col("parent_turn").alias("above"), distance.cast("long").alias("reply_order")), "places")
    held = state
    while True:
        up = state.select("conv_id", F.col("turn").alias("above"), F.col("above").alias("next"), F.col("reply_order").alias("more"))
        moved = cut(state.join(up, ["conv_id", "above"], "left"), "places")
        if moved.filter("next is not null").isEmpty():
            return state.select("conv_id", "turn", "reply_order")
        drop(held)
        held = moved
        state = moved.select("conv_id", "turn", F.coalesce("next", "above").alias("above"), (F.col("reply_order") + F.coalesce("more", F.lit(0))).alias("reply_order"))


def link_quotations(messages: DataFrame) -> DataFrame:
    """messages (conv_id, turn, role, text) with text_unquoted, n_quoted, n_linked, parent_turn, root_turn, depth and reply_order; the text goes."""
    base = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    found = cut(passages(base.filter("conv_id is not null and turn is not null").select("conv_id", "turn", "text")), "passages")
    quoted = found.filter("level > 0").groupBy("conv_id", "turn").agg(F.count("*").alias("n_quoted"))
    edges = cut(parents(links(found)), "replies")
    facts = quoted.join(edges, ["conv_id", "turn"], "left").join(threads(edges), ["conv_id", "turn"], "left")
    kept = F.filter(F.split("text", "\n", -1), lambda x: ~x.rlike("^ ?>"))
    plain = F.regexp_replace(F.array_join(kept, "\n"), r"^\n+|\n+$", "")
    return base.join(facts, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        plain.alias("text_unquoted"),
        F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("reply_order", F.lit(0)).cast("long").alias("reply_order"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return link_quotations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = r"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
), message AS (
  SELECT DISTINCT conv_id, turn, text FROM base WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), line AS (
  SELECT conv_id, turn, text, pos, regexp_extract(l, '^( ?>)+') AS mark, regexp_replace(l, '^( ?>)+', '') AS body
  FROM (SELECT conv_id, turn, text, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS pos FROM message)
), leveled AS (
  SELECT *, length(replace(mark, ' ', '')) AS level, regexp_replace(body, '[ \t\n\r\f\x0B]+', '', 'g') = '' AS blank FROM line
), started AS (
  SELECT *, CASE WHEN blank THEN 0
    WHEN lag(level) OVER w = level AND NOT lag(blank) OVER w THEN 0 ELSE 1 END AS starts
  FROM leveled WINDOW w AS (PARTITION BY conv_id, turn, text ORDER BY pos)
), numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY conv_id, turn, text ORDER BY pos) AS run FROM started
), passage AS (
  SELECT DISTINCT conv_id, turn, level, sha256(lower(trim(regexp_replace(p, '[ \t\n\r\f\x0B]+', ' ', 'g')))) AS hash
  FROM (SELECT conv_id, turn, text, run, level, string_agg(body, ' ' ORDER BY pos) AS p FROM numbered WHERE NOT blank GROUP BY ALL)
), link AS (
  SELECT q.conv_id, q.turn, q.level, q.hash, max(o.turn) AS source
  FROM passage q JOIN passage o ON o.conv_id = q.conv_id AND o.hash = q.hash AND o.level = 0 AND q.level > 0 AND o.turn < q.turn
  GROUP BY ALL
), vote AS (
  SELECT conv_id, turn, level, source, count(*) AS n FROM link GROUP BY ALL
), parent AS (
  SELECT conv_id, turn, source AS parent_turn, total AS n_linked
  FROM (SELECT *, sum(n) OVER (PARTITION BY conv_id, turn) AS total,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, source DESC) AS r FROM vote) WHERE r = 1
), thread AS (
  SELECT conv_id, turn, parent_turn AS root_turn, 1 AS depth, [turn] AS path FROM parent
  UNION ALL
  SELECT t.conv_id, t.turn, p.parent_turn, t.depth + 1, list_prepend(t.root_turn, t.path) FROM thread t JOIN parent p ON p.conv_id = t.conv_id AND p.turn = t.root_turn
), root AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, root_turn ORDER BY path) AS reply_order
  FROM (SELECT conv_id, turn, arg_max(root_turn, depth) AS root_turn, max(depth) AS depth, arg_max(path, depth) AS path FROM thread GROUP BY ALL)
), quoted AS (
  SELECT conv_id, turn, count(*) AS n_quoted FROM passage WHERE level > 0 GROUP BY ALL
)
SELECT b.conv_id, b.turn, b.role,
  regexp_replace(array_to_string(list_filter(string_split(b.text, chr(10)), lambda x: NOT regexp_matches(x, '^ ?>')), chr(10)), '^\n+|\n+$', '', 'g') AS text_unquoted,
  CAST(coalesce(q.n_quoted, 0) AS BIGINT) AS n_quoted, CAST(coalesce(p.n_linked, 0) AS BIGINT) AS n_linked, p.parent_turn,
  coalesce(r.root_turn, b.turn) AS root_turn, CAST(coalesce(r.depth, 0) AS BIGINT) AS depth,
  CAST(coalesce(r.reply_order, 0) AS BIGINT) AS reply_order
FROM base b
LEFT JOIN quoted q ON q.conv_id = b.conv_id AND q.turn = b.turn
LEFT JOIN parent p ON p.conv_id = b.conv_id AND p.turn = b.turn
LEFT JOIN root r ON r.conv_id = b.conv_id AND r.turn = b.turn
"""
