"""Reply trees to training conversations. Spark functions only.

Messages name their parent; every leaf ends a branch. Branches come from self-joins that double their reach: round
``k`` gives each message its ancestor ``2^k`` up and the score of the stretch between, so the last one ranks the leaves;
going back down, each branch adds the ancestors that are ``2^k`` above what it has. A thread of a thousand turns takes
ten rounds, written one by one, and a branch one row for each of its messages. Branches are ranked by score (then length, then leaf); the chosen ones
are formatted.

``<|im_start|>role`` opens a turn, ``<|im_end|>`` closes it; control strings inside texts get a backslash after their
first character and backslashes are doubled, so no text can open or close a turn, and all can be read back. Only the
texts of assistant turns are under the loss mask.

Null texts and roles are empty. Messages whose parent is missing, null or not above them are roots. Repeated rows are
turns of their own; rows of equal turn come in order of role and text. A null conversation is one of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlprism.session import materialize

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# The first character of a control string, ahead of the rest: those of this template and of others in use.
_CONTROL = r"(?=\|[^|\s]*\|>)|(?=/?s>)|(?=</?SYS>>)"
TRAINED = "assistant"
# Doubling joins in one plan.
JOINS = 3


def escape(text: Column) -> Column:
    t = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    t = F.regexp_replace(t, rf"<(?:{_CONTROL})", r"<\\")
    return F.regexp_replace(t, r"\[(?=/?INST\])", r"[\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def linear_messages(conversations: DataFrame) -> DataFrame:
    """``(conv, node, parent, role, text, score)`` of conversations kept as rows by turn: each replies to the one before."""
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    rows = conversations.select(F.col("conv_id").alias("conv"), node.alias("node"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def branches(messages: DataFrame, most: int = 1) -> DataFrame:
    """``(conv, leaf, node, below)``: the ``most`` best branches of each conversation, ``below`` 0 for the leaf.

    ``messages`` has ``conv, node, parent, score``; a parent's ``node`` is below its replies'.
    """
    known = messages.select(F.col("conv").alias("_c"), F.col("node").alias("_p"))
    own = messages.select("conv", "node", "parent", "score").withColumn("conv", F.struct("conv"))
    known = known.withColumn("_c", F.struct("_c").cast(own.schema["conv"].dataType))
    good = (F.col("conv") == F.col("_c")) & (F.col("parent") == F.col("_p")) & (F.col("parent") < F.col("node"))
    tree = own.join(known, good, "left").select("conv", "node", F.col("_p").alias("up"), F.coalesce("score", F.lit(0.0)).alias("gain"))
    # reach[k]: each message with the one 2 ** k above it, if there is one, and the score and number of messages below that.
    reach = [materialize(tree.select("*", F.lit(1).cast("long").alias("hops")), "reach")]
    while not reach[-1].filter("up IS NOT NULL").isEmpty():
        last = reach[-1]
        above = last.select(F.col("conv").alias("_c"), F.col("node").alias("_n"), F.col("up").alias("far"), F.col("gain").alias("more"), F.col("hops").alias("further"))
        moved = last.filter("up IS NOT NULL").join(above, (F.col("conv") == F.col("_c")) & (F.col("up") == F.col("_n")))
        moved = moved.select("conv", "node", F.col("far").alias("up"), (F.col("gain") + F.col("more")).alias("gain"), (F.col("hops") + F.col("further")).alias("hops"))
        reach.append(materialize(moved.unionByName(last.filter("up IS NULL")), "reach"))
    parents = reach[0].filter("up IS NOT NULL").select("conv", F.col("up").alias("node")).distinct()
    leaves = reach[-1].join(parents, ["conv", "node"], "left_anti")
    rank = F.row_number().over(W.partitionBy("conv").orderBy(F.desc("gain"), F.desc("hops"), "node"))
    chosen = leaves.withColumn("rank", rank).filter(F.col("rank") <= most)
    rows = chosen.select("conv", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("below"))
    # Going back down, each message of a branch adds the one 2 ** k above it. A plan holds a few of these joins.
    for k in range(len(reach) - 2, -1, -1):
        jump = reach[k].filter("up IS NOT NULL").select("conv", "node", "up")
        own, next_ = F.struct("node", "below"), F.struct(F.col("up").alias("node"), (F.col("below") + (1 << k)).alias("below"))
        both = F.array_compact(F.array(own, F.when(F.col("up").isNotNull(), next_)))
        rows = rows.join(jump, ["conv", "node"], "left").select("conv", "leaf", F.inline(both))
        if k % JOINS == 0:
            rows = materialize(rows, "branches")
    return rows if len(reach) > 1 else materialize(rows, "branches")


def format_branches(messages: DataFrame, rows: DataFrame) -> DataFrame:
    """``(conv, leaf, formatted, loss)``: one conversation for each branch; ``loss`` holds start and length of each masked-in text."""
    texts = messages.select(F.struct("conv").alias("conv"), "node", "role", "text")
    rows = rows.join(texts, ["conv", "node"])
    head = F.concat(F.lit(OPEN), F.url_encode("role"), F.lit("\n"))
    rows = rows.select("conv", "leaf", "below", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    rows = rows.withColumn("turn", F.concat("head", "body", F.lit(CLOSE)))
    before = W.partitionBy("conv", "leaf").orderBy(F.desc("below")).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)) + F.length("head")
    rows = rows.withColumn("span", F.when(F.col("role") == TRAINED, F.struct(start.alias("start"), F.length("body").cast("long").alias("length"))))
    turns = F.sort_array(F.collect_list(F.struct((-F.col("below")).alias("o"), "turn", "span")))
    out = rows.groupBy("conv", "leaf").agg(turns.alias("t"))
    spans = F.filter(F.transform("t", lambda x: x["span"]), lambda s: s.isNotNull())
    return out.select("conv.conv", "leaf", F.concat_ws("", F.transform("t", lambda x: x["turn"])).alias("formatted"), spans.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv, leaf, place, role, text, trained)`` of formatted conversations; a turn is trained if its text is a span of the mask."""
    key = F.struct("conv").alias("conv")
    parts = formatted.select(key, "leaf", F.posexplode(F.split("formatted", r"<\|im_end\|>\n")).alias("place", "part"))
    before = W.partitionBy("conv", "leaf").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("offset", F.coalesce(F.sum(F.length("part") + len(CLOSE)).over(before), F.lit(0)))
    head = F.instr("part", "\n")
    body = F.substring("part", head + 1, F.length("part"))
    turns = parts.filter("part != ''").select(
        "conv",
        "leaf",
        "place",
        F.url_decode(F.substring("part", F.lit(len(OPEN) + 1), head - len(OPEN) - 1)).alias("role"),
        unescape(body).alias("text"),
        (F.col("offset") + head).alias("start"),
        F.length(body).cast("long").alias("length"),
    )
    spans = formatted.select(key, "leaf", F.inline("loss")).withColumn("trained", F.lit(True))
    rows = turns.join(spans, ["conv", "leaf", "start", "length"], "left")
    return rows.select("conv", "leaf", "place", "role", "text", F.coalesce("trained", F.lit(False)).alias("trained"))


def digests(conversations: DataFrame) -> DataFrame:
    """Formats conversations kept by turn, reads them back, and describes what was read."""
    messages = materialize(linear_messages(conversations), "messages")
    formatted = materialize(format_branches(messages, branches(messages)), "formatted")
    turns = F.sort_array(F.collect_list(F.struct("place", "role", "text", "trained")))
    rows = read_back(formatted).groupBy("conv", "leaf").agg(turns.alias("t"))
    said = F.concat_ws("", F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    loss = F.concat_ws("", F.transform(F.filter("t", lambda x: x["trained"]), lambda x: x["text"]))
    sizes = formatted.select(F.struct("conv").alias("conv"), "leaf", F.length("formatted").cast("long").alias("formatted_chars"))
    rows = rows.join(sizes, ["conv", "leaf"])
    return rows.select(
        F.col("conv.conv").alias("conv_id"),
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: The conversation that the query adds: its texts are control strings of other templates.
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def with_planted(conversations: DataFrame) -> DataFrame:
    own = conversations.select("conv_id", "turn", "role", "text")
    return own.union(own.sparkSession.createDataFrame(PLANTED, own.schema))


def oracle() -> str:
    """What must be read back, as SQL."""
    rows = ", ".join("(%d, %d, '%s', '%s')" % r for r in PLANTED)
    return rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t, role, text
  FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES {rows}) v(conv_id, turn, role, text))),
made AS (
  SELECT *, regexp_replace(regexp_replace(replace(t, '\', '\\'), '<(\|[^|\s]*\|>|/?s>|</?SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g') AS e FROM rows),
said AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS said,
         coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FILTER (r = '{TRAINED}'), '') AS loss,
         sum({len(OPEN)} + length(r) + 1 + length(e) + {len(CLOSE)})::BIGINT AS formatted_chars
  FROM made GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM said
"""
