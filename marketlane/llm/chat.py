"""Chat formatting into budgeted windows, in DataFrame functions only.

Prefix sums of the turns' tokens cut a conversation into spans of whole turns. Each span becomes one window: the system
turn again, the tail of the span before as history, then the span's own turns. Only the span's own assistant texts are
under the loss mask, so each is a target once. Texts are escaped reversibly; ``read_back`` recovers turns and targets
from the formatted strings alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM, HISTORY, OWN = 0, 1, 2


def escaped(text: F.Column) -> F.Column:
    """No ``<|`` is left: each ``<``, any backslashes, ``|`` gets one more backslash before the ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: F.Column) -> F.Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def _role_in(role: F.Column) -> F.Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_out(role: F.Column) -> F.Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def word_tokens(text: F.Column) -> F.Column:
    """Words, and four more for the marks around a turn."""
    return (F.size(F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda x: x != "")) + 4).cast("long")


def chat_windows(conversations: DataFrame, budget: int = 1024, history: int = 128, tokens=word_tokens) -> DataFrame:
    """One row per window: conv_id, window, n_turns (its own), n_tokens, formatted, own_from, loss (spans of formatted).

    Takes conv_id, turn, role, text and ignores other columns. Turns go by turn, then role, then text; nulls come first.
    A null text or role is empty; a null conv_id is a conversation of its own. A window has at most ``budget`` tokens
    unless the system turn or a single turn alone needs more; such a turn has a span of its own. Empty tables give none.
    """
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    earlier, so_far = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy("conv_id")
    zero = F.lit(0).cast("long")
    t = turns.withColumn("at", F.row_number().over(ordered) - 1)
    t = t.withColumn("system", (F.col("at") == 0) & (F.col("role") == "system")).withColumn("cost", tokens(F.col("text")))
    t = t.withColumn("own", F.when(F.col("system"), zero).otherwise(F.col("cost")))
    t = t.withColumn("before", F.coalesce(F.sum("own").over(earlier), zero))
    t = t.withColumn("room", F.greatest(F.lit(16), F.floor((budget - history - F.max(F.col("cost") - F.col("own")).over(everything)) / 2)))
    t = t.withColumn("big", (F.col("own") > F.col("room")).cast("int"))
    t = t.withColumn("part", F.struct((2 * F.coalesce(F.sum("big").over(earlier), zero) + F.col("big")).alias("bigs"), F.floor(F.col("before") / F.col("room")).alias("fill")))
    t = t.withColumn("new", F.when(F.lag("part").over(ordered) != F.col("part"), 1).otherwise(0))
    t = t.withColumn("window", F.sum("new").over(so_far).cast("int"))
    span = Window.partitionBy("conv_id", "window")
    t = t.withColumn("last", F.max("window").over(everything)).withColumn("after", F.max(F.col("before") + F.col("own")).over(span) - F.col("before"))
    uses = F.concat(
        F.array(F.struct(F.col("window"), F.lit(OWN).alias("kind"))),
        F.when(~F.col("system") & (F.col("after") <= history) & (F.col("window") < F.col("last")), F.array(F.struct((F.col("window") + 1).alias("window"), F.lit(HISTORY).alias("kind")))).otherwise(F.array().cast("array<struct<window:int,kind:int>>")),
        F.when(F.col("system") & (F.col("last") > 0), F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("last"))), lambda w: F.struct(w.alias("window"), F.lit(SYSTEM).alias("kind")))).otherwise(F.array().cast("array<struct<window:int,kind:int>>")),
    )
    head = F.concat(F.lit(OPEN), _role_in(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    placed = t.select("conv_id", "at", "cost", (F.col("role") == "assistant").alias("target"), head.alias("head"), body.alias("body"), F.explode(uses).alias("use")).select("*", "use.*").drop("use")
    placed = placed.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    within = Window.partitionBy("conv_id", "window").orderBy("kind", "at").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("from", F.coalesce(F.sum(F.char_length("piece")).over(within), zero))
    one = F.struct("kind", "at", "piece", "from", "target", (F.col("from") + F.char_length("head")).alias("start"), (F.col("from") + F.char_length("head") + F.char_length("body")).alias("end"))
    grouped = placed.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(one)).alias("p"), F.sum("cost").alias("n_tokens"), F.count_if(F.col("kind") == OWN).alias("n_turns"), F.min(F.when(F.col("kind") == OWN, F.col("from"))).alias("own_from"))
    loss = F.transform(F.filter("p", lambda x: (x["kind"] == OWN) & x["target"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return grouped.select("conv_id", "window", "n_turns", "n_tokens", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"), "own_from", loss.alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """For each window, from its formatted string: ``turns`` (role and text of its own turns) and ``targets`` (texts)."""
    tail = F.substring(F.col("formatted"), F.col("own_from").cast("int") + 1, F.char_length("formatted"))
    pieces = F.filter(F.split(tail, r"<\|im_end\|>\n"), lambda x: x.startswith(OPEN))
    role = lambda x: _role_out(F.substring(F.substring_index(x, "\n", 1), F.lit(len(OPEN) + 1), F.char_length(x)))
    text = lambda x: unescaped(F.substring(x, F.instr(x, "\n") + 1, F.char_length(x)))
    target = lambda s: unescaped(F.substring(F.col("formatted"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))
    return windows.select("conv_id", "window", F.transform(pieces, lambda x: F.struct(role(x).alias("role"), text(x).alias("text"))).alias("turns"), F.transform("loss", target).alias("targets"), F.char_length("formatted").cast("long").alias("chars"))


def digest(windows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows."""
    back = read_back(windows).select("conv_id", "window", "chars", F.size("turns").alias("n"), F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("said"), F.array_join("targets", "").alias("loss"))
    whole = back.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window", "said", "loss"))).alias("w"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"))
    said, loss = F.array_join("w.said", ""), F.array_join("w.loss", "")
    return whole.select("conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars", "n_windows")


# Windows are cut by the same sums; formatted characters are counted, as a turn's marks and escapes are known.
SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok' FROM range(2) AS r(i)),
placed AS (
  SELECT *, row_number() OVER w - 1 AS pos, 4 + len(list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) AS cost
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
owned AS (SELECT *, pos = 0 AND role = 'system' AS system, CASE WHEN pos = 0 AND role = 'system' THEN 0 ELSE cost END AS own FROM placed),
summed AS (
  SELECT *, coalesce(sum(own) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         greatest(16, floor((1024 - 128 - max(cost - own) OVER (PARTITION BY conv_id)) / 2)) AS room FROM owned),
parts AS (
  SELECT *, 2 * coalesce(sum(CAST(own > room AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + CAST(own > room AS INTEGER) AS bigs,
         floor(before / room) AS fill FROM summed),
edges AS (SELECT *, CASE WHEN lag(bigs) OVER w <> bigs OR lag(fill) OVER w <> fill THEN 1 ELSE 0 END AS new FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
windows AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS win FROM edges),
used AS (
  SELECT *, 1 + CASE WHEN NOT system AND max(before + own) OVER (PARTITION BY conv_id, win) - before <= 128 AND win < max(win) OVER (PARTITION BY conv_id) THEN 1 ELSE 0 END
              + CASE WHEN system THEN max(win) OVER (PARTITION BY conv_id) ELSE 0 END AS uses,
         replace(replace(role, '%', '%25'), chr(10), '%0A') AS head FROM windows),
sized AS (
  SELECT *, 24 + length(head) + len(regexp_extract_all(head, '<\\*\|')) + length(text) + len(regexp_extract_all(text, '<\\*\|')) AS chars FROM used)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars * uses) AS BIGINT) AS formatted_chars, count(DISTINCT win) AS n_windows
FROM sized GROUP BY conv_id
"""
