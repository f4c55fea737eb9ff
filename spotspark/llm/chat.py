"""Preference formatting of chat conversations, in DataFrame functions only.

A pair has a chosen and a rejected conversation. Their longest common prefix of turns (same role and text) is rendered once as
the prompt; what follows on each side is its completion, in segments whose text is trained on (mask 1) only where an
assistant speaks. Turns are joined by place, so the prefix is found without gathering conversations; only the rendered turns
of one conversation are gathered, ordered by turn.

The marks can't be forged: wherever a text has "<|", it is rendered as "<||", which no mark contains, and "|" in a role is doubled, so
that a role ends at the first single one; undoing both gives role and text as they were.
Beside the mask, each completion has the places of its assistant texts.

Defined cases: null roles and texts are empty; turns are placed by turn, then role, then text (ties, repeated rows stay as turns);
rows without a turn come first; a pair without one of its sides, or whose sides are equal, has an empty completion there; rows
with a null pair are left out; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def format_preferences(turns: DataFrame) -> DataFrame:
    """turns: (pair_id, side in {chosen, rejected}, turn, role, text).

    Result: pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask, chosen_spans, rejected_spans. A mask has a
    letter for each turn of the completion: 1 where it is trained on. Spans are the code points of these turns in the completion that
    are trained on (the text and the mark that ends it), as start:end (end exclusive), joined by commas.
    """
    rows = turns.where(F.col("pair_id").isNotNull() & F.col("side").isin("chosen", "rejected"))
    rows = rows.select("pair_id", "side", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")))
    # both sides of a place meet in one row: equal while they share role and text
    met = rows.groupBy("pair_id", "place").agg(
        F.max(F.when(F.col("side") == "chosen", F.struct("role", "text"))).alias("c"), F.max(F.when(F.col("side") == "rejected", F.struct("role", "text"))).alias("r")
    )
    differs = ~F.coalesce(F.col("c") == F.col("r"), F.lit(False))
    first = F.min(F.when(differs, F.col("place"))).over(Window.partitionBy("pair_id"))
    met = met.withColumn("first", F.coalesce(first, F.lit(2147483647)))
    safe = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("<||"))
    named = lambda c: F.replace(F.col(c), F.lit("|"), F.lit("||"))
    show = lambda s: F.concat(F.lit(OPEN), named(f"{s}.role"), F.lit(CLOSE), safe(f"{s}.text"), F.lit(END))
    trained = lambda s: F.when(F.col(f"{s}.role") == "assistant", "1").otherwise("0")
    shared, own = F.col("place") < F.col("first"), F.col("place") >= F.col("first")
    head = lambda s: F.length(F.concat(F.lit(OPEN), named(f"{s}.role"), F.lit(CLOSE)))
    sized = lambda s: F.struct("place", head(s).alias("head"), F.length(show(s)).alias("whole"), (F.col(f"{s}.role") == "assistant").alias("trained"))
    turns_of = lambda cond, s: F.collect_list(F.when(cond, sized(s)))
    gather = lambda cond, text: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("place", text.alias("t"))))), lambda x: x["t"]), "")
    out = met.groupBy("pair_id").agg(
        F.sum(shared.cast("long")).alias("n_prompt_turns"),
        gather(shared, show("c")).alias("prompt"),
        gather(own & F.col("c").isNotNull(), show("c")).alias("chosen"),
        gather(own & F.col("r").isNotNull(), show("r")).alias("rejected"),
        gather(own & F.col("c").isNotNull(), trained("c")).alias("chosen_mask"),
        gather(own & F.col("r").isNotNull(), trained("r")).alias("rejected_mask"),
        turns_of(own & F.col("c").isNotNull(), "c").alias("c"),
        turns_of(own & F.col("r").isNotNull(), "r").alias("r"),
    )
    kept = ["pair_id", "n_prompt_turns", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask"]
    return out.select(*kept, _spans("c").alias("chosen_spans"), _spans("r").alias("rejected_spans"))


def _spans(turns: str) -> Column:
    """start:end of the trained parts, from the turns (place, head and whole lengths, trained) in order."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("s"))

    def step(x: Column, t: Column) -> Column:
        span = F.concat(F.when(x["s"] != "", ",").otherwise(""), (x["at"] + t["head"]).cast("string"), F.lit(":"), (x["at"] + t["whole"]).cast("string"))
        return F.struct((x["at"] + t["whole"]).alias("at"), F.when(t["trained"], F.concat(x["s"], span)).otherwise(x["s"]).alias("s"))

    return F.aggregate(F.array_sort(turns), zero, step, lambda x: x["s"])


def preference_turns(conversations: DataFrame) -> DataFrame:
    """Preference pairs out of plain conversations: chosen is a conversation up to its last assistant turn; rejected is the same
    with that turn's text taken from the last assistant turn of the conversation beside it (conv_id 2i and 2i + 1)."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    said = rows.where("role = 'assistant' and turn is not null")
    last = said.groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("x")).select("pair_id", F.col("x.turn").alias("last"), F.col("x.text").alias("answer"))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("answer").alias("other"))
    ends = last.drop("answer").join(other, "pair_id")
    upto = rows.join(ends, "pair_id").where(F.coalesce(F.col("turn") <= F.col("last"), F.lit(True)))
    final = (F.col("turn") == F.col("last")) & (F.col("role") == "assistant")
    chosen = upto.select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text")
    rejected = upto.select("pair_id", F.lit("rejected").alias("side"), "turn", "role", F.when(final, F.col("other")).otherwise(F.col("text")).alias("text"))
    return chosen.unionByName(rejected)


def _oracle_side(text: str) -> str:
    """Spans of one side: code points before a turn are the sum of the turns before it."""
    shown = f"'<|' || replace(role, '|', '||') || '|>' || chr(10) || replace({text}, '<|', '<||') || '<|end|>' || chr(10)"
    head = "4 + len(replace(role, '|', '||')) + 1"
    before = f"coalesce(sum(CASE WHEN place >= first THEN len({shown}) ELSE 0 END) OVER (PARTITION BY pair_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    return f"CAST({before} + {head} AS BIGINT) || ':' || CAST({before} + len({shown}) AS BIGINT)"


ORACLE = f"""
WITH said AS (SELECT conv_id, max({{'turn': turn, 'text': text}}) AS x FROM conversations WHERE role = 'assistant' AND turn IS NOT NULL AND conv_id IS NOT NULL GROUP BY 1),
ends AS (SELECT a.conv_id, a.x.turn AS last, b.x.text AS other FROM said a JOIN said b ON b.conv_id = xor(a.conv_id, 1)),
upto AS (SELECT c.conv_id AS pair_id, row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn, coalesce(c.role, ''), coalesce(c.text, '')) AS place, coalesce(c.role, '') AS role, coalesce(c.text, '') AS c,
  coalesce(CASE WHEN c.turn = e.last AND c.role = 'assistant' THEN e.other ELSE c.text END, '') AS r FROM conversations c JOIN ends e ON c.conv_id = e.conv_id WHERE coalesce(c.turn <= e.last, true)),
split AS (SELECT *, coalesce(min(CASE WHEN c <> r THEN place END) OVER (PARTITION BY pair_id), 2147483647) AS first FROM upto),
shown AS (SELECT *, replace(role, '|', '||') AS er, replace(c, '<|', '<||') AS ec, replace(r, '<|', '<||') AS ex, {_oracle_side("c")} AS cs, {_oracle_side("r")} AS rs FROM split)
SELECT pair_id, CAST(sum(CASE WHEN place < first THEN 1 ELSE 0 END) AS BIGINT) AS n_prompt_turns,
  coalesce(string_agg('<|' || er || '|>' || chr(10) || ec || '<|end|>' || chr(10), '' ORDER BY place) FILTER (place < first), '') AS prompt,
  coalesce(string_agg('<|' || er || '|>' || chr(10) || ec || '<|end|>' || chr(10), '' ORDER BY place) FILTER (place >= first), '') AS chosen,
  coalesce(string_agg('<|' || er || '|>' || chr(10) || ex || '<|end|>' || chr(10), '' ORDER BY place) FILTER (place >= first), '') AS rejected,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN '1' ELSE '0' END, '' ORDER BY place) FILTER (place >= first), '') AS chosen_mask,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN '1' ELSE '0' END, '' ORDER BY place) FILTER (place >= first), '') AS rejected_mask,
  coalesce(string_agg(cs, ',' ORDER BY place) FILTER (place >= first AND role = 'assistant'), '') AS chosen_spans,
  coalesce(string_agg(rs, ',' ORDER BY place) FILTER (place >= first AND role = 'assistant'), '') AS rejected_spans
FROM shown GROUP BY 1"""
