"""Preference formatting: one prompt, two masked completions."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import given, query

LAST = 2**63 - 1  # where a turn without a number stands


def _turns(conversations: DataFrame) -> DataFrame:
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (
        conversations.filter(F.col("conv_id").isNotNull())
        .groupBy("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("place")).agg(F.min(said).alias("said"))
    )


def preference_segments(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """Render every pair of a chosen and a rejected conversation, one row per rendered turn.

    ``conversations`` has ``conv_id``, ``turn``, ``role``, ``text``; ``pairs`` has ``pair_id``,
    ``chosen_id``, ``rejected_id``. Turns are compared by number, role and text. Those before the first
    that differs are the common prefix: they come once, as ``part`` ``prompt``. What follows comes
    as ``chosen`` and as ``rejected``. Returns ``pair_id``, ``part``, ``place`` (turn number), ``role``,
    ``rendered`` and ``mask_from``: from that character on the rendered turn counts in the loss
    (the words of an assistant in a completion and their end mark); null: no part of it does.

    A turn is rendered as ``<|im_start|>role``, a line end, the text, ``<|im_end|>`` and a line end. A ``<|`` in
    a text becomes ``< |``, so no text can pass for a mark. Null roles and texts count as empty. Of
    rows that share a conversation and number the smallest (role, text) counts, so repeated rows
    change nothing; a null number comes last; rows of a null conversation take no part, nor
    do pairs of unknown conversations. A pair whose one side is null or unknown has an empty prompt
    and one completion; two equal conversations are all prompt. Other columns are ignored.

    The prefix is found by aggregation per (pair, place), never by gathering a conversation, so
    a conversation or opening that holds a third of all turns spreads like any other rows.
    """
    sides = pairs.select("pair_id", F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("chosen_id").alias("conv_id")),
        F.struct(F.lit("rejected").alias("side"), F.col("rejected_id").alias("conv_id")),
    )).alias("s")).select("pair_id", "s.side", "s.conv_id").filter(F.col("pair_id").isNotNull() & F.col("conv_id").isNotNull())
    rows = _turns(conversations).join(sides, "conv_id").select("pair_id", "side", "place", "said")
    places = rows.groupBy("pair_id", "place").agg(
        F.min("said").alias("said"), F.max("said").alias("other"),
        F.max(F.col("side") == "chosen").alias("chosen"), F.max(F.col("side") == "rejected").alias("rejected"),
    )
    splits = places.filter(~(F.col("chosen") & F.col("rejected") & (F.col("said") == F.col("other")))).groupBy("pair_id").agg(F.min("place").alias("split"))
    joined = rows.join(splits, "pair_id", "left")
    in_prompt = F.col("split").isNull() | (F.col("place") < F.col("split"))
    safe = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("< |"))
    header = F.concat(F.lit("<|im_start|>"), safe("said.role"), F.lit("\n"))
    counts = ~in_prompt & (F.col("said.role") == "assistant")
    return joined.filter(~in_prompt | (F.col("side") == "chosen")).select(
        "pair_id", F.when(in_prompt, "prompt").otherwise(F.col("side")).alias("part"), "place", F.col("said.role").alias("role"),
        F.concat(header, safe("said.text"), F.lit("<|im_end|>\n")).alias("rendered"),
        F.when(counts, F.char_length(header)).alias("mask_from"),
    )


def preference_examples(segments: DataFrame) -> DataFrame:
    """One row per pair: ``prompt``, and per completion its text and ``[from, to)`` spans that count in the loss.

    Meant for training jobs that want whole strings; here a pair's text is gathered in one value.
    """
    turn = F.struct("place", "rendered", "mask_from")
    of = lambda part: F.array_sort(F.collect_list(F.when(F.col("part") == part, turn)))
    parts = segments.groupBy("pair_id").agg(*[of(p).alias(p) for p in ("prompt", "chosen", "rejected")])
    text = lambda p: F.concat_ws("", F.transform(p, lambda t: t["rendered"])).alias(p)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("spans"))

    def step(state, t):
        to = state["at"] + F.char_length(t["rendered"])
        span = F.array(F.struct((state["at"] + t["mask_from"]).alias("from"), (to - 1).alias("to")))
        return F.struct(to.alias("at"), F.when(t["mask_from"].isNull(), state["spans"]).otherwise(F.concat(state["spans"], span)).alias("spans"))

    spans = lambda p: F.aggregate(p, start, step)["spans"].alias(f"{p}_spans")
    return parts.select("pair_id", text("prompt"), text("chosen"), text("rejected"), spans("chosen"), spans("rejected"))


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs of conversations 2i and 2i + 1, for tables without preferences.

    The one with more characters by its assistant is chosen, the smaller id among equals; a conversation
    without a neighbour is chosen and has none rejected.
    """
    words = F.when(F.col("said.role") == "assistant", F.char_length("said.text")).otherwise(0)
    sizes = _turns(conversations).groupBy("conv_id").agg(F.sum(words).alias("words"))
    ranked = sizes.groupBy(F.floor(F.col("conv_id") / 2).alias("pair_id")).agg(
        F.min(F.struct((-F.col("words")).alias("w"), "conv_id")).alias("best"), F.max(F.struct((-F.col("words")).alias("w"), "conv_id")).alias("worst")
    )
    best, worst = F.col("best.conv_id"), F.col("worst.conv_id")
    return ranked.select("pair_id", best.alias("chosen_id"), F.when(best != worst, worst).alias("rejected_id"))


@query("""
with t as (
  select conv_id, turn as place, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  where conv_id is not null
  qualify row_number() over (partition by conv_id, turn order by coalesce(role, ''), coalesce(text, '')) = 1
), c as (
  select conv_id, conv_id // 2 as pair_id, sum(case when role = 'assistant' then length(text) else 0 end) as words from t group by conv_id
), s as (
  select conv_id, pair_id, case when row_number() over (partition by pair_id order by words desc, conv_id) = 1 then 'chosen' else 'rejected' end as side from c
), r as (select pair_id, side, place, role, text from t join s using (conv_id)),
d as (
  select coalesce(a.pair_id, b.pair_id) as pair_id, min(coalesce(a.place, b.place)) as split
  from (from r where side = 'chosen') a full join (from r where side = 'rejected') b
    on a.pair_id = b.pair_id and a.place = b.place and a.role = b.role and a.text = b.text
  where a.pair_id is null or b.pair_id is null group by all
), p as (
  select pair_id, case when split is null or place < split then 'prompt' else side end as part, place, replace(role, '<|', '< |') as role, side,
    replace(text, '<|', '< |') as text
  from r left join d using (pair_id)
)
select pair_id, part, place, role,
  sha256('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)) as rendered_sha256,
  case when part <> 'prompt' and role = 'assistant' then length(role) + 13 end::int as mask_from
from p where part <> 'prompt' or side = 'chosen'
""")
def op9_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = given(spark, sf_dir, "conversations")
    segments = preference_segments(conversations, neighbour_pairs(conversations))
    return segments.withColumn("rendered_sha256", F.sha2("rendered", 256)).drop("rendered")
