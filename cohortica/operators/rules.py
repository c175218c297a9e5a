"""Rules that name, describe and prioritise segments: ordered conditions and lookup tables, in our own words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortica import config

S = config.SETTINGS
DIMENSIONS = ("readiness", "confidence", "barriers", "engagement")


def value_for(profile: DataFrame, dimension: str, label_pattern: str, segment: str = "segment") -> DataFrame:
    """segment, <dimension>: the standardised mean furthest from 0 among variables whose lower-case label matches."""
    hit = profile.where(F.lower("label").rlike(label_pattern))
    w = Window.partitionBy(segment).orderBy(F.abs("standardised_mean").desc_nulls_last(), "variable")
    return hit.withColumn("__k", F.row_number().over(w)).where("__k = 1").select(segment, F.col("standardised_mean").alias(dimension))


def classify_level(value: Column, high: str = "High", middle: str = "Moderate", low: str = "Low", cut: float = S.strong) -> Column:
    return F.when(value >= cut, high).when(value <= -cut, low).otherwise(middle)


def segment_name(readiness: Column, confidence: Column, barriers: Column, engagement: Column, s: config.Settings = S) -> Column:
    """The first of five that holds; nulls hold nothing."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(yes(readiness >= s.strong) & yes(confidence >= s.strong), "Ready and assured")
        .when(yes(readiness <= -s.strong) & yes(barriers >= s.strong), "Held back by barriers")
        .when(yes(confidence <= -s.moderate), "Unsure of themselves")
        .when(yes(engagement >= s.strong) & yes(readiness < s.moderate), "Active, not committed")
        .otherwise("Mixed middle")
    )


def narrative(name: Column, levels: dict[str, Column]) -> Column:
    parts = [F.concat(F.lit(f"{d} is "), F.lower(c)) for d, c in levels.items()]
    return F.concat(name, F.lit(": "), F.concat_ws(", ", *parts), F.lit("."))


def position(x: Column) -> Column:
    """High, Low or Moderate from a free description."""
    s = F.lower(F.coalesce(x, F.lit("moderate")))
    return F.when(s.rlike("high|strong"), "High").when(s.rlike("low|weak|limited"), "Low").otherwise("Moderate")


def priority_score(readiness: Column, confidence: Column, barriers: Column, share_pct: Column) -> Column:
    r, c, b = position(readiness), position(confidence), position(barriers)
    return (
        F.when(r == "High", 3).when(r == "Moderate", 2).otherwise(1)
        + F.when(c == "Low", 2).when(c == "Moderate", 1).otherwise(0)
        + F.when(b == "High", 3).when(b == "Moderate", 1).otherwise(0)
        + F.when(share_pct >= 30, 2).when(share_pct >= 20, 1).otherwise(0)
    )


def priority(score: Column) -> Column:
    return F.when(score >= 8, "Very high").when(score >= 6, "High").when(score >= 4, "Medium").otherwise("Lower")


#: What each name calls for: problem, objective, service, channel, message, tone, call to action.
STRATEGY = [
    ("Ready and assured", "Intent isn't yet turned into a habit", "Turn intent into regular action", "One-step enrolment", "Reminders where they already are", "You are ready: start today", "direct", "Start now"),
    ("Held back by barriers", "Costs and effort outweigh the benefit", "Lower the first hurdle", "Subsidised, assisted start", "Trusted local contacts", "We take the hard part off you", "supportive", "See what help there is"),
    ("Unsure of themselves", "They doubt that they can do it", "Build confidence by small wins", "Guided trial", "Peers and coaches", "Small steps count", "encouraging", "Try one step"),
    ("Active, not committed", "Activity without a reason to change", "Link activity to a goal", "Personal goal setting", "Digital tools in use", "Make what you do count", "motivating", "Set a goal"),
    ("Mixed middle", "No single obstacle stands out", "Find out what moves each part", "Segmented offers", "Broad reach, then retarget", "There is a way that suits you", "neutral", "Find your way"),
]
STRATEGY_COLUMNS = "working_name string, core_problem string, objective string, service string, channel string, message string, tone string, call_to_action string"

#: Actions and measures that every segment gets, in order; what they are about comes from the segment's strategy.
ACTIONS = ("Brief the team on the segment", "Prepare the offer", "Prepare the message", "Open the channel", "Support the first step", "Review the result")
KPIS = ("Reach", "Response", "Start", "Completion", "Retention")


def strategy(names: DataFrame) -> DataFrame:
    """names (segment, working_name) with its strategy."""
    return names.join(F.broadcast(names.sparkSession.createDataFrame(STRATEGY, STRATEGY_COLUMNS)), "working_name", "left")


def _numbered(spark: SparkSession, values: tuple[str, ...], name: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(values, 1)), f"{name}_rank int, {name} string")


def actions(segments: DataFrame, most: int = len(ACTIONS)) -> DataFrame:
    """segment, priority, action_rank, action: as many rows for each segment as there are actions, up to most."""
    table = F.array(*[F.struct(F.lit(i).alias("action_rank"), F.lit(a).alias("action")) for i, a in enumerate(ACTIONS[:most], 1)])
    return segments.select("segment", "priority", F.explode(table).alias("a")).select("segment", "priority", "a.*")


def kpis(segments: DataFrame, most: int = len(KPIS)) -> DataFrame:
    table = F.array(*[F.struct(F.lit(i).alias("kpi_rank"), F.lit(a).alias("kpi")) for i, a in enumerate(KPIS[:most], 1)])
    return segments.select("segment", F.explode(table).alias("a")).select("segment", "a.*")


def implementation_rank(segments: DataFrame) -> DataFrame:
    """segments (segment, priority_score, share_pct) with overall_rank: by score, then share, then name."""
    return segments.withColumn("overall_rank", F.row_number().over(Window.orderBy(F.col("priority_score").desc_nulls_last(), F.col("share_pct").desc_nulls_last(), "segment")))


#: Which level of which dimension calls for which beginning; the first that holds counts, the last one always does.
SEQUENCE = (
    ({"readiness": "High", "confidence": "High"}, "Start with offers that can be taken up at once."),
    ({"barriers": "High"}, "Start by lowering barriers, with help at hand."),
    ({"confidence": "Low"}, "Start with small guided steps that build confidence."),
    ({}, "Start with personal messages and try several ways."),
)
#: Bands of priority, the most pressing first; a segment's level is 4 in the first and 1 in the last.
BANDS = ("Very high", "High", "Medium", "Lower")


def chosen(cases: tuple, positions: dict[str, Column]) -> Column:
    """The text of the first case whose levels all hold; the last case always does."""
    holds = lambda levels: reduce(lambda a, b: a & b, [positions[d] == level for d, level in levels.items()])
    return reduce(lambda out, case: F.when(holds(case[0]), case[1]).otherwise(out), reversed(cases[:-1]), F.lit(cases[-1][1]))


def recommended_sequence(**positions: Column) -> Column:
    """What a segment is to begin with, by the position of each dimension (free descriptions; null is Moderate)."""
    return chosen(SEQUENCE, {d: position(x) for d, x in positions.items()})


#: What positions call for, whatever the segment's name: column -> cases in order. digital is High where the segment's traits show it.
_BOTH = {"readiness": "High", "confidence": "High"}
_FAR = {"readiness": "Low", "barriers": "High"}
BY_POSITION = {
    "core_problem": (
        (_FAR, "Hurdles keep them from getting ready, and change looks out of reach"),
        ({"readiness": "Moderate", "confidence": "Low"}, "They are open to change but doubt that they can keep it up"),
        (_BOTH, "They are willing and able; delay and unclear steps hold them up"),
        ({"barriers": "High"}, "They would change, but it asks too much effort"),
        ({}, "The way from knowing to doing means little to them yet"),
    ),
    "objective": (
        (_FAR, "Make it look easier, and help with small first steps"),
        ({"confidence": "Low"}, "Show that each step can be done and that it gets them on"),
        (_BOTH, "Turn readiness into action at once, with nothing in the way"),
        ({}, "Make it matter to them, with a choice of next steps"),
    ),
    "approach": (
        (_FAR, "Lower hurdles, talk about motives, graded tasks, what others did, reassurance"),
        ({"confidence": "Low"}, "Plans made together, if-then intentions, feedback, examples of peers"),
        (_BOTH, "Plain calls to act, defaults, reminders, a quick start"),
        ({}, "Personal facts, well-ordered choices, prompts at the right time"),
    ),
    "service": (
        ({"barriers": "High"}, "A person who guides, flexible hours, lower costs, calls back"),
        ({"confidence": "Low"}, "An introduction in steps, regular talks, coaching, visible progress"),
        (_BOTH, "Self-service, short forms, booking and answer at once"),
        ({}, "Self-service and people side by side, as they choose"),
    ),
    "channel": (
        ({"barriers": "High"}, "First: people they trust, telephone, places nearby. Then: simple digital reminders"),
        ({"confidence": "Low"}, "First: people they trust, telephone, places nearby. Then: simple digital reminders"),
        (_BOTH, "First: mobile, mail, website. Then: short reminders"),
        ({"digital": "High"}, "First: personal mail, mobile and web. Then: an adviser, if wanted"),
        ({}, "Digital, direct and personal contact together"),
    ),
}
#: What tells of digital habits in a segment's traits, lower case.
DIGITAL = r"used digital tool.*\+|digital.*high|online.*high"


def strategy_by_position(segments: DataFrame, traits: str | None = None, digital: str = DIGITAL) -> DataFrame:
    """segments (readiness, confidence, barriers as free descriptions, null is Moderate) with a column for each of BY_POSITION.

    traits: a column of text about the segment; where the pattern digital matches it, in any case, the segment is reached by digital means.
    """
    signal = F.lower(F.coalesce(F.col(traits), F.lit(""))).rlike(digital) if traits else F.lit(False)
    at = {d: position(F.col(d)) for d in ("readiness", "confidence", "barriers")} | {"digital": F.when(signal, "High").otherwise("Moderate")}
    return segments.withColumns({name: chosen(cases, at) for name, cases in BY_POSITION.items()})


def implementation_priorities(segments: DataFrame) -> DataFrame:
    """segments (segment, priority, readiness, confidence, barriers, share_pct and more) with priority_level, recommended_sequence and overall_rank.

    The rank goes by level, then share, then name; a null or unknown priority has the lowest level.
    """
    level = reduce(lambda out, i: F.when(F.col("priority") == BANDS[i], len(BANDS) - i).otherwise(out), range(len(BANDS) - 1), F.lit(1))
    order = Window.orderBy(F.col("priority_level").desc(), F.col("share_pct").desc_nulls_last(), "segment")  # a row a segment
    begun = segments.withColumns({"priority_level": level, "recommended_sequence": recommended_sequence(**{d: F.col(d) for d in ("readiness", "confidence", "barriers")})})
    return begun.withColumn("overall_rank", F.row_number().over(order))


def persona(sizes: DataFrame, numeric: DataFrame, categorical: DataFrame, most: int = S.top_features) -> DataFrame:
    """segment, n, share_pct, key_characteristics, profiling_signals: the strongest means and each variable's commonest level, as text."""
    top = Window.partitionBy("segment").orderBy(F.abs("standardised_mean").desc_nulls_last(), "variable")
    traits = numeric.withColumn("k", F.row_number().over(top)).where(F.col("k") <= most).withColumn("text", F.concat(F.when(F.col("standardised_mean") >= 0, "higher ").otherwise("lower "), "variable"))
    modal = Window.partitionBy("segment", "variable").orderBy(F.col("n").desc(), "level")
    first = categorical.withColumn("m", F.row_number().over(modal)).where("m = 1")
    signals = first.withColumn("k", F.row_number().over(Window.partitionBy("segment").orderBy(F.col("within_segment_share").desc(), "variable"))).where(F.col("k") <= most).withColumn("text", F.concat("variable", F.lit(": "), "level"))
    joined = lambda d, name: d.groupBy("segment").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "; ").alias(name))
    return sizes.join(joined(traits, "key_characteristics"), "segment", "left").join(joined(signals, "profiling_signals"), "segment", "left")


def _first(*cases: tuple[Column, str], other: str) -> Column:
    out = F.when(cases[0][0], cases[0][1])
    for test, text in cases[1:]:
        out = out.when(test, text)
    return out.otherwise(other)


def implications(positions: DataFrame) -> DataFrame:
    """positions: segment, working_name, readiness, confidence, barriers (High, Moderate or Low) -> delivery_style, support_intensity, call_to_action."""
    ready, unsure, blocked = F.col("readiness") == "High", F.col("confidence") == "Low", F.col("barriers") == "High"
    return positions.select(
        "segment", "working_name",
        _first((ready, "Short and direct, with the least effort asked"), (unsure, "Guided, with support at each step"), (blocked, "Practical, with the obstacles taken first"), other="Flexible, fitted to the person").alias("delivery_style"),
        _first((unsure & blocked, "High"), (ready, "Low to moderate"), other="Moderate").alias("support_intensity"),
        _first((ready, "Begin today"), (unsure, "Try one step with help"), (blocked, "See an easier way"), other="Find out more").alias("call_to_action"),
    )


def message_advice(positions: DataFrame) -> DataFrame:
    """positions: also trust -> segment, working_name, tone, avoid."""
    ready, unready, unsure, blocked, wary = F.col("readiness") == "High", F.col("readiness") == "Low", F.col("confidence") == "Low", F.col("barriers") == "High", F.col("trust") == "Low"
    return positions.select(
        "segment", "working_name",
        _first((wary, "Open, with evidence"), (unsure, "Encouraging, without blame"), (ready, "Decisive"), other="Even and informative").alias("tone"),
        _first((unready, "Pressing for action"), (unsure, "Hints at failing"), (blocked, "Passing over cost, time or effort"), (wary, "Claims without proof"), other="The same words for everyone").alias("avoid"),
    )


def interventions(positions: DataFrame) -> DataFrame:
    """implications and advice side by side, whichever of the two a segment has."""
    return implications(positions).join(message_advice(positions), ["segment", "working_name"], "full")


def quote(readiness: Column, confidence: Column, barriers: Column) -> Column:
    """What a segment's persona might say."""
    said = _first(((readiness == "High") & (confidence == "High"), "Tell me the next step and I will take it."), (confidence == "Low", "I would like to, if someone shows me that I can."), (barriers == "High", "It costs me too much time and money as things are."), other="I may change if it suits my life.")
    return F.concat(F.lit("\u201c"), said, F.lit("\u201d"))


def message_hierarchy(positions: DataFrame) -> DataFrame:
    """segment, working_name, message_rank, message_type, message: the main message, what supports it, and what to say to doubts."""
    main = _first((F.col("readiness") == "High", "You are set to begin"), (F.col("readiness") == "Low", "There is no hurry"), other="A small start is enough")
    support = _first((F.col("confidence") == "Low", "We go with you at each step"), (F.col("confidence") == "High", "You know how to do this"), other="You can learn as you go")
    doubts = _first((F.col("barriers") == "High", "We take care of cost and effort"), other="It fits in with what you do already")
    rows = F.array(*[F.struct(F.lit(i).alias("message_rank"), F.lit(kind).alias("message_type"), text.alias("message")) for i, (kind, text) in enumerate((("Main", main), ("Support", support), ("Doubts", doubts)), 1)])
    return positions.select("segment", "working_name", F.explode(rows).alias("m")).select("segment", "working_name", "m.*")


def message_framework(positions: DataFrame) -> DataFrame:
    """The hierarchy with each segment's tone and what to avoid."""
    return message_hierarchy(positions).join(message_advice(positions), ["segment", "working_name"], "left")


def segment_actions(strategies: DataFrame, priorities: DataFrame) -> DataFrame:
    """segment, action_rank, action: what each step is about comes from the segment's strategy (strategy()) and priority."""
    s = strategies.join(priorities.select("segment", "priority"), "segment", "left")
    steps = (F.concat(F.lit("Brief the team: "), "core_problem"), F.concat(F.lit("Prepare the offer: "), "service"), F.concat(F.lit("Prepare the message: "), "message"), F.concat(F.lit("Open the channel: "), "channel"), F.concat(F.lit("Support the first step: "), "call_to_action"), F.concat(F.lit("Review at priority "), F.lower("priority")))
    return s.select("segment", F.explode(F.array(*[F.struct(F.lit(i).alias("action_rank"), x.alias("action")) for i, x in enumerate(steps, 1)])).alias("a")).select("segment", "a.*")


def segment_kpis(strategies: DataFrame) -> DataFrame:
    """segment, kpi_rank, kpi: measures of the segment's own objective, service and channel."""
    named = (F.concat(F.lit("Reach by "), F.lower("channel")), F.concat(F.lit("Response to: "), "message"), F.concat(F.lit("Starts of "), F.lower("service")), F.concat(F.lit("Objective met: "), "objective"))
    return strategies.select("segment", F.explode(F.array(*[F.struct(F.lit(i).alias("kpi_rank"), x.alias("kpi")) for i, x in enumerate(named, 1)])).alias("a")).select("segment", "a.*")
