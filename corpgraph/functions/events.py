"""Executive-change events in alert lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpgraph.functions.common import collapse, sub, text_of

# Event sentences in order, with the fields that their groups fill.
EVENTS = [
    (r"(?i)^(.*?)(?: has joined the company as )(.+?)\.?$", "joined", ("executive_name", "new_position")),
    (r"(?i)^(.*?)(?: will join the company as )(.+?)(?: on .+?)?\.?$", "will_join", ("executive_name", "new_position")),
    (r"(?i)^(.*?), who was (.*?), is promoted to (.+?)\.?$", "promoted", ("executive_name", "old_position", "new_position")),
    (r"(?i)^(.*?)(?: who was )(.*?)(?:, becomes )(.+?)\.?$", "became", ("executive_name", "old_position", "new_position")),
    (r"(?i)^(.*?)(?: who is )(.*?)(?:, will be promoted to )(.+?)(?: on .+?)?\.?$", "will_be_promoted", ("executive_name", "old_position", "new_position")),
    (r"(?i)^(.*?)(?: who is )(.*?)(?:, will become )(.+?)(?: on .+?)?\.?$", "will_become", ("executive_name", "old_position", "new_position")),
    (r"(?i)^(.*?), (.*?), has left the company\.?$", "left", ("executive_name", "old_position")),
    (r"(?i)^(.*?), (.*?), will leave the company(?: on .+?)?\.?$", "will_leave", ("executive_name", "old_position")),
    (r"(?i)^(.*?), (.*?), will retire(?: on .+?)?\.?$", "will_retire", ("executive_name", "old_position")),
    (r"(?i)^(.*?), who is (.*?)(?: will soon retire)\.?$", "will_retire", ("executive_name", "old_position")),
]
FIELDS = ("executive_name", "old_position", "new_position")


def event_text(line: Column) -> Column:
    return sub(sub(sub(collapse(text_of(line)), r"\s+,", ","), r"\s+\.", "."), r"(?i)\(\s*posted on", "(posted on")


def parse_event(line: Column) -> Column:
    """struct of event_type, names and positions, dates and the cleaned line; ``unparsed`` if no sentence fits."""
    raw = event_text(line)
    core = F.trim(sub(raw, r"(?i)\s*\(posted on [^)]+\)\.?$", ""))
    trim = lambda c: F.regexp_replace(c, r"^[ ,.]+|[ ,.]+$", "")
    cases = []
    for pattern, kind, fields in EVENTS:
        at = {f: trim(F.regexp_extract(core, pattern, i + 1)) for i, f in enumerate(fields)}
        cases.append((core.rlike(pattern), F.struct(F.lit(kind).alias("event_type"), *[at.get(f, F.lit("")).alias(f) for f in FIELDS])))
    out = F.when(*cases[0])
    for cond, value in cases[1:]:
        out = out.when(cond, value)
    out = out.otherwise(F.struct(F.lit("unparsed").alias("event_type"), *[F.lit("").alias(f) for f in FIELDS]))
    effective = F.trim(F.regexp_extract(raw, r"\bon ([A-Z][a-z]{2,}\.? \d{1,2}, \d{4})\b", 1))
    posted = F.trim(F.regexp_extract(raw, r"(?i)\(posted on ([^)]+)\)", 1))
    return F.struct(out["event_type"].alias("event_type"), *[out[f].alias(f) for f in FIELDS], effective.alias("effective_date"), posted.alias("posted_date"), raw.alias("raw_event_text"))
