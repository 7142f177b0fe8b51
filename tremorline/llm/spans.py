"""Places of regular expressions in texts, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def places(text: Column, pattern: Column | str, kind: str, matches: Column, valid: Callable[[Column], Column]) -> Column:
    """An array of (start, kind, end) of the valid matches, in code points, end exclusive.

    ``matches`` are all matches in order; the stretches between them tell where they stand. Places are gathered as text,
    which grows by copying bytes, not structs.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    steps = F.zip_with(F.split(text, pattern, -1), matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        here = F.concat_ws(":", start, end)
        counts = x["match"].isNotNull() & valid(x["match"])
        return F.struct(end.alias("at"), F.when(counts, F.concat(state["found"], F.lit(","), here)).otherwise(state["found"]).alias("found"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("found"))
    found = F.aggregate(steps, start, step, lambda state: F.split(F.substring(state["found"], 2, 2147483647), ","))
    parsed = F.transform(
        F.filter(found, lambda x: x != ""),
        lambda x: F.struct(
            F.substring_index(x, ":", 1).cast("int").alias("start"),
            F.lit(kind).alias("kind"),
            F.substring_index(x, ":", -1).cast("int").alias("end"),
        ),
    )
    nothing = F.array().cast("array<struct<start:int,kind:string,end:int>>")
    return F.when(F.size(matches) > 0, parsed).otherwise(nothing)


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(spans: Column) -> Column:
    return F.sha2(written(spans).cast("binary"), 256)
