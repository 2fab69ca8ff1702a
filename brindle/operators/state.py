"""The state table (object_type, id, state, ts, data): work queues, merges, and time to live.

``data`` is a JSON object, as text or as VARIANT (``as_variant`` makes one of the other).  A VARIANT is parsed when it is written, and queries take their fields from it by path without parsing the payload again;
a field of another type than is asked for is converted where that is possible, else null.  A state of an id is written once; later writes of it are ignored.  ``window_days`` of 0 is no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .durable import cut


def _scope(state: DataFrame, object_type: str | None, ids, window_days: int, as_of: Column | None) -> DataFrame:
    if object_type is not None and "object_type" in state.columns:
        state = state.where(F.col("object_type") == object_type)
    if ids is not None:
        state = state.where(F.col("id").isin(list(ids))) if not isinstance(ids, DataFrame) else state.join(ids, "id", "left_semi")
    if window_days:
        state = state.where(F.col("ts") >= as_of - F.expr(f"INTERVAL {window_days} DAYS"))
    return state


def _paged(df: DataFrame, limit: int, offset: int) -> DataFrame:
    if not (limit or offset):
        return df
    df = df.orderBy("ts", "id").offset(offset)
    return df.limit(limit) if limit else df


def _not_done(queue: DataFrame, state: DataFrame, exclude) -> DataFrame:
    exclude = [exclude] if isinstance(exclude, str) else list(exclude or ())
    if exclude:
        queue = queue.join(state.where(F.col("state").isin(exclude)).select("id"), "id", "left_anti")
    return queue


def get_one(state: DataFrame, include: str, exclude=None, *, object_type: str | None = None, ids=None, window_days: int = 0, as_of: Column | None = None, conditions: dict | None = None, limit: int = 0, offset: int = 0) -> DataFrame:
    """Rows in one state that are in none of the excluded ones; conditions are values, or lists of values, of payload fields."""
    everything = state if object_type is None else _scope(state, object_type, None, 0, None)
    rows = _scope(everything, None, ids, window_days, as_of).where((F.col("state") == include) & F.col("data").isNotNull())
    for name, value in (conditions or {}).items():
        found = field(name, "string", is_variant(state))
        rows = rows.where(found.isin([str(v) for v in value]) if isinstance(value, (list, tuple, set)) else found == str(value))
    return _paged(_not_done(rows, everything, exclude), limit, offset).select("id", "ts", "data")


def get_many(state: DataFrame, include: list[str], exclude=None, *, fields: dict[str, str], object_type: str | None = None, ids=None, window_days: int = 0, as_of: Column | None = None, limit: int = 0, offset: int = 0) -> DataFrame:
    """Ids that are in all of the included states and none of the excluded ones, with their payloads merged.

    ``fields`` gives the name and type of each payload field.  Of truthy values the one of the latest (ts, state) is taken: one aggregate, no list of payloads.
    """
    everything = state if object_type is None else _scope(state, object_type, None, 0, None)
    rows = _scope(everything, None, ids, window_days, as_of).where(F.col("state").isin(include) & F.col("data").isNotNull())
    rows = _not_done(rows, everything, exclude)
    if is_variant(state):
        made = rows.withColumn("_d", F.struct(*[F.try_variant_get("data", f"$['{k}']", v).alias(k) for k, v in fields.items()]))
    else:
        made = rows.withColumn("_d", F.from_json("data", ", ".join(f"`{k}` {v}" for k, v in fields.items())))
    at = F.struct("ts", "state")
    best = [F.max_by(F.when(truthy(F.col("_d")[k], v), F.col("_d")[k]), F.when(truthy(F.col("_d")[k], v), at)).alias(k) for k, v in fields.items()]
    merged = made.groupBy("id").agg(F.max("ts").alias("ts"), F.count(F.lit(1)).alias("_n"), *best).where(F.col("_n") >= len(include)).drop("_n")
    return _paged(merged, limit, offset)


def truthy(value: Column, kind: str) -> Column:
    """Not null, empty, zero or false."""
    kind = kind.lower()
    if kind.startswith(("array", "map")):
        return F.coalesce(F.size(value) > 0, F.lit(False))
    if kind == "string":
        return F.coalesce(value != "", F.lit(False))
    if kind == "boolean":
        return F.coalesce(value, F.lit(False))
    if kind in ("timestamp", "date") or kind.startswith("struct"):
        return value.isNotNull()
    return F.coalesce(value != 0, F.lit(False))


def put(state: DataFrame, items: DataFrame, state_name: str, *, object_type: str | None = None, as_of: Column | None = None, id_col: str = "id") -> DataFrame:
    """Rows to append for items reaching a state: those that had not; null and empty fields stay out of the payload."""
    others = [c for c in items.columns if c != id_col]
    kinds = dict(items.dtypes)
    payload = F.to_json(F.struct(*[F.when(truthy(F.col(c), kinds[c]), F.col(c)).alias(c) for c in others])) if others else F.lit("{}")
    made = items.select(F.col(id_col).cast("string").alias("id"), F.lit(state_name).alias("state"), (as_of if as_of is not None else F.current_timestamp()).alias("ts"), payload.alias("data"))
    if is_variant(state):
        made = made.withColumn("data", F.try_parse_json("data"))
    target = state
    if object_type is not None:
        made, target = made.withColumn("object_type", F.lit(object_type)), state.where(F.col("object_type") == object_type)
    return store.insert_ignore(target, made, ["id", "state"]).select(*[c for c in state.columns if c in made.columns])


def deduplicate(state: DataFrame, items: DataFrame, state_name: str, *, id_col: str = "id", arrival: str | None = None) -> DataFrame:
    """Items whose id has not reached the state; of several with one id the last to arrive."""
    order = [F.col(arrival).desc()] if arrival else None
    done = state.where(F.col("state") == state_name).select(F.col("id").alias(id_col))
    return store.first_of_batch(items, [id_col], order).join(done, id_col, "left_anti")


def expire(state: DataFrame, as_of: Column, window_days: int, *, keep_markers: bool = True) -> DataFrame:
    """Old payloads go; with keep_markers their rows stay, so the work is not done again."""
    if keep_markers:
        return store.ttl_null_out(state, "ts", "data", as_of, f"{window_days} DAYS")
    return store.ttl_retain(state, "ts", as_of, f"{window_days} DAYS")


def mark_done(state: DataFrame, ids: DataFrame, states: list[str], as_of: Column) -> DataFrame:
    """Rows to append that mark ids as done in several states, with empty payloads."""
    rows = ids.select(F.col("id").cast("string").alias("id"), F.explode(F.array(*[F.lit(s) for s in states])).alias("state"), as_of.alias("ts"), F.lit("{}").alias("data"))
    return store.insert_ignore(state, rows, ["id", "state"])


def field(name: str, kind: str, variant: bool = False) -> Column:
    """A payload field by path (``a.b`` is b inside a), for conditions."""
    if variant:
        return F.try_variant_get("data", "$" + "".join(f"['{p}']" for p in name.split(".")), kind)
    return F.get_json_object("data", f"$.{name}").cast(kind)


def is_variant(state: DataFrame) -> bool:
    return dict(state.dtypes).get("data") == "variant"


def as_variant(state: DataFrame) -> DataFrame:
    """The table with payloads parsed once; text that is no JSON is null."""
    return state if is_variant(state) else state.withColumn("data", F.try_parse_json("data"))


def batches(rows: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Number the rows' batches of a fixed size in this order.  Rows are sorted by ranges and written; a range numbers its own rows, and the ranges' sizes (a row each) give where each begins."""
    at = F.monotonically_increasing_id()  # the range in the high bits, the place in it in the low 33
    placed = cut(rows.orderBy(*order).withColumn("_at", at))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    begin, starts = 0, []
    for r in placed.groupBy(part.alias("p")).count().orderBy("p").collect():
        starts += [F.lit(r["p"]), F.lit(begin)]
        begin += r["count"]
    first = F.element_at(F.create_map(*starts), part) if starts else F.lit(0)
    return placed.withColumn("batch", F.floor((first + place) / size)).drop("_at")
