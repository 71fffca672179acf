"""Data Vault loaders: (stage rows, target rows so far) -> rows to append.

Every loader is repeatable: what the target already holds is not returned again. Rows of
a batch are reduced to distinct ones before anything is joined, so a business key that
fills a third of the batch is combined on the map side, except where rows are dealt by key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tonearm.functions.keys import SOURCE, hash_key, hash_uniform, row_hash, text_form
from tonearm.functions.ranking import ranked
from tonearm.plans.specs import LoadSpec
from tonearm.sources.store import KEY_PART, KEY_PARTS, month_of, part_of

#: Rows that are new, and the columns of the target made of them: hashed keys are made last, behind all shuffles.
Fresh = tuple[DataFrame, Mapping[str, Column | str]]

# fixed values: price rules of the subscription table
BASIC_COST = (8.0, 15.0)
PREMIUM_FACTOR = (1.1, 1.6)
ROYALTY = (0.01, 0.1)
PREMIUM_ROYALTY_FACTOR = 1.2


def not_in(new: DataFrame, target: DataFrame | None, keys: Sequence[str], sure: Sequence[str] = ()) -> DataFrame:
    """Rows of `new` whose key is not in `target`; missing key fields are equal to each other. Those named
    in `sure` are never missing, so that rows dealt by them need no other shuffle.

    The target is first cut to the keys of the batch. For a small batch that semi join
    broadcasts the batch and reads the target once without shuffling it, where a plain
    anti join would shuffle the whole target; a large batch shuffles on the same key.
    """
    if target is None:
        return new
    equal = lambda k, known: F.col(k) == known if k in sure else F.col(k).eqNullSafe(known)
    same = reduce(and_, [equal(k, F.col("_known_" + k)) for k in keys])
    known = target.select(*[F.col(k).alias("_known_" + k) for k in keys])
    known = known.join(new.select(*keys), same, "left_semi")
    return new.join(known, same, "left_anti")


def within_batch_months(stage: DataFrame, target: DataFrame | None, spec: LoadSpec) -> DataFrame | None:
    """Target rows of the months that the batch has; a stored target skips the files of all others.

    The months are named one by one (a few numbers reach the driver), so that one event that is
    years late adds its own month and not those between.
    """
    if target is None or "actual_month" not in target.columns:
        return target
    month = month_of(F.expr(spec.fields["actual_dtm"])).alias("month")
    return target.where(F.col("actual_month").isin([row.month for row in stage.select(month).distinct().collect()]))


def within_batch_parts(keys: Column, rows: DataFrame, target: DataFrame | None) -> DataFrame | None:
    """Target rows of the key parts that the batch has; a stored target skips the files of all others.

    The parts are a handful of small numbers, and only these reach the driver.
    """
    if target is None or KEY_PART not in target.columns:
        return target
    parts = [row.part for row in rows.select(part_of(keys).alias("part")).distinct().collect()]
    return target if len(parts) == KEY_PARTS else target.where(F.col(KEY_PART).isin(parts))


def _key(spec: LoadSpec, source: str) -> Column:
    return hash_key([text_form(F.col(p)) for p in spec.parts], source)


def _complete(stage: DataFrame, spec: LoadSpec) -> DataFrame:
    """Rows without a business key cannot be addressed; the stage keeps them in quarantine."""
    return stage.dropna(subset=list(spec.parts))


def _batch(stage: DataFrame, spec: LoadSpec) -> DataFrame:
    """Business key parts (prefixed) and derived columns."""
    parts = [F.col(p).alias("_" + p) for p in spec.parts]
    fields = [F.expr(sql).alias(name) for name, sql in spec.fields.items()]
    return _complete(stage, spec).select(*parts, *fields)


def _batch_key(spec: LoadSpec, source: str) -> Column:
    return hash_key([text_form(F.col("_" + p)) for p in spec.parts], source)


def _keyed(rows: DataFrame, key: Column, placed: bool) -> DataFrame:
    """Each different row once, with its key as `_key`. With `placed` one shuffle, of the short ids that the key
    is made of, serves both this and joins on the key; copies meet behind it instead of on the map side. The
    hashed keys, which don't compress, are made on either side of that shuffle and don't go through it."""
    if placed:
        return rows.repartition(key).withColumn("_key", key).distinct()
    return rows.distinct().withColumn("_key", key)


def new_hub(stage: DataFrame, target: DataFrame | None, spec: LoadSpec, source: str = SOURCE) -> Fresh:
    (part,) = spec.parts
    keys = _complete(stage, spec).select(F.col(part).cast("string").alias("original_id")).distinct()
    key = hash_key([F.col("original_id")], source)
    fresh = not_in(keys, within_batch_parts(key, keys, target), ["original_id"])
    return fresh, {spec.key: key, "original_id": "original_id", "source": F.lit(source)}


def new_link(
    stage: DataFrame, target: DataFrame | None, spec: LoadSpec, source: str = SOURCE, placed: bool = False
) -> Fresh:
    """New links. `placed` deals them by their key while they are still the short ids they came with, so that
    a join on the key, or several, needs no shuffle of the hashed keys, which don't compress. The look-up in the
    target is such a join."""
    key = _key(spec, source)
    hashed = {name: hash_key([text_form(F.col(part))], source) for part, name in zip(spec.parts, spec.part_names)}
    rows = _complete(stage, spec).select(*spec.parts).distinct()
    target = within_batch_parts(key, rows, target)
    if target is not None:
        rows = not_in(rows.repartition(key).withColumn("_key", key), target.select(F.col(spec.key).alias("_key")), ["_key"], sure=["_key"])
    elif placed:
        rows = rows.repartition(key)
    return rows.select(*spec.parts), {spec.key: key, **hashed}


def new_lsat(
    stage: DataFrame,
    target: DataFrame | None,
    spec: LoadSpec,
    source: str = SOURCE,
    published: bool = False,
    placed: bool = False,
) -> Fresh:
    """New facts. A fact is known if all its fields are, so that the result doesn't depend on how the
    stream was cut into batches; `published` knows a fact by its key and moment alone. `placed` deals
    them by their key. Where earlier facts are looked up, keys go through the shuffle as bytes."""
    target = within_batch_months(stage, target, spec)
    own = {**{f: f for f in spec.fields}, "source": F.lit(source)}
    if target is None or "actual_month" in target.columns and target.isEmpty():
        rows = _keyed(_batch(stage, spec), _batch_key(spec, source), placed)
        if placed:
            return rows, {spec.key: "_key", **own}
        return rows.drop("_key"), {spec.key: _batch_key(spec, source), **own}
    rows = _batch(stage, spec).distinct().select(F.unbase64(_batch_key(spec, source)).alias("_key"), *spec.fields)
    known = target.withColumn("_key", F.unbase64(spec.key))
    keys = ["_key", "actual_dtm"] if published else ["_key", *spec.fields]
    return not_in(rows, known, keys, sure=["_key"]), {spec.key: F.base64("_key"), **own}


def latest_version(sat: DataFrame, key: str) -> DataFrame:
    """Last version per key. The rank filter is applied per partition before the shuffle."""
    order = [F.desc("actual_dtm")] + ([F.asc("row_hash")] if "row_hash" in sat.columns else [])
    return ranked(sat, [key], order, "_rnum").where(F.col("_rnum") <= 1).drop("_rnum")


def new_sat(
    stage: DataFrame,
    target: DataFrame | None,
    spec: LoadSpec,
    source: str = SOURCE,
    corrected: bool = False,
    published: bool = False,
) -> Fresh:
    """New versions of the attributes of a hub; versions are compared per key.

    With `published` a version counts as known if any key has an equal row hash, which loses
    versions between batches. `corrected` fills missing fields from the last version of the
    same key; as published, that version is looked up by the raw id among hashed ids, which
    finds nothing.
    """
    fields = list(spec.fields)
    rows = _batch(stage, spec).distinct()
    if target is None:
        made = {spec.key: _batch_key(spec, source), **{f: f for f in fields}, "row_hash": row_hash(rows, fields, source)}
        return rows, made | {"source": F.lit(source)}
    rows = rows.select(_batch_key(spec, source).alias(spec.key), *fields)
    if not published:
        target = within_batch_parts(F.col(spec.key), rows, target)
    if corrected:
        touched = target.join(rows.select(spec.key), spec.key, "left_semi")
        previous = latest_version(touched, spec.key).select(
            spec.key, *[F.col(f).alias("_prev_" + f) for f in fields]
        )
        rows = rows.join(previous, spec.key, "left").select(
            spec.key, *[F.coalesce(f, "_prev_" + f).alias(f) for f in fields]
        )
    rows = rows.withColumn("row_hash", row_hash(rows, fields, source)).withColumn("source", F.lit(source))
    fresh = not_in(rows, target, ["row_hash"] if published else [spec.key, "row_hash"])
    return fresh, {c: c for c in fresh.columns}


def subscription_cost(
    stage: DataFrame, target: DataFrame | None, spec: LoadSpec, source: str = SOURCE, seed: str = "0"
) -> DataFrame:
    """A Basic and a Premium price row per enabled country, drawn repeatably from its code."""
    code = F.col("country_code")

    def between(bounds: tuple[float, float], name: str) -> Column:
        low, high = bounds
        return hash_uniform(code, name, seed) * F.lit(high - low) + F.lit(low)

    def money(amount: Column) -> Column:
        return F.round(amount, 2).cast("decimal(5,2)")

    def offer(kind: str, cost: str, royalty: str) -> Column:
        return F.struct(
            F.lit(kind).alias("subscription_type"),
            F.col(cost).alias("subscription_cost"),
            F.col(royalty).alias("royalty"),
        )

    enabled = _complete(stage, spec).groupBy(code).agg(F.min("event_time").alias("enabled_dt"))
    priced = (
        not_in(enabled, target, ["country_code"])
        .withColumn("_cost", money(between(BASIC_COST, "basic")))
        .withColumn("_royalty", money(between(ROYALTY, "royalty")))
        .withColumn("_premium", money(F.col("_cost").cast("double") * between(PREMIUM_FACTOR, "factor")))
        .withColumn("_extra", money(F.col("_royalty").cast("double") * F.lit(PREMIUM_ROYALTY_FACTOR)))
    )
    offers = F.array(offer("Basic", "_cost", "_royalty"), offer("Premium", "_premium", "_extra"))
    return priced.select(code, "enabled_dt", F.inline(offers)).withColumn("source", F.lit(source))


def load_genres(stage: DataFrame, target: DataFrame | None, spec: LoadSpec, source: str = SOURCE) -> DataFrame:
    (part,) = spec.parts
    fields = [F.expr(sql).alias(name) for name, sql in spec.fields.items()]
    rows = _complete(stage, spec).select(F.col(part).alias(spec.key), *fields, F.lit(source).alias("source"))
    return not_in(rows.distinct(), target, [spec.key])


def new_ref(stage: DataFrame, target: DataFrame | None, spec: LoadSpec, source: str = SOURCE) -> Fresh:
    loader = {"ref_country_subscription_cost": subscription_cost, "ref_genre": load_genres}[spec.target]
    rows = loader(stage, target, spec, source)
    return rows, {c: c for c in rows.columns}


LOADERS = {"hub": new_hub, "sat": new_sat, "link": new_link, "lsat": new_lsat, "ref": new_ref}


def fresh_rows(spec: LoadSpec, stage: DataFrame, target: DataFrame | None = None, **options) -> Fresh:
    return LOADERS[spec.kind](stage, target, spec, **options)


def load(spec: LoadSpec, stage: DataFrame, target: DataFrame | None = None, **options) -> DataFrame:
    rows, made = fresh_rows(spec, stage, target, **options)
    return rows.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in made.items()])
