"""Nested paths and type coercion for raw items (a VARIANT column)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlens import config as cfg


def json_path(path: str) -> str:
    """``answers.0`` -> ``$.answers[0]``."""
    steps = (f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))
    return "$" + "".join(steps)


def get_path(item: Column | str, path: str | None, to: str = "string") -> Column:
    """Value at a dotted path; any miss on the way is null."""
    if path is None:
        return F.lit(None).cast(to)
    return F.try_variant_get(item, json_path(path), to)


def get_present(item: Column | str, path: str) -> Column:
    """The VARIANT at a path, with JSON null as SQL null."""
    v = get_path(item, path, "variant")
    return F.when(~F.is_variant_null(v), v)


# The characters that count as white space.
WHITE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim every kind of white space."""
    return F.trim(c, F.lit(WHITE))


def to_float(c: Column) -> Column:
    """Keep digits and points, then parse: ``-1`` is 1, ``4.5/5`` is 4.55, ``1.2.3`` is null."""
    return F.nullif(F.regexp_replace(c, r"[^0-9.]", ""), F.lit("")).try_cast("double")


def to_int(c: Column) -> Column:
    """Keep digits, then parse: ``4.0`` is 40."""
    return F.nullif(F.regexp_replace(c, r"[^0-9]", ""), F.lit("")).try_cast("bigint")


def to_bool(c: Column) -> Column:
    return F.lower(c).isin(*cfg.TRUE_WORDS)


def to_str(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def to_utc_date(c: Column) -> Column:
    """Calendar date in UTC of each value on its own; unparseable is null."""
    return F.to_date(F.try_to_timestamp(c))


COERCE = {cfg.FLOAT: to_float, cfg.INT: to_int, cfg.BOOL: to_bool, cfg.STR: to_str}


def by_source(actor: Column, choose) -> Column:
    """One CASE over the source layouts, so all sources go through a single scan."""
    branches = [(actor == F.lit(key), choose(layout)) for key, layout in cfg.LAYOUTS.items()]
    return reduce(lambda acc, b: acc.when(*b), branches[1:], F.when(*branches[0]))


def mapped_field(item: Column, actor: Column, name: str) -> Column:
    """A unified field, read and coerced from whichever layout the row has."""
    kind = cfg.UNIFIED_FIELDS[name]
    null = F.lit(None).cast(cfg.SPARK_TYPES[kind])
    raw = by_source(
        actor, lambda lay: get_path(item, lay.fields[name]) if name in lay.fields else F.lit(None).cast("string")
    )
    if not any(name in lay.fields for lay in cfg.LAYOUTS.values()):
        return null
    return COERCE[kind](raw)


def bonus_json(item: Column, actor: Column) -> Column:
    """Source extras as JSON text keyed by the last path step, in declared order, absent ones left out."""
    return by_source(
        actor,
        lambda lay: F.to_json(
            F.struct(*[get_present(item, path).alias(key) for path, key in zip(lay.bonus, lay.bonus_keys)])
        ),
    )


def platform(item: Column, actor: Column) -> Column:
    """Platform of the row: per record for the multi-platform source, else the source's own."""

    def choose(lay: cfg.SourceLayout) -> Column:
        own = F.lit(lay.platform)
        if lay.platform_path is None:
            return own
        raw = F.nullif(get_path(item, lay.platform_path), F.lit(""))
        known = F.create_map(*[F.lit(x) for kv in cfg.PLATFORMS.items() for x in kv])
        return F.coalesce(F.try_element_at(known, raw), F.lower(raw), own)

    return by_source(actor, choose)


def stable_id(native, product_id, reviewer_name, review_date, likes, dislikes) -> Column:
    """Native id, else a hash over fields that do not change between scrapes (null hashes as ``None``)."""

    def text(c: Column, n: int | None = None) -> Column:
        c = F.coalesce(c, F.lit("None"))
        return F.substring(c, 1, n) if n else c

    seed = F.concat_ws(
        "|", text(product_id), text(reviewer_name), text(review_date), text(likes, 100), text(dislikes, 100)
    )
    return F.coalesce(F.nullif(native, F.lit("")), F.concat(F.lit("hash-"), F.substring(F.sha2(seed, 256), 1, 16)))


def confidence(columns: list[str] = cfg.CONFIDENCE_FIELDS) -> Column:
    """Share of key fields that are filled, two decimals."""
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])
    n = len(columns)
    return F.floor(filled * F.lit(100.0) / F.lit(float(n)) + F.lit(0.5)).cast("double") / F.lit(100.0)


# -- bonus data read back ----------------------------------------------------


def bonus_text(bonus: Column, key: str) -> Column:
    return F.try_variant_get(bonus, f"$.{key}", "string")


def incentivized(review_type: Column) -> Column:
    return F.coalesce(review_type.isin(*cfg.INCENTIVIZED_TYPES), F.lit(False))


def switched_products(bonus: Column) -> Column:
    """Prior product names joined with `` | ``; the value may be an object with a list or a bare list."""
    kind = "array<struct<name string>>"
    items = F.coalesce(
        F.try_variant_get(bonus, "$.switched_from.products", kind), F.try_variant_get(bonus, "$.switched_from", kind)
    )
    names = F.filter(F.transform(items, lambda p: p["name"]), lambda n: n.isNotNull())
    return F.when(F.size(names) > 0, F.array_join(names, " | "))


def switched_reason(bonus: Column) -> Column:
    return F.nullif(F.try_variant_get(bonus, "$.switched_from.reason", "string"), F.lit(""))
