"""Evaluation configurations: small, resolved on the driver."""

from __future__ import annotations

MISSING = object()


def dataset_list(config: dict | list) -> list[dict]:
    """Entries by name, or a list whose entries have names."""
    out = [{"name": k, **v} for k, v in config.items()] if isinstance(config, dict) else [dict(c) for c in config]
    if any(not c.get("name") for c in out):
        raise ValueError("every evaluation dataset needs a name")
    return out


def pairs(args: list[str], default: str = "aime") -> list[dict]:
    """``name path name path ...``; one value alone is the path of the default name."""
    if len(args) == 1:
        return [{"name": default, "path": args[0]}]
    if len(args) % 2:
        raise ValueError("evaluation datasets come as pairs of name and path")
    return [{"name": n, "path": p} for n, p in zip(args[::2], args[1::2], strict=True)]


def resolve(field: str, dataset: dict, defaults: dict, args: dict):
    """The first place that has the field, in the order dataset, defaults, arguments; an explicit None counts as there."""
    for place in (dataset, defaults, args):
        value = place.get(field, MISSING)
        if value is not MISSING:
            return value
    return None


def merged_metadata(metadata: dict | None, rm_type: str | None, overrides: dict | None) -> dict:
    """Row metadata, then the scorer's type, then overrides; the last wins."""
    return {**(metadata or {}), **({"rm_type": rm_type} if rm_type else {}), **(overrides or {})}


#: Most rows of a configuration table.
MOST_ROWS = 10_000


def table_rows(config, order: str) -> list:
    """All rows of a configuration table; more than ``MOST_ROWS`` are an error."""
    rows = config.orderBy(order).limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS:
        raise ValueError(f"a configuration of more than {MOST_ROWS} rows")
    return rows


def merged_column(metadata, rm_type, overrides):
    """:func:`merged_metadata` for columns of string maps."""
    from pyspark.sql import functions as F

    empty = F.create_map().cast("map<string,string>")
    typed = F.when(rm_type.isNotNull() & (rm_type != ""), F.create_map(F.lit("rm_type"), rm_type)).otherwise(empty)
    parts = [F.coalesce(metadata, empty), typed, F.coalesce(overrides, empty)]
    keys = F.array_distinct(F.flatten(F.array(*map(F.map_keys, parts))))
    # the last map that has the key
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.coalesce(*[F.try_element_at(p, k) for p in reversed(parts)])))
