"""JSON, arrays and maps as Column expressions. Malformed JSON is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_json(t: Column) -> Column:
    """Whether a text is JSON; null and blank texts are not."""
    return F.coalesce(F.try_parse_json(t).isNotNull() & (F.trim(t) != ""), F.lit(False))


def is_json_object(t: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(t)).startswith("OBJECT"), F.lit(False))


def parsed_or_empty(t: Column) -> Column:
    """A map of the members of a JSON object as texts, empty for anything else."""
    empty = F.create_map().cast("map<string,string>")
    return F.when(is_json_object(t), F.coalesce(F.from_json(t, "map<string,string>"), empty)).otherwise(empty)


def canonical(t: Column) -> Column:
    """JSON in one form: no blanks, keys in order at every depth, numbers without useless digits; null for what is no JSON."""
    return F.to_json(F.try_parse_json(t))


def extra_keys(t: Column, allowed: list[str]) -> Column:
    """Keys of a JSON object that aren't allowed, in order."""
    return F.array_sort(F.array_except(F.map_keys(parsed_or_empty(t)), F.array(*map(F.lit, allowed))))


def pointer(t: Column, path: str) -> Column:
    """The text at a JSON pointer (``~1`` is /, ``~0`` is ~), null where it leads nowhere."""
    parts = [p.replace("~1", "/").replace("~0", "~") for p in path.split("/")[1:]]
    where = "$" + "".join(f"[{p}]" if p.isdigit() else f"['{p}']" for p in parts)
    return F.try_variant_get(F.try_parse_json(t), where, "string")


def first_mismatch(a: Column, b: Column) -> Column:
    """0-based place of the first differing item of two arrays, their shorter size if one begins the other, null if equal."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    at = F.array_position(same, F.lit(False))
    return F.when(a == b, None).when((at > 0) & (at <= n), (at - 1).cast("long")).otherwise(n.cast("long"))


def map_difference(a: Column, b: Column) -> Column:
    """Struct of the keys missing in ``b``, extra in ``b``, and different in both, each sorted."""
    ka, kb = F.map_keys(a), F.map_keys(b)
    other = F.filter(F.array_intersect(ka, kb), lambda k: ~F.element_at(a, k).eqNullSafe(F.element_at(b, k)))
    return F.struct(F.array_sort(F.array_except(ka, kb)).alias("missing"), F.array_sort(F.array_except(kb, ka)).alias("extra"), F.array_sort(other).alias("different"))


def masked_labels(ids: Column, prefix: Column, most: int, width: int) -> Column:
    """The last ``most`` ids with -100 for what belongs to the prefix, padded with -100 to ``width``."""
    n = F.size(ids)
    cut = F.greatest(n - most, F.lit(0))
    kept = F.slice(ids, cut + 1, F.lit(most))
    labels = F.transform(kept, lambda x, i: F.when(i + cut < prefix, F.lit(-100)).otherwise(x))
    return F.concat(labels, F.array_repeat(F.lit(-100).cast("int"), F.greatest(F.lit(width) - F.size(kept), F.lit(0))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, null if one has no length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
