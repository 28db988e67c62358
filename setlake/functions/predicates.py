"""Predicates and labels as Catalyst expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entity types of an identity, projects and relation types that count (fixed values).
ENTITY_TYPES = ("way", "relation")
PROJECTS = ("wikipedia", "wikivoyage")
RELATION_TYPES = ("multipolygon", "boundary")
#: Category labels in the order of reports (fixed values).
CATEGORIES = ("neither", "website_only", "wikidata_only", "both")
RING_RULES = ("first3", "distinct3")


def text_present(text: Column) -> Column:
    """Whether something is left after trimming Unicode space separators; a null is blank, a line feed is not. Looks no further than the first such character."""
    return F.coalesce(text, F.lit("")).rlike(r"[^\p{Zs}]")


def successful(status: Column, text: Column, ok: str) -> Column:
    """A status that equals ``ok``, case-sensitively, with text present."""
    return (status == ok) & text_present(text)


def any_successful(*pairs: tuple[Column, Column], ok: str) -> Column:
    """Whether any (status, text) pair is successful within itself."""
    return reduce(lambda a, b: a | b, (successful(s, t, ok) for s, t in pairs))


def valid_identity(kind: Column, ident: Column) -> Column:
    return kind.isin(*ENTITY_TYPES) & (ident > 0)


def closed_ring(refs: Column, rule: str = "first3") -> Column:
    """Whether node references close a ring.

    ``first3``: the first three differ from each other and the last is the first. ``distinct3``: at
    least four references, last equal to first, three distinct ones before the last.
    """
    if rule not in RING_RULES:
        raise ValueError(f"unknown ring rule: {rule!r}")
    first, last = F.get(refs, F.lit(0)), F.try_element_at(refs, F.lit(-1))
    if rule == "first3":
        second, third = F.get(refs, F.lit(1)), F.get(refs, F.lit(2))
        rest = (F.size(refs) >= 3) & (first != second) & (first != third) & (second != third)
    else:
        body = F.slice(refs, F.lit(1), F.greatest(F.size(refs) - 1, F.lit(0)))
        rest = (F.size(refs) >= 4) & (F.size(F.array_distinct(body)) >= 3)
    return F.coalesce(rest & (first == last), F.lit(False))


def area_relation(tags: Column) -> Column:
    """Whether any ``type`` tag, among an array of (k, v), names an area; exact case."""
    return F.coalesce(F.exists(tags, lambda t: (t["k"] == "type") & t["v"].isin(*RELATION_TYPES)), F.lit(False))


def category(in_a: Column, in_b: Column, labels: tuple[str, str, str, str] = CATEGORIES) -> Column:
    """The label of two memberships; ``labels`` in the order neither, first only, second only, both."""
    neither, a_only, b_only, both = labels
    return F.when(in_a & in_b, both).when(in_a, a_only).when(in_b, b_only).otherwise(neither)


def shard(kind: Column, ident: Column, shards: int) -> Column:
    """A stable shard number of a key."""
    return F.pmod(F.xxhash64(F.concat_ws(":", kind, ident.cast("string"))), F.lit(shards)).cast("int")


@dataclass(frozen=True, slots=True)
class Flags:
    """Two memberships of one identity, outside Spark."""

    website: bool
    wikidata: bool

    @property
    def category(self) -> str:
        return CATEGORIES[bool(self.website) + 2 * bool(self.wikidata)]


@dataclass(frozen=True, slots=True, order=True)
class Identity:
    """A validated key, outside Spark."""

    osm_type: str
    osm_id: int

    def __post_init__(self) -> None:
        if self.osm_type not in ENTITY_TYPES:
            raise ValueError(f"unsupported entity type: {self.osm_type!r}")
        if self.osm_id <= 0:
            raise ValueError(f"identity must be positive: {self.osm_id}")

    @property
    def key(self) -> tuple[str, int]:
        return self.osm_type, self.osm_id
