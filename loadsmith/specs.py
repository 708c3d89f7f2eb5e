"""Declarative specifications for the dimension operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TrackedAttribute:
    """One type-6 attribute: incoming column, current column, history column."""

    source: str
    current: str
    history: str
    route: str  # route name when only this attribute changed


@dataclass(frozen=True)
class Type6Spec:
    """Hybrid slowly changing dimension with current/historical attribute pairs.

    null_policy: ``ignore`` (a NULL on either side is "no change"),
    ``distinct`` (null-safe comparison) or ``fail`` (raise on a NULL compare).
    batch_dedup: ``none`` (every incoming row is applied), ``latest`` (keep the
    latest row per key by ``source_date`` then ``dedup_order``) or ``error``.
    dedupe_reference: use one active row per key (lowest surrogate) for the
    lookup, as a lookup with duplicate reference keys does.
    broadcast_batch_rows: when the batch (counted) or the inserts (known exactly)
    have at most this many rows, their keys are broadcast and the active rows are
    only scanned, never shuffled; 0 leaves every join strategy to Catalyst.
    Used when the active rows are estimated above ``large_active_bytes``
    (below that there is no shuffle worth saving).
    """

    key: str = "ID"
    surrogate: str = "Emp_Key"
    carried: tuple[str, ...] = ("Name",)
    tracked: tuple[TrackedAttribute, ...] = (
        TrackedAttribute("City", "CURRENTCity", "HESTORICALCity", "city"),
        TrackedAttribute("Email", "CURRENTEmail", "HESTORICALEmail", "email"),
    )
    source_date: str = "Update_Date"
    start: str = "STARTDate"
    end: str = "ENDDate"
    flag: str = "Active_Flag"
    null_policy: str = "ignore"
    batch_dedup: str = "none"
    dedup_order: tuple[str, ...] = ()
    dedupe_reference: bool = True
    key_type: str = "bigint"
    broadcast_batch_rows: int = 200_000
    large_active_bytes: int = 64 << 20
    new_route: str = "new"
    all_route: str = "both"
    none_route: str = "none"

    @property
    def dim_columns(self) -> list[str]:
        cols = [self.surrogate, self.key, *self.carried]
        for t in self.tracked:
            cols += [t.current, t.history]
        return cols + [self.start, self.end, self.flag]

    @property
    def changed_routes(self) -> list[str]:
        return [t.route for t in self.tracked] + [self.all_route]


@dataclass(frozen=True)
class VersionedSpec:
    """Versioned dimension: one tracked date and a version counter.

    version_rule: ``reference`` (date changed -> 1, same date -> old + 1,
    every matched member re-versioned) or ``conventional`` (changed -> old + 1,
    same date -> no new version).
    """

    key: str = "ID"
    surrogate: str = "Emp_Key"
    attributes: tuple[str, ...] = ("Name", "City", "Email")
    date: str = "Schedule_Date"
    flag: str = "Active_Flag"
    version: str = "Version_No"
    null_policy: str = "ignore"
    batch_dedup: str = "none"
    dedup_order: tuple[str, ...] = ()
    dedupe_reference: bool = True
    key_type: str = "bigint"
    broadcast_batch_rows: int = 200_000
    large_active_bytes: int = 64 << 20
    version_rule: str = "reference"
    new_route: str = "new"
    changed_route: str = "changed"
    same_route: str = "same"

    @property
    def dim_columns(self) -> list[str]:
        return [self.surrogate, self.key, *self.attributes, self.date, self.flag,
                self.version]


@dataclass(frozen=True)
class DocumentSpec:
    """How to turn JSON documents into rows.

    array_path: dotted path of the array to explode (``products`` for
    ``$.products[*]``); parents: root scalars carried beside each element
    (prefixed with ``parent_prefix``).  ``first_rows`` keeps the first N elements
    of all documents together.
    """

    schema: str
    array_path: str
    parents: tuple[str, ...] = ()
    parent_prefix: str = "P_"
    include_parents_when_child_missing: bool = False
    keep_position: bool = False
    extra: dict = field(default_factory=dict)
