"""The kind protocol: what a feature kind brings to the engine.

The built-in kinds share one pane aggregate and differ in their roll-ups.  A
kind from outside (:func:`register_kind`) brings all four parts:

* ``validate``     -- a spec's error, or None (X3: an invalid spec affects no other);
* ``pane.partial`` -- the pane aggregate over routed rows, giving a binary state per
  (entity, feature, sub key, pane);
* ``pane.combine`` -- the associative aggregate that merges states: of coarser panes,
  of the stream's batches, of late events;
* ``rollup``       -- pane table -> feature rows (see ``rollup_states`` for look-backs of
  mergeable states).

It then runs in batch, in the stream, at every cadence and through every sink like
the others.  Register a kind before its specs are compiled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class PaneState:
    """The pane level of a kind; ``val`` is a row's field (text), ``field_type`` its declared type."""

    keep: Callable[[], Column]       # which routed rows contribute
    sub_key: Callable[[], Column]    # text that splits a pane's state, so that none grows without bound
    partial: Callable[[], Column]    # aggregate of routed rows -> binary
    combine: Callable[[str], Column]  # aggregate of a column of states -> binary
    read: Callable[[Column], Column] = lambda state: state  # what look-backs merge in place of states
    merge: Callable[[str], Column] | None = None  # plain aggregate function of a column of them; None: ``combine``


@dataclass(frozen=True)
class FeatureKind:
    """``applies`` picks the compiled specs the kind serves; ``rollup(panes, specs, pane_ms, tz, clock_field)`` gives their features."""

    name: str
    applies: Callable[[object], bool]
    rollup: Callable[..., DataFrame]
    validate: Callable[[dict], str | None] = lambda spec: None
    pane: PaneState | None = None    # None: the pane level that the built-in kinds share


#: Roll-ups by name, each run only when a spec needs it.
KIND_REGISTRY: dict[str, FeatureKind] = {}


def register_kind(kind: FeatureKind) -> FeatureKind:
    """Add a kind; a kind with a pane level of its own serves the specs whose ``configType`` is its name."""
    known = KIND_REGISTRY.get(kind.name)
    if known is not None and (known.pane is None) != (kind.pane is None):
        raise ValueError(f"{kind.name} is a built-in kind")
    KIND_REGISTRY[kind.name] = kind
    return kind


def added_kind(name: str | None) -> FeatureKind | None:
    """The registered kind of this name that has a pane level of its own."""
    kind = KIND_REGISTRY.get(name)
    return kind if kind is not None and kind.pane is not None else None


def added_kinds(names) -> list[FeatureKind]:
    return [k for k in map(added_kind, sorted(names)) if k is not None]
