"""Table and view declarations shared by every operator."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model.
DEFAULT_GC_GRACE = 864000  # seconds
MAX_TTL = 20 * 365 * 24 * 3600  # seconds
MAX_EXPIRY = 2147483646  # seconds since the epoch


def _clustering(items) -> tuple[tuple[str, str], ...]:
    out = []
    for item in items:
        name, direction = (item, "asc") if isinstance(item, str) else item
        if direction not in ("asc", "desc"):
            raise ValueError(f"clustering direction of {name} must be asc or desc")
        out.append((name, direction))
    return tuple(out)


@dataclass(frozen=True)
class TableSpec:
    """Partition key, clustering columns (with direction), statics and cells of a table."""

    partition_key: Sequence[str]
    clustering: Sequence = ()
    static: Sequence[str] = ()
    regular: Sequence[str] = ()
    default_ttl: int = 0
    gc_grace: int = DEFAULT_GC_GRACE
    name: str = "t"

    def __post_init__(self):
        if not self.partition_key:
            raise ValueError("a table needs at least one partition key column")
        object.__setattr__(self, "partition_key", tuple(self.partition_key))
        object.__setattr__(self, "clustering", _clustering(self.clustering))
        object.__setattr__(self, "static", tuple(self.static))
        object.__setattr__(self, "regular", tuple(self.regular))
        if not 0 <= self.default_ttl <= MAX_TTL:
            raise ValueError("default_ttl out of range")
        names = [*self.columns]
        if len(set(names)) != len(names):
            raise ValueError("duplicate column in table spec")

    @property
    def pk(self) -> list[str]:
        return list(self.partition_key)

    @property
    def ck(self) -> list[str]:
        return [name for name, _ in self.clustering]

    @property
    def key(self) -> list[str]:
        return self.pk + self.ck

    @property
    def columns(self) -> list[str]:
        """All columns in the order ``SELECT *`` shows them."""
        return self.pk + self.ck + list(self.static) + list(self.regular)

    def clustering_order(self, reverse: bool = False) -> list[Column]:
        """Sort columns for clustering order, or for the reversed order."""
        out = []
        for name, direction in self.clustering:
            ascending = (direction == "asc") != reverse
            out.append(F.col(name).asc() if ascending else F.col(name).desc())
        return out

    @property
    def mixed_order(self) -> bool:
        return len({direction for _, direction in self.clustering}) > 1


@dataclass(frozen=True)
class ViewSpec:
    """A denormalised projection of ``base`` keyed by other columns."""

    base: TableSpec
    partition_key: Sequence[str]
    clustering: Sequence = ()
    columns: Sequence[str] = ()
    where: Column | None = field(default=None, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "partition_key", tuple(self.partition_key))
        object.__setattr__(self, "clustering", _clustering(self.clustering))
        key = self.key
        missing = [c for c in self.base.key if c not in key]
        if missing:
            raise ValueError(f"view key must hold every base key column, missing {missing}")
        extra = [c for c in key if c not in self.base.key]
        if len(extra) > 1:
            raise ValueError(f"at most one non-key base column may enter a view key, got {extra}")
        if any(c in self.base.static for c in extra):
            raise ValueError("static columns cannot be part of a view key")
        columns = tuple(self.columns) or tuple(c for c in self.base.regular if c not in key)
        unknown = [c for c in (*key, *columns) if c not in self.base.columns]
        if unknown:
            raise ValueError(f"unknown view columns {unknown}")
        object.__setattr__(self, "columns", tuple(c for c in columns if c not in key))

    @property
    def key(self) -> list[str]:
        return list(self.partition_key) + [name for name, _ in self.clustering]

    @property
    def moved(self) -> str | None:
        """The base cell that became a key column of the view, if any."""
        return next((c for c in self.key if c not in self.base.key), None)

    def as_table(self) -> TableSpec:
        return TableSpec(self.partition_key, self.clustering, (), self.columns,
                         self.base.default_ttl, self.base.gc_grace, self.base.name + "_view")
