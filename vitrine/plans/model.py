"""The normalised tables that the plans read."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession


class Collection(Mapping[str, DataFrame]):
    """Named tables, each opened on first use.

    ``hierarchy(id, parentid, name, pos, primarytype, isversion)`` maps a
    record's id to its external id (csid) and links a parent to the ordered
    members of its repeating groups.  ``misc(id, lifecyclestate)`` holds the
    soft-delete flag and ``relations`` the typed edges between csids.  The other
    names are record tables, group tables and list tables keyed by ``id``.
    """

    def __init__(self, openers: Mapping[str, Callable[[], DataFrame]], lacks: Iterable[str] = ()):
        self._openers = dict(openers)
        self._lacks = frozenset(lacks)
        self._open: dict[str, DataFrame] = {}
        self._kept: dict[str, object] = {}

    @classmethod
    def of(cls, **tables: DataFrame) -> Collection:
        return cls({name: (lambda df=df: df) for name, df in tables.items()})

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> Collection:
        """Tables of the session catalog: ``{"objects": "db.objects_common", ...}``."""
        return cls({k: (lambda t=t: spark.table(t)) for k, t in names.items()})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._openers[name]()
        return self._open[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError as missing:
            raise AttributeError(name) from missing

    def keep(self, name: str, make: Callable[[], object]):
        """What ``make`` gives, made once for this collection: an index over its tables."""
        if name not in self._kept:
            self._kept[name] = make()
        return self._kept[name]

    def is_open(self, name: str) -> bool:
        return name in self._open

    def with_tables(self, **tables: DataFrame) -> Collection:
        """The same collection with some tables replaced or added."""
        return self.adding(**{n: (lambda df=df: df) for n, df in tables.items()})

    def adding(self, **openers: Callable[[], DataFrame]) -> Collection:
        """The same collection with further tables, each opened on first use."""
        return Collection({**{n: (lambda n=n: self[n]) for n in self}, **openers}, self._lacks)

    def lacking(self, *names: str) -> Collection:
        """The same collection, with tables that it is known not to have; plans leave out what they would hold."""
        return Collection({n: (lambda n=n: self[n]) for n in self}, self._lacks | set(names))

    def has(self, name: str) -> bool:
        """Whether a table that a plan can do without is there; one that is neither there nor declared as lacking is an error."""
        if name not in self and name not in self._lacks:
            raise KeyError(f"the collection has no table {name}; if it is not to have one, say so with lacking({name!r})")
        return name in self

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)
