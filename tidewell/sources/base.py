"""Sources: each gives users, items, interactions and, if it has them, related items, as plans in one contract."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.contracts import log

_REGISTRY: dict[str, type[Source]] = {}


class Source(ABC):
    """Subclasses read; the getters keep the plan, not the data."""

    def __init__(self, spark: SparkSession, config: dict | None = None):
        self.spark, self.config, self._plans = spark, dict(config or {}), {}

    @abstractmethod
    def load_users(self) -> DataFrame: ...

    @abstractmethod
    def load_items(self) -> DataFrame: ...

    @abstractmethod
    def load_interactions(self) -> DataFrame: ...

    def load_co_occurrence(self) -> DataFrame | None:
        return None

    def validate_config(self) -> None:
        return None

    def get(self, table: str) -> DataFrame | None:
        if table not in self._plans:
            self._plans[table] = getattr(self, f"load_{table}")()
        return self._plans[table]

    def get_users(self) -> DataFrame:
        return self.get("users")

    def get_items(self) -> DataFrame:
        return self.get("items")

    def get_interactions(self) -> DataFrame:
        return self.get("interactions")

    def get_co_occurrence(self) -> DataFrame | None:
        return self.get("co_occurrence")

    def schema_info(self) -> dict[str, list[str] | None]:
        """Column names of each table; None for one that can't be read."""
        out = {}
        for t in ("users", "items", "interactions", "co_occurrence"):
            try:
                df = self.get(t)
                out[t] = df.columns if df is not None else None
            except Exception as e:
                log.warning("%s can't be read: %s", t, e)
                out[t] = None
        return out

    def need(self, *keys: str) -> None:
        missing = [k for k in keys if not self.config.get(k)]
        if missing:
            raise ValueError(f"{type(self).__name__} needs {', '.join(missing)}")


def register(name: str, cls: type[Source] | None = None):
    """Register a source under a name, without regard to case; also a decorator."""

    def put(c: type[Source]) -> type[Source]:
        _REGISTRY[name.lower()] = c
        return c

    return put(cls) if cls else put


def create(name: str, spark: SparkSession, config: dict | None = None) -> Source:
    if name.lower() not in _REGISTRY:
        raise ValueError(f"no source {name!r}; there are {', '.join(names())}")
    return _REGISTRY[name.lower()](spark, config)


def names() -> list[str]:
    return sorted(_REGISTRY)


def to_seconds(c: Column, form: str = "ms") -> Column:
    """Unix seconds: 's' as it is, 'datetime' parsed, 'ms' divided where larger than 10^12."""
    if form == "datetime":
        return F.unix_timestamp(F.try_to_timestamp(c.cast("string")))
    n = c.try_cast("long")
    return n if form == "s" else F.when(n > 10**12, F.floor(n / 1000)).otherwise(n)


def liked(rating: Column, like: float, dislike: float) -> Column:
    """like from `like` on, dislike up to `dislike`, else neutral (also without rating)."""
    return F.when(rating >= like, "like").when(rating <= dislike, "dislike").otherwise("neutral")


def mapped(c: Column, table: dict[str, str], default: Column) -> Column:
    if not table:
        return default
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), c), default)


@register("memory")
class Memory(Source):
    """Tables that are already frames, for tests and for chaining runs. config: users, items, interactions, co_occurrence; users and items are derived where they are missing."""

    def load_interactions(self) -> DataFrame:
        self.need("interactions")
        return self.config["interactions"]

    def load_users(self) -> DataFrame:
        given = self.config.get("users")
        return given if given is not None else self.get_interactions().select("user_id").where("user_id is not null").distinct()

    def load_items(self) -> DataFrame:
        given = self.config.get("items")
        return given if given is not None else self.get_interactions().select("item_id").where("item_id is not null").distinct()

    def load_co_occurrence(self) -> DataFrame | None:
        return self.config.get("co_occurrence")

    def need(self, *keys: str) -> None:
        missing = [k for k in keys if self.config.get(k) is None]
        if missing:
            raise ValueError(f"Memory needs {', '.join(missing)}")
