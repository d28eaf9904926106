"""Where a lake reads from and what its tables are called."""

from __future__ import annotations

from dataclasses import dataclass

LAYERS = ("bronze", "silver", "gold")

# The layout of the source data set under its root. Only the readings are many
# files; the others are named one by one because files of another shape lie beside them.
SOURCE_FILES = {
    "readings": "halfhourly/*.csv",
    "households": "households/informations_households.csv",
    "holidays": "calendar/uk_bank_holidays.csv",
    "weather": "weather/weather_daily_darksky.csv",
}


def object_store_root(account: str, container: str) -> str:
    return f"abfss://{container}@{account}.dfs.core.windows.net"


def volume_root(catalog: str, schema: str, volume: str = "raw") -> str:
    return f"/Volumes/{catalog}/{schema}/{volume}"


@dataclass(frozen=True)
class LakeConfig:
    """``source_root`` is any URI Spark can read; tables are ``[catalog.]namespace_layer.name``.

    ``table_root`` places the tables' files; without it they go to the warehouse of the session.
    ``table_format`` is any installed format: parquet comes with Spark, delta needs its package.
    Tables by meter have so many ``buckets``, one per 200 MB of the fact or so; a table's last ``kept_versions``
    replaced versions stay, for readers that began before the switch.
    """

    source_root: str
    namespace: str = "meterlake"
    source_folder: str = ""
    catalog: str | None = None
    table_root: str | None = None
    table_format: str = "parquet"
    buckets: int = 8
    kept_versions: int = 1

    def source_path(self, source: str) -> str:
        parts = [self.source_root.rstrip("/"), self.source_folder.strip("/"), SOURCE_FILES[source]]
        return "/".join(part for part in parts if part)

    def schema(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        name = f"{self.namespace}_{layer}"
        return f"{self.catalog}.{name}" if self.catalog else name

    def versions(self, layer: str) -> str:
        """The schema of the tables behind the names of a layer."""
        return f"{self.schema(layer)}_versions"

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema(layer)}.{name}"

    def location(self, layer: str, name: str) -> str | None:
        return f"{self.table_root.rstrip('/')}/{layer}/{name}" if self.table_root else None
