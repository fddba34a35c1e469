"""Settings of the sink."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from .functions.names import container_and_path, scheme


class ConfigError(ValueError):
    """Settings that cannot be used; ``errors`` has a message for each, by key."""

    def __init__(self, errors: Mapping[str, str]) -> None:
        super().__init__("; ".join(errors.values()))
        self.errors = dict(errors)


#: Key -> (kind, default, least value or choices). No default: the key is needed.
KEYS = {
    "storage.path": (str, None, None),
    "merge.keys": (list, [], None),
    "table.name": (str, "${topic}", None),
    "write.mode": (str, "cdc", ("append", "upsert", "cdc")),
    "merge.batch.size": (int, 50_000, 1),
    "merge.interval.ms": (int, 60_000, 1000),
    "merge.delete.enabled": (bool, True, None),
    "schema.evolution": (bool, True, None),
    "checkpoint.interval": (int, 10, 1),
    "cdc.envelope.format": (str, "debezium_full", ("debezium_full", "debezium_flattened")),
    "dead.letter.path": (str, "", None),
    "catalog.enabled": (bool, False, None),
    "catalog.name": (str, "", None),
    "catalog.schema": (str, "", None),
    "catalog.workspace.url": (str, "", None),
    "catalog.warehouse.id": (str, "", None),
    "catalog.token": (str, "", None),
    "catalog.sync.interval.ms": (int, 300_000, 10_000),
    "storage.auth": (str, "", ("", "key", "sas", "identity")),
    "storage.secret": (str, "", None),
}


def _read(key: str, raw: object) -> object:
    kind, _, limit = KEYS[key]
    if kind is list:
        value = [x.strip() for x in raw.split(",") if x.strip()] if isinstance(raw, str) else list(raw)
    elif kind is bool:
        if str(raw).lower() not in ("true", "false"):
            raise ValueError(f"{key} must be true or false")
        value = str(raw).lower() == "true"
    elif kind is int:
        try:
            value = int(raw)
        except (TypeError, ValueError):
            raise ValueError(f"{key} must be a whole number") from None
        if limit is not None and value < limit:
            raise ValueError(f"{key} must be at least {limit}")
    else:
        value = str(raw)
        if isinstance(limit, tuple) and value not in limit:
            raise ValueError(f"{key} must be one of {', '.join(limit)}")
    return value


@dataclass(frozen=True)
class Config:
    """Validated settings; use ``Config.of``."""

    values: Mapping[str, object]

    @classmethod
    def of(cls, given: Mapping[str, object]) -> Config:
        errors: dict[str, str] = {}
        values: dict[str, object] = {}
        for key, (_, default, _) in KEYS.items():
            if key in given:
                try:
                    values[key] = _read(key, given[key])
                except ValueError as e:
                    errors[key] = str(e)
            elif default is None:
                errors[key] = f"{key} is required"
            else:
                values[key] = default
        errors |= {k: f"{k} is not known" for k in given if k not in KEYS}
        if not errors:
            errors = cls._across(values)
        if errors:
            raise ConfigError(errors)
        return cls(values)

    @staticmethod
    def _across(v: Mapping[str, object]) -> dict[str, str]:
        """Rules between settings, each under the key it names first."""
        errors = {}
        if v["write.mode"] != "append" and not v["merge.keys"]:
            errors["merge.keys"] = f"merge.keys is required when write.mode is '{v['write.mode']}'"
        if v["catalog.enabled"]:
            errors |= {k: f"{k} is required when catalog.enabled is true" for k in ("catalog.name", "catalog.schema") if not str(v[k]).strip()}
        kind = scheme(str(v["storage.path"]))
        if kind in ("abfs", "abfss", "wasb", "wasbs"):
            try:
                container_and_path(str(v["storage.path"]))
            except ValueError as e:
                errors["storage.path"] = str(e)
            if v["storage.auth"] in ("key", "sas") and not v["storage.secret"]:
                errors["storage.secret"] = f"storage.secret is required when storage.auth is '{v['storage.auth']}'"
        return errors

    def __getitem__(self, key: str) -> object:
        return self.values[key]

    @property
    def deletes(self) -> bool:
        """Only change capture deletes; an upsert never does."""
        return self["write.mode"] == "cdc" and bool(self["merge.delete.enabled"])

    def hadoop_options(self) -> dict[str, str]:
        """Hadoop settings for the blob store that the path names."""
        path = str(self["storage.path"])
        if scheme(path) not in ("abfs", "abfss") or not self["storage.auth"]:
            return {}
        host = path.split("//", 1)[1].split("/", 1)[0].split("@")[-1]
        secret = str(self["storage.secret"])
        if self["storage.auth"] == "key":
            return {f"fs.azure.account.auth.type.{host}": "SharedKey", f"fs.azure.account.key.{host}": secret}
        if self["storage.auth"] == "sas":
            return {f"fs.azure.account.auth.type.{host}": "SAS", f"fs.azure.sas.fixed.token.{host}": secret}
        return {f"fs.azure.account.auth.type.{host}": "OAuth", f"fs.azure.account.oauth.provider.type.{host}": "org.apache.hadoop.fs.azurebfs.oauth2.MsiTokenProvider"}
