"""Settings: dataclasses from YAML files that inherit, with dotted overrides."""

from __future__ import annotations

import dataclasses
import os
from typing import Any

import yaml


def merged(base: dict, over: dict) -> dict:
    """Mappings merge, everything else (lists too) is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load(path: str, overrides: list[str] | None = None, _seen: tuple[str, ...] = ()) -> dict[str, Any]:
    """A YAML file over the one that its ``_base`` names, with overrides such as ``embed.batch=4``."""
    path = os.path.abspath(path)
    if path in _seen:
        raise ValueError(f"{path} inherits from itself")
    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    base = data.pop("_base", None)
    if base:
        data = merged(load(os.path.join(os.path.dirname(path), base), None, (*_seen, path)), data)
    for o in overrides or []:
        keys, _, value = o.partition("=")
        leaf: Any = yaml.safe_load(value)
        for k in reversed(keys.split(".")):
            leaf = {k: leaf}
        data = merged(data, leaf)
    return data


def typed(kind: type, data: dict[str, Any]):
    """A dataclass from a mapping; unknown keys are an error."""
    fields = {f.name: f for f in dataclasses.fields(kind)}
    unknown = set(data) - set(fields)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    make = {k: typed(fields[k].default_factory, v) if isinstance(v, dict) and dataclasses.is_dataclass(fields[k].default_factory) else v for k, v in data.items()}
    return kind(**make)


@dataclasses.dataclass
class ParseConfig:
    backend: str = "local"
    min_chars: int = 50
    extensions: tuple[str, ...] = (".pdf", ".docx", ".doc")


@dataclasses.dataclass
class ExtractConfig:
    run_generic: bool = True
    run_site: bool = True


@dataclasses.dataclass
class EmbedConfig:
    model_id: str = "local/hashing-64"
    chunking: str = "sentence"
    max_seq: int = 8192
    safety: int = 512
    chars_per_token: float = 2.0
    overlap_tokens: int = 256
    batch: int = 8


@dataclasses.dataclass
class ReduceConfig:
    methods: tuple[str, ...] = ("pca", "tsne", "umap")
    n_components: int = 2
    cluster: bool = True


@dataclasses.dataclass
class SiteConfig:
    host: str = "example.org"
    output_root: str = "data"
    parse: ParseConfig = dataclasses.field(default_factory=ParseConfig)
    extract: ExtractConfig = dataclasses.field(default_factory=ExtractConfig)
    embed: EmbedConfig = dataclasses.field(default_factory=EmbedConfig)
    reduce: ReduceConfig = dataclasses.field(default_factory=ReduceConfig)

    def path(self, kind: str) -> str:
        """Where a site's files of a kind are: pdf, html, md, jsonl, embeddings, reduced, logs."""
        sub = {"embeddings": "parquet/embeddings", "reduced": "parquet/reduced"}.get(kind, kind)
        return f"{self.output_root.rstrip('/')}/{self.host}/{sub}"
