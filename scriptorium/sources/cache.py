"""Corpus cache: a text file and a sidecar per key; the sidecar is written last and is
the sign that the entry is whole."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import re
from dataclasses import asdict, dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class CacheMeta:
    provider: str
    key: str
    source: str
    fetched_at: str
    sha256: str
    size_bytes: int
    extras: dict[str, str] = field(default_factory=dict)


def safe_name(key: str) -> str:
    clean = re.sub(r'[<>:"/\\|?*\x00]', "_", key)
    if clean == key and len(key) <= 80:
        return key
    return clean[:60].rstrip("._-") + "-" + hashlib.sha256(key.encode()).hexdigest()[:16]


def key_of(provider: str, *parts: str) -> str:
    return f"{provider}-" + hashlib.sha256("|".join(parts).encode()).hexdigest()[:16]


class CacheStore:
    def __init__(self, root: str | Path):
        self.root = Path(root)

    def _paths(self, provider: str, key: str) -> tuple[Path, Path]:
        base = self.root / safe_name(provider) / safe_name(key)
        return Path(f"{base}.txt"), Path(f"{base}.meta.json")

    def read_meta(self, provider: str, key: str) -> CacheMeta | None:
        try:
            raw = json.loads(self._paths(provider, key)[1].read_text("utf-8"))
            return CacheMeta(**raw)
        except (OSError, ValueError, TypeError):
            return None

    def has(self, provider: str, key: str) -> bool:
        return self._paths(provider, key)[0].is_file() and self.read_meta(provider, key) is not None

    def read_text(self, provider: str, key: str) -> str | None:
        return self._paths(provider, key)[0].read_text("utf-8") if self.has(provider, key) else None

    def write(self, provider: str, key: str, text: str, source: str, extras: dict[str, str] | None = None) -> CacheMeta:
        body, side = self._paths(provider, key)
        body.parent.mkdir(parents=True, exist_ok=True)
        data = text.encode("utf-8")
        now = dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        meta = CacheMeta(provider, key, source, now, hashlib.sha256(data).hexdigest(), len(data), extras or {})
        for path, content in ((body, data), (side, json.dumps(asdict(meta), ensure_ascii=False).encode())):
            tmp = path.with_name(f"{path.name}.{os.getpid()}.tmp")
            tmp.write_bytes(content)
            os.replace(tmp, path)
        return meta

    def remove(self, provider: str, key: str) -> bool:
        body, side = self._paths(provider, key)
        there = side.exists() or body.exists()
        side.unlink(missing_ok=True)
        body.unlink(missing_ok=True)
        return there

    def keys(self, provider: str) -> list[str]:
        metas = sorted((self.root / safe_name(provider)).glob("*.meta.json"))
        return sorted(json.loads(m.read_text("utf-8"))["key"] for m in metas)
