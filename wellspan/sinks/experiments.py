"""Experiment folders: a name made of what is known, one JSON file, and who may write."""

from __future__ import annotations

import hashlib
import json
import os
import stat
from collections.abc import Mapping
from datetime import datetime

from ..functions.names import REQUIRED
from ..sources import files


def experiment_id(metadata: Mapping) -> str:
    """First 12 hexadecimal digits of the SHA-256 of the metadata as sorted JSON: equal data, equal id."""
    return hashlib.sha256(json.dumps(metadata, sort_keys=True).encode()).hexdigest()[:12]


def missing(metadata: Mapping) -> list[str]:
    """Labels of the required fields that are missing or empty."""
    return [label for field, label in REQUIRED.items() if not metadata.get(field)]


def register(root: str, metadata: Mapping, created: str | None = None) -> str:
    """Create an experiment's folder and return its path; the id doesn't depend on ``created`` (now, if it isn't given)."""
    if lacking := missing(metadata):
        raise ValueError(f"Missing required fields: {', '.join(lacking)}")
    folder = f"{root.rstrip('/')}/{experiment_id(metadata)}"
    written = dict(metadata) | {"created": created or datetime.now().isoformat()}
    files.write_bytes(f"{folder}/metadata.json", json.dumps(written, indent=2, ensure_ascii=False).encode())
    return folder


def set_writable(folder: str, writable: bool) -> None:
    """Let the owner write to a local folder, or nobody; others may read either way.  Stores without such rights are left alone."""
    if ":" not in folder or folder.startswith("file:"):
        _, path = files.filesystem(folder)
        read = stat.S_IRUSR | stat.S_IXUSR | stat.S_IRGRP | stat.S_IXGRP | stat.S_IROTH | stat.S_IXOTH
        os.chmod(path, read | (stat.S_IWUSR if writable else 0))
